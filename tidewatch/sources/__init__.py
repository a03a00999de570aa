"""Readers, writers, catalog helpers and generated inputs."""
