"""Scoring of logs as they arrive with models fitted in batch."""
