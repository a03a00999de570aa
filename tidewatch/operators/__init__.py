"""Reusable DataFrame operators: joins, selections, models, checks."""
