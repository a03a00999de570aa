"""The jobs: log health, delivery, reviews, marts and quality reports."""
