"""Operations of a training-data pipeline: deduplication, scoring, search, tokens and packing."""
