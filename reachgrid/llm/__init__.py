"""Operators of a training-data pipeline: deduplication, packing, tokens, files,
personal data, quality rules and nearest neighbours."""
