"""Operators of a training-data pipeline: filters, near duplicates, scoring and token output for text corpora."""
