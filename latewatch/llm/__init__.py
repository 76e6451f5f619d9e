"""Operators of a training-data pipeline: extraction, scans, scores, de-duplication, encoding."""
