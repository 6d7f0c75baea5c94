"""Operators of a training-data pipeline: deduplication, decontamination, classifiers, redaction, mixing, extraction."""
