"""Operators for training-data pipelines: text scoring, filtering, redaction, joins, search and tokenisation."""
