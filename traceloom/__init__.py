"""Spark-first analytics for agent traces: curation, evaluation, statistics, routing and cost."""
