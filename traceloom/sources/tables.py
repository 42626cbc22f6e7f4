"""Parquet table access: column pruning at the scan, no schema inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from traceloom.session import workers_find_package


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read ``{sf_dir}/{name}.parquet``; only ``columns`` when given, so the scan is pruned."""
    workers_find_package(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df
