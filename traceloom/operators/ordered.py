"""Ranks, running sums and carried values over whole tables in order, without one task holding a key.

Rows are dealt by range of (keys, order) and written out; each range works on its own, and what comes before it is added from a
table with one row a range and key. Rows that are equal in keys and order lie in one range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from traceloom.operators.similarity import written


def _ranges(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return written(df.repartitionByRange(n, *keys, *order).withColumn("_range", F.spark_partition_id()))


def running(df: DataFrame, keys: list[str], order: list[str], value, name: str, ties: list[str] | None = None) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the key's rows before this one, and ``name_all``: over all rows of the key.
    ``ties``: further columns that order rows equal in ``order``."""
    return running_sums(df, keys, order, {name: value}, ties)


def running_sums(df: DataFrame, keys: list[str], order: list[str], values: dict, ties: list[str] | None = None) -> DataFrame:
    """As :func:`running`, for several values by name in one pass."""
    names = list(values)
    dealt = _ranges(df.withColumns({f"_value_{x}": v for x, v in values.items()}), keys, order)
    by = [*keys, "_range"]
    sums = dealt.groupBy(*by).agg(*(F.sum(f"_value_{x}").alias(f"_sum_{x}") for x in names))
    own = Window.partitionBy(*keys)
    earlier = own.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(f"_sum_{x}").over(earlier), F.lit(0)).alias(f"_before_{x}") for x in names]
    offsets = sums.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_range").alias("_r"), *before, *(F.sum(f"_sum_{x}").over(own).alias(f"{x}_all") for x in names))
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy(*by).orderBy(*order, *(ties or [])).rowsBetween(Window.unboundedPreceding, -1)
    held = dealt.withColumns({f"_inside_{x}": F.coalesce(F.sum(f"_value_{x}").over(inside), F.lit(0)) for x in names})
    out = held.join(F.broadcast(offsets), same)  # a row a range and key
    out = out.withColumns({x: F.col(f"_before_{x}") + F.col(f"_inside_{x}") for x in names})
    return out.select(*df.columns, *(c for x in names for c in (x, f"{x}_all")))


def carried(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the last value of ``value`` that isn't null among the key's rows up to this one."""
    dealt = _ranges(df, keys, order)
    by = [*keys, "_range"]
    last = dealt.where(F.col(value).isNotNull()).groupBy(*by).agg(F.max_by(value, F.struct(*order)).alias("_last"))
    every = dealt.select(*by).distinct().join(last, by, "left")
    before = F.last("_last", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    ends = every.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_range").alias("_r"), before.alias("_before"))
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_k{i}"))
    inside = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = dealt.withColumn("_inside", F.last(value, ignorenulls=True).over(inside)).join(F.broadcast(ends), same, "left")  # a row a range and key
    return out.withColumn(name, F.coalesce("_inside", "_before")).select(*df.columns, name)
