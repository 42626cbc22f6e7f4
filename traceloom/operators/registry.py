"""Registry tables as append-only versions: selectors, lineage, prices, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.functions.text import bucket
from traceloom.operators.ordered import carried


class NoMatch(LookupError):
    """Nothing fits a selector."""


class Ambiguous(LookupError):
    """More than one row fits a selector that names one."""


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key. An aggregate, so partial maxima are taken before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``new`` rows replace ``old`` ones of the same keys."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def insert_new(old: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of ``batch`` whose key isn't stored, the first of each key."""
    first = batch.groupBy(key).agg(F.min_by(F.struct(*[c for c in batch.columns if c != key]), order).alias("_r")).select(key, "_r.*")
    return first.join(old.select(key), key, "left_anti").select(*batch.columns)


def only(df: DataFrame):
    """The single row; NoMatch or Ambiguous otherwise."""
    rows = df.limit(2).collect()
    if not rows:
        raise NoMatch("no row fits")
    if len(rows) > 1:
        raise Ambiguous("several rows fit")
    return rows[0]


def best_by(df: DataFrame, metric: str, started: str) -> DataFrame:
    """The row with the largest metric, the newest of equals; rows without a metric never win."""
    return df.where(F.col(metric).isNotNull()).orderBy(F.desc(metric), F.desc(started)).limit(1)


def tail(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The newest n rows, oldest first."""
    return df.orderBy(*(F.desc(c) for c in order)).limit(n).orderBy(*order)


def lineage(df: DataFrame, id_col: str, parent_col: str, depth: int = 20) -> DataFrame:
    """``id, ancestor, hops`` along parent pointers; a cycle ends at ``depth``."""
    df.select(F.col(id_col).alias("id"), F.col(parent_col).alias("parent")).createOrReplaceTempView("_lineage")
    return df.sparkSession.sql(
        f"""with recursive up(id, ancestor, hops) as (
          select id, parent, 1 from _lineage where parent is not null
          union all select up.id, l.parent, hops + 1 from up join _lineage l on l.id = up.ancestor where l.parent is not null and hops < {depth})
        select id, ancestor, hops from up"""
    )


def price_at(facts: DataFrame, prices: DataFrame, keys: list[str], at: str, since: str, value: str) -> DataFrame:
    """Each fact with the price in force at its time: the newest of the key that starts no later. Facts and prices of a key
    merge into one ordered run, dealt by ranges, so no pair of rows is built that is not used and no key is one task's."""
    f = facts.select("*", F.col(at).alias("_t"), F.lit(1).alias("_o"), F.lit(None).cast(prices.schema[value].dataType).alias("_v"))
    p = prices.select(*keys, F.col(since).alias("_t"), F.lit(0).alias("_o"), F.col(value).alias("_v"))
    both = carried(f.unionByName(p, allowMissingColumns=True), keys, ["_t", "_o"], "_v", value)
    return both.where("_o = 1").select(*facts.columns, value)


def differing(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose values differ between two flat tables, missing ones included."""
    x, y = a.select(key, F.col(value).alias("left_value")), b.select(key, F.col(value).alias("right_value"))
    return x.join(y, key, "full").where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def stable_split(df: DataFrame, key, share: float, salt: str = "17") -> DataFrame:
    """Adds ``test``: a hash split that no repartitioning changes."""
    return df.withColumn("test", bucket(F.concat(F.lit(salt + "|"), key.cast("string")), 1_000_000) < int(share * 1_000_000))


def set_hash(ids) -> object:
    """First twelve hex digits of sha256 over a sorted set."""
    return F.substring(F.sha2(F.to_json(F.array_sort(F.collect_set(ids))), 256), 1, 12)
