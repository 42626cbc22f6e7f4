"""Row and group filters of the curation chain. Every filter gives a reason column: null keeps the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Canonical order of the stages, whatever order a configuration names them in.
STAGES = ["outcome", "schema_valid", "no_error_loops", "length", "teacher", "quality_judge", "exact_dedupe", "near_dedupe", "decontaminate", "pii", "stratify"]


def outcome_reason(success) -> Column:
    return F.when(success, None).when(success.isNull(), "no recorded outcome").otherwise("task failed")


def length_reason(n, least: int = 2, most: int = 40) -> Column:
    return F.when(n < least, F.concat(F.lit("too short: "), n.cast("string"), F.lit(" turns"))).when(n > most, F.concat(F.lit("too long: "), n.cast("string"), F.lit(" turns")))


def teacher_reason(model, allowed: list[str]) -> Column:
    """An empty list keeps all."""
    return F.when(~F.coalesce(model.isin(allowed), F.lit(False)), "teacher not allowed") if allowed else F.lit(None).cast("string")


def quality_reason(score, least: float = 3.0) -> Column:
    """An unscored row is kept."""
    return F.when(score < least, "judge score below minimum")


def reason_key(reason) -> Column:
    """Reasons that differ in numbers only count as one."""
    return F.regexp_replace(reason, r"\d+(\.\d+)?", "N")


def run_stages(df: DataFrame, reasons: list[tuple[str, Column]]) -> DataFrame:
    """Adds ``drop_stage`` and ``drop_reason``: the first stage, in order, that drops the row. One projection, no passes."""
    stage = reason = F.lit(None).cast("string")
    for name, why in reversed(reasons):
        stage, reason = F.when(why.isNotNull(), name).otherwise(stage), F.coalesce(why, reason)
    return df.withColumns({"drop_stage": stage, "drop_reason": reason})


def stage_counts(staged: DataFrame, names: list[str]) -> DataFrame:
    """``stage, n_in, n_dropped, n_out`` from one aggregate, a row for each stage in order."""
    place = F.coalesce(F.expr(" ".join(["case drop_stage", *(f"when '{n}' then {i}" for i, n in enumerate(names)), "end"])), F.lit(len(names)))
    counts = staged.agg(*(F.count(F.when(place >= i, 1)).alias(f"i{i}") for i in range(len(names) + 1)))
    rows = [F.struct(F.lit(n).alias("stage"), F.col(f"i{i}").alias("n_in"), (F.col(f"i{i}") - F.col(f"i{i + 1}")).alias("n_dropped"), F.col(f"i{i + 1}").alias("n_out")) for i, n in enumerate(names)]
    return counts.select(F.inline(F.array(*rows)))


def reason_histogram(staged: DataFrame, example, order) -> DataFrame:
    """Dropped rows by stage and reason key, with the first example."""
    return staged.where("drop_reason is not null").groupBy("drop_stage", reason_key(F.col("drop_reason")).alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.min_by(example, order).alias("example"))


def exact_dedupe(df: DataFrame, key: str, order: str, id_col: str) -> DataFrame:
    """Adds ``survivor``: the id of the key's first row in ``order``. An aggregate with partial sums and a join, so a key
    that a third of the rows share isn't sorted in one task, as a window would."""
    first = df.groupBy(F.col(key).alias("_k")).agg(F.min_by(F.col(id_col), F.col(order)).alias("survivor"))
    return df.join(first, F.col(key) == F.col("_k"), "left").drop("_k")


def keep_per_group(df: DataFrame, group: str, order: list, n: int) -> DataFrame:
    """The first n rows of each group in ``order``; rows without a group form group -1. A top-n filter is pushed below the
    shuffle by the optimiser, so a hot group sends n rows a task."""
    g = F.coalesce(F.col(group), F.lit(-1))
    w = Window.partitionBy(g).orderBy(*order)
    return df.withColumn("rank_in_group", F.row_number().over(w)).where(F.col("rank_in_group") <= n)


def runs_of(df: DataFrame, key: str, order: list, state) -> DataFrame:
    """Longest run of rows of one ``state`` per key: ``key, state, longest``."""
    whole, same = Window.partitionBy(key).orderBy(*order), Window.partitionBy(key, "_s").orderBy(*order)
    marked = df.withColumn("_s", state).withColumn("_g", F.row_number().over(whole) - F.row_number().over(same))
    lengths = marked.groupBy(key, "_s", "_g").agg(F.count(F.lit(1)).alias("n"))
    return lengths.groupBy(key, F.col("_s").alias("state")).agg(F.max("n").alias("longest"))


def coverage(before: DataFrame, after: DataFrame, cluster: str, sparse: int = 10) -> DataFrame:
    """Rows per cluster before and after, and whether it is sparse after."""
    a = before.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_before"))
    b = after.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_after"))
    n = F.coalesce("n_after", F.lit(0))
    return a.join(b, cluster, "full").select(cluster, F.coalesce("n_before", F.lit(0)).alias("n_before"), n.alias("n_after"), (n < sparse).alias("sparse"))


def top_frequencies(df: DataFrame, value: str, order: str, k: int) -> DataFrame:
    """The k most frequent values; ties go to the one seen first in ``order``."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_seen")).orderBy(F.desc("n"), "first_seen").limit(k)


def retire_partition(df: DataFrame, stamp, retired_at, cutoff) -> DataFrame:
    """``state``: already retired, retired (older than the cutoff, or without a readable time) or kept."""
    return df.withColumn("state", F.when(retired_at.isNotNull(), "already").when(stamp.isNull() | (stamp < cutoff), "retired").otherwise("kept"))


def tag_matches(tag, pattern: str) -> Column:
    """Equality, or a shell glob if the pattern holds any of ``*?[``."""
    import fnmatch

    return tag.rlike(fnmatch.translate(pattern).replace("(?s:", "^(?s:").replace("\\Z", "$").replace("\\z", "$")) if any(c in pattern for c in "*?[") else tag == pattern


def unpaired_calls(calls: DataFrame, answers: DataFrame) -> DataFrame:
    """Calls without a later answer and answers without an earlier call, by trace and call id: ``trace, call_id, problem``."""
    c, r = calls.select("trace", "call_id", F.col("turn").alias("ct")), answers.select("trace", "call_id", F.col("turn").alias("rt"))
    both = c.join(r, ["trace", "call_id"], "full")
    problem = F.when(F.col("rt").isNull(), "call without result").when(F.col("ct").isNull() | (F.col("rt") <= F.col("ct")), "result without call")
    return both.select("trace", "call_id", problem.alias("problem")).where("problem is not null")
