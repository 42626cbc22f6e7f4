"""Evaluation tables: aggregates over tasks and repeats, replay look-ups, pairs, labels and divergences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from traceloom.operators.ordered import running
from traceloom.operators.similarity import written


def task_means(rows: DataFrame, by: list[str], value) -> DataFrame:
    """Mean of tasks' means: a task with many repeats counts once. Null counts as 0."""
    x = F.coalesce(value.cast("double"), F.lit(0.0))
    return rows.groupBy(*by, "task_id").agg(F.avg(x).alias("m")).groupBy(*by).agg(F.avg("m").alias("mean"), F.count(F.lit(1)).alias("n_tasks"))


def run_aggregate(rows: DataFrame, run: str = "run") -> DataFrame:
    """Per run: success over tasks' means, row means of validity, medians of size, and the largest repeat count."""
    tasks = rows.groupBy(run, "task_id").agg(F.avg(F.coalesce(F.col("success").cast("double"), F.lit(0.0))).alias("m"), F.count(F.lit(1)).alias("n"))
    top = tasks.groupBy(run).agg(F.avg("m").alias("success"), F.count(F.lit(1)).alias("n_tasks"), F.max("n").alias("n_per_task"))
    rest = rows.groupBy(run).agg(F.avg((F.col("kind") != "view").cast("double")).alias("schema_valid"), F.median("turns").alias("turns"), F.median("tokens").alias("tokens"))
    return top.join(rest, run)


def throughput(rows: DataFrame, by: str, tokens, milliseconds) -> DataFrame:
    """Tokens a second from sums; null where no time passed."""
    ms = F.sum(milliseconds)
    return rows.groupBy(by).agg(F.when(ms > 0, F.sum(tokens) / (ms / 1000)).alias("tokens_per_second"))


def replay_index(calls: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first recorded call of each key."""
    return calls.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in calls.columns if c not in keys]), F.struct(*order)).alias("first")).select(*keys, "first.*")


def replay(wanted: DataFrame, index: DataFrame, keys: list[str], answer: str) -> DataFrame:
    """Adds the recorded answer and ``served``: replayed or diverged. The index is unique in ``keys``, so rows stay rows."""
    return wanted.join(index.select(*keys, F.col(answer).alias("answer")), keys, "left").withColumn("served", F.when(F.col("answer").isNull(), "diverged").otherwise("replayed"))


def nearest_call(wanted: DataFrame, recorded: DataFrame, tool: str, tokens: str, order: str, threshold: float = 0.92, others: bool = False) -> DataFrame:
    """For each wanted call (id, unique) the recorded call (``order``, unique) of the same tool with the most similar argument tokens, the
    smallest of equally similar ones. With ``others`` a call isn't compared with the recorded one of its own number.

    Calls of one tool with equal tokens are one while pairs are searched: sets that share a token meet on (tool, token) and similarity
    follows from counts. A set keeps its first two recorded calls, and its two best ones, since at most one is a call's own."""
    key = F.array_sort(tokens).alias("_s")
    w, r = wanted.select("id", tool, key), recorded.select(F.col(order).alias("ord"), tool, key)
    most = 2 if others else 1
    first = Window.partitionBy(tool, "_s").orderBy("ord")
    rs = r.withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= most).groupBy(tool, "_s").agg(F.array_sort(F.collect_list("ord")).alias("ords"))
    ws = w.groupBy(tool, "_s").agg(F.min("id").alias("_w"))
    x = ws.select(tool, "_w", F.size("_s").alias("nw"), F.explode("_s").alias("t"))
    y = rs.select(tool, "ords", F.size("_s").alias("nr"), F.explode("_s").alias("t"))
    both = x.join(y, [tool, "t"]).groupBy("_w", "ords").agg(F.count(F.lit(1)).alias("i"), F.first("nw").alias("nw"), F.first("nr").alias("nr"))
    scored = both.select("_w", (F.col("i") / (F.col("nw") + F.col("nr") - F.col("i"))).alias("score"), F.explode("ords").alias("ord"))
    nearest = Window.partitionBy("_w").orderBy(F.desc("score"), "ord")
    best = scored.withColumn("_k", F.row_number().over(nearest)).where(F.col("_k") <= most).groupBy("_w").agg(F.array_sort(F.collect_list(F.struct("_k", "score", "ord"))).alias("b"))
    met = w.join(ws, [tool, "_s"]).join(best, "_w")
    if others:
        met = met.withColumn("b", F.filter("b", lambda c: c["ord"] != F.col("id")))
    got = met.select("id", F.get("b", F.lit(0)).alias("b")).where("b is not null")
    return got.select("id", "b.score", "b.ord", (F.col("b.score") >= threshold).alias("served"))


def first_divergence(a: DataFrame, b: DataFrame, key: str, also: list[str] | None = None) -> DataFrame:
    """The first turn at which two trajectories differ in role, content (a null one reads as empty) or a column of ``also``, such as
    the signature of a turn's calls, if the roles there are both assistant; none if one is the other's beginning."""
    said = F.struct(F.coalesce("text", F.lit("")), *(also or []))
    x = a.select(key, "turn", F.col("role").alias("ra"), said.alias("ta"))
    y = b.select(key, "turn", F.col("role").alias("rb"), said.alias("tb"))
    differs = ~F.col("ra").eqNullSafe(F.col("rb")) | ~F.col("ta").eqNullSafe(F.col("tb"))
    first = x.join(y, [key, "turn"]).where(differs).groupBy(key).agg(F.min_by(F.struct("turn", "ra", "rb"), "turn").alias("d"))
    return first.select(key, F.when((F.col("d.ra") == "assistant") & (F.col("d.rb") == "assistant"), F.col("d.turn")).alias("turn"))


def tried_pairs(rows: DataFrame, cap: int = 4, judge=None) -> DataFrame:
    """Pairs of a success and a failure of one task, in order of the success, then the failure, up to the ``cap``-th valid one of a
    task: ``task_id, chosen, rejected, why, k``; k counts the valid ones so far. ``judge`` takes pairs and adds ``why``, null for
    a valid pair; without it all are valid.

    Each round pairs twice as many successes as the one before with all failures of their task, only for tasks that still
    lack pairs and have further successes; so a task's cross product is built only as far as its pairs need it."""
    order = Window.partitionBy("task_id").orderBy("id")
    good = written(rows.where("success").select("task_id", F.col("id").alias("chosen"), F.row_number().over(order).alias("g")))
    bad = written(rows.where("not success").select("task_id", F.col("id").alias("rejected")))
    open_ = written(good.groupBy("task_id").agg(F.max("g").alias("most")).join(bad.select("task_id").distinct(), "task_id").withColumn("have", F.lit(0).cast("long")))
    judge = judge or (lambda p: p.withColumn("why", F.lit(None).cast("string")))
    found, done, width = judge(good.join(bad, "task_id").select("task_id", "chosen", "rejected").limit(0)), 0, 1
    while open_.limit(1).count():
        some = good.where((F.col("g") > done) & (F.col("g") <= done + width)).join(open_, "task_id").join(bad, "task_id")
        new = written(judge(some.select("task_id", "chosen", "rejected")))
        found = found.unionByName(new)
        more = open_.join(new.where("why is null").groupBy("task_id").agg(F.count(F.lit(1)).alias("new")), "task_id", "left").withColumn("have", F.col("have") + F.coalesce("new", F.lit(0))).drop("new")
        done, width = done + width, width * 2
        open_ = written(more.where((F.col("have") < cap) & (F.col("most") > done)))
    valid = F.col("why").isNull().cast("int")
    k = F.sum(valid).over(Window.partitionBy("task_id").orderBy("chosen", "rejected"))
    return found.withColumn("k", k.cast("int")).where(F.col("k") - valid < cap)


def success_failure_pairs(rows: DataFrame, cap: int = 4, judge=None) -> DataFrame:
    """The valid ones of :func:`tried_pairs`."""
    return tried_pairs(rows, cap, judge).where("why is null").select("task_id", "chosen", "rejected", "k")


def balance_kinds(pairs: DataFrame, kind: str, order: str, ratio: float) -> DataFrame:
    """Keeps the first teacher pairs, at most ``ratio`` times the rollout pairs; all of them if there is no rollout pair."""
    n = pairs.agg(F.count(F.when(F.col(kind) == "rollout", 1)).alias("n_rollout"))
    ranked = running(pairs, [kind], [order], F.lit(1), "k").join(F.broadcast(n), how="cross")  # one row
    return ranked.where((F.col(kind) != "teacher") | (F.col("n_rollout") == 0) | (F.col("k") < F.floor(F.col("n_rollout") * ratio))).select(*pairs.columns)


def turn_labels(failed, known, matches, corrected) -> Column:
    """How good a turn was: the task failed; the teacher was here and agreed or not; later corrected or not."""
    return F.when(failed, "task_failed").when(known & matches, "teacher_match").when(known, "teacher_mismatch").when(corrected, "corrected_later").otherwise("uncorrected")


def diff_kind(tool_a, tool_b, names_a, names_b) -> Column:
    """What a preference pair differs in."""
    return F.when(tool_a != tool_b, "tool_vs_text").when(~tool_a, "text").when(names_a != names_b, "tool_choice").otherwise("tool_args")


def turn_windows(messages: DataFrame, key: str, width: int = 12) -> DataFrame:
    """One window per assistant turn: its first and last turn. It starts ``width`` messages back, and further back past tool
    results."""
    order = Window.partitionBy(key).orderBy("turn")
    last = F.last(F.when(F.col("role") != "tool", F.col("turn")), ignorenulls=True)
    marked = messages.withColumn("start_ok", last.over(order)).withColumn("n", F.row_number().over(order))
    back = F.first("start_ok").over(order.rowsBetween(-(width - 1), 0))
    return marked.withColumn("start", back).where("role = 'assistant'").select(key, "turn", "start")


def span_mask(tokens, spans) -> Column:
    """For each token whether its start lies in a span; tokens of no width are masked."""
    return F.transform(tokens, lambda t: (t["s"] < t["e"]) & F.exists(spans, lambda x: (x["a"] <= t["s"]) & (t["s"] < x["b"])))
