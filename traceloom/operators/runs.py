"""Runs of an evaluation: merged statistics, per-task and divergence tables, and the full paired comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceloom.operators import statistics as S
from traceloom.operators.ordered import running


def replay_stats(rows: DataFrame, by: list[str]) -> DataFrame:
    """Sums of replayed, fuzzy and diverged calls, the share of fuzzy ones among those served, and the least fuzzy score."""
    n = {c: F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("replayed", "fuzzy", "diverged")}
    out = rows.groupBy(*by).agg(*n.values(), F.min("min_fuzzy_score").alias("min_fuzzy_score"))
    return out.withColumn("fuzzy_share", F.coalesce(F.try_divide(F.col("fuzzy"), F.col("replayed") + F.col("fuzzy")), F.lit(0.0)))


def live_stats(rows: DataFrame, by: list[str], tools: str = "tools") -> DataFrame:
    """Live tool calls and errors, their rate, and calls per tool (a map) from each row's own map."""
    totals = rows.groupBy(*by).agg(F.sum("calls").alias("calls"), F.sum("errors").alias("errors"))
    per = rows.select(*by, F.explode(tools).alias("tool", "n")).groupBy(*by, "tool").agg(F.sum("n").alias("n"))
    maps = per.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("tool", "n")))).alias("by_tool"))
    rate = F.coalesce(F.try_divide(F.col("errors"), F.col("calls")), F.lit(0.0))
    return totals.join(maps, by, "left").withColumn("error_rate", rate)


def usage_metrics(rows: DataFrame, by: list[str]) -> DataFrame:
    """Median prompt and completion tokens a task; the cached share of prompt tokens, null if none was cached."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    cached, prompts = F.sum(zero("cached_prompt_tokens")), F.sum(zero("prompt_tokens"))
    return rows.groupBy(*by).agg(
        F.median(zero("prompt_tokens")).alias("prompt_tokens_median"), F.median(zero("completion_tokens")).alias("completion_tokens_median"),
        F.when((cached > 0) & (prompts > 0), cached / prompts).alias("cache_hit_frac"),
    )


def batched_throughput(rows: DataFrame, by: list[str], generate_seconds: Column) -> DataFrame:
    """Completion tokens over seconds spent generating, of a batched run; null where there is neither."""
    tokens = F.sum(F.coalesce("tokens", F.lit(0)))
    return rows.groupBy(*by).agg(F.when((tokens > 0) & (generate_seconds > 0), tokens / generate_seconds).alias("tokens_per_second"), F.lit("batched").alias("mode"))


def cascade_metrics(rows: DataFrame, by: list[str], threshold: float | None) -> DataFrame:
    """Escalated turns over all turns, and the median of tokens that escalations threw away."""
    n = F.coalesce(F.sum("escalations"), F.lit(0))
    rate = F.coalesce(F.try_divide(n, F.sum("n_turns")), F.lit(0.0))
    wasted = F.median(F.coalesce(F.col("wasted_student_tokens"), F.lit(0)).cast("double"))
    return rows.groupBy(*by).agg(rate.alias("escalation_rate"), n.alias("escalations"), wasted.alias("wasted_student_tokens_median"), F.lit(threshold).cast("double").alias("cascade_threshold"))


def observed_rates(rows: DataFrame) -> DataFrame:
    """Success of both runs over the tasks they share: what happened, without a claim. Null without shared tasks."""
    return S.paired(rows, F.col("success")).agg(F.avg("a").alias("rate_a"), F.avg("b").alias("rate_b"), F.count(F.lit(1)).alias("n_shared_tasks"))


def stop_reasons(rows: DataFrame, by: list[str], reason: str = "stop_reason") -> DataFrame:
    """Rows per stop reason as a map."""
    n = rows.groupBy(*by, reason).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce(reason, F.lit("unknown")), "n")))).alias("stop_reasons"))


def divergence_summary(rows: DataFrame, limit: int = 10) -> DataFrame:
    """Per tool the divergences, the largest score of a nearest recorded call, and the first one's arguments; the ``limit`` most
    frequent. Rows: tool, score, args, and a column ``id`` in order of the run."""
    per = rows.where("tool is not null").groupBy("tool").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("max_score"), F.min_by("args", "id").alias("example"), F.min("id").alias("first"))
    return per.orderBy(F.desc("n"), "first").limit(limit).drop("first")


def per_task(rows: DataFrame) -> DataFrame:
    """Per task: successes and divergences over repeats, and the detail of the first repeat that failed."""
    ok = F.coalesce(F.col("success"), F.lit(False))
    failed = F.min_by(F.when(~ok, F.col("detail")), F.when(~ok, F.col("repeat_idx")))
    div = F.count(F.when(F.col("diverged"), 1))
    of = lambda c: F.concat_ws("/", c.cast("string"), F.count(F.lit(1)).cast("string"))
    return rows.groupBy("task_id").agg(of(F.count(F.when(ok, 1))).alias("success"), of(div).alias("diverged"), failed.alias("first_failure"))


def draws(spark, iterations: int, n: int, seed: str) -> DataFrame:
    """``it, slot``: for each iteration n slots out of 0 to n - 1, by hash of (seed, iteration, place)."""
    grid = spark.range(iterations * n).select(F.floor(F.col("id") / n).alias("it"), (F.col("id") % n).alias("k"))
    h = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), "it", "k"), 256), 1, 8), 16, 10).cast("long")
    return grid.select("it", (h % n).alias("slot"))


def median_difference(pairs: DataFrame, iterations: int = 200, seed: str = "0") -> DataFrame:
    """Medians of both runs, the relative difference (null at median 0 of b), and an interval of the median of a - b over tasks,
    resampled. Fewer than two tasks give NaN."""
    numbered = running(pairs.select("task_id", "a", "b", (F.col("a") - F.col("b")).alias("d")), [], ["task_id"], F.lit(1), "slot")
    head = numbered.agg(F.median("a").alias("median_a"), F.median("b").alias("median_b"), F.median("d").alias("median_difference"), F.count(F.lit(1)).alias("n"))
    head = head.withColumn("relative_delta", F.try_divide(F.col("median_a") - F.col("median_b"), F.col("median_b")))
    n = pairs.count()
    if n < 2:
        return head.withColumns({c: F.lit(float("nan")) for c in ("low", "high")})
    medians = draws(pairs.sparkSession, iterations, n, seed).join(numbered.select("slot", "d"), "slot").groupBy("it").agg(F.median("d").alias("m"))
    ends = medians.agg(F.percentile("m", 0.025).alias("low"), F.percentile("m", 0.975).alias("high"))
    return head.join(F.broadcast(ends), how="cross")  # one row


def live_interval(per_cluster: DataFrame, iterations: int = 200, seed: str = "0") -> DataFrame:
    """Interval of the weighted difference over clusters (columns cluster_id, w, d), clusters resampled."""
    numbered = running(per_cluster.select("cluster_id", "w", "d"), [], ["cluster_id"], F.lit(1), "slot")
    n = per_cluster.count()
    if n < 2:
        return per_cluster.sparkSession.createDataFrame([(float("nan"),) * 3], "delta double, low double, high double")
    m = draws(per_cluster.sparkSession, iterations, n, seed).join(numbered.select("slot", "w", "d"), "slot").groupBy("it").agg((F.sum(F.col("w") * F.col("d")) / F.sum("w")).alias("m"))
    ends = m.agg(F.percentile("m", 0.025).alias("low"), F.percentile("m", 0.975).alias("high"))
    return numbered.agg((F.sum(F.col("w") * F.col("d")) / F.sum("w")).alias("delta")).join(F.broadcast(ends), how="cross")  # one row


class NotPairable(ValueError):
    """Runs of different eval sets, or unknown ones: a mistake, not a small sample."""


def compare(runs: DataFrame, rows: DataFrame, a: str, b: str, alpha: float = 0.05, iterations: int = 200) -> dict:
    """Everything that two runs' shared tasks allow to say, a minus b. ``runs``: id, eval_set_id, mode; ``rows``: run, task_id,
    success, tokens, turns, cluster. Refusals, in this order: different tool modes; too few tasks or repeats; no variance."""
    found = {r.id: r for r in runs.where(F.col("id").isin(a, b)).select("id", "eval_set_id", "mode").collect()}  # two rows
    for x in (a, b):
        if x not in found:
            raise NotPairable(f"unknown eval run: {x}")
    if found[a].eval_set_id != found[b].eval_set_id:
        raise NotPairable(f"different eval sets: {found[a].eval_set_id} and {found[b].eval_set_id}")
    # the paired table has run A as the baseline; a - b is the difference from it
    mine = rows.where(F.col("run").isin(a, b)).withColumn("run", F.when(F.col("run") == b, "A").otherwise("B"))
    pairs = S.paired(mine, F.col("success"))
    rates = observed_rates(mine).first()
    out = {"run_a": a, "run_b": b, "alpha": alpha, "n_shared_tasks": rates.n_shared_tasks, "observed": {"rate_a": rates.rate_b, "rate_b": rates.rate_a}}
    modes = [found[x].mode or "replay" for x in (a, b)]
    if modes[0] != modes[1]:
        return out | {"refusal": f"different tool modes: {modes[0]} and {modes[1]}", "incompatible": True}
    power = S.power_guard(pairs).first()
    if power.refusal:
        return out | {"refusal": power.refusal}
    ci = S.bootstrap(pairs, iterations).first()
    if ci.low == ci.high and ci.delta == 0:
        return out | {"refusal": "every task had the same outcome under both runs"}
    odd = S.mcnemar(pairs).first()
    mcnemar = {"only_a": odd.only_b, "only_b": odd.only_a, "p": odd.p}  # the paired table's b is run a
    out |= {"success": ci.asDict(), "mcnemar": mcnemar}
    tests = [("success", mcnemar["p"])]
    for name in ("tokens", "turns"):
        per = S.paired(mine, F.col(name))
        out[name] = S.wilcoxon(per).first().asDict() | median_difference(per.select("task_id", F.col("b").alias("a"), F.col("a").alias("b")), iterations).first().asDict()
        tests.append((name, out[name]["p"]))
    holm = S.holm(rows.sparkSession.createDataFrame([(n, float(p), 0) for n, p in tests], "name string, p double, g int"), "p", ["g"]).collect()
    out["holm"] = {r.name: {"p": r.p, "p_adjusted": r.adjusted, "significant": r.adjusted <= alpha} for r in holm}
    return out


def full_match_drift(a: DataFrame, b: DataFrame, iterations: int = 200) -> DataFrame:
    """Difference of the share of full matches by turn (columns trace, turn, full) in points of a hundred, task by task, with an
    interval. Turns that only one side has make it null: the two were not run over the same turns."""
    both = a.select("trace", "turn", F.col("full").cast("double").alias("x")).join(b.select("trace", "turn", F.col("full").cast("double").alias("y")), ["trace", "turn"], "full")
    odd = both.agg(F.count(F.when(F.col("x").isNull() | F.col("y").isNull(), 1)).alias("misaligned"))
    tasks = both.groupBy(F.col("trace").alias("task_id")).agg((F.avg("x") * 100).alias("a"), (F.avg("y") * 100).alias("b")).where("a is not null and b is not null")
    out = S.bootstrap(tasks, iterations).join(F.broadcast(odd), how="cross")  # one row
    return out.select("misaligned", *(F.when(F.col("misaligned") == 0, F.col(c)).alias(c) for c in ("delta", "low", "high")))


def quantization_verdict(full: Column, small: Column, most_drop: float = 2.0) -> Column:
    """Whether a quantised child's success, both in 0 to 1, drops by at most so many points of a hundred; a gain always passes."""
    drop = (full - small) * 100
    return F.struct(drop.alias("drop_pp"), (F.round(drop, 9) <= most_drop).alias("ok"))


def holdout_error(graded: DataFrame, judged: str, truth: str, key: str = "id", salt: str = "h") -> DataFrame:
    """How far a judge's rate is off after its own correction: half of the rows (by hash) calibrates, the other half is corrected and
    compared with its truth. Null where the judge tells nothing."""
    half = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(salt), F.col(key).cast("string")), 256), 1, 8), 16, 10).cast("long") % 2
    j, t = F.col(judged), F.col(truth)
    x = graded.select(half.alias("half"), j.alias("j"), t.alias("t"))
    cal = S.judge_confusion(x.where("half = 0"), F.col("j"), F.col("t")).select((1 - F.col("fnr")).alias("sens"), (1 - F.col("fpr")).alias("spec"), "usable")
    rest = x.where("half = 1").agg(F.avg(F.col("j").cast("double")).alias("observed"), F.avg(F.col("t").cast("double")).alias("actual"), F.count(F.lit(1)).alias("n"))
    both = rest.join(F.broadcast(cal), how="cross")  # one row each
    corrected = S.corrected_rate(F.col("observed"), F.col("sens"), F.col("spec"), F.col("usable"))
    return both.select("n", "observed", "actual", corrected.alias("corrected"), (corrected - F.col("actual")).alias("error"))


def cluster_table(rows: DataFrame, subjects: list[str], floor: float = 0.55) -> DataFrame:
    """Per cluster each subject's success side by side, the tasks of the first subject (null where it has none), and where the router
    would send it: the teacher below the floor of the second subject. ``rows``: subject, cluster (text), success, n_tasks. Unnamed
    clusters are called none and come last."""
    name = F.coalesce("cluster", F.lit("none"))
    cell = lambda s, c: F.max(F.when(F.col("subject") == s, F.col(c)))
    wide = rows.groupBy(name.alias("cluster")).agg(cell(subjects[0], "n_tasks").alias("n_tasks"), *(cell(s, "success").alias(s) for s in subjects))
    second = F.col(subjects[min(1, len(subjects) - 1)])
    route = F.when(second.isNull(), None).when(second < floor, "teacher").otherwise("student")
    return wide.withColumn("routing", route).orderBy(F.col("cluster") == "none", "cluster")


def coverage_summary(coverage: DataFrame) -> DataFrame:
    """Of a coverage table (n_before, n_after, sparse): clusters, sparse ones, rows kept and their share."""
    n, kept = F.sum("n_before"), F.sum("n_after")
    return coverage.agg(F.count(F.lit(1)).alias("n_clusters"), F.count(F.when(F.col("sparse"), 1)).alias("n_sparse"), kept.alias("n_after"), F.coalesce(F.try_divide(kept, n), F.lit(0.0)).alias("share"))


def curation_result(funnel: list[dict], coverage: DataFrame, config: dict, notes: list[str], embedder: str) -> dict:
    """What a curation did, as one object: rows in and out, stages, coverage, the configuration and its hash."""
    import hashlib
    import json

    text = json.dumps(config, sort_keys=True, default=str)
    return {
        "n_input": funnel[0]["n_in"] if funnel else 0, "n_output": funnel[-1]["n_out"] if funnel else 0, "stages": funnel, "coverage": coverage_summary(coverage).first().asDict(),
        "filter_config": config, "config_hash": hashlib.sha256(text.encode()).hexdigest()[:12], "notes": notes, "embedder": embedder,
    }


def aggregate(rows: DataFrame, run: str = "run") -> DataFrame:
    """Everything that a run's rows say: success over tasks' means, shares of valid and diverged rows, medians of turns, calls, tokens and
    latency, rows per stop reason, and the most repeats of a task."""
    tasks = rows.groupBy(run, "task_id").agg(F.avg(F.coalesce(F.col("success").cast("double"), F.lit(0.0))).alias("m"), F.count(F.lit(1)).alias("n"))
    top = tasks.groupBy(run).agg(F.avg("m").alias("success"), F.count(F.lit(1)).alias("n_tasks"), F.max("n").alias("n_per_task"))
    share = lambda c: F.avg(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(c)
    rest = rows.groupBy(run).agg(share("schema_valid"), share("diverged"), *(F.median(c).alias(f"{c}_median") for c in ("n_turns", "n_tool_calls", "tokens", "latency_ms")))
    return top.join(rest, run).join(stop_reasons(rows, [run]), run)
