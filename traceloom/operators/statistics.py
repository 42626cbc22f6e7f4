"""Paired statistics over tasks. Tables are small after the per-task means; every step is still distributed."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from traceloom.operators.ordered import running

# Below these no statistic may be given.
LEAST_TASKS, LEAST_REPEATS = 20, 3


def paired(rows: DataFrame, value) -> DataFrame:
    """``task_id, a, b``: both runs' means of the tasks they share, from one aggregate."""
    x = F.coalesce(value.cast("double"), F.lit(0.0))
    side = lambda r: F.avg(F.when(F.col("run") == r, x))
    n = lambda r: F.count(F.when(F.col("run") == r, 1))
    return rows.groupBy("task_id").agg(side("A").alias("a"), side("B").alias("b"), n("A").alias("na"), n("B").alias("nb")).where("a is not null and b is not null")


def power_guard(pairs: DataFrame) -> DataFrame:
    """Whether statistics may be given, and why not."""
    g = pairs.agg(F.count(F.lit(1)).alias("n_tasks"), F.coalesce(F.min(F.least("na", "nb")), F.lit(0)).alias("n_repeats"))
    why = F.when(F.col("n_tasks") < LEAST_TASKS, "too few tasks").when(F.col("n_repeats") < LEAST_REPEATS, "too few repeats")
    return g.withColumn("refusal", why)


def bootstrap(pairs: DataFrame, iterations: int = 200, seed: str = "0") -> DataFrame:
    """Interval of mean(b - a): each iteration draws as many tasks as there are, by hash of (seed, iteration, slot). Draws are
    equi-joined on the slot, so no pair of rows is built but the drawn ones; fewer than two tasks give NaN."""
    numbered = running(pairs.select("task_id", (F.col("b") - F.col("a")).alias("d")), [], ["task_id"], F.lit(1), "slot").select("d", "slot")
    n = pairs.count()
    if n < 2:
        return pairs.sparkSession.createDataFrame([(float("nan"),) * 3], "delta double, low double, high double")
    draws = pairs.sparkSession.range(iterations * n).select(F.floor(F.col("id") / n).alias("it"), (F.col("id") % n).alias("k"))
    h = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), "it", "k"), 256), 1, 8), 16, 10).cast("long")
    means = draws.select("it", (h % n).alias("slot")).join(numbered, "slot").groupBy("it").agg(F.avg("d").alias("m"))
    ends = means.agg(F.percentile("m", 0.025).alias("low"), F.percentile("m", 0.975).alias("high"))
    return numbered.agg(F.avg("d").alias("delta")).join(F.broadcast(ends), how="cross")  # one row


def mcnemar(pairs: DataFrame) -> DataFrame:
    """Discordant counts of majority success, and the exact two-sided p-value."""
    c = pairs.agg(F.count(F.when((F.col("a") <= 0.5) & (F.col("b") > 0.5), 1)).alias("only_b"), F.count(F.when((F.col("a") > 0.5) & (F.col("b") <= 0.5), 1)).alias("only_a"))
    n, k = F.col("only_a") + F.col("only_b"), F.least("only_a", "only_b")
    # sum of C(n, i) / 2^n for i <= k by the recurrence of the terms' logarithms
    terms = F.aggregate(
        F.sequence(F.lit(1), F.greatest(k, F.lit(1))), F.struct((-n * math.log(2)).alias("t"), F.exp(-n * math.log(2)).alias("s")),
        lambda acc, i: F.struct((acc["t"] + F.log(n - i + 1) - F.log(i)).alias("t"), (acc["s"] + F.when(i <= k, F.exp(acc["t"] + F.log(n - i + 1) - F.log(i))).otherwise(0.0)).alias("s")), lambda acc: acc["s"],
    )
    return c.withColumn("p", F.when(n == 0, 1.0).otherwise(F.least(F.lit(1.0), 2 * terms)))


#: Pairs up to which the signed-rank p-value without ties is exact.
MOST_EXACT = 50


def signed_rank_p(n: Column, w: Column) -> Column:
    """The exact two-sided p-value of the smaller rank sum ``w`` of ``n`` different absolute differences: of the 2^n sets of ranks those with a sum up
    to w are counted, one rank at a time, over an array of sums."""
    zeros = lambda k: F.array_repeat(F.lit(0.0), k)
    add = lambda c, i: F.zip_with(F.concat(c, zeros(i)), F.concat(zeros(i), c), lambda x, y: x + y)
    counts = F.aggregate(F.sequence(F.lit(1), n.cast("int")), F.array(F.lit(1.0)), add)
    below = F.aggregate(F.slice(counts, F.lit(1), F.floor(w).cast("int") + 1), F.lit(0.0), lambda s, x: s + x)
    return F.when(n < 1, 1.0).otherwise(F.least(F.lit(1.0), 2 * below / F.pow(F.lit(2.0), n)))


def wilcoxon(pairs: DataFrame) -> DataFrame:
    """Signed-rank sums with mid-ranks, zeros dropped: n, w_plus, w_minus, and p: exact for up to MOST_EXACT pairs without ties, else by the normal
    approximation with ties."""
    d = pairs.select((F.col("b") - F.col("a")).alias("d")).where("d <> 0").select(F.round(F.abs("d"), 9).alias("m"), (F.col("d") > 0).alias("up"))
    groups = d.groupBy("m").agg(F.count(F.lit(1)).alias("c"), F.count(F.when(F.col("up"), 1)).alias("u"))
    ranked = running(groups, [], ["m"], F.col("c"), "before").withColumn("r", F.col("before") + (F.col("c") + 1) / 2.0)
    s = ranked.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("r") * F.col("u")), F.lit(0.0)).alias("w_plus"),
        F.coalesce(F.sum(F.col("r") * (F.col("c") - F.col("u"))), F.lit(0.0)).alias("w_minus"), F.sum(F.col("c") * F.col("c") * F.col("c") - F.col("c")).alias("ties"),
    )
    n = F.col("n")
    var = n * (n + 1) * (2 * n + 1) / 24.0 - F.col("ties") / 48.0
    z = F.abs(F.least("w_plus", "w_minus") - n * (n + 1) / 4.0) / F.sqrt(var)
    # complementary error function by a rational approximation (Abramowitz and Stegun 7.1.26)
    t = 1 / (1 + 0.3275911 * z / math.sqrt(2))
    erfc = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * F.exp(-z * z / 2)
    few = (n <= MOST_EXACT) & (F.col("ties") == 0)
    exact = signed_rank_p(F.when(few, n).otherwise(0), F.least("w_plus", "w_minus"))
    return s.select("n", "w_plus", "w_minus", F.when(n == 0, 1.0).when(few, exact).otherwise(F.least(F.lit(1.0), erfc)).alias("p"))


def holm(df: DataFrame, p: str, by: list[str]) -> DataFrame:
    """Holm's adjusted p-values within each group: the running maximum of min(1, (m - i) p)."""
    order = Window.partitionBy(*by).orderBy(p, "name")
    whole = Window.partitionBy(*by)
    step = F.least(F.lit(1.0), (F.count(F.lit(1)).over(whole) - F.row_number().over(order) + 1) * F.col(p))
    return df.withColumn("_s", step).withColumn("adjusted", F.max("_s").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_s")


def judge_confusion(df: DataFrame, judged, truth) -> DataFrame:
    """Agreement and error rates of a judge against the truth."""
    c = lambda cond: F.count(F.when(cond, 1))
    counts = df.agg(c(judged & truth).alias("tp"), c(judged & ~truth).alias("fp"), c(~judged & truth).alias("fn"), c(~judged & ~truth).alias("tn"))
    n = F.expr("tp + fp + fn + tn")
    return counts.select("tp", "fp", "fn", "tn", F.expr("try_divide(tp + tn, tp + fp + fn + tn)").alias("agreement"), F.expr("try_divide(fp, fp + tn)").alias("fpr"), F.expr("try_divide(fn, fn + tp)").alias("fnr"), (n >= 30).alias("usable"))


def corrected_rate(observed, sensitivity, specificity, usable) -> Column:
    """Rogan-Gladen: the true rate behind an imperfect judge's, in [0, 1]; null if the judge tells nothing."""
    d = sensitivity + specificity - 1
    return F.when(usable & (d > 1e-6), F.greatest(F.lit(0.0), F.least(F.lit(1.0), (observed + specificity - 1) / d)))


def live_clusters(rows: DataFrame, least: int = 5) -> DataFrame:
    """``cluster_id, w, d``: the smaller count and the difference of the canary's success from production's, for clusters that
    both serve enough. Student arm, no fallback, graded and clustered rows only."""
    use = rows.where("arm = 'student' and not fallback and outcome is not null and cluster_id is not null")
    n = lambda a: F.count(F.when(F.col("adapter") == a, 1))
    rate = lambda a: F.avg(F.when(F.col("adapter") == a, F.col("outcome").cast("double")))
    per = use.groupBy("cluster_id").agg(n("prod").alias("np"), n("canary").alias("nc"), rate("prod").alias("rp"), rate("canary").alias("rc")).where((F.col("np") >= least) & (F.col("nc") >= least))
    return per.select("cluster_id", F.least("np", "nc").alias("w"), (F.col("rc") - F.col("rp")).alias("d"))


def live_delta(rows: DataFrame, least: int = 5, clusters: int = 3) -> DataFrame:
    """The clusters' differences weighted by the smaller count; null with too few clusters."""
    n = F.count(F.lit(1))
    return live_clusters(rows, least).agg(n.alias("n_clusters"), F.when(n >= clusters, F.sum(F.col("w") * F.col("d")) / F.sum("w")).alias("delta"))


def round_decision(c: dict) -> Column:
    """Whether a training round is kept. ``c``: columns schema_valid, divergence_delta, refusal, low, high, delta, token_delta,
    token_high."""
    unchanged = (c["low"] <= 0) & (c["high"] >= 0) & (c["delta"] > -0.01)
    return (
        F.when(c["schema_valid"] < 0.99, "discard").when(c["divergence_delta"] > 0.05, "discard").when(c["refusal"].isNotNull(), "discard")
        .when(c["low"] > 0, "promote").when(unchanged & (c["token_high"] < 0), "promote").otherwise("discard")
    )
