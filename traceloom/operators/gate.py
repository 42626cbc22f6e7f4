"""Confidence gate: calibration measures, threshold search, verdicts and a fitted calibrator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceloom.operators.ordered import running
from traceloom.operators.similarity import written


def bin_of(p, bins: int = 10) -> Column:
    """Equal bins, the first closed on both sides, the others open below."""
    return F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.ceil(F.round(p * bins, 9)) - 1)).cast("int")


def reliability(df: DataFrame, bins: int = 10) -> DataFrame:
    """``bin, n, mean_p, mean_y``; empty bins stay, with nulls."""
    have = df.groupBy(bin_of(F.col("p"), bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg("p").alias("mean_p"), F.avg("y").alias("mean_y"))
    return df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).join(have, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), "mean_p", "mean_y")


def ece(df: DataFrame, bins: int = 10) -> DataFrame:
    """Expected calibration error."""
    r = reliability(df, bins).where("n > 0")
    return r.agg((F.sum(F.col("n") * F.abs(F.col("mean_p") - F.col("mean_y"))) / F.sum("n")).alias("ece"))


def auroc_brier(df: DataFrame) -> DataFrame:
    """AUROC from rank sums with mid-ranks (null on one class), Brier score, share of positives. Ranks come from counts per
    distinct score, summed over ranges of the score."""
    g = df.groupBy("p").agg(F.count(F.lit(1)).alias("c"), F.sum("y").alias("u"))
    s = running(g, [], ["p"], F.col("c"), "before").withColumn("r", F.col("before") + (F.col("c") + 1) / 2.0).agg(F.sum(F.col("r") * F.col("u")).alias("w"), F.sum("u").alias("n1"), F.sum("c").alias("n"))
    n1, n0 = F.col("n1"), F.col("n") - F.col("n1")
    rank = s.select(F.when((n1 > 0) & (n0 > 0), (F.col("w") - n1 * (n1 + 1) / 2.0) / (n1 * n0)).alias("auroc"))
    rest = df.agg(F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("brier"), F.avg("y").alias("positive_rate"))
    return rank.join(F.broadcast(rest), how="cross")  # one row each


def verdict(n, positives, auroc, error, least_turns: int = 50) -> Column:
    """Whether a gate may be used; a reason for each way it may not."""
    return (
        F.when(n < least_turns, "unreliable").when((positives == 0) | (positives == n), "degenerate_labels").when(auroc.isNull() | F.isnan(auroc), "unreliable")
        .when(auroc < 0.55, "uninformative").when((auroc < 0.6) | (error > 0.05), "unreliable").otherwise("usable")
    )


def threshold_curve(turns: DataFrame, grid: DataFrame, student_cost: float = 1.0, teacher_cost: float = 10.0) -> DataFrame:
    """For each threshold: tasks that succeed, escalations and cost. A task succeeds if all its kept turns are good and, if any
    turn escalates, the teacher solves it. Turns are reduced to one row per (task, score) before they meet the grid, which
    holds a fixed number of thresholds."""
    small = turns.groupBy("task", "p").agg(F.min("good").alias("good"), F.count(F.lit(1)).alias("n"), F.min("teacher_ok").alias("teacher_ok"))
    kept = F.col("p") >= F.col("tau")
    per = small.join(F.broadcast(grid), how="cross").groupBy("tau", "task").agg(
        F.coalesce(F.min(F.when(kept, F.col("good"))), F.lit(1)).alias("kept_good"), F.sum(F.when(~kept, F.col("n")).otherwise(0)).alias("escalated"),
        F.sum("n").alias("n"), F.min("teacher_ok").alias("teacher_ok"),
    )
    ok = F.when((F.col("kept_good") == 1) & ((F.col("escalated") == 0) | (F.col("teacher_ok") == 1)), 1.0).otherwise(0.0)
    rate = F.sum("escalated") / F.sum("n")
    return per.groupBy("tau").agg(F.avg(ok).alias("success"), rate.alias("escalation"), (F.lit(student_cost) + rate * teacher_cost).alias("cost"), F.avg("teacher_ok").alias("teacher_rate"))


def choose_threshold(curve: DataFrame, budget: float = 0.01) -> DataFrame:
    """The cheapest threshold whose success drops by no more than ``budget``; the first of equals."""
    fine = curve.where(F.col("teacher_rate") - F.col("success") <= budget)
    return fine.orderBy("cost", "tau").limit(1)


def entropy(logprobs) -> Column:
    """Entropy of the renormalised softmax over the given log probabilities."""
    top = F.array_max(logprobs)
    e = F.transform(logprobs, lambda x: F.exp(x - top))
    z = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return F.aggregate(e, F.lit(0.0), lambda a, x: a - (x / z) * F.log(x / z + 1e-12))


# Turns that a gate needs, rows of the rarer class in a fold, and from how many on a step curve is fitted.
LEAST_TURNS, LEAST_PER_FOLD, LEAST_FOR_STEPS = 100, 10, 50


def fit_refusals(df: DataFrame, by: list[str], features: list[str], label: str, least_turns: int = LEAST_TURNS, least_per_fold: int = LEAST_PER_FOLD) -> DataFrame:
    """``n, minority, folds, method, reason`` for each group of turns: why no gate can be fitted (null if one can), else into how many folds and with which
    curve. Reasons in order: too_few_turns, no_features, single_class, and fit_error where the rarer class can't fill two folds."""
    has = lambda f: F.count(F.when(F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double")), 1))
    seen = sum((has(f) for f in features), F.lit(0))
    ones = F.count(F.when(F.col(label) == 1, 1))
    g = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), seen.alias("_seen"), ones.alias("_ones"))
    rare = F.least(F.col("_ones"), F.col("n") - F.col("_ones"))
    reason = F.when(F.col("n") < least_turns, "too_few_turns").when(F.col("_seen") == 0, "no_features").when(rare == 0, "single_class").when(rare < 2 * least_per_fold, "fit_error")
    folds = F.greatest(F.lit(2), F.least(F.lit(5), F.floor(rare / least_per_fold))).cast("int")
    fits = lambda c: F.when(F.col("reason").isNull(), c)
    out = g.withColumns({"minority": rare, "reason": reason})
    return out.select(*by, "n", "minority", fits(folds).alias("folds"), fits(F.when(rare >= LEAST_FOR_STEPS, "isotonic").otherwise("sigmoid")).alias("method"), "reason")


def fold_of(task: Column, folds: int, seed: int = 0) -> Column:
    """The fold of a task's turns, by hash."""
    return F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), task.cast("string")), 256), 1, 8), 16, 10).cast("long") % folds


def fit_trees(df: DataFrame, features: list[str], label: str, seed: int = 0):
    """Boosted trees over values and missing indicators of :func:`impute`."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    cols = [c for f in features for c in (f"{f}_v", f"{f}_m")]
    vec = VectorAssembler(inputCols=cols, outputCol="_x")
    trees = GBTClassifier(featuresCol="_x", labelCol=label, maxDepth=3, maxIter=20, stepSize=0.1, seed=seed).fit(vec.transform(df))
    return lambda x: trees.transform(vec.transform(x)).withColumn("_s", _second(F.col("probability"))).drop("_x", "rawPrediction", "probability", "prediction")


def out_of_fold(df: DataFrame, features: list[str], label: str, task: str, folds: int, seed: int = 0) -> DataFrame:
    """``_s``: each row's score by trees that saw no turn of its task. A fold whose other folds hold one class gives no score."""
    split = df.withColumn("_fold", fold_of(F.col(task), folds, seed))
    parts = []
    for k in range(folds):
        rest = split.where(F.col("_fold") != k)
        lo, hi = rest.agg(F.min(label), F.max(label)).first()
        if lo is not None and lo != hi:
            parts.append(fit_trees(rest, features, label, seed)(split.where(F.col("_fold") == k)))
    if not parts:
        return split.withColumn("_s", F.lit(None).cast("double")).limit(0).drop("_fold")
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.drop("_fold")


def fit_isotonic(df: DataFrame, score: str, label: str) -> DataFrame:
    """``at, value``: the steps of the isotonic curve, from counts a distinct score."""
    from pyspark.ml.regression import IsotonicRegression

    g = df.groupBy(F.col(score).cast("double").alias("_s")).agg(F.avg(F.col(label).cast("double")).alias("_m"), F.count(F.lit(1)).cast("double").alias("_n"))
    model = IsotonicRegression(featuresCol="_s", labelCol="_m", weightCol="_n").fit(g)
    return df.sparkSession.createDataFrame([(float(x), float(v)) for x, v in zip(model.boundaries, model.predictions, strict=True)], "at double, value double")


def with_isotonic(df: DataFrame, score: str, curve: DataFrame) -> DataFrame:
    """Adds ``calibrated``: the curve at a score, in a straight line between steps and level beyond its ends."""
    steps = F.array_sort(F.collect_list(F.struct("at", "value")))
    x = df.join(F.broadcast(curve.agg(steps.alias("_c"))), how="cross")  # one row
    s = F.col(score).cast("double")
    below, above = F.filter("_c", lambda c: c["at"] <= s), F.filter("_c", lambda c: c["at"] >= s)
    lo, hi = F.get(below, F.size(below) - 1), F.get(above, F.lit(0))
    line = lo["value"] + (hi["value"] - lo["value"]) * F.coalesce(F.try_divide(s - lo["at"], hi["at"] - lo["at"]), F.lit(0.0))
    return x.withColumn("calibrated", F.coalesce(line, lo["value"], hi["value"])).drop("_c")


def fit_sigmoid(df: DataFrame, score: str, label: str, rounds: int = 25) -> tuple[float, float]:
    """Slope and offset of 1 / (1 + exp(-(a s + b))) with smoothed targets, by Newton's method: a round is one aggregate of five sums, and ends
    the search when both change by less than 1e-10."""
    import math

    s, y = F.col(score).cast("double"), F.col(label).cast("double")
    n1, n0 = df.agg(F.sum(y), F.sum(1 - y)).first()
    x = df.select(s.alias("s"), F.when(y == 1, (n1 + 1) / (n1 + 2)).otherwise(1 / (n0 + 2)).alias("t"))
    a, b = 0.0, math.log((n1 + 1) / (n0 + 1))
    for _ in range(rounds):
        m = 1 / (1 + F.exp(-(F.lit(a) * F.col("s") + F.lit(b))))
        v = m * (1 - m)
        ga, gb, aa, ab, bb = x.agg(F.sum((F.col("t") - m) * F.col("s")), F.sum(F.col("t") - m), F.sum(v * F.col("s") * F.col("s")) + 1e-12, F.sum(v * F.col("s")), F.sum(v) + 1e-12).first()
        det = aa * bb - ab * ab
        da, db = (bb * ga - ab * gb) / det, (aa * gb - ab * ga) / det
        a, b = a + da, b + db
        if max(abs(da), abs(db)) < 1e-10:
            break
    return a, b


def fit_calibrator(df: DataFrame, features: list[str], label: str = "y", task: str = "task", seed: int = 0, least_turns: int = LEAST_TURNS, least_per_fold: int = LEAST_PER_FOLD) -> dict:
    """A calibrated gate: ``reason`` if there is none, else ``score`` (a function that adds ``p`` to turns), ``method``, ``features``, and ``holdout``
    (n, positive_rate, auroc, brier, ece of the out-of-fold probabilities).

    The curve is fitted on scores of trees that saw no turn of the same task: a step curve where the rarer class is large enough, else a
    sigmoid. The trees that are kept learn from all turns."""
    seen = df.agg(*(F.count(F.when(F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double")), 1)).alias(f) for f in features)).first()
    used = [f for f in features if seen[f]]
    plan = fit_refusals(df.withColumn("_all", F.lit(0)), ["_all"], features, label, least_turns, least_per_fold).first()
    if plan is None or plan.reason:
        return {"reason": plan.reason if plan else "too_few_turns", "features": used, "method": None, "holdout": None, "score": None}
    wide = impute(df, used)
    held = written(out_of_fold(wide, used, label, task, plan.folds, seed))
    if not held.limit(1).count():
        return {"reason": "fit_error", "features": used, "method": None, "holdout": None, "score": None}
    if plan.method == "isotonic":
        curve = fit_isotonic(held, "_s", label)
        calibrate = lambda x: with_isotonic(x, "_s", curve).withColumnRenamed("calibrated", "p")
    else:
        a, b = fit_sigmoid(held, "_s", label)
        calibrate = lambda x: x.withColumn("p", 1 / (1 + F.exp(-(F.lit(a) * F.col("_s") + F.lit(b)))))
    told = written(calibrate(held).select("p", F.col(label).alias("y")))
    report = auroc_brier(told).first().asDict() | {"ece": ece(told).first().ece, "n": told.count()}
    trees = fit_trees(wide, used, label, seed)
    drop = [c for f in used for c in (f"{f}_v", f"{f}_m")] + ["_s"]
    return {"reason": None, "features": used, "method": plan.method, "holdout": report, "score": lambda x: calibrate(trees(impute(x, used))).drop(*drop)}


def impute(df: DataFrame, features: list[str]) -> DataFrame:
    """A value and a missing indicator for each feature: NaN and null become 0 with the indicator set."""
    out = {}
    for f in features:
        gone = F.col(f).isNull() | F.isnan(F.col(f).cast("double"))
        out[f"{f}_v"], out[f"{f}_m"] = F.when(gone, 0.0).otherwise(F.col(f).cast("double")), gone.cast("double")
    return df.withColumns(out)


def _second(v) -> Column:
    from pyspark.ml.functions import vector_to_array

    return F.element_at(vector_to_array(v), 2)
