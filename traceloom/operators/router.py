"""Routing: posteriors, arm choice, canary split, model names, health windows and late outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceloom.functions.text import bucket
from traceloom.operators.ordered import running, running_sums
from traceloom.operators.similarity import written


def posterior(rows: DataFrame, keys: list[str], order: list[str], decay: float = 0.995) -> DataFrame:
    """Beta parameters after all outcomes in order, each older one decayed once more: the closed form of the sequential
    update. ``alpha, beta, n`` per key. Ages come from ranges of the order, so few keys don't mean few tasks; rows beyond where
    decay ** age vanishes still count, with that weight."""
    s = F.col("outcome").cast("double")
    placed = running(rows, keys, order, F.lit(1), "_place")
    aged = placed.withColumn("_w", F.pow(F.lit(decay), F.col("_place_all") - F.col("_place") - 1))
    n = F.count(F.lit(1))
    prior = F.pow(F.lit(decay), n)
    return aged.groupBy(*keys).agg((F.sum(s * F.col("_w")) + prior).alias("alpha"), (F.sum((1 - s) * F.col("_w")) + prior).alias("beta"), n.alias("n"))


def greedy_arm(student: str, teacher: str, floor: float = 0.55, least: int = 10) -> Column:
    """The arm by posterior means: the teacher where enough evidence has the student below the floor; ties to the student."""
    mean = lambda p: F.col(f"{p}_alpha") / (F.col(f"{p}_alpha") + F.col(f"{p}_beta"))
    seen = F.col(f"{student}_alpha") + F.col(f"{student}_beta") - 2
    return F.when((seen >= least) & (mean(student) < floor), "teacher").when(mean(student) >= mean(teacher), "student").otherwise("teacher")


def use_canary(key, share: float) -> Column:
    return bucket(key) < share * 100


def resolve_route(name, teachers: list[str]) -> DataFrame | Column:
    """Kind of a requested model name: teacher, student, cascade, router or error."""
    parts = F.split(name, ":")
    tau = F.get(parts, F.lit(2))
    good = tau.isNull() | (tau == "auto") | (F.try_to_number(tau, F.lit("9.999")).between(0, 1) if hasattr(F, "try_to_number") else tau.cast("double").between(0, 1))
    return (
        F.when(name == "teacher", "teacher").when(F.get(parts, F.lit(0)) == "student", "student")
        .when((F.get(parts, F.lit(0)) == "cascade") & (F.size(parts) >= 2), F.when(good, "cascade").otherwise("error"))
        .when(name.isin(teachers), "router").otherwise("error")
    )


def rolling_rate(rows: DataFrame, flag, seconds: int = 300, least: int = 20, alert: float = 0.2) -> DataFrame:
    """For each row the share of ``flag`` among the rows of the last ``seconds``, and whether it is an alert. A window is a difference of
    two running sums over moments: up to the row's, and before the window's start. So the work follows the rows, however many of
    them a window holds. Rows without a time are each other's window."""
    width = seconds * 1_000_000
    x = rows.select("id", F.unix_micros(F.col("received_at").cast("timestamp")).alias("t"), flag.cast("int").alias("f"))
    moments = written(x.groupBy("t").agg(F.count(F.lit(1)).alias("m"), F.coalesce(F.sum("f"), F.lit(0)).alias("up"), F.count("f").alias("told")))
    here = moments.where("t is not null").select("t", F.lit(1).alias("o"), "m", "up", "told")
    starts = here.select((F.col("t") - width).alias("t"), F.lit(0).alias("o"), *(F.lit(0).cast("long").alias(c) for c in ("m", "up", "told")))
    names = {"_m": "m", "_up": "up", "_told": "told"}
    placed = running_sums(here.union(starts), [], ["t", "o"], {k: F.col(v) for k, v in names.items()})
    ends = placed.select(F.when(F.col("o") == 1, F.col("t")).otherwise(F.col("t") + width).alias("t"), *((F.when(F.col("o") == 1, F.col(k) + F.col(v)).otherwise(-F.col(k))).alias(v) for k, v in names.items()))
    window = ends.groupBy("t").agg(*(F.sum(v).alias(v) for v in names.values())).union(moments.where("t is null"))
    met = x.join(window.withColumnRenamed("t", "at"), F.col("t").eqNullSafe(F.col("at")))
    out = met.select("id", F.col("m").alias("n"), F.expr("try_divide(up, told)").alias("rate"))
    return out.select("id", "n", "rate", ((F.col("n") >= least) & (F.col("rate") > alert)).alias("alert"))


def latest_outcome(requests: DataFrame, feedback: DataFrame) -> DataFrame:
    """Requests with their newest feedback, if any."""
    last = feedback.groupBy("id").agg(F.max_by("outcome", "at").alias("late"))
    return requests.join(last, "id", "left").withColumn("outcome", F.coalesce("late", "outcome")).drop("late")
