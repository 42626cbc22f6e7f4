"""The request log as streams: rolling health, late outcomes, posteriors as keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

POSTERIOR = "cluster_id long, arm string, alpha double, beta double, n long"


def health(requests: DataFrame, seconds: int = 300, slide: int = 60, late: str = "10 minutes", least: int = 20, alert: float = 0.2) -> DataFrame:
    """Fallback share per sliding window of event time; rows later than the watermark are left out by the engine."""
    w = F.window("received_at", f"{seconds} seconds", f"{slide} seconds")
    rate = F.avg(F.col("fallback").cast("double"))
    g = requests.withWatermark("received_at", late).groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n"), rate.alias("rate"))
    return g.select(F.col("w.start").alias("start"), "n", "rate", ((F.col("n") >= least) & (F.col("rate") > alert)).alias("alert"))


def with_outcomes(requests: DataFrame, feedback: DataFrame, within: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Requests joined with feedback (id, outcome, at) that comes within a time; both sides have watermarks, so state ends."""
    r = requests.drop("outcome").withWatermark("received_at", late)
    f = feedback.select(F.col("id").alias("fid"), "outcome", "at").withWatermark("at", late)
    return r.join(f, F.expr(f"id = fid and at >= received_at and at <= received_at + interval {within}"), "inner").drop("fid")


def posterior(rows: DataFrame, decay: float = 0.995) -> DataFrame:
    """Beta posterior of each (cluster_id, arm), kept as state: older evidence decays with each outcome. Within a micro-batch a
    key's rows are taken in order of (received_at, id); a key's newest posterior is emitted in each batch that has rows of it."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        alpha, beta, n = state.get if state.exists else (1.0, 1.0, 0)
        rows = pd.concat(list(frames)).sort_values(["received_at", "id"])
        for s in rows["outcome"]:
            alpha, beta, n = alpha * decay + bool(s), beta * decay + (not s), n + 1
        state.update((alpha, beta, n))
        yield pd.DataFrame([(*key, alpha, beta, n)], columns=["cluster_id", "arm", "alpha", "beta", "n"])

    graded = rows.where("outcome is not null and not fallback and cluster_id is not null")
    return graded.groupBy("cluster_id", "arm").applyInPandasWithState(update, POSTERIOR, "alpha double, beta double, n long", "update", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """Run over what is there and return the in-memory table; for tests and small look-ups."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)
