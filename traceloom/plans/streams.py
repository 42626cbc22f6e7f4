"""Streaming queries, run once over what the events table holds."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from traceloom.operators.similarity import shared_dir
from traceloom.plans import views as V
from traceloom.plans.registered import query
from traceloom.streaming import router as R


def event_stream(spark, d):
    """The events table as a stream of request-log rows."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    e = spark.readStream.schema(schema).parquet(f"{d}/event[s].parquet")  # a pattern may be one file, a plain path may not
    return e.select(
        F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("received_at"), F.when(F.col("event_type").isin("click", "purchase", "view"), "student").otherwise("teacher").alias("arm"),
        (F.col("event_type") == "error").alias("fallback"), F.when(F.col("event_type") != "signup", F.col("value") > 20).alias("outcome"), (F.col("user_id") % 7).alias("cluster_id"),
    )


def once(spark, stream, mode):
    name = f"run_{uuid.uuid4().hex}"
    return R.run_once(stream, name, mode, f"{shared_dir(spark)}/streams/{name}")


@query("stream_health", f"with {V.REQUESTS} select epoch_us(time_bucket(interval 1 hour, received_at))::bigint as start, count(*) as n, round(avg(fallback::int), 6) as rate, count(*) >= 20 and avg(fallback::int) > 0.2 as alert from v_request group by time_bucket(interval 1 hour, received_at)")
def stream_health(spark, d):
    """Hourly fallback share by event time."""
    out = once(spark, R.health(event_stream(spark, d), 3600, 3600), "complete")
    return out.select(F.unix_micros("start").alias("start"), "n", F.round("rate", 6).alias("rate"), "alert")


@query("stream_posterior", f"""with {V.REQUESTS}, o as (select *, row_number() over w as rn, count(*) over (partition by cluster_id, arm) as n from v_request where outcome is not null and not fallback window w as (partition by cluster_id, arm order by received_at, id))
select cluster_id, arm, round(sum(outcome::int * pow(0.995, n - rn)) + pow(0.995, max(n)), 5) as alpha, round(sum((1 - outcome::int) * pow(0.995, n - rn)) + pow(0.995, max(n)), 5) as beta, count(*) as n from o group by all""")
def stream_posterior(spark, d):
    """The newest posterior of each cluster and arm, from keyed state."""
    out = once(spark, R.posterior(event_stream(spark, d)), "update")
    best = out.groupBy("cluster_id", "arm").agg(F.max_by(F.struct("alpha", "beta", "n"), "n").alias("b"))
    return best.select("cluster_id", "arm", F.round("b.alpha", 5).alias("alpha"), F.round("b.beta", 5).alias("beta"), "b.n")
