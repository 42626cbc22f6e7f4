"""Stand-in views: the test tables seen as traces, results, requests, scores and calls, in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from traceloom.functions.text import bucket
from traceloom.sources.tables import read_table


def results(spark, d) -> DataFrame:
    """Events as evaluation rows: one per (run, task, repeat)."""
    e = read_table(spark, d, "events", "event_id", "ts", "user_id", "event_type", "value")
    e = e.withColumn("run", F.when(F.dayofmonth("ts") <= 15, "A").otherwise("B"))
    order = Window.partitionBy("user_id", "run").orderBy("ts", "event_id")
    return e.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("task_id"), "run", (F.row_number().over(order) - 1).alias("repeat_idx"),
        (F.col("event_type") != "error").alias("success"), F.col("value").alias("tokens"), (F.pmod("event_id", F.lit(7)) + 1).alias("turns"),
        (F.col("user_id") % 7).alias("cluster"), F.col("event_type").alias("kind"),
    )


RESULTS = """v_result as (
  select event_id as id, user_id as task_id, case when day(ts) <= 15 then 'A' else 'B' end as run,
    row_number() over (partition by user_id, case when day(ts) <= 15 then 'A' else 'B' end order by ts, event_id) - 1 as repeat_idx,
    event_type <> 'error' as success, value as tokens, event_id % 7 + 1 as turns, user_id % 7 as cluster, event_type as kind from events)"""


def requests(spark, d) -> DataFrame:
    """Events as a request log; sign-ups have no outcome yet."""
    e = read_table(spark, d, "events", "event_id", "ts", "user_id", "event_type", "value")
    return e.select(
        F.col("event_id").alias("id"), F.col("ts").alias("received_at"), F.when(F.col("event_type").isin("click", "purchase", "view"), "student").otherwise("teacher").alias("arm"),
        (F.col("event_type") == "error").alias("fallback"), F.when(F.col("event_type") != "signup", F.col("value") > 20).alias("outcome"),
        (F.col("user_id") % 7).alias("cluster_id"), F.when(bucket(F.col("user_id")) < 30, "canary").otherwise("prod").alias("adapter"),
        F.col("value").alias("student_tokens"), F.col("user_id"),
    )


REQUESTS = """v_request as (
  select event_id as id, ts as received_at, case when event_type in ('click', 'purchase', 'view') then 'student' else 'teacher' end as arm,
    event_type = 'error' as fallback, case when event_type <> 'signup' then value > 20 end as outcome, user_id % 7 as cluster_id,
    case when cast('0x' || substr(sha256(cast(user_id as varchar)), 1, 8) as bigint) % 100 < 30 then 'canary' else 'prod' end as adapter,
    value as student_tokens, user_id from events)"""


def scores(spark, d) -> DataFrame:
    """Labels as scored turns: probability from a bucket of the id."""
    x = read_table(spark, d, "labels", "doc_id", "quality")
    return x.select("doc_id", (bucket(F.col("doc_id")) / 100.0).alias("p"), F.col("quality").alias("y"), (F.col("doc_id") % 50).alias("task"), bucket(F.col("doc_id")).alias("b"))


SCORES = """v_score as (
  select doc_id, (cast('0x' || substr(sha256(cast(doc_id as varchar)), 1, 8) as bigint) % 100) / 100.0 as p, quality as y, doc_id % 50 as task,
    cast('0x' || substr(sha256(cast(doc_id as varchar)), 1, 8) as bigint) % 100 as b from labels)"""


def calls(spark, d) -> DataFrame:
    """Events as tool calls of one trace per user, in time order."""
    e = read_table(spark, d, "events", "event_id", "ts", "user_id", "event_type", "props")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return e.select(F.col("user_id").alias("trace"), F.row_number().over(order).alias("turn"), F.col("event_type").alias("tool"), F.col("props").alias("args"), (F.col("event_type") == "error").alias("error"), F.col("event_id").alias("id"))


CALLS = """v_call as (
  select user_id as trace, row_number() over (partition by user_id order by ts, event_id) as turn, event_type as tool, props as args,
    event_type = 'error' as error, event_id as id from events)"""


def turns(spark, d) -> DataFrame:
    return read_table(spark, d, "conversations", "conv_id", "turn", "role", "text")


def call_traces(spark, d):
    """A trace a user: each event is a call, with its number as the result; then an answer."""
    c = calls(spark, d)
    call = F.struct(F.col("id").cast("string").alias("id"), F.lit("function").alias("type"), F.struct(F.col("tool").alias("name"), F.col("args").alias("arguments")).alias("function"))
    turn = F.array(
        F.struct(F.lit("assistant").alias("role"), F.lit(None).cast("string").alias("content"), F.array(call).alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id")),
        F.struct(F.lit("tool").alias("role"), F.col("id").cast("string").alias("content"), F.array().cast("array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>").alias("tool_calls"), F.col("id").cast("string").alias("tool_call_id")),
    )
    per = c.groupBy("trace").agg(F.array_sort(F.collect_list(F.struct("turn", turn.alias("m")))).alias("t"))
    ends = lambda role, text: F.array(F.struct(F.lit(role).alias("role"), F.lit(text).alias("content"), F.lit(None).cast("array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>").alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id")))
    messages = F.concat(ends("user", "go"), F.flatten(F.transform("t", lambda x: x["m"])), ends("assistant", "all done"))
    return per.select(F.col("trace"), messages.alias("messages"))
