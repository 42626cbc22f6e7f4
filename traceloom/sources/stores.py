"""Run stores and request logs as trace sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts that count as true.
TRUE = ["1", "true", "pass", "passed", "yes", "success"]


def read_store(spark: SparkSession, url: str, table: str, since=None, limit: int | None = None, order: tuple[str, str] = ("started_at", "id"), **options) -> DataFrame:
    """A table of a JDBC store; :func:`newest` of it where ``since`` or ``limit`` is given. The condition reaches the store."""
    df = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return df if since is None and limit is None else newest(df, since, limit, order)


def newest(df: DataFrame, since=None, limit: int | None = None, order: tuple[str, str] = ("started_at", "id")) -> DataFrame:
    """Rows from ``since`` on, in order; the first ``limit``."""
    df = df if since is None else df.where(F.col(order[0]) >= since)
    df = df.orderBy(*order)
    return df if limit is None else df.limit(limit)


def last_said(df: DataFrame, value: str) -> F.Column:
    """The value of the newest row, by whatever of these columns there is: created_at, at, id; then the largest value."""
    return F.max_by(as_bool(F.col(value)), F.struct(*(c for c in ("created_at", "at", "id") if c in df.columns), value))


def final_message(response):
    """The assistant message that a stored response (JSON text) holds, as a struct (content, tool_calls as JSON text); null for an
    empty one. Two dialects: choices, or content as text or blocks."""
    get = lambda p: F.get_json_object(response, p)
    content, calls = get("$.choices[0].message.content"), get("$.choices[0].message.tool_calls")
    calls = F.when(calls.isNotNull() & (calls != "[]"), calls)
    chosen = F.when((F.coalesce(content, F.lit("")) != "") | calls.isNotNull(), F.struct(content.alias("content"), calls.alias("tool_calls")))
    block = "array<struct<type:string,text:string,id:string,name:string,input:string>>"
    blocks = F.from_json(get("$.content"), block)
    text = F.coalesce(F.array_join(F.transform(F.filter(blocks, lambda b: b["type"] == "text"), lambda b: b["text"]), ""), get("$.content"))
    used = F.transform(
        F.filter(blocks, lambda b: b["type"] == "tool_use"),
        lambda b: F.struct(b["id"].alias("id"), F.lit("function").alias("type"), F.struct(b["name"].alias("name"), b["input"].alias("arguments")).alias("function")),
    )
    other = F.struct(F.nullif(text, F.lit("")).alias("content"), F.when(F.size(used) > 0, F.to_json(used)).alias("tool_calls"))
    return F.when(get("$.choices").isNotNull(), chosen).when(get("$.content").isNotNull() & F.coalesce(get("$.role"), F.lit("assistant")).eqNullSafe("assistant"), other)


def as_bool(c):
    return F.when(c.isNull(), None).otherwise(F.lower(c.cast("string")).isin(TRUE))


def trajectories(runs: DataFrame, calls: DataFrame, results: DataFrame | None = None, labels: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(traces, problems): the last call of each run holds its trajectory; tokens and cost are sums, 0 as null. Evaluation
    results overwrite labels; of several rows of a run the newest counts. One aggregate and joins instead of a query a run."""
    order = F.struct("started_at", "id")
    total = lambda c: F.nullif(F.sum(F.coalesce(F.col(c), F.lit(0))), F.lit(0)).alias(c)
    last = calls.groupBy(F.col("run_id")).agg(F.max_by(F.struct("request", "response", "model"), order).alias("l"), total("prompt_tokens"), total("completion_tokens"), total("cost_usd"))
    made = runs.select(F.col("id").alias("run_id"), "task_id").join(last, "run_id", "left")
    outcome = F.lit(None).cast("boolean")
    if labels is not None:
        made = made.join(labels.groupBy("run_id").agg(last_said(labels, "value").alias("label")), "run_id", "left")
        outcome = F.col("label")
    if results is not None:
        made = made.join(results.groupBy("run_id").agg(last_said(results, "passed").alias("passed"), F.lit(True).alias("judged")), "run_id", "left")
        outcome = F.when(F.col("judged"), F.col("passed")).otherwise(outcome)
    made = made.withColumn("success", outcome)
    fine = made.where("l is not null").select("run_id", "task_id", "l.request", "l.response", F.col("l.model").alias("teacher_model"), "prompt_tokens", "completion_tokens", "cost_usd", "success")
    return fine, made.where("l is null").select(F.concat(F.lit("run without calls: "), "run_id").alias("problem"))


def teacher_reason(arm, escalated, marked):
    """Why a logged request counts as written by the teacher; null if it doesn't."""
    return F.when(F.lower(arm) == "teacher", "arm").when(escalated, "escalated").when(marked, "marked message")


def request_traces(log: DataFrame, since, require_outcome: bool = True, exclude_teacher: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(traces, problems, counts) of a request log: rows since a time, with messages, not written by the teacher. Teacher rows
    are counted whether excluded or not."""
    rows = log.where(F.col("received_at") >= since)
    if require_outcome:
        rows = rows.where("outcome is not null")
    why = rows.withColumn("reason", teacher_reason(F.col("arm"), F.col("escalated"), F.exists("messages", lambda m: F.coalesce(m["arm"] == "teacher", F.lit(False)))))
    kept = why.where("reason is null") if exclude_teacher else why
    counts = why.agg(F.count(F.lit(1)).alias("n"), F.count("reason").alias("teacher_written"))
    return kept.where(F.size("messages") > 0), kept.where(F.coalesce(F.size("messages"), F.lit(0)) <= 0).select(F.concat(F.lit("no messages: "), F.col("id").cast("string")).alias("problem")), counts
