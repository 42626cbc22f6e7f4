"""Queries over costs, clusters and blocks of reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from traceloom.operators import assembly as A
from traceloom.operators import clustering as K
from traceloom.plans import views as V
from traceloom.plans.registered import query
from traceloom.plans.evaluation import r6
from traceloom.plans.routing import _RUN, runs
from traceloom.sources.tables import read_table


@query("arm_costs", "select round(avg(value) * (2.0 / (800 * 0.6 * 3600) * 1e6) / 1e6, 9) as student, round((avg(user_id) * 0.9 * 3 + avg(user_id) * 0.1 * 0.3 + avg(value) * 15) / 1e6, 9) as teacher from events")
def arm_costs(spark, d):
    means = read_table(spark, d, "events", "value", "user_id").agg(F.avg("value").alias("student_tokens"), F.avg("user_id").alias("teacher_prompt_tokens"), F.avg("value").alias("teacher_completion_tokens"), F.lit(0.1).alias("cache_hit_frac"))
    return A.arm_costs(means, {"input": 3.0, "output": 15.0, "cache_read": 0.3}, 2.0).select(F.round("student", 9).alias("student"), F.round("teacher", 9).alias("teacher"))


@query("cost_block", """with x as (select p_partkey, p_size * 10.0 as tps, case when p_partkey % 3 = 0 then 'batched' else 'unbatched' end as mode, p_size / 100.0 as esc, p_retailprice / 1000 as t from part),
 y as (select *, 500 * (2.0 / (tps * 0.6 * 3600) * 1e6) / 1e6 + esc * t as c from x)
select p_partkey, round(c, 6) as cascade_cost, case when mode = 'batched' then round(1 - c / t, 6) end as saving, case when mode = 'batched' then round(2.0 * 24 / (t - esc * t), 6) end as breakeven_per_day from y""")
def cost_block(spark, d):
    p = read_table(spark, d, "part", "p_partkey", "p_size", "p_retailprice")
    rows = p.select(
        "p_partkey", F.lit(2.0).alias("gpu_hour"), (F.col("p_size") * 10.0).alias("tokens_per_second"), F.when(F.col("p_partkey") % 3 == 0, "batched").otherwise("unbatched").alias("mode"),
        (F.col("p_size") / 100.0).alias("escalation_rate"), (F.col("p_retailprice") / 1000).alias("teacher_cost"), F.lit(500).alias("student_tokens"), F.lit(None).cast("double").alias("wasted"),
    )
    return A.cost_block(rows).select("p_partkey", *r6("cascade_cost", "saving", "breakeven_per_day"))


@query("spend_cap", """with u as (select count(*) as n, avg(length(text)) as pt, avg(turn) as ct from conversations), s as (select stage, n * r * p * (pt * i + ct * o) / 1e6 as usd from u, (values ('rollouts', 4, 1, 1.0, 2.0), ('judge', 1, 2, 3.0, 15.0)) x(stage, r, p, i, o))
select stage, round(usd, 6) as usd, round(2 * (select sum(usd) from s), 6) as cap from s""")
def spend_cap(spark, d):
    stages = spark.createDataFrame([("rollouts", 4, 1, "small"), ("judge", 1, 2, "large")], "stage string, repeats int, passes int, model string")
    prices = spark.createDataFrame([("small", 9.0, 9.0, "2023"), ("small", 1.0, 2.0, "2024"), ("large", 3.0, 15.0, "2024")], "model string, input double, output double, effective_from string")
    tasks = V.turns(spark, d).select(F.length("text").alias("prompt_tokens"), F.col("turn").alias("completion_tokens"))
    return A.spend(tasks, stages, prices).select("stage", *r6("usd", "cap"))


@query("price_in_force", "select c_mktsegment as provider, c_nationkey as model, arg_max(c_acctbal, c_custkey) as input from customer group by 1, 2")
def price_in_force(spark, d):
    p = read_table(spark, d, "customer", F.col("c_mktsegment").alias("provider"), F.col("c_nationkey").alias("model"), F.col("c_custkey").alias("effective_from"), F.col("c_acctbal").alias("input"))
    return A.price_in_force(p).select("provider", "model", "input")


@query("price_upsert", "select c_mktsegment as provider, c_nationkey as model, c_custkey as effective_from, case when c_nationkey = 3 then 1.5 else c_acctbal end as input from customer")
def price_upsert(spark, d):
    p = read_table(spark, d, "customer", F.col("c_mktsegment").alias("provider"), F.col("c_nationkey").alias("model"), F.col("c_custkey").alias("effective_from"), F.col("c_acctbal").alias("input"))
    return A.upsert_prices(p, p.where("model = 3").withColumn("input", F.lit(1.5)))


@query("cluster_assignment", """with c as (select label as cluster, embedding as e from embeddings where vec_id in (select min(vec_id) from embeddings group by label)),
 x as (select v.vec_id, c.cluster, list_sum(list_transform(range(1, 65), lambda i: (v.embedding[i]::double - c.e[i]::double) * (v.embedding[i]::double - c.e[i]::double))) as d from embeddings v, c)
select vec_id, arg_min(cluster, struct_pack(d := d, c := cluster)) as cluster, round(min(d), 6) as distance from x group by 1""")
def cluster_assignment(spark, d):
    e = read_table(spark, d, "embeddings", "vec_id", "embedding", "label")
    first = e.groupBy(F.col("label").alias("cluster")).agg(F.min_by("embedding", "vec_id").cast("array<double>").alias("centroid"))
    return K.assign(e.withColumn("embedding", F.col("embedding").cast("array<double>")), "embedding", first).select("vec_id", "cluster", *r6("distance"))


@query("first_turns", "select conv_id as trace, turn from (select *, row_number() over (partition by conv_id order by turn) as k from conversations where role = 'assistant') where k <= 2 order by 1, 2 limit 50")
def first_turns(spark, d):
    return A.first_turns(V.turns(spark, d).withColumnRenamed("conv_id", "trace")).select("trace", "turn")


@query("retrain_facts", f"with {V.REQUESTS}, {_RUN} select (select count(*) from v_request where received_at >= timestamp '2024-01-20' and outcome is not null) as graded, (select count(*) from labels) as samples, arg_max(id, started_at) as run_id, round(arg_max(success, started_at), 6) as success from v_run")
def retrain_facts(spark, d):
    return A.retrain_facts(V.requests(spark, d), read_table(spark, d, "labels", "doc_id"), runs(spark, d), F.lit("2024-01-20").cast("timestamp")).select("graded", "samples", "run_id", *r6("success"))


@query("eval_rows_of_run", f"with {V.RESULTS} select task_id, repeat_idx, success from v_result where run = 'B'")
def eval_rows_of_run(spark, d):
    return A.eval_rows(V.results(spark, d), "B").select("task_id", "repeat_idx", "success")


@query("sample_kinds", "select event_type as kind, count(*) as n, sum(user_id)::bigint as tokens, sum(event_id)::bigint as target_tokens from events group by 1")
def sample_kinds(spark, d):
    return A.sample_kinds(read_table(spark, d, "events", F.col("event_type").alias("kind"), F.col("user_id").alias("n_tokens"), F.col("event_id").alias("n_target_tokens")))
