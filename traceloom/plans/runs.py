"""Queries over runs: merged statistics, tables and comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from traceloom.operators import runs as U
from traceloom.operators import statistics as S
from traceloom.plans import views as V
from traceloom.plans.registered import query
from traceloom.plans.evaluation import P, pairs, r6
from traceloom.sources.tables import read_table

R = V.RESULTS


@query("replay_stats", f"""with {R}, x as (select run, sum(turns)::bigint as replayed, sum(id % 3)::bigint as fuzzy, count(*) filter (where kind = 'error') as diverged, min(case when id % 3 > 0 then tokens / 200 end) as m from v_result group by 1)
select run, replayed, fuzzy, diverged, round(m, 6) as min_fuzzy_score, round(fuzzy / (replayed + fuzzy), 6) as fuzzy_share from x""")
def replay_stats(spark, d):
    f = F.col("id") % 3
    rows = V.results(spark, d).select("run", F.col("turns").alias("replayed"), f.alias("fuzzy"), (F.col("kind") == "error").cast("int").alias("diverged"), F.when(f > 0, F.col("tokens") / 200).alias("min_fuzzy_score"))
    return U.replay_stats(rows, ["run"]).select("run", "replayed", "fuzzy", "diverged", *r6("min_fuzzy_score", "fuzzy_share"))


@query("live_stats", f"""with {R}, t as (select run, kind, sum(turns)::bigint as n from v_result group by all),
 m as (select run, string_agg(kind || '=' || n, ',' order by kind) as tools from t group by 1)
select v.run, sum(turns)::bigint as calls, count(*) filter (where kind = 'error') as errors, round(count(*) filter (where kind = 'error') / sum(turns), 6) as error_rate, any_value(m.tools) as tools from v_result v join m on m.run = v.run group by 1""")
def live_stats(spark, d):
    rows = V.results(spark, d).select("run", F.col("turns").alias("calls"), (F.col("kind") == "error").cast("int").alias("errors"), F.create_map("kind", "turns").alias("tools"))
    out = U.live_stats(rows, ["run"])
    text = F.array_join(F.transform(F.map_entries("by_tool"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return out.select("run", "calls", "errors", *r6("error_rate"), text.alias("tools"))


@query("usage_metrics", """select event_type, round(median(value), 6) as prompt_tokens_median, median(user_id)::double as completion_tokens_median,
 round(sum(case when event_id % 2 = 0 and event_type <> 'view' then value / 2 else 0 end) / nullif(sum(case when event_type <> 'view' then value end), 0), 6) as cache_hit_frac from events group by 1""")
def usage_metrics(spark, d):
    e = read_table(spark, d, "events", "event_id", "user_id", "event_type", "value")
    rows = e.select("event_type", F.col("value").alias("prompt_tokens"), F.col("user_id").alias("completion_tokens"), F.when((F.col("event_id") % 2 == 0) & (F.col("event_type") != "view"), F.col("value") / 2).alias("cached_prompt_tokens"))
    return U.usage_metrics(rows, ["event_type"]).select("event_type", *r6("prompt_tokens_median", "completion_tokens_median", "cache_hit_frac"))


@query("batched_throughput", f"with {R} select run, round(sum(tokens) / max(turns), 4) as tokens_per_second, 'batched' as mode from v_result group by run")
def batched_throughput(spark, d):
    return U.batched_throughput(V.results(spark, d), ["run"], F.max("turns")).select("run", F.round("tokens_per_second", 4).alias("tokens_per_second"), "mode")


@query("cascade_metrics", f"with {R} select run, round(count(*) filter (where kind = 'error') / sum(turns), 6) as escalation_rate, count(*) filter (where kind = 'error') as escalations, round(median(case when kind = 'error' then tokens else 0 end), 6) as wasted_student_tokens_median, 0.7::double as cascade_threshold from v_result group by run")
def cascade_metrics(spark, d):
    wasted = F.col("kind") == "error"
    rows = V.results(spark, d).select("run", F.col("turns").alias("n_turns"), wasted.cast("int").alias("escalations"), F.when(wasted, F.col("tokens")).alias("wasted_student_tokens"))
    return U.cascade_metrics(rows, ["run"], 0.7).select("run", *r6("escalation_rate"), "escalations", *r6("wasted_student_tokens_median"), "cascade_threshold")


@query("observed_rates", f"with {P} select round(avg(a), 6) as rate_a, round(avg(b), 6) as rate_b, count(*) as n_shared_tasks from v_pair")
def observed_rates(spark, d):
    return U.observed_rates(V.results(spark, d)).select(*r6("rate_a", "rate_b"), "n_shared_tasks")


@query("stop_reasons", f"with {R}, n as (select run, kind, count(*) as n from v_result group by all) select run, string_agg(kind || '=' || n, ',' order by kind) as reasons from n group by 1")
def stop_reasons(spark, d):
    out = U.stop_reasons(V.results(spark, d), ["run"], "kind")
    return out.select("run", F.array_join(F.transform(F.map_entries("stop_reasons"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("reasons"))


@query("divergence_summary", f"with {V.CALLS}, x as (select tool, count(*) as n, round(max(id % 97 / 97.0), 6) as max_score, arg_min(args, id) as example, min(id) as f from v_call where id % 5 = 0 or error group by 1) select tool, n, max_score, example from x order by n desc, f limit 3")
def divergence_summary(spark, d):
    rows = V.calls(spark, d).where("id % 5 = 0 or error").select("tool", "args", "id", (F.col("id") % 97 / 97.0).alias("score"))
    return U.divergence_summary(rows, 3).select("tool", "n", *r6("max_score"), "example")


@query("per_task_table", f"""with {R} select task_id, count(*) filter (where success) || '/' || count(*) as success, count(*) filter (where kind = 'view') || '/' || count(*) as diverged, arg_min(kind || ' ' || id, repeat_idx) filter (where not success) as first_failure from v_result where run = 'A' group by 1""")
def per_task_table(spark, d):
    rows = V.results(spark, d).where("run = 'A'").select("task_id", "repeat_idx", "success", (F.col("kind") == "view").alias("diverged"), F.concat_ws(" ", "kind", F.col("id").cast("string")).alias("detail"))
    return U.per_task(rows)


_DRAWS = "n as (select count(*) as n from {0}), x as (select i.range as it, cast('0x' || substr(sha256('0:' || i.range || ':' || k.range), 1, 8) as bigint) % n as slot from n, range(200) i, (select unnest(range((select n from n))) as range) k)"


@query("median_difference_ci", f"""with {P}, s as (select a, b, a - b as d, row_number() over (order by task_id) - 1 as slot from v_pair), {_DRAWS.format('v_pair')},
 m as (select it, median(d) as m from x join s on s.slot = x.slot group by it)
select round((select median(a) from s), 6) as median_a, round((select median(b) from s), 6) as median_b, round((select median(d) from s), 6) as median_difference, round(quantile_cont(m, 0.025), 6) as low, round(quantile_cont(m, 0.975), 6) as high from m""")
def median_difference_ci(spark, d):
    return U.median_difference(pairs(spark, d)).select(*r6("median_a", "median_b", "median_difference", "low", "high"))


@query("live_delta_ci", f"""with {V.REQUESTS}, c as (select cluster_id, count(*) filter (where adapter = 'prod') as np, count(*) filter (where adapter = 'canary') as nc, avg(outcome::int) filter (where adapter = 'prod') as rp, avg(outcome::int) filter (where adapter = 'canary') as rc
  from v_request where arm = 'student' and not fallback and outcome is not null and cluster_id is not null group by 1), w as (select cluster_id, least(np, nc) as w, rc - rp as d from c where np >= 5 and nc >= 5),
 s as (select *, row_number() over (order by cluster_id) - 1 as slot from w), {_DRAWS.format('w')}, m as (select it, sum(w * d) / sum(w) as m from x join s on s.slot = x.slot group by it)
select round((select sum(w * d) / sum(w) from s), 6) as delta, round(quantile_cont(m, 0.025), 6) as low, round(quantile_cont(m, 0.975), 6) as high from m""")
def live_delta_ci(spark, d):
    return U.live_interval(S.live_clusters(V.requests(spark, d))).select(*r6("delta", "low", "high"))


@query("full_compare", f"""with {P}, s as (select b - a as d, row_number() over (order by task_id) - 1 as slot from v_pair), n as (select count(*) as n from v_pair),
 x as (select i.range as it, cast('0x' || substr(sha256('0:' || i.range || ':' || k.range), 1, 8) as bigint) % n as slot from n, range(20) i, (select unnest(range((select n from n))) as range) k), m as (select it, avg(d) as m from x join s on s.slot = x.slot group by it),
 e as (select quantile_cont(m, 0.025) as low, quantile_cont(m, 0.975) as high from m),
 c as (select count(*) as n, count(*) filter (where a <= 0.5 and b > 0.5) as only_b, count(*) filter (where a > 0.5 and b <= 0.5) as only_a, avg(b) - avg(a) as delta, avg(b) as rate_a, avg(a) as rate_b from v_pair),
 t as (select task_id, least(count(*) filter (where run = 'A'), count(*) filter (where run = 'B')) as r from v_result group by 1), g as (select min(r) as r from t where r > 0),
 w as (select *, case when n < 20 then 'too few tasks' when (select r from g) < 3 then 'too few repeats' end as refusal, only_a + only_b as k from c, e)
select n as n_shared_tasks, refusal, round(rate_a, 6) as rate_a, round(rate_b, 6) as rate_b, case when refusal is null then round(delta, 6) end as delta, case when refusal is null then round(low, 6) end as low, case when refusal is null then round(high, 6) end as high,
 case when refusal is null then only_b end as only_a, case when refusal is null then only_a end as only_b,
 case when refusal is null then round(case when k = 0 then 1.0 else least(1, 2 * list_sum(list_transform(range(0, least(only_a, only_b) + 1), lambda i: exp(lgamma(k + 1.0) - lgamma(i + 1.0) - lgamma(k - i + 1.0) - k * ln(2.0))))) end, 6) end as p from w""")
def full_compare(spark, d):
    """Run B against run A, so that the shared tasks' differences are those of the paired table. A refusal is a result: its row says why."""
    runs = spark.createDataFrame([("A", "s", None), ("B", "s", "replay")], "id string, eval_set_id string, mode string")
    got = U.compare(runs, V.results(spark, d), "B", "A", iterations=20)
    six = lambda x: None if x is None else round(x, 6)
    said, odd = got.get("success", {}), got.get("mcnemar", {})
    row = (got["n_shared_tasks"], got.get("refusal"), six(got["observed"]["rate_a"]), six(got["observed"]["rate_b"]), six(said.get("delta")), six(said.get("low")), six(said.get("high")), odd.get("only_a"), odd.get("only_b"), six(odd.get("p")))
    return spark.createDataFrame([row], "n_shared_tasks long, refusal string, rate_a double, rate_b double, delta double, low double, high double, only_a long, only_b long, p double")


@query("merge_drift", f"""with {R}, t as (select task_id, avg((turns > 3)::int) * 100 as a, avg((turns > 4)::int) * 100 as b from v_result where run = 'A' group by 1) select 0::bigint as misaligned, round(avg(b - a), 6) as delta from t""")
def merge_drift(spark, d):
    rows = V.results(spark, d).where("run = 'A'")
    side = lambda n: rows.select(F.col("task_id").alias("trace"), F.col("repeat_idx").alias("turn"), (F.col("turns") > n).alias("full"))
    return U.full_match_drift(side(3), side(4), 20).select("misaligned", *r6("delta"))


@query("quantization_verdict", "select p_partkey, round((0.9 - p_size / 60.0) * 100, 6) as drop_pp, round((0.9 - p_size / 60.0) * 100, 9) <= 2.0 as ok from part")
def quantization_verdict(spark, d):
    v = U.quantization_verdict(F.lit(0.9), F.col("p_size") / 60.0)
    return read_table(spark, d, "part", "p_partkey", "p_size").select("p_partkey", v.alias("v")).select("p_partkey", F.round("v.drop_pp", 6).alias("drop_pp"), "v.ok")


@query("holdout_error", f"""with {V.SCORES}, x as (select doc_id, p > 0.4 as j, y = 1 as t, cast('0x' || substr(sha256('h|' || doc_id), 1, 8) as bigint) % 2 as half from v_score),
 c as (select count(*) filter (where j and t) / count(*) filter (where t) as sens, count(*) filter (where not j and not t) / count(*) filter (where not t) as spec, count(*) >= 30 as usable from x where half = 0),
 r as (select count(*) as n, avg(j::int) as observed, avg(t::int) as actual from x where half = 1)
select n, round(observed, 6) as observed, round(actual, 6) as actual, round(case when usable and sens + spec - 1 > 1e-6 then greatest(0, least(1, (observed + spec - 1) / (sens + spec - 1))) end, 6) as corrected from r, c""")
def holdout_error(spark, d):
    rows = V.scores(spark, d).select(F.col("doc_id").alias("id"), (F.col("p") > 0.4).alias("j"), (F.col("y") == 1).alias("t"))
    return U.holdout_error(rows, "j", "t").select("n", *r6("observed", "actual", "corrected"))


@query("cluster_table", f"""with {R}, t as (select kind, cluster, task_id, avg(success::int) as m from v_result group by all), x as (select kind as subject, case when cluster = 6 then 'none' else cluster::varchar end as cluster, avg(m) as success, count(*) as n from t group by all)
select cluster, max(n) filter (where subject = 'click') as n_tasks, round(max(success) filter (where subject = 'click'), 6) as click, round(max(success) filter (where subject = 'error'), 6) as error, case when max(success) filter (where subject = 'error') < 0.55 then 'teacher' when max(success) filter (where subject = 'error') is not null then 'student' end as routing from x group by 1""")
def cluster_table(spark, d):
    from traceloom.operators.evaluation import task_means

    per = task_means(V.results(spark, d), ["kind", "cluster"], F.col("success"))
    rows = per.select(F.col("kind").alias("subject"), F.when(F.col("cluster") != 6, F.col("cluster").cast("string")).alias("cluster"), F.col("mean").alias("success"), "n_tasks")
    return U.cluster_table(rows, ["click", "error"]).select("cluster", "n_tasks", *r6("click", "error"), "routing")


@query("coverage_summary", """with a as (select user_id % 7 as k, count(*) as n from events group by 1), b as (select user_id % 7 as k, count(*) as n from events where event_type = 'error' and value > 60 group by 1), c as (select coalesce(a.n, 0) as n, coalesce(b.n, 0) as m from a full join b on a.k = b.k)
select count(*) as n_clusters, count(*) filter (where m < 10) as n_sparse, sum(m)::bigint as n_after, round(sum(m) / sum(n), 6) as share from c""")
def coverage_summary(spark, d):
    from traceloom.operators.curation import coverage

    e = read_table(spark, d, "events", "user_id", "event_type", "value").withColumn("cluster", F.col("user_id") % 7)
    return U.coverage_summary(coverage(e, e.where("event_type = 'error' and value > 60"), "cluster")).select("n_clusters", "n_sparse", "n_after", *r6("share"))


@query("run_aggregate_full", f"""with {R}, t as (select run, task_id, avg(success::int) as m, count(*) as n from v_result group by all), s as (select run, kind, count(*) as n from v_result group by all),
 a as (select run, avg(m) as success, count(*) as n_tasks, max(n) as n_per_task from t group by 1), b as (select run, avg((kind <> 'view')::int) as sv, avg((kind = 'click')::int) as dv, median(turns) as mt, median(cluster) as mc, median(tokens) as mk, median(tokens * 10) as ml from v_result group by 1),
 r as (select run, string_agg(kind || '=' || n, ',' order by kind) as reasons from s group by 1)
select a.run, round(success, 6) as success, n_tasks, n_per_task, round(sv, 6) as schema_valid, round(dv, 6) as diverged, round(mt, 6) as n_turns_median, round(mc, 6) as n_tool_calls_median, round(mk, 6) as tokens_median, round(ml, 6) as latency_ms_median, reasons from a join b on b.run = a.run join r on r.run = a.run""")
def run_aggregate_full(spark, d):
    rows = V.results(spark, d).withColumns({"schema_valid": F.col("kind") != "view", "diverged": F.col("kind") == "click", "n_turns": F.col("turns"), "n_tool_calls": F.col("cluster"), "latency_ms": F.col("tokens") * 10, "stop_reason": F.col("kind")})
    out = U.aggregate(rows)
    reasons = F.array_join(F.transform(F.map_entries("stop_reasons"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("reasons")
    return out.select("run", *r6("success"), "n_tasks", "n_per_task", *r6("schema_valid", "diverged", "n_turns_median", "n_tool_calls_median", "tokens_median", "latency_ms_median"), reasons)
