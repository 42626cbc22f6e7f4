"""Queries over router learning, gate points and registry selectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from traceloom.operators import selectors as L
from traceloom.operators import thompson as T
from traceloom.plans import views as V
from traceloom.plans.registered import query
from traceloom.plans.evaluation import r6
from traceloom.plans.registry import POST, posterior
from traceloom.sources.tables import read_table

Q = V.REQUESTS


@query("pooled_posterior", f"with {POST} select arm, round(greatest(1e-6, 1 + sum(alpha - 1)), 5) as alpha, round(greatest(1e-6, 1 + sum(beta - 1)), 5) as beta from v_p group by 1")
def pooled_posterior(spark, d):
    return T.pooled(posterior(spark, d)).select("arm", F.round("alpha", 5).alias("alpha"), F.round("beta", 5).alias("beta"))


@query("warm_start", f"with {Q} select cluster_id, arm, count(*) filter (where coalesce(outcome, false)) + 1.0::double as alpha, count(*) filter (where not coalesce(outcome, false)) + 1.0::double as beta from v_request group by 1, 2")
def warm_start(spark, d):
    counts = T.cluster_counts(V.requests(spark, d).withColumn("success", F.col("outcome")))
    return T.warm_start(spark.createDataFrame([], "cluster_id long, arm string, alpha double, beta double"), counts)


@query("router_summary", f"with {POST} select cluster_id, arm, round(alpha / (alpha + beta), 6) as mean, round(alpha + beta - 2, 5) as n, arm = 'student' and alpha + beta - 2 >= 10 and alpha / (alpha + beta) < 0.55 as below_floor from v_p")
def router_summary(spark, d):
    return T.summary(posterior(spark, d)).select("cluster_id", "arm", *r6("mean"), F.round("n", 5).alias("n"), "below_floor")


@query("thompson_choice", f"""with {POST}, w as (select cluster_id, max(alpha) filter (where arm = 'student') as sa, max(beta) filter (where arm = 'student') as sb, max(alpha) filter (where arm = 'teacher') as ta, max(beta) filter (where arm = 'teacher') as tb from v_p group by 1)
select v.id, case when sa + sb - 2 >= 10 and sa / (sa + sb) < 0.25 then 'floor' when sa + sb - 2 >= 30 and ta + tb - 2 >= 30 and (cast('0x' || substr(sha256('0|' || v.id || '|explore'), 1, 12) as bigint) + 0.5) / pow(2, 48) > 0.1 then 'greedy' else 'draw' end as how from v_request v join w on w.cluster_id = v.cluster_id""")
def thompson_choice(spark, d):
    """How the arm of each request was chosen; the draws themselves are tested for their distribution."""
    p = posterior(spark, d)
    side = lambda a, c: F.max(F.when(F.col("arm") == a, F.col(c))).alias(f"{a}_{c}")
    wide = V.requests(spark, d).join(p.groupBy("cluster_id").agg(*(side(a, c) for a in ("student", "teacher") for c in ("alpha", "beta"))), "cluster_id")
    return T.choose(wide, F.col("id"), {"student": 0.001, "teacher": 0.01}, floor=0.25).select("id", "how")


@query("route_health", f"with {Q}, w as (select *, case when user_id % 4 = 0 then null else cluster_id end as c from v_request where received_at >= timestamp '2024-01-20') select count(*) as n, round(avg(fallback::int), 6) as fallback_rate, round(avg((c is null)::int), 6) as unassigned_rate, count(*) >= 20 and avg(fallback::int) > 0.2 as fallback_alert, count(*) >= 20 and avg((c is null)::int) > 0.5 as unassigned_alert from w")
def route_health(spark, d):
    rows = V.requests(spark, d).withColumn("cluster_id", F.when(F.col("user_id") % 4 != 0, F.col("cluster_id")))
    return T.route_health(rows, F.lit("2024-01-20").cast("timestamp")).select("n", *r6("fallback_rate", "unassigned_rate"), "fallback_alert", "unassigned_alert")


@query("fallback_alert", f"with {Q} select count(*) as n, round(avg(fallback::int), 6) as rate, count(*) >= 5 and avg(fallback::int) > 0.15 as alert from v_request where received_at >= timestamp '2024-01-20'")
def fallback_alert(spark, d):
    return T.fallback_alert(V.requests(spark, d), F.lit("2024-01-20").cast("timestamp"), 0.15).select("n", *r6("rate"), "alert")


@query("usage_extraction", """with x as (select event_id, event_id % 3 as k, cast(json_extract_string(props, '$.k') as bigint) as n from events)
select event_id, case when k = 1 then n + 7 else n end as prompt_tokens, case when k = 1 then 7 when k = 2 then 5 end as cached_prompt_tokens from x""")
def usage_extraction(spark, d):
    n = F.get_json_object("props", "$.k")
    texts = [F.format_string('{"usage":{"prompt_tokens":%s}}', n), F.format_string('{"usage":{"input_tokens":%s,"cache_read_input_tokens":7}}', n), F.format_string('{"usage":{"prompt_tokens":%s,"prompt_tokens_details":{"cached_tokens":5}}}', n)]
    payload = F.when(F.col("event_id") % 3 == 0, texts[0]).when(F.col("event_id") % 3 == 1, texts[1]).otherwise(texts[2])
    return read_table(spark, d, "events", "event_id", "props").select("event_id", T.usage(payload).alias("u")).select("event_id", "u.*")


@query("pick_verified", "with p as (select p_size / 50.0::double as tau, avg(p_retailprice) / 1000 as cost, 0.9 - p_size / 500.0 as success from part group by p_size) select round(tau, 6) as tau, round(success, 6) as success from p order by case when (0.9 - success) * 100 <= 5 then 0 else 1 end, case when (0.9 - success) * 100 <= 5 then cost end, tau limit 1")
def pick_verified(spark, d):
    p = read_table(spark, d, "part", "p_size", "p_retailprice").groupBy("p_size").agg((F.avg("p_retailprice") / 1000).alias("cost"))
    points = p.select((F.col("p_size") / 50.0).alias("tau"), "cost", (F.lit(0.9) - F.col("p_size") / 500.0).alias("success"))
    return T.pick_verified(points, 5.0, 0.9).select(*r6("tau", "success"))


@query("escalation", f"with {V.SCORES} select task, count(*) filter (where p >= 0.6) as kept, coalesce(sum(case when p < 0.6 then b end), 0)::bigint as wasted from v_score group by 1")
def escalation(spark, d):
    e = T.escalate(V.scores(spark, d).withColumn("tokens", F.col("b")), 0.6)
    return e.groupBy("task").agg(F.count(F.when(F.col("kept"), 1)).alias("kept"), F.sum("wasted").alias("wasted"))


def adapters(spark, d):
    p = read_table(spark, d, "part", "p_brand", "p_size", "p_partkey", "p_retailprice")
    return p.select(F.col("p_partkey").cast("string").alias("id"), F.concat(F.lit("n"), F.col("p_size").cast("string")).alias("name"), F.when(F.col("p_size") % 5 == 0, "x").alias("parent_id"), F.when(F.col("p_partkey") % 11 == 0, "t").alias("retired_at"), F.col("p_retailprice").alias("created_at"), F.col("p_size").alias("version"), F.col("p_brand").alias("tag"))


def runs(spark, d):
    e = read_table(spark, d, "events", "event_id", "user_id", "value", "event_type")
    return e.select(F.col("event_id").cast("string").alias("id"), F.col("event_id").cast("string").alias("run_id"), F.col("user_id").cast("string").alias("subject"), F.when(F.col("event_type") == "view", "live").when(F.col("event_type") == "click", "replay").alias("mode"), F.col("value").alias("success"), F.col("event_id").alias("started_at"))


_AD = "v_ad as (select p_partkey::varchar as id, 'n' || p_size as name, case when p_size % 5 = 0 then 'x' end as parent_id, case when p_partkey % 11 = 0 then 't' end as retired_at, p_retailprice as created_at, p_size as version, p_brand as tag from part)"
_RUN = "v_run as (select event_id::varchar as id, user_id::varchar as subject, case event_type when 'view' then 'live' when 'click' then 'replay' end as mode, value as success, event_id as started_at from events)"


@query("latest_adapter", f"with {_AD} select id, version from v_ad where retired_at is null and tag like 'Brand#1%' order by created_at desc, version desc limit 1")
def latest_adapter(spark, d):
    return L.latest(adapters(spark, d), ["created_at", "version"], tag="Brand#1*").select("id", "version")


@query("best_adapter", f"with {_AD}, {_RUN}, r as (select a.id, arg_max(struct_pack(s := r.success, t := r.started_at), r.started_at) as r from v_ad a join v_run r on r.subject = a.id where a.retired_at is null and a.parent_id is null group by 1) select id, round(r.s, 6) as success from r order by r.s desc, r.t desc limit 1")
def best_adapter(spark, d):
    return L.best_adapter(adapters(spark, d), runs(spark, d)).select("id", *r6("success"))


@query("adapter_results", f"with {_AD}, {_RUN}, r as (select subject, arg_max(id, started_at) as run_id, arg_max(success, started_at) as success from v_run group by 1) select a.id, r.run_id, round(r.success, 6) as success from v_ad a left join r on r.subject = a.id")
def adapter_results(spark, d):
    return L.adapter_results(adapters(spark, d), runs(spark, d)).select("id", "run_id", *r6("success"))


@query("quantized_child", f"with {_AD} select id from v_ad where retired_at is null and parent_id = 'x' order by created_at desc, id desc limit 1")
def quantized_child(spark, d):
    return L.quantized_child(adapters(spark, d), "x").select("id")


@query("live_and_replay", f"""with {_RUN}, g as (select subject, arg_max(id, started_at) filter (where mode = 'live') as live_run, arg_max(id, started_at) filter (where coalesce(mode, 'replay') = 'replay') as replay_run,
 arg_max(success, started_at) filter (where mode = 'live') - arg_max(success, started_at) filter (where coalesce(mode, 'replay') = 'replay') as delta from v_run group by 1) select subject, live_run, replay_run, round(delta, 6) as delta from g where live_run is not null and replay_run is not null""")
def live_and_replay(spark, d):
    return L.live_and_replay(runs(spark, d)).select("subject", "live_run", "replay_run", *r6("delta"))


@query("run_lookup", f"with {_RUN} select id from v_run where subject = '7' order by started_at desc limit 1")
def run_lookup(spark, d):
    r = L.find_run(runs(spark, d), "latest:7")
    return spark.createDataFrame([(r.id,)], "id string")


@query("registry_counts", f"with {Q} select (select count(*) from conversations) as traces, (select count(*) from nation) as rounds, count(*) as requests, count(outcome) as graded from v_request where received_at >= timestamp '2024-01-10'")
def registry_counts(spark, d):
    return L.counts(V.turns(spark, d), read_table(spark, d, "nation", "n_nationkey"), V.requests(spark, d), F.lit("2024-01-10").cast("timestamp"))


@query("commands_by_time", "select s_acctbal as at, 'a' as kind, s_suppkey::varchar as id, s_name as command from supplier union all select c_acctbal, 'b', c_custkey::varchar, c_name from customer")
def commands_by_time(spark, d):
    a = read_table(spark, d, "supplier", F.col("s_suppkey").alias("id"), "s_acctbal", "s_name")
    b = read_table(spark, d, "customer", F.col("c_custkey").alias("id"), "c_acctbal", "c_name")
    return L.commands((a, "a", "s_acctbal", "s_name"), (b, "b", "c_acctbal", "c_name"))


@query("retire_report", f"with {_AD}, n as (select distinct (p_partkey * 3)::varchar as id from part) select n.id, case when a.id is null then 'unknown' when a.retired_at is not null then 'already retired' else 'retired' end as result from n left join v_ad a on a.id = n.id")
def retire_report(spark, d):
    ids = read_table(spark, d, "part", (F.col("p_partkey") * 3).cast("string").alias("id"))
    return L.retire(adapters(spark, d).withColumn("retired_reason", F.lit(None).cast("string")), ids, F.lit("now"), "stale")[1]


@query("router_state", f"with {POST} select cluster_id, arm, case when arm = 'teacher' then 5.0 else round(alpha, 5) end as alpha from v_p")
def router_state(spark, d):
    p = posterior(spark, d).select("cluster_id", "arm", F.round("alpha", 5).alias("alpha"))
    return L.router_state(p, p.where("arm = 'teacher'").withColumn("alpha", F.lit(5.0)))


@query("disjoint_splits", "select doc_id as key, ['a', 'b'] as sets from documents d where exists (select 1 from labels l where l.doc_id = d.doc_id)")
def disjoint_splits(spark, d):
    return L.disjoint(("a", read_table(spark, d, "documents", "doc_id")), ("b", read_table(spark, d, "labels", "doc_id")), key="doc_id")


@query("stable_trace_order", "select o_orderkey as id, o_orderdate as created_at from orders order by o_orderdate, o_orderkey limit 50")
def stable_trace_order(spark, d):
    return L.trace_order(read_table(spark, d, "orders", F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("created_at")), 50)


@query("rounds_for_tag", "select o_orderkey as round_idx, o_orderstatus as tag from orders where o_orderstatus in ('F', 'P') order by o_orderkey")
def rounds_for_tag(spark, d):
    """Orders as rounds, their status as tag; two patterns, of which one is a prefix."""
    o = read_table(spark, d, "orders", F.col("o_orderkey").alias("round_idx"), F.col("o_orderstatus").alias("tag"))
    return L.rounds_for_tag(o, "F*").unionByName(L.rounds_for_tag(o, "P"))


@query("sft_dataset_hash", """select coalesce(arg_max(p_name, struct_pack(a := p_size, b := p_partkey::varchar)) filter (where p_brand = 'Brand#11'), 'missing') as content_hash from part
 union all select 'missing' from (select count(*) from part)""")
def sft_dataset_hash(spark, d):
    """Parts as datasets: the newest of one brand, and of a brand that there isn't."""
    p = read_table(spark, d, "part", "p_brand", "p_size", "p_partkey", "p_name")
    of = lambda brand: p.select(F.when(F.col("p_brand") == brand, "sft").otherwise("pairs").alias("kind"), F.col("p_size").alias("version"), F.col("p_partkey").alias("created_at"), F.col("p_name").alias("content_hash"))
    return L.sft_hash(of("Brand#11"), "missing").unionByName(L.sft_hash(of("none"), "missing"))


_CAL = """v_cal as (select p_partkey::varchar as id, p_size % 10 as adapter_id, p_retailprice as created_at, p_partkey % 3 > 0 as usable, case when p_partkey % 4 > 0 then p_size / 100.0 + 0.2 end as threshold, case when p_partkey % 5 > 0 then 'entropy,turn' else 'turn' end as f from part),
 v_new as (select adapter_id, arg_max(id, struct_pack(a := created_at, b := id)) as id, arg_max(usable, struct_pack(a := created_at, b := id)) as usable, arg_max(struct_pack(t := threshold), struct_pack(a := created_at, b := id)).t as threshold, arg_max(f, struct_pack(a := created_at, b := id)) as f from v_cal group by 1)"""


def calibrations(spark, d):
    """Parts as stored calibrations of ten adapters."""
    p = read_table(spark, d, "part", "p_partkey", "p_size", "p_retailprice")
    k = F.col("p_partkey")
    order = F.when(k % 5 > 0, F.array(F.lit("entropy"), F.lit("turn"))).otherwise(F.array(F.lit("turn")))
    return p.select(k.cast("string").alias("id"), (F.col("p_size") % 10).alias("adapter_id"), F.col("p_retailprice").alias("created_at"), (k % 3 > 0).alias("usable"), F.when(k % 4 > 0, F.col("p_size") / 100.0 + 0.2).alias("threshold"), order.alias("feature_order"))


@query("calibration_for_adapter", f"with {_CAL} select adapter_id, id, usable, round(threshold, 6) as threshold, f as features from v_new")
def calibration_for_adapter(spark, d):
    return L.calibrations_for(calibrations(spark, d)).select("adapter_id", "id", "usable", F.round("threshold", 6).alias("threshold"), F.array_join("feature_order", ",").alias("features"))


@query("cascade_from_calibration", f"""with {_CAL}, {V.SCORES}, t as (select doc_id, doc_id % 12 as adapter_id, case when doc_id % 7 > 0 then p end as score from v_score)
select doc_id, n.id is null or not usable or f <> 'entropy,turn' or score is null or score < coalesce(threshold, 1.0) as escalate, case when n.id is null then 'no calibration' when not usable then 'unusable' when f <> 'entropy,turn' then 'other features' when score is null then 'no score' when score < coalesce(threshold, 1.0) then 'below the threshold' end as why
from t left join v_new n on n.adapter_id = t.adapter_id""")
def cascade_from_calibration(spark, d):
    """Turns of twelve adapters, of which ten have a calibration, under the newest one of each."""
    t = V.scores(spark, d).select("doc_id", (F.col("doc_id") % 12).alias("adapter_id"), F.when(F.col("doc_id") % 7 > 0, F.col("p")).alias("score"))
    return L.cascade_decisions(t, calibrations(spark, d), ["entropy", "turn"]).select("doc_id", "escalate", "why")
