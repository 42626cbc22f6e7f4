"""Evaluation, statistics, gate and cost queries."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from traceloom.operators import cost as M
from traceloom.operators import evaluation as E
from traceloom.operators import gate as G
from traceloom.operators import statistics as S
from traceloom.operators.ordered import running
from traceloom.plans import views as V
from traceloom.plans.registered import query
from traceloom.sources.tables import read_table

R = V.RESULTS
r6 = lambda *cs: [F.round(c, 6).alias(c) for c in cs]


@query("run_aggregate", f"""with {R}, t as (select run, task_id, avg(success::int) as m, count(*) as n from v_result group by all)
select a.run, round(a.success, 6) as success, a.n_tasks, a.n_per_task, round(b.schema_valid, 6) as schema_valid, b.turns, b.tokens from
 (select run, avg(m) as success, count(*) as n_tasks, max(n) as n_per_task from t group by run) a join
 (select run, avg((kind <> 'view')::int) as schema_valid, median(turns) as turns, round(median(tokens), 6) as tokens from v_result group by run) b on a.run = b.run""")
def run_aggregate(spark, d):
    return E.run_aggregate(V.results(spark, d)).select("run", *r6("success"), "n_tasks", "n_per_task", *r6("schema_valid"), "turns", *r6("tokens"))


@query("two_level_mean", f"with {R}, t as (select run, task_id, avg(tokens) as m from v_result group by all) select run, round(avg(m), 6) as mean, count(*) as n_tasks from t group by run")
def two_level_mean(spark, d):
    return E.task_means(V.results(spark, d), ["run"], F.col("tokens")).select("run", *r6("mean"), "n_tasks")


@query("per_cluster_success", f"with {R}, t as (select run, cluster, task_id, avg(success::int) as m from v_result group by all) select run, cluster, round(avg(m), 6) as mean, count(*) as n_tasks from t group by all")
def per_cluster_success(spark, d):
    return E.task_means(V.results(spark, d), ["run", "cluster"], F.col("success")).select("run", "cluster", *r6("mean"), "n_tasks")


@query("throughput", f"with {R} select run, round(sum(tokens) / (sum(turns) / 1000), 4) as tokens_per_second from v_result group by run")
def throughput(spark, d):
    return E.throughput(V.results(spark, d), "run", F.col("tokens"), F.col("turns")).select("run", F.round("tokens_per_second", 4).alias("tokens_per_second"))


@query("conditional_avgs", f"""with {V.REQUESTS}, n as (select * from v_request order by received_at desc, id desc limit 5000)
select round(avg(case when arm = 'teacher' then student_tokens end), 6) as teacher_mean, round(avg(case when arm = 'student' then student_tokens end), 6) as student_mean,
 count(*) as n, count(*) filter (where arm = 'teacher') as n_teacher from n""")
def conditional_avgs(spark, d):
    new = V.requests(spark, d).orderBy(F.desc("received_at"), F.desc("id")).limit(5000)
    mean = lambda a: F.round(F.avg(F.when(F.col("arm") == a, F.col("student_tokens"))), 6)
    return new.agg(mean("teacher").alias("teacher_mean"), mean("student").alias("student_mean"), F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("arm") == "teacher", 1)).alias("n_teacher"))


@query("log_summary", f"""with {V.REQUESTS} select count(*) as requests, count(outcome) as graded, count(*) filter (where outcome is null) as ungraded, count(*) filter (where outcome) as successful,
 count(*) filter (where fallback) as escalated, count(*) filter (where arm = 'teacher') as teacher_written from v_request""")
def log_summary(spark, d):
    c = lambda x: F.count(F.when(x, 1))
    o = F.col("outcome")
    return V.requests(spark, d).agg(F.count(F.lit(1)).alias("requests"), F.count("outcome").alias("graded"), c(o.isNull()).alias("ungraded"), c(o).alias("successful"), c(F.col("fallback")).alias("escalated"), c(F.col("arm") == "teacher").alias("teacher_written"))


@query("corpus_sources", "select case when count(distinct source) = 1 then max(source) else 'mixed: ' || string_agg(distinct source, ', ' order by source) end as writers from documents")
def corpus_sources(spark, d):
    s = F.array_sort(F.collect_set("source"))
    return read_table(spark, d, "documents", "source").agg(F.when(F.size(s) == 1, s[0]).otherwise(F.concat(F.lit("mixed: "), F.array_join(s, ", "))).alias("writers"))


@query("next_version", "select p_brand, coalesce(max(p_size), 0) + 1 as next_version from part group by p_brand")
def next_version(spark, d):
    return read_table(spark, d, "part", "p_brand", "p_size").groupBy("p_brand").agg((F.coalesce(F.max("p_size"), F.lit(0)) + 1).alias("next_version"))


@query("dataset_hash", "select lang, sha256(string_agg(h, '|' order by h)) as content_hash from (select lang, sha256(text) as h from documents) group by lang")
def dataset_hash(spark, d):
    t = read_table(spark, d, "documents", "lang", F.sha2("text", 256).alias("h"))
    return t.groupBy("lang").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "|"), 256).alias("content_hash"))


@query("count_of_counts", "select c, count(*) as n from (select o_custkey, count(*) as c from orders group by 1) group by 1")
def count_of_counts(spark, d):
    return read_table(spark, d, "orders", "o_custkey").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n"))


@query("prefix_token_cost", """with t as (select conv_id, role, ceil(length(text) / 4) as k, coalesce(sum(ceil(length(text) / 4)) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0) as before from conversations)
select conv_id, cast(sum(before) as bigint) as prompt_tokens, cast(sum(k) as bigint) as completion_tokens from t where role = 'assistant' group by 1""")
def prefix_token_cost(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    t = V.turns(spark, d).select("conv_id", "turn", "role", F.ceil(F.length("text") / 4).alias("k"))
    t = t.withColumn("before", F.coalesce(F.sum("k").over(w), F.lit(0))).where("role = 'assistant'")
    return t.groupBy("conv_id").agg(F.sum("before").alias("prompt_tokens"), F.sum("k").alias("completion_tokens"))


@query("stage_spend", """with p as (select avg(length(text)) as k from conversations) select stage, round(n * k * price, 6) as usd from p,
 (values ('rollouts', 3, 0.002), ('eval', 5, 0.002), ('judge', 1, 0.01)) s(stage, n, price)""")
def stage_spend(spark, d):
    stages = spark.createDataFrame([("rollouts", 3, 0.002), ("eval", 5, 0.002), ("judge", 1, 0.01)], "stage string, n int, price double")
    k = V.turns(spark, d).agg(F.avg(F.length("text")).alias("k"))
    return k.join(F.broadcast(stages), how="cross").select("stage", F.round(F.col("n") * F.col("k") * F.col("price"), 6).alias("usd"))  # three rows


@query("missing_share", "select round(avg((l.quality is null)::int), 6) as quality, round(avg((l.toxic is null)::int), 6) as toxic from documents d left join labels l on l.doc_id = d.doc_id")
def missing_share(spark, d):
    x = read_table(spark, d, "documents", "doc_id").join(read_table(spark, d, "labels"), "doc_id", "left")
    return x.agg(*(F.round(F.avg(F.col(c).isNull().cast("double")), 6).alias(c) for c in ("quality", "toxic")))


P = f"{R}, v_pair as (select task_id, avg(success::int) filter (where run = 'A') as a, avg(success::int) filter (where run = 'B') as b, count(*) filter (where run = 'A') as na, count(*) filter (where run = 'B') as nb from v_result group by 1 having a is not null and b is not null)"


def pairs(spark, d):
    return S.paired(V.results(spark, d), F.col("success"))


@query("paired_means", f"with {P} select task_id, round(a, 6) as a, round(b, 6) as b from v_pair")
def paired_means(spark, d):
    return pairs(spark, d).select("task_id", *r6("a", "b"))


@query("power_guard", f"with {P} select count(*) as n_tasks, coalesce(min(least(na, nb)), 0) as n_repeats, case when count(*) < 20 then 'too few tasks' when coalesce(min(least(na, nb)), 0) < 3 then 'too few repeats' end as refusal from v_pair")
def power_guard(spark, d):
    return S.power_guard(pairs(spark, d))


@query("bootstrap_ci", f"""with {P}, n as (select count(*) as n from v_pair), s as (select b - a as d, row_number() over (order by task_id) - 1 as slot from v_pair),
 x as (select i.range as it, cast('0x' || substr(sha256('0:' || i.range || ':' || k.range), 1, 8) as bigint) % n as slot from n, range(200) i, (select unnest(range((select n from n))) as range) k),
 m as (select it, avg(d) as m from x join s on s.slot = x.slot group by it)
select round((select avg(d) from s), 6) as delta, round(quantile_cont(m, 0.025), 6) as low, round(quantile_cont(m, 0.975), 6) as high from m""")
def bootstrap_ci(spark, d):
    return S.bootstrap(pairs(spark, d)).select(*r6("delta", "low", "high"))


@query("mcnemar_counts", f"with {P} select count(*) filter (where a <= 0.8 and b > 0.8) as only_b, count(*) filter (where a > 0.8 and b <= 0.8) as only_a from v_pair")
def mcnemar_counts(spark, d):
    shifted = pairs(spark, d).select((F.col("a") - 0.3).alias("a"), (F.col("b") - 0.3).alias("b"))
    return S.mcnemar(shifted).select("only_b", "only_a")


@query("wilcoxon_w", f"""with {P}, x as (select round(abs(b - a), 9) as m, b > a as up from v_pair where b <> a),
 r as (select up, avg(k) over (partition by m) as r from (select *, row_number() over (order by m) as k from x))
select count(*) as n, coalesce(sum(r) filter (where up), 0) as w_plus, coalesce(sum(r) filter (where not up), 0) as w_minus from r""")
def wilcoxon_w(spark, d):
    return S.wilcoxon(pairs(spark, d)).select("n", "w_plus", "w_minus")


@query("signed_rank_p", """with recursive c(n, s, k) as (select 0, 0, 1.0::double union all select n, s, sum(k) from (select n + 1 as n, s, k from c where n < 25 union all select n + 1, s + n + 1, k from c where n < 25) group by n, s),
 u as (select n, s, sum(k) over (partition by n order by s) / pow(2, n) as below from c), x as (select p_partkey, (p_size % 25 + 1)::int as n, p_partkey % ((p_size % 25 + 1) * (p_size % 25 + 2) // 4 + 1) as w from part)
select p_partkey, round(least(1, 2 * below), 8) as p from x join u on u.n = x.n and u.s = x.w""")
def signed_rank_p(spark, d):
    """Exact p-values of up to 25 pairs, one a part."""
    n = F.col("p_size") % 25 + 1
    x = read_table(spark, d, "part", "p_partkey", "p_size").select("p_partkey", n.cast("int").alias("n"), (F.col("p_partkey") % (F.floor(n * (n + 1) / 4) + 1)).alias("w"))
    return x.select("p_partkey", F.round(S.signed_rank_p(F.col("n"), F.col("w")), 8).alias("p"))


@query("holm", f"""with {P}, q as (select task_id % 5 as g, cast(task_id as varchar) as name, abs(b - a) / 4 as p from v_pair),
 s as (select *, least(1, (count(*) over (partition by g) - row_number() over (partition by g order by p, name) + 1) * p) as s from q)
select g, name, round(max(s) over (partition by g order by p, name rows unbounded preceding), 6) as adjusted from s""")
def holm(spark, d):
    q = pairs(spark, d).select((F.col("task_id") % 5).alias("g"), F.col("task_id").cast("string").alias("name"), (F.abs(F.col("b") - F.col("a")) / 4).alias("p"))
    return S.holm(q, "p", ["g"]).select("g", "name", *r6("adjusted"))


J = f"{R}, v_judge as (select success as t, turns > 2 as j from v_result)"


@query("judge_confusion", f"""with {J}, c as (select count(*) filter (where j and t) as tp, count(*) filter (where j and not t) as fp, count(*) filter (where not j and t) as fn, count(*) filter (where not j and not t) as tn from v_judge)
select tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) as agreement, round(fp / (fp + tn), 6) as fpr, round(fn / (fn + tp), 6) as fnr, tp + fp + fn + tn >= 30 as usable from c""")
def judge_confusion(spark, d):
    v = V.results(spark, d).select("success", (F.col("turns") > 2).alias("j"))
    return S.judge_confusion(v, F.col("j"), F.col("success")).select("tp", "fp", "fn", "tn", *r6("agreement", "fpr", "fnr"), "usable")


@query("rogan_gladen", """select s, round(case when s + 0.8 - 1 > 0.000001 then greatest(0, least(1, (0.6 + 0.8 - 1) / (s + 0.8 - 1))) end, 6) as rate from (select distinct p_size / 50.0 as s from part)""")
def rogan_gladen(spark, d):
    s = read_table(spark, d, "part", (F.col("p_size") / 50.0).alias("s")).distinct()
    return s.select("s", F.round(S.corrected_rate(F.lit(0.6), F.col("s"), F.lit(0.8), F.lit(True)), 6).alias("rate"))


@query("weighted_ab_delta", f"""with {V.REQUESTS}, u as (select * from v_request where arm = 'student' and not fallback and outcome is not null),
 c as (select cluster_id, count(*) filter (where adapter = 'prod') as np, count(*) filter (where adapter = 'canary') as nc, avg(outcome::int) filter (where adapter = 'prod') as rp, avg(outcome::int) filter (where adapter = 'canary') as rc from u group by 1 having np >= 5 and nc >= 5)
select count(*) as n_clusters, round(case when count(*) >= 3 then sum(least(np, nc) * (rc - rp)) / sum(least(np, nc)) end, 6) as delta from c""")
def weighted_ab_delta(spark, d):
    return S.live_delta(V.requests(spark, d)).select("n_clusters", *r6("delta"))


@query("decision_case", f"""with {P} select task_id, case when a < 0.5 then 'discard' when a - b > 0.05 then 'discard' when na < 3 then 'discard' when b - a - 0.1 > 0 then 'promote'
 when b - a - 0.1 <= 0 and b - a + 0.1 >= 0 and b - a > -0.01 and b > 0.85 then 'promote' else 'discard' end as decision from v_pair""")
def decision_case(spark, d):
    p = pairs(spark, d)
    a, b = F.col("a"), F.col("b")
    c = {"schema_valid": F.when(a < 0.5, 0.0).otherwise(1.0), "divergence_delta": a - b, "refusal": F.when(F.col("na") < 3, "few"), "low": b - a - 0.1, "high": b - a + 0.1, "delta": b - a, "token_high": F.when(b > 0.85, -1.0).otherwise(1.0)}
    return p.select("task_id", S.round_decision(c).alias("decision"))


@query("ece", f"""with {V.SCORES}, g as (select least(9, greatest(0, cast(ceil(b / 10.0) as int) - 1)) as bin, count(*) as n, avg(p) as mp, avg(y) as my from v_score group by 1) select round(sum(n * abs(mp - my)) / sum(n), 6) as ece from g""")
def ece(spark, d):
    return G.ece(V.scores(spark, d)).select(*r6("ece"))


@query("reliability_bins", f"""with {V.SCORES}, g as (select least(9, greatest(0, cast(ceil(b / 10.0) as int) - 1)) as bin, count(*) as n, avg(p) as mp, avg(y) as my from v_score group by 1)
select cast(i.range as int) as bin, coalesce(n, 0) as n, round(mp, 6) as mean_p, round(my, 6) as mean_y from range(10) i left join g on g.bin = i.range""")
def reliability_bins(spark, d):
    return G.reliability(V.scores(spark, d)).select("bin", "n", *r6("mean_p", "mean_y"))


@query("auroc_brier", f"""with {V.SCORES}, r as (select y, avg(k) over (partition by p) as r from (select *, row_number() over (order by p) as k from v_score))
select round((sum(r) filter (where y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 6) as auroc, (select round(avg(pow(p - y, 2)), 6) from v_score) as brier, round(avg(y), 6) as positive_rate from r""")
def auroc_brier(spark, d):
    return G.auroc_brier(V.scores(spark, d)).select(*r6("auroc", "brier", "positive_rate"))


@query("gate_verdict", f"""with {V.SCORES}, g as (select task, count(*) as n, sum(y) as k, avg(p) as a from v_score group by 1)
select task, case when n < 5 then 'unreliable' when k = 0 or k = n then 'degenerate_labels' when a < 0.55 then 'uninformative' when a < 0.6 then 'unreliable' else 'usable' end as verdict from g""")
def gate_verdict(spark, d):
    g = V.scores(spark, d).groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("k"), F.avg("p").alias("a"))
    return g.select("task", G.verdict(F.col("n"), F.col("k"), F.col("a"), F.lit(0.0), 5).alias("verdict"))


CURVE = f"""{V.SCORES}, v_t as (select (5 + i.range) / 100.0 as tau, task, p, y, (task % 10 <> 0)::int as ok from v_score, range(95) i),
 v_k as (select tau, task, coalesce(min(case when p >= tau then y end), 1) as good, count(*) filter (where p < tau) as e, count(*) as n, min(ok) as ok from v_t group by all),
 v_c as (select tau, avg(case when good = 1 and (e = 0 or ok = 1) then 1.0 else 0.0 end) as success, sum(e) / sum(n) as escalation, 1 + sum(e) / sum(n) * 10 as cost, avg(ok) as teacher_rate from v_k group by tau)"""


def curve(spark, d):
    t = V.scores(spark, d).select("task", "p", F.col("y").alias("good"), (F.col("task") % 10 != 0).cast("int").alias("teacher_ok"))
    grid = spark.range(95).select(((F.col("id") + 5) / 100.0).alias("tau"))
    return G.threshold_curve(t, grid)


@query("threshold_curve", f"with {CURVE} select tau, round(success, 6) as success, round(escalation, 6) as escalation, round(cost, 6) as cost, round(teacher_rate, 6) as teacher_rate from v_c")
def threshold_curve(spark, d):
    return curve(spark, d).select("tau", *r6("success", "escalation", "cost", "teacher_rate"))


@query("threshold_choice", f"with {CURVE} select tau, round(cost, 6) as cost from v_c where teacher_rate - success <= 0.01 order by cost, tau limit 1")
def threshold_choice(spark, d):
    return G.choose_threshold(curve(spark, d)).select("tau", *r6("cost"))


@query("cascade_sim", f"with {V.SCORES} select case when b >= 60 then 'student' else 'teacher' end as arm, count(*) as n, coalesce(sum(case when b < 60 then b end), 0)::bigint as wasted from v_score group by 1")
def cascade_sim(spark, d):
    s = V.scores(spark, d)
    kept = F.col("b") >= 60
    return s.groupBy(F.when(kept, "student").otherwise("teacher").alias("arm")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.when(~kept, F.col("b"))), F.lit(0)).alias("wasted"))


@query("group_percentiles", "select user_id, round(quantile_cont(value, 0.1), 6) as p10, round(avg(value), 6) as mean, round(min(value), 6) as low from events group by 1")
def group_percentiles(spark, d):
    return read_table(spark, d, "events", "user_id", "value").groupBy("user_id").agg(F.round(F.percentile("value", 0.1), 6).alias("p10"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.min("value"), 6).alias("low"))


@query("entropy_by_group", """with c as (select user_id, event_type, count(*) as c from events group by all), z as (select *, c / sum(c) over (partition by user_id) as q from c)
select user_id, round(-sum(q * ln(q + 1e-12)), 6) as entropy from z group by 1""")
def entropy_by_group(spark, d):
    c = read_table(spark, d, "events", "user_id", "event_type").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("c"))
    return c.groupBy("user_id").agg(F.collect_list(F.log("c")).alias("l")).select("user_id", F.round(G.entropy(F.col("l")), 6).alias("entropy"))


def share_of(n, share: str):
    """A share of a count, rounded down, in decimals: as a double 90,000 * 0.7 is below 63,000."""
    return F.floor(n * F.lit(Decimal(share))).cast("long")


@query("group_split", """with t as (select distinct user_id from events), r as (select user_id, row_number() over (order by sha256('0|' || user_id), user_id) as k, count(*) over () as n from t)
select user_id, k <= greatest(1, floor(n * 0.7)) as fit from r""")
def group_split(spark, d):
    t = read_table(spark, d, "events", "user_id").distinct()
    hashed = t.withColumn("h", F.sha2(F.concat(F.lit("0|"), F.col("user_id").cast("string")), 256))
    return running(hashed, [], ["h", "user_id"], F.lit(1), "k").select("user_id", (F.col("k") < F.greatest(F.lit(1), share_of(F.col("k_all"), "0.7"))).alias("fit"))


@query("replay_lookup", f"""with {V.CALLS}, i as (select tool, args, arg_min(id, id) as answer from v_call where trace % 2 = 0 group by all)
select w.id, i.answer, case when i.answer is null then 'diverged' else 'replayed' end as served from v_call w left join i on i.tool = w.tool and i.args = w.args where w.trace % 2 = 1""")
def replay_lookup(spark, d):
    c = V.calls(spark, d)
    index = E.replay_index(c.where("trace % 2 = 0").select("tool", "args", F.col("id").alias("recorded")), ["tool", "args"], ["recorded"])
    return E.replay(c.where("trace % 2 = 1").select("id", "tool", "args"), index, ["tool", "args"], "recorded").select("id", "answer", "served")


@query("fuzzy_lookup", r"""with t as (select p_partkey as id, p_brand as tool, list_distinct(string_split(p_name, ' ')) as s from part),
 x as (select w.id, r.id as ord, len(list_intersect(w.s, r.s)) as i, len(w.s) as nw, len(r.s) as nr from t w join t r on r.tool = w.tool and r.id <> w.id),
 y as (select id, ord, i / (nw + nr - i) as score from x where i > 0)
select id, round(max(score), 6) as score, arg_min(ord, struct_pack(a := -score, b := ord)) as ord, max(score) >= 0.92 as served from y group by id""")
def fuzzy_lookup(spark, d):
    t = read_table(spark, d, "part", F.col("p_partkey").alias("id"), F.col("p_brand").alias("tool"), F.array_distinct(F.split("p_name", " ")).alias("s"))
    return E.nearest_call(t, t.withColumnRenamed("id", "ord"), "tool", "s", "ord", others=True).select("id", *r6("score"), "ord", "served")


@query("success_failure_pairs", f"""with {R}, a as (select task_id, id as chosen, row_number() over (partition by task_id order by id) as i from v_result where success), b as (select task_id, id as rejected from v_result where not success),
 p as (select a.task_id, chosen, rejected, cast(row_number() over (partition by a.task_id order by i, rejected) as int) as k from a join b on a.task_id = b.task_id) select * from p where k <= 4""")
def success_failure_pairs(spark, d):
    return E.success_failure_pairs(V.results(spark, d))


@query("balance_kinds", """with p as (select o_orderkey as id, case when o_orderstatus = 'O' then 'rollout' else 'teacher' end as kind from orders), r as (select *, row_number() over (partition by kind order by id) as k, (select count(*) from p where kind = 'rollout') as n from p)
select kind, count(*) as n from r where kind <> 'teacher' or n = 0 or k <= floor(n * 0.5) group by 1""")
def balance_kinds(spark, d):
    p = read_table(spark, d, "orders", F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "O", "rollout").otherwise("teacher").alias("kind"))
    return E.balance_kinds(p, "kind", "id", 0.5).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("first_divergence", """with x as (select a.conv_id, a.turn, a.role as ra, b.role as rb, a.text <> b.text as d from conversations a join conversations b on b.conv_id = a.conv_id + 1 and b.turn = a.turn),
 f as (select conv_id, min(turn) as t from x where ra <> rb or d group by 1)
select f.conv_id, case when x.ra = 'assistant' and x.rb = 'assistant' then f.t end as turn from f join x on x.conv_id = f.conv_id and x.turn = f.t""")
def first_divergence(spark, d):
    a = V.turns(spark, d)
    return E.first_divergence(a, a.withColumn("conv_id", F.col("conv_id") - 1), "conv_id")


@query("turn_windows", """with m as (select conv_id, turn, case when role = 'system' then 'tool' else role end as role, row_number() over (partition by conv_id order by turn) as n from conversations),
 k as (select *, max(case when role <> 'tool' then turn end) over (partition by conv_id order by turn) as ok from m)
select a.conv_id, a.turn, (select max(ok) from k b where b.conv_id = a.conv_id and b.n = greatest(1, a.n - 2)) as start from k a where a.role = 'assistant'""")
def turn_windows(spark, d):
    m = V.turns(spark, d).withColumn("role", F.when(F.col("role") == "system", "tool").otherwise(F.col("role")))
    return E.turn_windows(m, "conv_id", 3)


@query("lookahead_flag", f"with {V.CALLS} select a.id, exists(select 1 from v_call b where b.trace = a.trace and b.turn > a.turn and b.turn <= a.turn + 2 and b.error) as corrected from v_call a where not a.error")
def lookahead_flag(spark, d):
    w = Window.partitionBy("trace").orderBy("turn").rowsBetween(1, 2)
    return V.calls(spark, d).withColumn("corrected", F.coalesce(F.bool_or("error").over(w), F.lit(False))).where("not error").select("id", "corrected")


@query("rft_cap", f"with {R} select task_id, id from (select task_id, id, row_number() over (partition by task_id order by id) as k from v_result where success) where k <= 2")
def rft_cap(spark, d):
    from traceloom.operators.curation import keep_per_group

    return keep_per_group(V.results(spark, d).where("success").select("task_id", "id"), "task_id", ["id"], 2).select("task_id", "id")


@query("pair_cap", f"""with {R} select task_id, id from (select task_id, id, row_number() over (partition by task_id order by sha256('7|' || id), id) as k from v_result where not success) where k <= 3""")
def pair_cap(spark, d):
    from traceloom.operators.curation import keep_per_group

    return keep_per_group(V.results(spark, d).where("not success").select("task_id", "id"), "task_id", [F.sha2(F.concat(F.lit("7|"), F.col("id").cast("string")), 256), "id"], 3).select("task_id", "id")


@query("stable_sample", "select c_custkey from (select c_custkey, row_number() over (order by sha256('s|' || c_custkey), c_custkey) as k from customer) where k <= 20")
def stable_sample(spark, d):
    return read_table(spark, d, "customer", "c_custkey").orderBy(F.sha2(F.concat(F.lit("s|"), F.col("c_custkey").cast("string")), 256), "c_custkey").limit(20)


@query("positional_split", """select c_custkey, case when k <= floor(n * 0.7) then 'train' when k <= floor(n * 0.7) + floor(n * 0.15) then 'calib' else 'holdout' end as split
 from (select c_custkey, row_number() over (partition by c_mktsegment order by c_custkey) as k, count(*) over (partition by c_mktsegment) as n from customer)""")
def positional_split(spark, d):
    g = Window.partitionBy("c_mktsegment")
    k, n = F.row_number().over(g.orderBy("c_custkey")), F.count(F.lit(1)).over(g)
    c = read_table(spark, d, "customer", "c_custkey", "c_mktsegment").select("c_custkey", k.alias("k"), n.alias("n"))
    cut = share_of(F.col("n"), "0.7")
    return c.select("c_custkey", F.when(F.col("k") <= cut, "train").when(F.col("k") <= cut + share_of(F.col("n"), "0.15"), "calib").otherwise("holdout").alias("split"))


@query("conditional_match_rates", f"with {R} select run, round(avg(success::int) filter (where turns > 3), 6) as full_match, round(avg((tokens > 30)::int) filter (where turns > 3 and success), 6) as args_match from v_result group by run")
def conditional_match_rates(spark, d):
    tool, name = F.col("turns") > 3, F.col("success")
    return V.results(spark, d).groupBy("run").agg(F.round(F.avg(F.when(tool, name.cast("double"))), 6).alias("full_match"), F.round(F.avg(F.when(tool & name, (F.col("tokens") > 30).cast("double"))), 6).alias("args_match"))


@query("span_mask", "select conv_id, turn, greatest(0, least(length(text) // 8, 10) - 5) as n from conversations")
def span_mask(spark, d):
    """Tokens of eight characters; the span is characters 40 to 80."""
    t = V.turns(spark, d).withColumn("tokens", F.transform(F.filter(F.sequence(F.lit(0), F.floor(F.length("text") / 8)), lambda i: i < F.floor(F.length("text") / 8)), lambda i: F.struct((i * 8).alias("s"), (i * 8 + 8).alias("e"))))
    mask = E.span_mask(F.col("tokens"), F.array(F.struct(F.lit(40).alias("a"), F.lit(80).alias("b"))))
    return t.select("conv_id", "turn", F.size(F.filter(mask, lambda x: x)).cast("long").alias("n"))


@query("cost_model", """select p_partkey, round(p_retailprice / (p_size * 0.6 * 3600) * 1e6, 4) as student_mtok, round((1000 * (1 - p_size / 100.0) * 3 + 1000 * p_size / 100.0 * 0.3 + 500 * 15) / 1e6, 9) as teacher_task from part""")
def cost_model(spark, d):
    p = read_table(spark, d, "part", "p_partkey", "p_retailprice", "p_size")
    size = F.col("p_size")
    return p.select("p_partkey", F.round(M.student_per_mtok(F.col("p_retailprice"), size), 4).alias("student_mtok"), F.round(M.teacher_per_task(F.lit(1000), F.lit(500), F.lit(3.0), F.lit(15.0), size / 100.0, F.lit(0.3)), 9).alias("teacher_task"))


@query("breakeven", """select p_partkey, round(case when p_size - 25 > 0 then 2.0 * 24 / (p_size - 25) end, 6) as tasks_per_day, round(case when p_size - 1 <> 0 then 1 - 25.0 / (p_size - 1) end, 6) as saving from part""")
def breakeven(spark, d):
    p = read_table(spark, d, "part", "p_partkey", "p_size")
    b = M.breakeven_per_day(F.lit(2.0), F.col("p_size"), F.lit(25))
    return p.select("p_partkey", F.round(F.when(b != float("inf"), b), 6).alias("tasks_per_day"), F.round(M.saving(F.col("p_size") - 1, F.lit(25.0)), 6).alias("saving"))
