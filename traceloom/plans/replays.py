"""Queries that run recorded policies and build samples, on events as tool calls and on conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from traceloom.operators import replay as E
from traceloom.operators import samples as M
from traceloom.plans import views as V
from traceloom.plans.registered import query
from traceloom.plans.evaluation import r6
from traceloom.sources.tables import read_table


_RUN = f"""{V.CALLS}, w as (select a.trace, b.turn, b.tool, b.args from (select distinct trace from v_call) a join v_call b on b.trace = a.trace + 1 and b.turn <= 12),
 m as (select w.*, exists (select 1 from v_call r where r.trace = w.trace and r.tool = w.tool and r.args = w.args) as known from w),
 n as (select trace, count(*) as calls from v_call group by 1), x as (select a.trace, min(m.turn) filter (where not known) as miss, any_value(n.calls) as calls from (select distinct trace from v_call) a join n on n.trace = a.trace + 1 join m on m.trace = a.trace group by 1)"""


@query("replay_run", f"""with {_RUN} select trace::varchar as task_id, coalesce(miss, least(12, calls + 1))::integer as n_turns, coalesce(miss, least(12, calls))::integer as n_tool_calls, miss is not null as diverged, case when miss is not null then 'diverged' when calls < 12 then 'answered' else 'max_turns' end as stop_reason from x""")
def replay_run(spark, d):
    """Each user's recording, run by the policy of the next user."""
    t = V.call_traces(spark, d)
    policy = E.recorded_turns(t).withColumn("task", F.col("task") - 1)
    out = E.play(policy.join(t.select(F.col("trace").alias("task")), "task", "semi"), E.recorded_calls(t))
    return out.select(F.col("task").cast("string").alias("task_id"), "n_turns", "n_tool_calls", "diverged", "stop_reason")


@query("replay_own", f"with {V.CALLS}, n as (select trace, count(*) as c from v_call group by 1) select trace::varchar as task_id, r.range::integer as repeat_idx, c < 12 as success, least(c, 12)::integer as replayed, 0::integer as fuzzy from n, range(2) r")
def replay_own(spark, d):
    """Every recording run by itself, twice: what is recorded comes back."""
    t = V.call_traces(spark, d)
    out = E.play(E.recorded_turns(t, repeats=2), E.recorded_calls(t))
    return out.select(F.col("task").cast("string").alias("task_id"), F.col("repeat").alias("repeat_idx"), E.clean_grade().alias("success"), "replayed", "fuzzy")


@query("replay_served", f"""with {V.CALLS}, i as (select trace, tool, args, min(id) as first from v_call group by all), w as (select v.trace + 1 as trace, v.turn, v.tool, v.args from v_call v where exists (select 1 from v_call x where x.trace = v.trace + 1)),
 e as (select w.*, i.first from w left join i on i.trace = w.trace and i.tool = w.tool and i.args = w.args)
select trace, turn, tool, case when first is null then 'diverged' else 'replayed' end as served, first::varchar as answer, case when first is null and exists (select 1 from v_call r where r.trace = e.trace and r.tool = e.tool and r.args = e.args) then 1.0 end as score from e""")
def replay_served(spark, d):
    """Every call of the user before, asked of each user's recording: exact answers and divergences with the nearest record in one plan. Arguments
    have one key, so a call that isn't recorded shares no token with those that are."""
    c = V.calls(spark, d)
    asked = c.select((F.col("trace") + 1).alias("task"), "turn", "tool", "args").join(c.select(F.col("trace").alias("task")).distinct(), "task", "semi")
    known = c.select(F.col("trace").alias("task"), F.col("id").alias("ord"), "tool", "args", F.col("id").cast("string").alias("result"))
    out = E.serve(asked, known)
    return out.select(F.col("task").alias("trace"), "turn", "tool", "served", F.when(F.col("served") == "replayed", F.col("answer")).alias("answer"), "score")


@query("calls_made", f"with {V.CALLS} select trace, count(*)::integer as n, md5(string_agg(tool, '>' order by turn)) as h from v_call group by 1")
def calls_made(spark, d):
    made = V.call_traces(spark, d).select("trace", E.calls_made(F.col("messages")).alias("c"))
    return made.select("trace", F.size("c").alias("n"), F.md5(F.array_join(F.transform("c", lambda x: x["tool"]), ">")).alias("h"))


@query("rollout_warnings", "select 'success above 0.95' as warning from (select avg((value < 1000)::int) as s from events) where s > 0.95")
def rollout_warnings(spark, d):
    e = read_table(spark, d, "events", (F.col("value") < 1000).alias("success"), F.lit(1).alias("replayed"), F.lit(0).alias("fuzzy"))
    return E.rollout_warnings(e)


@query("rollout_traces", "select 'ro_' || substr(sha256(text), 1, 16) as id, sha256(text) as content_hash, count(*) as n from conversations group by 1, 2")
def rollout_traces(spark, d):
    t = V.turns(spark, d).select(F.col("text").alias("messages"), F.col("conv_id").alias("task_id"), F.lit(True).alias("success"))
    return E.rollout_traces(t).groupBy("id", "content_hash").agg(F.count(F.lit(1)).alias("n"))


def conversations(spark, d):
    """Messages of conversations."""
    return V.turns(spark, d).select(F.col("conv_id").cast("string").alias("trace_id"), "turn", "role", "text")


_WORDS = r"len(regexp_extract_all({0}, '[^\s]+'))"


@query("loss_masks", rf"""with w as (select conv_id, role, {_WORDS.format('text')} as n from conversations) select conv_id::varchar as trace_id, 'trajectory' as kind, (sum(n) + 2 * count(*))::integer as n_tokens, coalesce(sum(n) filter (where role = 'assistant'), 0)::integer as n_target_tokens from w group by 1 having coalesce(sum(n) filter (where role = 'assistant'), 0) > 0""")
def loss_masks(spark, d):
    return M.build_samples(conversations(spark, d), M.word_ids, 1 << 30).select("trace_id", "kind", "n_tokens", "n_target_tokens")


@query("window_samples", rf"""with s as (select conv_id, turn, role, {_WORDS.format('text')} as n from conversations), b as (select *, row_number() over (partition by conv_id order by turn) - 1 as i from s where role <> 'system'),
 y as (select conv_id, sum(n + 2) as n from s where role = 'system' group by 1), x as (select a.conv_id, a.i, greatest(0, a.i - 2) as st, (select sum(c.n + 2) from b c where c.conv_id = a.conv_id and c.i between greatest(0, a.i - 2) and a.i) + coalesce(y.n, 0) as n from b a left join y on y.conv_id = a.conv_id where a.role = 'assistant')
select conv_id::varchar as trace_id, i::integer as turn_index, st::integer as window_start, n::integer as n_tokens from x where n <= 200""")
def window_samples(spark, d):
    """Windows of two messages before each answer, of at most 200 tokens."""
    parts = M.windows(M.in_order(M.tokenized(conversations(spark, d), M.word_ids), "trace_id", "turn"), "trace_id", 2)
    n = F.aggregate("said", F.lit(0), lambda a, m: a + F.size(m["ids"]))
    return parts.select("trace_id", "turn_index", "window_start", n.alias("n_tokens")).where("n_tokens <= 200")


@query("target_tokens", rf"select conv_id::varchar as trace_id, coalesce(sum({_WORDS.format('text')}) filter (where role = 'assistant'), 0)::integer as n from conversations group by 1 having n > 0")
def target_tokens(spark, d):
    s = M.build_samples(conversations(spark, d), M.word_ids, 1 << 30)
    return s.select("trace_id", F.size(M.targets(F.col("labels"), F.col("input_ids"))).alias("n"))


@query("teacher_forced_interval", f"""with {V.RESULTS}, t as (select task_id, avg((turns > 3)::int) as m from v_result where run = 'A' group by 1), n as (select count(*) as n from t), s as (select m, row_number() over (order by task_id) - 1 as slot from t),
 x as (select i.range as it, cast('0x' || substr(sha256('0:' || i.range || ':' || k.range), 1, 8) as bigint) % n as slot from n, range(200) i, (select unnest(range((select n from n))) as range) k), b as (select it, avg(m) as m from x join s on s.slot = x.slot group by it)
select round((select avg(m) from t), 6) as delta, round(quantile_cont(m, 0.025), 6) as low, round(quantile_cont(m, 0.975), 6) as high from b""")
def teacher_forced_interval(spark, d):
    """Task-level mean of full matches with its interval: the difference from a run that never matches."""
    from traceloom.operators import statistics as S

    t = V.results(spark, d).where("run = 'A'").groupBy("task_id").agg(F.avg((F.col("turns") > 3).cast("double")).alias("b"))
    return S.bootstrap(t.withColumn("a", F.lit(0.0))).select(*r6("delta", "low", "high"))
