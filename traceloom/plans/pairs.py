"""Queries over preference pairs, on conversations seen as trajectories: users ask the same, answers differ by a short code."""

from __future__ import annotations

from pyspark.sql import functions as F

from traceloom.operators import pairs as P
from traceloom.plans.registered import query
from traceloom.sources.tables import read_table

MESSAGE = "array<struct<role:string,content:string,tool_calls:array<struct<id:string,function:struct<name:string,arguments:string>>>>>"


def trajectories(spark, d):
    t = read_table(spark, d, "conversations", "conv_id", "turn", "role", "text").where("role <> 'system'")
    said = F.when(F.col("role") == "assistant", F.concat(F.lit("say "), (F.length("text") % 3).cast("string"))).otherwise("ask")
    m = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", said.alias("content")))).alias("m"))
    plain = F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"), F.lit(None).alias("tool_calls"))).cast(MESSAGE)
    return m.select(F.col("conv_id").alias("id"), (F.col("conv_id") % 20).alias("task_id"), (F.col("conv_id") % 3 != 0).alias("success"), plain.alias("messages"))


TRAJECTORIES = """v_tr as (select conv_id as id, conv_id % 20 as task_id, conv_id % 3 <> 0 as success, list(case when role = 'assistant' then 'say ' || (length(text) % 3) else 'ask' end order by turn) as m, list(role order by turn) as r
  from conversations where role <> 'system' group by conv_id)"""
_AT = "list_position(list_transform(range(1, least(len(a.m), len(b.m)) + 1), lambda i: a.m[i] <> b.m[i] or a.r[i] <> b.r[i]), true)"
_TRIED = f"""{TRAJECTORIES}, x as (select a.task_id, a.id as chosen, b.id as rejected, {_AT} as pos, a.r as ra, b.r as rb, list_filter(a.m, lambda s: s <> 'ask') = list_filter(b.m, lambda s: s <> 'ask') as same
   from v_tr a join v_tr b on a.task_id = b.task_id and a.success and not b.success),
 y as (select *, case when coalesce(pos, 0) > 0 and ra[pos] = 'assistant' and rb[pos] = 'assistant' then null when same then 'no divergence' else 'divergent prefix' end as why from x),
 z as (select *, sum((why is null)::int) over (partition by task_id order by chosen, rejected) as k from y), tried as (select * from z where k - (why is null)::int < 4)"""


@query("offline_pairs", f"with {_TRIED} select task_id, chosen, rejected, pos::integer as \"at\" from tried where why is null")
def offline_pairs(spark, d):
    return P.offline_pairs(trajectories(spark, d))[0].select("task_id", "chosen", "rejected", "at")


@query("offline_pair_statistics", f"""with {_TRIED} select (select count(distinct task_id) from v_tr) as tasks_seen, (select count(*) from (select task_id from v_tr group by 1 having bool_or(success) and not bool_and(success))) as tasks_with_both,
 count(*) filter (where why is null) as pairs_built, count(*) filter (where why = 'no divergence') as no_divergence, count(*) filter (where why = 'divergent prefix') as divergent_prefix,
 (select count(*) from (select task_id from tried group by 1 having max(k) >= 4)) as capped from tried""")
def offline_pair_statistics(spark, d):
    return P.offline_pairs(trajectories(spark, d))[1]


@query("teacher_pairs", f"""with {TRAJECTORIES}, t as (select task_id, min(id) as id from v_tr where success group by 1), x as (select b.task_id, a.id as chosen, b.id as rejected, {_AT} as pos, a.r as ra, b.r as rb
   from t join v_tr a on a.id = t.id join v_tr b on b.task_id = t.task_id and not b.success)
select task_id, chosen::varchar as chosen, rejected::varchar as rejected, pos::integer as \"at\" from x where pos > 0 and ra[pos] = 'assistant' and rb[pos] = 'assistant'""")
def teacher_pairs(spark, d):
    t = trajectories(spark, d)
    return P.teacher_pairs(t, t).select("task_id", "chosen", "rejected", "at")


_H = "cast('0x' || substr(sha256({0}), 1, 8) as bigint)"


@query("sampled_pairs", f"""with {TRAJECTORIES}, s as (select *, row_number() over (partition by task_id, success order by id) - 1 as slot from v_tr), n as (select task_id, count(*) filter (where success) as g, count(*) filter (where not success) as b from v_tr group by 1),
 w as (select task_id, g, b, unnest(range(1, least(9, g * b) + 1)) as draw from n where g > 0 and b > 0),
 p as (select w.task_id, w.draw, a.id as chosen, b.id as rejected, {_AT} as pos, a.r as ra, b.r as rb, a.m as ma, b.m as mb from w
   join s a on a.task_id = w.task_id and a.success and a.slot = {_H.format("'0|' || w.task_id || '|' || w.draw || '|g'")} % w.g
   join s b on b.task_id = w.task_id and not b.success and b.slot = {_H.format("'0|' || w.task_id || '|' || w.draw || '|b'")} % w.b),
 v as (select *, row_number() over (partition by task_id, ma[pos], mb[pos] order by draw, rejected::varchar) as n from p where pos > 1 and ra[pos] = 'assistant' and rb[pos] = 'assistant'),
 c as (select *, row_number() over (partition by task_id order by draw, rejected::varchar) as k from v where n = 1)
select task_id, 'rollout' as pair_kind, 'text' as diff_kind, chosen::varchar as chosen, rejected::varchar as rejected from c where k <= 3""")
def sampled_pairs(spark, d):
    """Tasks with both outcomes only: without a success a stand-in task has no teacher either."""
    t = trajectories(spark, d)
    return P.sampled_pairs(t, t).select("task_id", "pair_kind", "diff_kind", "chosen", "rejected")


@query("pair_reject_reasons", f"""with {TRAJECTORIES}, x as (select case when a.r[1] = 'assistant' then 'prompt ends on an assistant turn' when len(a.m) < 2 then 'chosen is empty' when a.r[2] <> 'assistant' then 'chosen is not an assistant turn'
   when len(a.m) < 4 then 'rejected is empty' when a.r[4] <> 'assistant' then 'rejected is not an assistant turn' when a.m[2] = a.m[4] then 'same text apart from formatting' end as why from v_tr a)
select why, count(*) as n from x where why is not null group by 1""")
def pair_reject_reasons(spark, d):
    """A conversation's second message against its fourth, after the first."""
    t = trajectories(spark, d).select(F.slice("messages", 1, 1).alias("prompt"), F.get("messages", F.lit(1)).alias("good"), F.get("messages", F.lit(3)).alias("bad"))
    return t.select(P.reject_reason(F.col("prompt"), F.col("good"), F.col("bad")).alias("why")).where("why is not null").groupBy("why").agg(F.count(F.lit(1)).alias("n"))


@query("whitespace_normalized", r"select doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) as h from documents")
def whitespace_normalized(spark, d):
    return read_table(spark, d, "documents", "doc_id", "text").select("doc_id", F.md5(P.whitespace_normalized(F.col("text"))).alias("h"))
