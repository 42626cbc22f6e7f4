"""Curation, text and similarity queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from traceloom.functions import text as T
from traceloom.operators import curation as C
from traceloom.operators import similarity as S
from traceloom.plans import views as V
from traceloom.plans.registered import query
from traceloom.sources.tables import read_table

TRACES = """v_trace as (
  select c.conv_id, count(*) filter (where c.role = 'assistant') as n_turns, max(l.quality) as quality,
    sha256(string_agg(c.role || ':' || c.text, chr(10) order by c.turn)) as h
  from conversations c left join labels l on l.doc_id = c.conv_id group by c.conv_id)"""


def traces(spark, d):
    """Conversations as traces: turns, outcome from the labels, and a hash of the ordered messages."""
    said = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
    t = V.turns(spark, d).groupBy("conv_id").agg(F.count(F.when(F.col("role") == "assistant", 1)).alias("n_turns"), F.sha2(F.array_join(said, "\n"), 256).alias("h"))
    q = read_table(spark, d, "labels", "doc_id", "quality").groupBy(F.col("doc_id").alias("conv_id")).agg(F.max("quality").alias("quality"))
    return t.join(q, "conv_id", "left").withColumn("success", F.col("quality") == 1)


def staged(spark, d):
    t = C.exact_dedupe(traces(spark, d), "h", "conv_id", "conv_id")
    dup = F.when(F.col("survivor") != F.col("conv_id"), "duplicate")
    return C.run_stages(t, [("outcome", C.outcome_reason(F.col("success"))), ("length", C.length_reason(F.col("n_turns"))), ("exact_dedupe", dup)])


STAGED = TRACES + """, v_staged as (select *, case when quality is null then 'no recorded outcome' when quality <> 1 then 'task failed'
    when n_turns < 2 then 'too short: ' || n_turns || ' turns' when n_turns > 40 then 'too long: ' || n_turns || ' turns'
    when min(conv_id) over (partition by h) <> conv_id then 'duplicate' end as drop_reason from v_trace),
  v_s as (select *, case when drop_reason in ('no recorded outcome', 'task failed') then 'outcome' when drop_reason like 'too%' then 'length'
    when drop_reason = 'duplicate' then 'exact_dedupe' end as drop_stage from v_staged)"""


@query("curation_funnel", f"""with {STAGED}, p as (select case drop_stage when 'outcome' then 0 when 'length' then 1 when 'exact_dedupe' then 2 else 3 end as p from v_s)
select stage, count(*) filter (where p >= i) as n_in, count(*) filter (where p = i) as n_dropped, count(*) filter (where p > i) as n_out
from p, (values ('outcome', 0), ('length', 1), ('exact_dedupe', 2)) s(stage, i) group by stage""")
def curation_funnel(spark, d):
    return C.stage_counts(staged(spark, d), ["outcome", "length", "exact_dedupe"])


@query("reason_histogram", f"""with {STAGED} select drop_stage, regexp_replace(drop_reason, '\\d+(\\.\\d+)?', 'N', 'g') as reason, count(*) as n, min(conv_id) as example
from v_s where drop_reason is not null group by 1, 2""")
def reason_histogram(spark, d):
    return C.reason_histogram(staged(spark, d), F.col("conv_id"), F.col("conv_id"))


@query("f_outcome", f"with {TRACES} select conv_id, case when quality = 1 then null when quality is null then 'no recorded outcome' else 'task failed' end as reason from v_trace")
def f_outcome(spark, d):
    return traces(spark, d).select("conv_id", C.outcome_reason(F.col("success")).alias("reason"))


@query("f_length", f"with {TRACES} select conv_id, case when n_turns < 3 then 'too short: ' || n_turns || ' turns' when n_turns > 3 then 'too long: ' || n_turns || ' turns' end as reason from v_trace")
def f_length(spark, d):
    return traces(spark, d).select("conv_id", C.length_reason(F.col("n_turns"), 3, 3).alias("reason"))


@query("f_quality", "select d.doc_id, coalesce(l.quality >= 1, true) as keep from documents d left join labels l on l.doc_id = d.doc_id")
def f_quality(spark, d):
    docs = read_table(spark, d, "documents", "doc_id")
    x = docs.join(read_table(spark, d, "labels", "doc_id", "quality"), "doc_id", "left")
    return x.select("doc_id", C.quality_reason(F.col("quality"), 1).isNull().alias("keep"))


@query("exact_dedupe", "select doc_id, min(doc_id) over (partition by sha256(text)) as survivor from documents")
def exact_dedupe(spark, d):
    docs = read_table(spark, d, "documents", "doc_id", "text").select("doc_id", F.sha2("text", 256).alias("h"))
    return C.exact_dedupe(docs, "h", "doc_id", "doc_id").select("doc_id", "survivor")


@query("anti_join_evalset", "select conv_id, count(*) as n from conversations where conv_id not in (select item_id from benchmark) group by 1")
def anti_join_evalset(spark, d):
    keep = V.turns(spark, d).join(read_table(spark, d, "benchmark", F.col("item_id").alias("conv_id")), "conv_id", "left_anti")
    return keep.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))


@query("semi_join", "select conv_id, count(*) as n from conversations where conv_id in (select item_id from benchmark) group by 1")
def semi_join(spark, d):
    keep = V.turns(spark, d).join(read_table(spark, d, "benchmark", F.col("item_id").alias("conv_id")), "conv_id", "left_semi")
    return keep.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))


@query("error_runs", f"""with {V.CALLS}, g as (select *, turn - row_number() over (partition by trace, error order by turn) as g from v_call)
select trace, cast(max(n) as bigint) as longest, max(n) >= 3 as loops from (select trace, count(*) as n from g where error group by trace, g) group by trace""")
def error_runs(spark, d):
    runs = C.runs_of(V.calls(spark, d), "trace", ["turn"], F.col("error")).where("state")
    return runs.select("trace", "longest", (F.col("longest") >= 3).alias("loops"))


@query("repeated_events", f"with {V.CALLS} select trace, tool, args, count(*) as n from v_call group by all having count(*) >= 2")
def repeated_events(spark, d):
    return V.calls(spark, d).groupBy("trace", "tool", "args").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")


@query("role_alternation", """select conv_id, bool_and(ok) as alternates from (
  select conv_id, coalesce(role <> lag(role) over (partition by conv_id order by turn), true) as ok from conversations) group by 1""")
def role_alternation(spark, d):
    before = F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn"))
    ok = V.turns(spark, d).select("conv_id", F.coalesce(F.col("role") != before, F.lit(True)).alias("ok"))
    return ok.groupBy("conv_id").agg(F.bool_and("ok").alias("alternates"))


@query("retire_partition", """select case when o_orderstatus = 'F' then 'already' when o_orderdate < timestamp '1998-01-01' then 'retired' else 'kept' end as state,
  count(*) as n from orders group by 1""")
def retire_partition(spark, d):
    o = read_table(spark, d, "orders", "o_orderdate", "o_orderstatus")
    gone = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return C.retire_partition(o, F.col("o_orderdate"), gone, F.lit("1998-01-01").cast("timestamp")).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query("word_tokens", r"""select doc_id, cast(len(w) as bigint) as n, sha256(array_to_string(w, ' ')) as key
from (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') as w from documents)""")
def word_tokens(spark, d):
    docs = read_table(spark, d, "documents", "doc_id", "text").withColumn("w", T.words(F.col("text")))
    return docs.select("doc_id", F.size("w").cast("long").alias("n"), F.sha2(F.array_join("w", " "), 256).alias("key"))


@query("shingle_stats", r"""select doc_id, cast(case when len(w) = 0 then 0 when len(w) <= 5 then 1 else len(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) end as bigint) as n
from (select doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') as w from documents)""")
def shingle_stats(spark, d):
    return read_table(spark, d, "documents", "doc_id", "text").select("doc_id", F.size(T.shingles(F.col("text"))).cast("long").alias("n"))


ASCII = r"regexp_replace(text, '[^\x00-\x7F]', 'x', 'g')"


def ascii_text(c):
    """Non-ASCII characters as x: the engines' word borders agree on the rest."""
    return F.regexp_replace(c, r"[^\x00-\x7F]", "x")


@query("mask_literals", rf"""select doc_id, sha256(regexp_replace(regexp_replace({ASCII}, '{T.IDENTIFIER}', '<ID>', 'g'), '{T.NUMBER}', '<NUM>', 'g')) as masked from documents""")
def mask_literals(spark, d):
    return read_table(spark, d, "documents", "doc_id", "text").select("doc_id", F.sha2(T.mask_literals(ascii_text(F.col("text"))), 256).alias("masked"))


_REDACTED = ASCII
for _mark, _pattern in T.REDACTIONS:
    _REDACTED = f"regexp_replace({_REDACTED}, '{_pattern}', '{_mark}', 'g')"


@query("pii_redact", f"select doc_id, sha256({_REDACTED}) as redacted from documents")
def pii_redact(spark, d):
    return read_table(spark, d, "documents", "doc_id", "text").select("doc_id", F.sha2(T.redact(ascii_text(F.col("text"))), 256).alias("redacted"))


@query("pii_counts", "select " + ", ".join(rf"sum(cast(len(regexp_extract_all({ASCII}, '{p}')) as bigint))::bigint as {m.strip('<>').lower()}" for m, p in T.REDACTIONS) + " from documents")
def pii_counts(spark, d):
    t = read_table(spark, d, "documents", "text").select(ascii_text(F.col("text")).alias("t"))
    return t.agg(*(F.sum(F.regexp_count("t", F.lit(p)).cast("long")).alias(m.strip("<>").lower()) for m, p in T.REDACTIONS))


@query("text_signature_groups", """select lower(regexp_replace(text, '[ \\t\\n\\r.,;:!?''"()-]', '', 'g')) as signature, count(*) as n from conversations group by 1""")
def text_signature_groups(spark, d):
    return V.turns(spark, d).groupBy(T.text_signature(F.col("text")).alias("signature")).agg(F.count(F.lit(1)).alias("n"))


@query("token_estimates", """select conv_id, turn, greatest(1, length(text) // 4)::bigint as a, ceil(length(text) / 4)::bigint as b, (length(text) // 4)::bigint as c from conversations""")
def token_estimates(spark, d):
    t = F.col("text")
    return V.turns(spark, d).select("conv_id", "turn", T.estimate_tokens(t).alias("a"), T.json_tokens(t).alias("b"), T.prefix_tokens(t).alias("c"))


@query("amounts_in_text", r"""select page_id, cast(len(a) as bigint) as n, round(coalesce(list_sum(a), 0), 2) as total from (
  select page_id, list_transform(regexp_extract_all(html, '\$([0-9][0-9,]*(?:\.[0-9]{1,2})?)', 1), lambda x: cast(replace(x, ',', '') as double)) as a from pages)""")
def amounts_in_text(spark, d):
    p = read_table(spark, d, "pages", "page_id", "html").withColumn("a", T.amounts(F.col("html")))
    return p.select("page_id", F.size("a").cast("long").alias("n"), F.round(F.aggregate("a", F.lit(0.0), lambda s, x: s + x), 2).alias("total"))


@query("normalize_strings", "select '<ts>' as s, count(*) as n from orders union all select trim(c_name), count(*) from customer group by 1")
def normalize_strings(spark, d):
    o = read_table(spark, d, "orders", "o_orderdate").select(F.date_format("o_orderdate", " yyyy-MM-dd'T'HH:mm:ss'Z' ").alias("s"))
    c = read_table(spark, d, "customer", F.col("c_name").alias("s"))
    return o.union(c).groupBy(T.normalize_string(F.col("s")).alias("s")).agg(F.count(F.lit(1)).alias("n"))


@query("task_text", """with f as (select conv_id, min(turn) filter (where role = 'assistant') as a from conversations group by 1)
select c.conv_id, min(text) filter (where role = 'system') as task_system, string_agg(text, chr(10) order by turn) filter (where role = 'user' and (a is null or turn < a)) as task_user
from conversations c join f on f.conv_id = c.conv_id group by c.conv_id""")
def task_text(spark, d):
    """First system message, and the user's messages before the first answer."""
    m = V.turns(spark, d).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"), F.min(F.when(F.col("role") == "assistant", F.col("turn"))).alias("a"))
    asked = F.filter("m", lambda x: (x["role"] == "user") & (F.col("a").isNull() | (x["turn"] < F.col("a"))))
    system = F.get(F.filter("m", lambda x: x["role"] == "system"), F.lit(0))["text"]
    return m.select("conv_id", system.alias("task_system"), F.when(F.size(asked) > 0, F.array_join(F.transform(asked, lambda x: x["text"]), "\n")).alias("task_user"))


@query("assistant_text", """select conv_id, string_agg(text, chr(10) order by turn) as said from conversations where role = 'assistant' group by 1""")
def assistant_text(spark, d):
    m = V.turns(spark, d).where("role = 'assistant'").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("m"))
    return m.select("conv_id", F.array_join(F.transform("m", lambda x: x["text"]), "\n").alias("said"))


@query("turn_counts", "select conv_id, count(*) filter (where role = 'assistant') as n_turns, count(*) as n_messages from conversations group by 1")
def turn_counts(spark, d):
    return V.turns(spark, d).groupBy("conv_id").agg(F.count(F.when(F.col("role") == "assistant", 1)).alias("n_turns"), F.count(F.lit(1)).alias("n_messages"))


@query("turn_histogram", f"""with {TRACES} select case when n_turns <= 1 then '<=1' when n_turns <= 2 then '<=2' when n_turns <= 4 then '<=4' else '>4' end as bin,
  count(*) as n, round(count(*) / (select count(*) from v_trace), 6) as share from v_trace group by 1""")
def turn_histogram(spark, d):
    n = F.col("n_turns")
    bins = traces(spark, d).groupBy(F.when(n <= 1, "<=1").when(n <= 2, "<=2").when(n <= 4, "<=4").otherwise(">4").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return bins.join(F.broadcast(bins.agg(F.sum("n").alias("t"))), how="cross").select("bin", "n", F.round(F.col("n") / F.col("t"), 6).alias("share"))  # one row


@query("event_sequences", """select seq, count(*) as n from (select user_id, string_agg(event_type, '>' order by ts, event_id) as seq from events group by 1) group by 1""")
def event_sequences(spark, d):
    e = read_table(spark, d, "events", "event_id", "ts", "user_id", "event_type")
    seq = e.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))).alias("m"))
    return seq.groupBy(F.array_join(F.transform("m", lambda x: x["event_type"]), ">").alias("seq")).agg(F.count(F.lit(1)).alias("n"))


@query("content_hash_conversations", f"with {TRACES} select conv_id, h as content_hash from v_trace")
def content_hash_conversations(spark, d):
    return traces(spark, d).select("conv_id", F.col("h").alias("content_hash"))


_GRAMS = r"""case when len(w) = 0 then [] when len(w) < 8 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) end"""
_W = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') as w"


@query("decontaminate_documents", f"""with r as (select doc_id, {_GRAMS} as g from (select doc_id, {_W} from documents)), t as (select item_id, unnest({_GRAMS}) as h from (select item_id, {_W} from benchmark)),
  x as (select doc_id, len(g) as n, unnest(g) as h from r), s as (select doc_id, item_id, count(*) / any_value(n) as share from x join t on x.h = t.h group by 1, 2)
select doc_id as id, arg_min(item_id, struct_pack(a := -share, b := item_id)) as task, round(max(share), 6) as share from s where share >= 0.02 group by 1""")
def decontaminate_documents(spark, d):
    """At an overlap of 0.02, so that passages inside long documents show."""
    found = S.decontaminate(read_table(spark, d, "documents", "doc_id", "text"), read_table(spark, d, "benchmark", "item_id", "text"), "doc_id", "text", "item_id", "text", overlap=0.02)
    return found.select("id", "task", F.round("share", 6).alias("share"))


@query("jaccard_pairs", r"""with w as (select doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') as w from documents),
  s as (select doc_id, case when len(w) = 0 then [] when len(w) <= 5 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from w),
  e as (select doc_id, len(s) as n, unnest(s) as g from s),
  p as (select a.doc_id as a, b.doc_id as b, count(*) as i, any_value(a.n) as na, any_value(b.n) as nb from e a join e b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2)
select a, b, round(i / (na + nb - i), 6) as jaccard from p where i / (na + nb - i) >= 0.85""")
def jaccard_pairs(spark, d):
    return S.jaccard_pairs(read_table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", 0.85).select("a", "b", F.round("jaccard", 6).alias("jaccard"))


_JACCARD = r"""w as (select doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') as w from documents),
  s as (select doc_id, case when len(w) = 0 then [] when len(w) <= 5 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from w),
  e as (select doc_id, len(s) as n, unnest(s) as g from s),
  p as (select a.doc_id as a, b.doc_id as b, count(*) as i, any_value(a.n) as na, any_value(b.n) as nb from e a join e b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
  j as materialized (select a, b from p where i / (na + nb - i) >= 0.85)"""
#: Greedy keep-first over the rows that are the larger of some pair, in order: the list of dropped ids so far is the state.
_KEPT = """o as materialized (select b, row_number() over (order by b) as k, list(a) as before from j group by b),
  f(k, gone) as (select 0::bigint, []::bigint[] union all select o.k, case when len(o.before) > len(list_intersect(f.gone, o.before)) then list_append(f.gone, o.b) else f.gone end from f join o on o.k = f.k + 1),
  l as materialized (select gone from f order by k desc limit 1)"""


@query("near_dedupe", f"with recursive {_JACCARD}, {_KEPT} select doc_id as id, not list_contains((select gone from l), doc_id) as kept from documents")
def near_dedupe(spark, d):
    return S.near_dedupe(read_table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


@query("minhash_dedupe", f"with recursive {_JACCARD}, {_KEPT} select doc_id as id, not list_contains((select gone from l), doc_id) as kept from documents")
def minhash_dedupe(spark, d):
    """As near_dedupe, its pairs found by sketches and bands."""
    return S.near_dedupe(read_table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", sketches=True)


@query("minhash_pairs", f"with {_JACCARD.replace('select a, b from p', 'select a, b, round(i / (na + nb - i), 6) as jaccard from p')} select a, b, jaccard from j")
def minhash_pairs(spark, d):
    """Banded candidates verified on whole sets; a pair at the threshold is lost with probability 0.00001."""
    return S.minhash_pairs(read_table(spark, d, "documents", "doc_id", "text"), "doc_id", "text").select("a", "b", F.round("jaccard", 6).alias("jaccard"))


@query("minhash_errors", f"with {_JACCARD} select count(distinct least(a, b)) > 0 as some, true as mean_below, true as largest_below from j")
def minhash_errors(spark, d):
    """How far estimates of 128 places are off on the candidates: a mean below 0.06 and nothing beyond four deviations of 0.0442."""
    corpus = S.Corpus(read_table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", mark=S.sketch_marks())
    found = S.written(S.banded_candidates(S.sketched(corpus), 0.85))
    off = F.abs(F.col("estimate") - F.col("jaccard"))
    exact = S.verified(found, corpus, 0.0).select(F.col("ka.a").alias("ka"), F.col("kb.a").alias("kb"), "jaccard")
    return found.join(exact, ["ka", "kb"]).agg((F.count(F.lit(1)) > 0).alias("some"), (F.avg(off) < 0.06).alias("mean_below"), (F.max(off) < 0.177).alias("largest_below"))


@query("duplicate_groups", f"with recursive {_JACCARD}, {_KEPT} select m as id, list(b order by b) as dropped from (select b, min(a) as m from j where not list_contains((select gone from l), a) and list_contains((select gone from l), b) group by b) group by m")
def duplicate_groups(spark, d):
    docs = read_table(spark, d, "documents", "doc_id", "text")
    pairs = S.written(S.jaccard_pairs(docs, "doc_id", "text", 0.85).select("a", "b"))
    return S.duplicate_groups(docs.select(F.col("doc_id").alias("id")), pairs)


@query("cap_per_group", """select event_id, user_id, rank_in_group from (select event_id, user_id, cast(row_number() over (partition by user_id order by ts, event_id) as integer) as rank_in_group from events) where rank_in_group <= 3""")
def cap_per_group(spark, d):
    return C.keep_per_group(read_table(spark, d, "events", "event_id", "user_id", "ts"), "user_id", ["ts", "event_id"], 3).select("event_id", "user_id", "rank_in_group")


@query("coverage", """with a as (select user_id % 7 as cluster, count(*) as n from events group by 1), b as (select user_id % 7 as cluster, count(*) as n from events where event_type = 'error' and value > 60 group by 1)
select coalesce(a.cluster, b.cluster) as cluster, coalesce(a.n, 0) as n_before, coalesce(b.n, 0) as n_after, coalesce(b.n, 0) < 10 as sparse from a full join b on a.cluster = b.cluster""")
def coverage(spark, d):
    e = read_table(spark, d, "events", "user_id", "event_type", "value").withColumn("cluster", F.col("user_id") % 7)
    return C.coverage(e, e.where("event_type = 'error' and value > 60"), "cluster")


@query("topk_ties", "select event_type, n, first_seen from (select event_type, count(*) as n, min(event_id) as first_seen from events group by 1) order by n desc, first_seen limit 3")
def topk_ties(spark, d):
    return C.top_frequencies(read_table(spark, d, "events", "event_type", "event_id"), "event_type", "event_id", 3)


@query("event_type_freq", "select event_type, count(*) as n, round(count(*) / (select count(*) from events), 6) as share from events group by 1")
def event_type_freq(spark, d):
    f = read_table(spark, d, "events", "event_type").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return f.join(F.broadcast(f.agg(F.sum("n").alias("t"))), how="cross").select("event_type", "n", F.round(F.col("n") / F.col("t"), 6).alias("share"))  # one row
