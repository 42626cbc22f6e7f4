"""Queries over sources, canonical forms and turns: events as tool calls, conversations as JSON lines in two dialects."""

from __future__ import annotations

from pyspark.sql import functions as F

from traceloom.functions import canonical as N
from traceloom.functions import text as X
from traceloom.operators import curate as U
from traceloom.operators import curation as C
from traceloom.operators import gate as G
from traceloom.operators import samples as M
from traceloom.operators import lifecycle as L
from traceloom.operators import registry as K
from traceloom.operators import turns as T
from traceloom.plans import views as V
from traceloom.plans.registered import query
from traceloom.plans.evaluation import r6
from traceloom.sources import jsonl as J
from traceloom.sources import stores as S
from traceloom.sources.tables import read_table


@query("argument_hash", """select event_id, sha256('{"args":' || replace(props, ' ', '') || ',"tool":"' || event_type || '"}') as h from events""")
def argument_hash(spark, d):
    return read_table(spark, d, "events", "event_id", "event_type", "props").select("event_id", N.call_hash_udf()("event_type", "props").alias("h"))


@query("canonical_arguments", """select event_id, '{"a":"x","k":' || json_extract_string(props, '$.k') || '}' as canonical from events""")
def canonical_arguments(spark, d):
    put = F.format_string('{ "k" : %s, "a": "x" }', F.get_json_object("props", "$.k"))
    return read_table(spark, d, "events", "event_id", "props").select("event_id", N.canonical_arguments_udf(put).alias("canonical"))


@query("normalized_arguments", """select event_id, sha256('{"args":{"at":"<ts>","id":"<uuid>","v":"x"},"tool":"t"}') as h from events""")
def normalized_arguments(spark, d):
    """Times, ids, blanks and volatile keys don't matter: every call has the same hash."""
    text = F.format_string('{"v":" x ","request_id":"%s","id":"00000000-0000-4000-8000-%012d","at":"%s"}', F.col("event_id").cast("string"), F.col("event_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return read_table(spark, d, "events", "event_id", "ts").select("event_id", N.call_hash_udf()(F.lit("t"), text).alias("h"))


@query("js_numbers", """select p_partkey, sha256('{"args":{"n":' || p_size || '},"tool":"t"}') as h from part""")
def js_numbers(spark, d):
    """An integral number is written as an integer."""
    return read_table(spark, d, "part", "p_partkey", "p_size").select("p_partkey", N.call_hash_udf("js")(F.lit("t"), F.format_string('{"n":%d.0}', F.col("p_size"))).alias("h"))


@query("json_numbers", """select p_partkey, sha256('{"args":{"n":' || p_size || '.0},"tool":"t"}') as h from part""")
def json_numbers(spark, d):
    return read_table(spark, d, "part", "p_partkey", "p_size").select("p_partkey", N.call_hash_udf("json")(F.lit("t"), F.format_string('{"n":%d.0}', F.col("p_size"))).alias("h"))


@query("argument_tokens", "select event_id, ['k=' || json_extract_string(props, '$.k')] as t from events")
def argument_tokens(spark, d):
    return read_table(spark, d, "events", "event_id", "props").select("event_id", N.argument_tokens_udf("props").alias("t"))


@query("tool_rules", """select event_id, sha256('{"args":{"k":"same"},"tool":"' || event_type || '"}') = sha256('{"args":{"k":"same"},"tool":"view"}') as ruled, event_type = 'view' as is_view from events""")
def tool_rules(spark, d):
    """A rule of one tool alone: its arguments are all the same."""
    rules = {"view": N.ArgumentRules(custom=lambda a: {"k": "same"})}
    e = read_table(spark, d, "events", "event_id", "event_type", "props")
    same = N.call_hash_udf(rules=rules)("event_type", "props") == N.call_hash("view", {"k": "same"})
    return e.select("event_id", same.alias("ruled"), (F.col("event_type") == "view").alias("is_view"))


@query("durations", "select p_partkey, p_size * (case p_partkey % 6 when 0 then 1 when 1 then 60 when 2 then 3600 when 3 then 86400 when 4 then 604800 end) as seconds from part")
def durations(spark, d):
    unit = F.element_at(F.array(*map(F.lit, ["s", "m", "h", "d", "w", "y"])), (F.col("p_partkey") % 6 + 1).cast("int"))
    return read_table(spark, d, "part", "p_partkey", "p_size").select("p_partkey", X.duration_seconds(F.concat(F.col("p_size").cast("string"), unit)).alias("seconds"))


@query("word_ngrams", r"""with w as (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') as w from documents) select doc_id, case when len(w) = 0 then 0 when len(w) < 3 then 1 else len(list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))) end as n from w""")
def word_ngrams(spark, d):
    return read_table(spark, d, "documents", "doc_id", "text").select("doc_id", F.size(X.grams(X.words(F.col("text")), 3)).cast("long").alias("n"))


@query("exact_task_keys", r"select doc_id, sha256(array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), ' ')) as k from documents")
def exact_task_keys(spark, d):
    return read_table(spark, d, "documents", "doc_id", "text").select("doc_id", X.exact_key(F.col("text")).alias("k"))


@query("error_results", "select event_id, event_id % 9 in (0, 3, 4, 6, 7) as bad from events")
def error_results(spark, d):
    texts = ['{"error":"x"}', '{"error":0}', '{"error":false}', '{"error":"false"}', "Error: no", '{"error":[]}', '{"status":"FAILED"}', '{"status_code":500}', '{"status_code":"500"}']
    t = F.element_at(F.array(*map(F.lit, texts)), (F.col("event_id") % 9 + 1).cast("int"))
    return read_table(spark, d, "events", "event_id").select("event_id", X.is_error_result(t).alias("bad"))


@query("teacher_written", f"with {V.REQUESTS} select id, case when arm = 'teacher' then 'arm' when fallback then 'escalated' when user_id % 5 = 0 then 'marked message' end as reason from v_request")
def teacher_written(spark, d):
    return V.requests(spark, d).select("id", S.teacher_reason(F.col("arm"), F.col("fallback"), F.col("user_id") % 5 == 0).alias("reason"))


@query("request_log_scan", f"with {V.REQUESTS} select id from v_request where received_at >= timestamp '2024-01-15' and outcome is not null and arm <> 'teacher' and not fallback")
def request_log_scan(spark, d):
    say = F.array(F.struct(F.lit("user").alias("role"), F.lit("hi").alias("content"), F.lit(None).cast("string").alias("arm")))
    log = V.requests(spark, d).withColumns({"escalated": F.col("fallback"), "messages": say})
    return S.request_traces(log, F.lit("2024-01-15").cast("timestamp"))[0].select("id")


@query("outcome_resolution", """with c as (select user_id as run_id, arg_max(event_type, struct_pack(a := ts, b := event_id)) as last, nullif(sum(event_id), 0)::bigint as t from events group by 1), l as (select doc_id as run_id, arg_max(quality = 1, doc_id) as label from labels group by 1),
 r as (select vec_id as run_id, label % 2 = 0 as passed from embeddings)
select c.run_id, c.last, c.t as prompt_tokens, case when r.run_id is not null then r.passed else l.label end as success from c join customer k on k.c_custkey = c.run_id left join l on l.run_id = c.run_id left join r on r.run_id = c.run_id""")
def outcome_resolution(spark, d):
    """The last call of each run, and its outcome: results overwrite labels."""
    runs = read_table(spark, d, "customer", F.col("c_custkey").alias("id"), F.col("c_name").alias("task_id"))
    calls = read_table(spark, d, "events", F.col("event_id").alias("id"), F.col("user_id").alias("run_id"), F.col("ts").alias("started_at"), F.col("event_type").alias("request"), F.col("event_type").alias("response"), F.col("event_type").alias("model"), F.col("event_id").alias("prompt_tokens"), F.lit(0).alias("completion_tokens"), F.lit(0.0).alias("cost_usd"))
    labels = read_table(spark, d, "labels", F.col("doc_id").alias("run_id"), F.col("quality").alias("value"))
    results = read_table(spark, d, "embeddings", F.col("vec_id").alias("run_id"), (F.col("label") % 2 == 0).alias("passed"))
    return S.trajectories(runs, calls, results, labels)[0].select("run_id", F.col("request").alias("last"), "prompt_tokens", "success")


@query("final_messages", "select event_id, case when event_id % 4 = 3 then null else event_type end as content from events")
def final_messages(spark, d):
    texts = [F.format_string('{"choices":[{"message":{"content":"%s"}}]}', "event_type"), F.format_string('{"role":"assistant","content":[{"type":"text","text":"%s"}]}', "event_type"), F.format_string('{"content":"%s"}', "event_type"), F.lit('{"choices":[{"message":{"content":""}}]}')]
    k = F.col("event_id") % 4
    response = F.when(k == 0, texts[0]).when(k == 1, texts[1]).when(k == 2, texts[2]).otherwise(texts[3])
    return read_table(spark, d, "events", "event_id", "event_type").select("event_id", S.final_message(response)["content"].alias("content"))


def lines(spark, d, blocks: bool):
    """Conversations as JSON lines; in blocks every content is a list of one text block."""
    t = V.turns(spark, d)
    said = F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("text"))) if blocks else F.col("text")
    m = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", said.alias("content")))).alias("m"))
    messages = F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    return m.select(F.to_json(F.struct(F.col("conv_id").cast("string").alias("id"), messages.alias("messages"))).alias("value"))


_PARSED = """select conv_id::varchar as id, count(*) filter (where role = 'assistant') as n_turns, 0::bigint as n_tool_calls, string_agg(text, chr(10) order by turn) filter (where role = 'user' and turn < coalesce(fa, 1000000)) as task_user
 from (select *, min(turn) filter (where role = 'assistant') over (partition by conv_id) as fa from conversations) group by 1"""


@query("jsonl_parse", _PARSED)
def jsonl_parse(spark, d):
    return J.parse_lines(lines(spark, d, False)).select("id", "n_turns", "n_tool_calls", "task_user")


@query("block_dialect_parse", _PARSED)
def block_dialect_parse(spark, d):
    return J.parse_lines(lines(spark, d, True)).select("id", "n_turns", "n_tool_calls", "task_user")


@query("same_hash_in_both_dialects", "select count(distinct conv_id) as n from conversations")
def same_hash_in_both_dialects(spark, d):
    a, b = (J.parse_lines(lines(spark, d, x)).select("id", "content_hash") for x in (False, True))
    return a.join(b, ["id", "content_hash"]).agg(F.count(F.lit(1)).alias("n"))


@query("schema_problems", f"with {V.CALLS} select trace, count(*) filter (where json_extract_string(args, '$.k')::bigint > 50) as n from v_call group by 1")
def schema_problems(spark, d):
    from traceloom.functions.json_schema import call_problem_udf

    schema = F.lit('{"type":"object","properties":{"k":{"type":"integer","maximum":50}},"required":["k"]}')
    return V.calls(spark, d).withColumn("why", call_problem_udf("args", schema)).groupBy("trace").agg(F.count("why").alias("n"))


@query("unpaired_calls", f"with {V.CALLS} select trace, id as call_id, 'call without result' as problem from v_call where tool = 'view' union all select trace, id, 'result without call' from v_call where tool = 'error'")
def unpaired_calls(spark, d):
    c = V.calls(spark, d).select("trace", F.col("id").alias("call_id"), "turn", "tool")
    return C.unpaired_calls(c.where("tool <> 'error'").select("trace", "call_id", "turn"), c.where("tool <> 'view'").select("trace", "call_id", (F.col("turn") + 1).alias("turn")))


@query("error_run_lengths", f"""with {V.CALLS}, g as (select *, row_number() over (partition by trace order by turn) - row_number() over (partition by trace, error order by turn) as grp from v_call), r as (select trace, count(*) as n from g where error group by trace, grp)
select c.trace, coalesce(max(r.n), 0)::integer as longest from (select distinct trace from v_call) c left join r on r.trace = c.trace group by 1""")
def error_run_lengths(spark, d):
    said = F.when(F.col("error"), "Error: no").otherwise("fine")
    per = V.calls(spark, d).groupBy("trace").agg(F.array_sort(F.collect_list(F.struct("turn", F.lit("tool").alias("role"), said.alias("content")))).alias("m"))
    return per.select("trace", U.error_run(F.col("m")).cast("int").alias("longest"))


@query("call_signatures", f"""with {V.CALLS} select trace, sha256('{{"args":' || replace(args, ' ', '') || ',"tool":"' || tool || '"}}') as s, count(*) as n from v_call group by 1, 2""")
def call_signatures(spark, d):
    t = V.call_traces(spark, d).withColumnRenamed("trace", "id")
    m = t.select("id", F.explode("messages").alias("m")).where("m.role = 'assistant' and size(m.tool_calls) > 0")
    s = m.select(F.col("id").alias("trace"), T.signature_udf()(F.to_json("m.tool_calls")).alias("s"))
    return s.select("trace", F.explode("s").alias("s")).groupBy("trace", "s").agg(F.count(F.lit(1)).alias("n"))


def long_turns(spark, d, shift: int = 0):
    """Conversations in long form; every turn's signature is a code of its length."""
    t = V.turns(spark, d).withColumn("trace", F.col("conv_id") - shift)
    code = F.when(F.col("role") == "assistant", F.concat(F.lit("s"), (F.length("text") % 2).cast("string"))).otherwise("u")
    return t.select("trace", "turn", "role", F.lit("").alias("content"), F.when(F.col("role") == "assistant", F.array(F.lit("f"))).otherwise(F.array().cast("array<string>")).alias("names"), F.array(code).alias("signature"))


_LONG = "v_long as (select conv_id as trace, turn, role, case when role = 'assistant' then 's' || (length(text) % 2) else 'u' end as s from conversations)"


@query("prefix_groups", f"with {_LONG}, p as (select trace, turn, string_agg(role || ':' || s, '|') over (partition by trace order by turn rows between unbounded preceding and 1 preceding) as p from v_long), c as (select p, count(*) as n from p group by 1) select n, count(*) as groups from c group by 1")
def prefix_groups(spark, d):
    """How many turns share a prefix: the sizes of the groups."""
    p = T.with_prefix_key(long_turns(spark, d)).groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    return p.groupBy("n").agg(F.count(F.lit(1)).alias("groups"))


@query("corrected_turns", f"with {_LONG} select a.trace, a.turn, exists (select 1 from v_long b where b.trace = a.trace and b.turn > a.turn and b.role = 'assistant' and b.s <> a.s) as corrected from v_long a where a.role = 'assistant'")
def corrected_turns(spark, d):
    return T.corrected_later(long_turns(spark, d))


@query("turn_labels", f"""with {_LONG}, p as (select *, coalesce(string_agg(role || ':' || s, '|') over (partition by trace order by turn rows between unbounded preceding and 1 preceding), '') as p from v_long),
 t as (select trace - 1 as task, p, arg_max(s, turn) as ts from p where role = 'assistant' group by 1, 2),
 x as (select r.trace, r.turn, r.s, t.ts, exists (select 1 from v_long b where b.trace = r.trace and b.turn > r.turn and b.role = 'assistant' and b.s <> r.s) as corrected from p r left join t on t.task = r.trace and t.p = r.p where r.role = 'assistant')
select trace, turn, case when trace % 3 = 0 then 'task_failed' when ts = s then 'teacher_match' when ts is not null then 'teacher_mismatch' when corrected then 'corrected_later' else 'uncorrected' end as how from x""")
def turn_labels(spark, d):
    """Conversations as rollouts, the next conversation as their teacher."""
    r = long_turns(spark, d)
    outcomes = r.select("trace").distinct().select("trace", F.col("trace").alias("task"), (F.col("trace") % 3 != 0).alias("success"))
    return T.label_turns(r, outcomes, long_turns(spark, d, 1)).select("trace", "turn", "how")


@query("teacher_forced", f"with {_LONG} select a.trace, a.turn, a.s = b.s as full from v_long a join v_long b on b.trace = a.trace + 1 and b.turn = a.turn where a.role = 'assistant' and b.role = 'assistant'")
def teacher_forced(spark, d):
    return T.teacher_forced(long_turns(spark, d), long_turns(spark, d, 1)).select("trace", "turn", "full")


@query("teacher_forced_summary", f"with {_LONG}, x as (select a.trace, avg((a.s = b.s)::int) as f from v_long a join v_long b on b.trace = a.trace + 1 and b.turn = a.turn where a.role = 'assistant' and b.role = 'assistant' group by 1) select round(avg(f), 6) as full, 1.0::double as name, round(avg(f), 6) as args, count(*) as n_tasks from x")
def teacher_forced_summary(spark, d):
    return T.teacher_forced_summary(T.teacher_forced(long_turns(spark, d), long_turns(spark, d, 1))).select(*r6("full", "name", "args"), "n_tasks")


@query("turn_features", "select user_id, round(avg(-value), 6) as mean_logprob, round(min(-value), 6) as min_logprob, round(quantile_cont(-value, 0.1), 6) as p10_logprob, round(avg(-value) filter (where event_type = 'click'), 6) as arg_mean_logprob, count(*) as n_tokens from events group by 1 having count(*) filter (where event_type = 'click') > 0")
def turn_features(spark, d):
    t = read_table(spark, d, "events", "user_id", (-F.col("value")).alias("logprob"), (F.col("event_type") == "click").alias("is_arg"))
    return T.turn_features(t, ["user_id"]).where(~F.isnan("arg_mean_logprob")).select("user_id", *r6("mean_logprob", "min_logprob", "p10_logprob", "arg_mean_logprob"), "n_tokens")


@query("self_consistency", f"with {_LONG} select trace, round(count(*) filter (where s = 's1') / count(*), 6) as share from v_long where role = 'assistant' group by 1")
def self_consistency(spark, d):
    g = long_turns(spark, d).where("role = 'assistant'").groupBy("trace").agg(F.collect_list("signature").alias("samples"))
    return g.select("trace", F.round(T.self_consistency(F.array(F.lit("s1")), F.col("samples")), 6).alias("share"))


@query("tool_call_texts", """select event_id, case when event_id % 3 = 2 then 0 else 1 end as n, case when event_id % 3 = 2 then null else event_type end as tool from events""")
def tool_call_texts(spark, d):
    e = read_table(spark, d, "events", "event_id", "event_type", "props")
    hermes = F.format_string('ok <tool_call>{"name":"%s","arguments":%s}</tool_call>', "event_type", "props")
    llama = F.format_string('{"name":"%s","parameters":%s}', "event_type", "props")
    k = F.col("event_id") % 3
    calls = F.when(k == 0, T.parse_calls_udf("hermes")(hermes)).when(k == 1, T.parse_calls_udf("llama3_json")(llama)).otherwise(T.parse_calls_udf("hermes")(F.lit("just text")))
    return e.select("event_id", calls.alias("c")).select("event_id", F.size("c").alias("n"), F.get("c", F.lit(0))["name"].alias("tool"))


@query("retrain_gate_reasons", "select p_partkey, case when p_size < 9 then 'requests' when p_retailprice < 950 then 'samples' when p_partkey % 7 = 0 then 'decision' end as stopped_by from part")
def retrain_gate_reasons(spark, d):
    c = {"requests": F.col("p_size") * 5 + 5, "samples": (F.col("p_retailprice") - 900), "loss": F.lit(0.5), "decision": F.when(F.col("p_partkey") % 7 == 0, "discard").otherwise("promote"), "delta": F.lit(0.0), "ece": F.lit(0.01), "auroc": F.lit(0.9), "drop": F.lit(0.0), "checks_ok": F.lit(True)}
    return read_table(spark, d, "part", "p_partkey", "p_size", "p_retailprice").select("p_partkey", L.retrain_gates(c).alias("stopped_by"))


@query("promotion_checks", "select p_partkey, p_size > 25 as has_eval, p_retailprice >= 990 as schema_valid, p_partkey % 2 = 0 as not_worse, p_size <= 30 as tokens, p_partkey % 3 <> 0 as calibrated from part")
def promotion_checks(spark, d):
    c = {"has_eval": F.col("p_size") > 25, "schema_valid": F.col("p_retailprice") / 1000, "refusal": F.lit(None).cast("string"), "success_low": F.when(F.col("p_partkey") % 2 == 0, 0.0).otherwise(-0.5), "token_delta": F.col("p_size") - 30, "ece": F.when(F.col("p_partkey") % 3 != 0, 0.01)}
    return read_table(spark, d, "part", "p_partkey", "p_size", "p_retailprice").select("p_partkey", L.promotion_checks(c).alias("c")).select("p_partkey", "c.*")


@query("adapter_statuses", "select user_id as adapter_id, arg_max(event_type, struct_pack(a := ts, b := event_id)) as status from events group by 1")
def adapter_statuses(spark, d):
    e = read_table(spark, d, "events", F.col("user_id").alias("adapter_id"), F.col("event_type").alias("status"), F.col("ts").alias("at"), F.col("event_id").alias("seq"))
    return L.current_status(e)


@query("single_prod", "select p_partkey from part where p_partkey = 7")
def single_prod(spark, d):
    r = K.only(read_table(spark, d, "part", "p_partkey").where("p_partkey = 7"))
    return spark.createDataFrame([(r.p_partkey,)], "p_partkey long")


@query("orphan_runs", "select distinct l_partkey as id from lineitem where l_partkey not in (select p_partkey from part where p_size > 10)")
def orphan_runs(spark, d):
    named = read_table(spark, d, "lineitem", F.col("l_partkey").alias("id")).distinct()
    return L.orphan_runs(named, read_table(spark, d, "part", F.col("p_partkey").alias("id"), "p_size").where("p_size > 10"), "id")


@query("tag_matches", "select p_brand, p_brand like 'Brand#_2' as fits from part")
def tag_matches(spark, d):
    return read_table(spark, d, "part", "p_brand").select("p_brand", C.tag_matches(F.col("p_brand"), "Brand#?2").alias("fits"))


@query("argument_masks", """select event_id, case event_id % 4 when 0 then props when 1 then replace(props, ' ', '') when 2 then props else json_extract_string(props, '$.k') end as masked, case event_id % 4 when 0 then 2 when 2 then 2 else 1 end::int as n from events""")
def argument_masks(spark, d):
    """Tokens of generated calls that hold arguments: written as they are, compact where they were spaced, spaced where they were compact, or only
    the value in a sentence."""
    way, compact = F.col("event_id") % 4, F.replace(F.col("props"), F.lit(" "), F.lit(""))
    shown = F.when(way.isin(0, 2), F.col("props")).when(way == 1, compact).otherwise(F.get_json_object("props", "$.k"))
    e = read_table(spark, d, "events", "event_id", "event_type", "props").select("event_id", F.concat(F.lit("call "), "event_type", F.lit(" with "), shown, F.lit(" end")).alias("text"), F.when(way == 2, compact).otherwise(F.col("props")).alias("args"))
    place = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,w:string>>").alias("out"))
    one = lambda a, w: F.struct((a["at"] + F.length(w) + 1).alias("at"), F.concat(a["out"], F.array(F.struct(a["at"].alias("s"), (a["at"] + F.length(w)).alias("e"), w.alias("w")))).alias("out"))
    e = e.withColumn("tokens", F.aggregate(F.split("text", " "), place, one, lambda a: a["out"])).withColumn("spans", M.argument_spans(F.col("text"), F.col("args")))
    mask = e.withColumn("mask", M.argument_mask(F.col("tokens"), F.col("spans")))
    held = F.transform(F.filter(F.arrays_zip("tokens", "mask"), lambda x: x["mask"]), lambda x: x["tokens"]["w"])
    return mask.select("event_id", F.array_join(held, " ").alias("masked"), F.size(held).alias("n"))


_GATE = f"{V.SCORES}, g as (select doc_id, p, task, y, task % 5 as grp, case when task % 5 = 1 then null else p end as f, case when task % 5 = 2 then 1 else y end as z from v_score)"


def gate_rows(spark, d):
    """Scored turns in five groups: one has no feature, one has a single class, one is left with few turns."""
    x = V.scores(spark, d).withColumn("grp", F.col("task") % 5)
    return x.select("doc_id", "task", "grp", "p", "y", F.when(F.col("grp") != 1, F.col("p")).alias("f"), F.when(F.col("grp") == 2, 1).otherwise(F.col("y")).alias("z"))


@query("gate_fit_reasons", f"""with {_GATE}, h as (select * from g where grp <> 3 or doc_id % 7 = 0) select grp, count(*) as n, case when count(*) < 4 then 'too_few_turns' when count(f) = 0 then 'no_features' when min(z) = max(z) then 'single_class'
 when least(count(*) filter (where z = 1), count(*) filter (where z = 0)) < 4 then 'fit_error' end as reason from h group by 1""")
def gate_fit_reasons(spark, d):
    """Why a gate can't be fitted, for each group of turns."""
    return G.fit_refusals(gate_rows(spark, d).where("grp <> 3 or doc_id % 7 = 0"), ["grp"], ["f"], "z", least_turns=4, least_per_fold=2).select("grp", "n", "reason")


@query("gate_folds", f"with {V.SCORES} select doc_id, cast('0x' || substr(sha256('0:' || task), 1, 8) as bigint) % 5 as fold from v_score")
def gate_folds(spark, d):
    """Every task's turns lie in one fold."""
    return V.scores(spark, d).select("doc_id", G.fold_of(F.col("task"), 5).alias("fold"))


@query("gate_isotonic", f"""with {V.SCORES}, s as (select p, count(*) as n, sum(y) as u, row_number() over (order by p) as i from v_score group by p),
 r as (select a.i as lo, b.i as hi, (select sum(u) / sum(n) from s where s.i between a.i and b.i) as m from s a join s b on a.i <= b.i),
 k as (select s.p, s.i, r.lo, min(r.m) as m from s join r on r.lo <= s.i and r.hi >= s.i group by all) select p, round(max(m), 6) as calibrated from k group by p""")
def gate_isotonic(spark, d):
    """The isotonic curve at every distinct score."""
    x = V.scores(spark, d).select("p", "y")
    curve = G.fit_isotonic(x, "p", "y")
    return G.with_isotonic(x.select("p").distinct(), "p", curve).select("p", F.round("calibrated", 6).alias("calibrated"))


def _newton(n: int) -> str:
    """SQL of n Newton steps of the sigmoid fit with smoothed targets."""
    out = [V.SCORES, "c as (select sum(y) as n1, sum(1 - y) as n0 from v_score)", "t as materialized (select p as s, case when y = 1 then (n1 + 1) / (n1 + 2) else 1 / (n0 + 2) end as t from v_score, c)", "w0 as materialized (select 0.0::double as a, ln((n1 + 1) / (n0 + 1))::double as b from c)"]
    for i in range(n):
        out.append(f"q{i} as (select s, t, 1 / (1 + exp(-(a * s + b))) as m from t, w{i}), h{i} as (select sum((t - m) * s) as ga, sum(t - m) as gb, sum(m * (1 - m) * s * s) + 1e-12 as aa, sum(m * (1 - m) * s) as ab, sum(m * (1 - m)) + 1e-12 as bb from q{i})")
        out.append(f"w{i + 1} as materialized (select a + (bb * ga - ab * gb) / (aa * bb - ab * ab) as a, b + (aa * gb - ab * ga) / (aa * bb - ab * ab) as b from w{i}, h{i})")
    return "with " + ",\n ".join(out)


@query("gate_sigmoid", _newton(8) + " select round(a, 5) as a, round(b, 5) as b from w8")
def gate_sigmoid(spark, d):
    """Slope and offset of the sigmoid over all turns, by Newton steps over sums."""
    a, b = G.fit_sigmoid(V.scores(spark, d).select("p", "y"), "p", "y", rounds=8)
    return spark.createDataFrame([(round(a, 5), round(b, 5))], "a double, b double")
