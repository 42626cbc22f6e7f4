"""Replay, pairs, router draws, selectors, samples and hooks on small fixtures."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from traceloom.functions.text import is_error_result
from traceloom.operators import assembly as A
from traceloom.operators import evaluation as V
from traceloom.operators import pairs as P
from traceloom.operators import replay as R
from traceloom.operators import runs as U
from traceloom.operators import samples as M
from traceloom.operators import selectors as L
from traceloom.operators import similarity as S
from traceloom.operators import thompson as T
from traceloom.operators.ordered import carried, running
from traceloom.operators.registry import Ambiguous, NoMatch
from traceloom.plans.pairs import MESSAGE
from traceloom.sources import jsonl as J


def call(name, args, id_="c1"):
    return {"id": id_, "type": "function", "function": {"name": name, "arguments": args}}


def trace(calls, answer="bye"):
    m = [{"role": "system", "content": "s"}, {"role": "user", "content": "task"}]
    for i, (name, args, result) in enumerate(calls):
        m += [{"role": "assistant", "content": None, "tool_calls": [call(name, args, f"c{i}")]}, {"role": "tool", "tool_call_id": f"c{i}", "content": result}]
    return {"id": "t", "task_id": "k", "messages": [*m, {"role": "assistant", "content": answer}], "tools": []}


def test_running_and_carried_equal_windows(spark):
    rng = np.random.default_rng(0)
    rows = [(int(rng.integers(2)) if i % 9 else None, int(rng.integers(40)), i, int(rng.integers(5)), None if rng.random() < 0.7 else i) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, o int, i int, v int, w int")
    got = {r.i: r for r in running(df, ["k"], ["o", "i"], F.col("v"), "s").collect()}
    for k, o, i, _, _ in rows:
        before = [v for k2, o2, i2, v, _ in rows if k2 == k and (o2, i2) < (o, i)]
        assert got[i].s == sum(before) and got[i].s_all == sum(r[3] for r in rows if r[0] == k)
    named = df.where("k is not null")
    for r in carried(named, ["k"], ["o", "i"], "w", "last").collect():
        past = [x for x in rows if x[0] == r.k and (x[1], x[2]) <= (r.o, r.i) and x[4] is not None]
        assert r["last"] == (max(past, key=lambda x: (x[1], x[2]))[4] if past else None)


MESSAGES = "id string, task_id string, messages array<struct<role:string,content:string,tool_calls:array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>,tool_call_id:string>>"


def as_rows(*traces):
    full = lambda m: (m["role"], m.get("content"), m.get("tool_calls"), m.get("tool_call_id"))
    return [(str(i), "k", [full(m) for m in t["messages"]]) for i, t in enumerate(traces)]


def test_recordings_replay_diverge_and_stop(spark):
    own = trace([("f", '{"a":1}', "one"), ("f", '{"a":2}', "two")])
    other = trace([("f", '{"a": 1}', ""), ("f", '{"a":9}', "")])
    broken = trace([("f", "{no", "")])
    many = trace([("f", '{"a":1}', "one")] * 20)
    recorded = R.recorded_calls(spark.createDataFrame(as_rows(own), MESSAGES), "task_id")
    policies = R.recorded_turns(spark.createDataFrame(as_rows(own, other, broken, many), MESSAGES).withColumn("task", F.lit("k")), "id")
    turns = policies.select(F.lit("k").alias("task"), F.col("task").cast("int").alias("repeat"), "turn", "content", "calls")
    got = {r.repeat: r for r in R.play(turns, recorded).collect()}
    assert (got[0].stop_reason, got[0].replayed, got[0].n_turns, got[0].n_tool_calls, got[0].final_text) == ("answered", 2, 3, 2, "bye")
    assert got[1].diverged and (got[1].n_turns, got[1].n_tool_calls, got[1].divergence.tool, got[1].divergence.score) == (2, 2, "f", 0) and got[1].divergence.args == '{"a":9}'
    assert (got[2].stop_reason, got[2].replayed, got[2].n_tool_calls) == ("answered", 0, 1)
    assert (got[3].stop_reason, got[3].n_turns, got[3].replayed) == ("max_turns", 12, 12)
    short = R.play(turns, recorded, max_turns=1).where("repeat = 0").first()
    assert (short.stop_reason, short.n_turns) == ("max_turns", 1)
    graded = spark.createDataFrame([("bye ", "bye"), (None, ""), ("x", "y")], "a string, b string").select(R.label_grade(F.col("a"), F.col("b")).alias("ok")).collect()
    assert [r.ok for r in graded] == [True, True, False]
    # rounds that ask for each reply give the same as one plan over all turns
    tasks = turns.select("task", "repeat").distinct().withColumn("prompt", F.lit("task"))
    reply = lambda open_, n: turns.where(F.col("turn") == n).join(open_.select("task", "repeat"), ["task", "repeat"])
    rounds = R.play_rounds(tasks, reply, lambda calls: R.serve(calls, recorded))
    key = lambda r: (r.repeat, r.n_turns, r.n_tool_calls, r.stop_reason, r.replayed, r.final_text, r.completion_tokens_est)
    assert sorted(map(key, rounds.collect())) == sorted(map(key, got.values()))


def test_rounds_show_the_policy_what_was_said_and_live_tools_answer(spark):
    """A policy that doubles the last answer until it is large; the tool is a column expression."""
    tasks = spark.createDataFrame([(str(i), 0, str(i)) for i in (1, 3, 50)], "task string, repeat int, prompt string")

    def reply(open_, turn):
        last = F.element_at("said", -1)["content"]
        call = F.array(F.struct(F.lit("c").alias("id"), F.lit("double").alias("tool"), F.format_string('{"x":%s}', last).alias("args")))
        return open_.select("task", "repeat", F.concat(F.lit("at "), last).alias("content"), F.when(last.cast("int") < 20, call).otherwise(F.array().cast(R.CALLS)).alias("calls"))

    live = lambda calls: calls.withColumns({"served": F.lit("live"), "answer": (2 * F.get_json_object("args", "$.x").cast("int")).cast("string"), "h": F.lit(""), "nearest": F.lit(""), "score": F.lit(0.0)})
    got = {r.task: (r.final_text, r.n_turns, r.stop_reason) for r in R.play_rounds(tasks, reply, live).collect()}
    assert got == {"1": ("at 32", 6, "answered"), "3": ("at 24", 4, "answered"), "50": ("at 50", 1, "answered")}


def test_similar_calls_are_served_from_a_threshold_on(spark):
    args = {f"k{i}": i for i in range(30)}
    known = spark.createDataFrame([("t", 2, "f", json.dumps(args), "near"), ("t", 1, "f", '{"z":1}', "far"), ("u", 1, "f", json.dumps(args), "other task"), ("t", 0, "f", '{"z":1}', "first")], "task string, ord int, tool string, args string, result string")
    near = json.dumps(args | {"k0": 99})
    asked = spark.createDataFrame([(0, "t", "f", near), (1, "t", "f", '{ "z":1}'), (2, "t", "g", near), (3, "t", "f", "{no"), (4, "t", "f", '{"q":0}')], "i int, task string, tool string, args string")
    for fuzzy in (True, False):
        got = {r.i: r for r in R.serve(asked, known, fuzzy=fuzzy).collect()}
        assert [got[i].served for i in range(5)] == ["fuzzy" if fuzzy else "diverged", "replayed", "diverged", "malformed", "diverged"]
        assert got[0].answer == ("near" if fuzzy else R.NOT_RECORDED) and got[1].answer == "first" and got[3].answer == R.NOT_JSON
        assert 0.9 < got[0].score < 1 and json.loads(got[0].nearest) == args and got[2].score is None


def test_divergence_at_a_turn_without_content(spark):
    rows = [(1, 0, "user", "u", "x"), (1, 1, "assistant", None, "call a")]
    schema = "k int, turn int, role string, text string, signature string"
    a, b = spark.createDataFrame(rows, schema), spark.createDataFrame([rows[0], (1, 1, "assistant", None, "call b")], schema)
    assert V.first_divergence(a, b, "k").count() == 0
    assert [r.turn for r in V.first_divergence(a, b, "k", also=["signature"]).collect()] == [1]
    assert [r.turn for r in V.first_divergence(a, b.withColumn("text", F.coalesce("text", F.lit("says"))), "k").collect()] == [1]


def test_pair_reasons_and_caps(spark):
    say = lambda c, calls=None, role="assistant": {"role": role, "content": c, "tool_calls": calls}
    user = say("u", role="user")
    f1, f2 = [call("f", '{"a":1,"b":2}')], [call("f", '{"b":2, "a":1}')]
    cases = [
        ([], say("x"), say("y"), "prompt is empty"), ([user, say("z")], say("x"), say("y"), "prompt ends on an assistant turn"), ([user], None, say("y"), "chosen is empty"),
        ([user], say("x"), say("y", role="user"), "rejected is not an assistant turn"), ([user], say(None, [call("f", "{no")]), say("y"), "chosen has malformed arguments"),
        ([user], say("one", f1), say("two", f2), "same tool calls"), ([user], say("Hi, there!"), say("hi there"), "same text apart from formatting"), ([user], say("x", f1), say("x"), None), ([user], say("x"), say("y"), None),
    ]
    item = MESSAGE.removeprefix("array<").removesuffix(">")
    df = spark.createDataFrame([(i, p, g, b) for i, (p, g, b, _) in enumerate(cases)], f"i int, prompt {MESSAGE}, good {item}, bad {item}")
    got = {r.i: r.why for r in df.select("i", P.reject_reason(F.col("prompt"), F.col("good"), F.col("bad")).alias("why")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[3] for c in cases]
    # early invalid pairs don't cost later valid ones
    m = lambda *said: [user, *(say(x) for x in said)]
    rows = [(1, 7, True, m("a")), (2, 7, True, m("b")), (3, 7, False, m("a")), (4, 7, False, m("a", "c")), (5, 7, False, m("x")), (6, 8, True, m("q"))]
    traces = spark.createDataFrame(rows, f"id int, task_id int, success boolean, messages {MESSAGE}")
    made, stats = P.offline_pairs(traces, cap=2)
    assert sorted((r.chosen, r.rejected, r["at"]) for r in made.collect()) == [(1, 5, 2), (2, 3, 2)]
    s = stats.first()
    assert (s.tasks_seen, s.tasks_with_both, s.pairs_built, s.no_divergence, s.divergent_prefix, s.capped) == (2, 1, 2, 1, 1, 1)
    pairs = P.sampled_pairs(traces, traces)
    assert 1 <= pairs.count() <= 3 and P.pair_statistics(pairs)["diff_kind"] == {"text": pairs.count()}
    assert P.offline_pairs(traces.limit(0))[0].count() == 0


def test_pairs_are_written_with_their_reasons(spark, tmp_path):
    user = {"role": "user", "content": "u", "tool_calls": None}
    a = lambda c: {"role": "assistant", "content": c, "tool_calls": None}
    item = MESSAGE.removeprefix("array<").removesuffix(">")
    df = spark.createDataFrame([([user], a("x"), a("y")), ([user], a("x"), a("X!"))], f"prompt {MESSAGE}, good {item}, bad {item}")
    kept, reasons = P.write_pairs(df, str(tmp_path / "pairs"))
    assert kept.count() == 1 and [tuple(r) for r in reasons.collect()] == [("same text apart from formatting", 1)]
    line = df.select(P.rendered(F.col("prompt"), F.col("good"), F.col("bad")).alias("r")).first().r
    assert line.prompt == "<s><|user|>\nu\n" and line.chosen == "<|assistant|>\nx\n"


def test_beta_draws_have_the_right_distribution(spark):
    for alpha, beta in ((1.0, 1.0), (2.0, 5.0), (60.0, 20.0)):
        x = np.array([r[0] for r in spark.range(20000).select(T.beta_draw(F.lit(alpha), F.lit(beta), F.col("id"))).collect()])
        mean, sd = alpha / (alpha + beta), np.sqrt(alpha * beta / ((alpha + beta) ** 2 * (alpha + beta + 1)))
        assert abs(x.mean() - mean) < 0.01 and abs(x.std() - sd) < 0.02
    with pytest.raises(ValueError):
        T.floor_reachable(0.9, 10)
    T.floor_reachable(0.995, 10)
    assert T.verification_points(0.03) == [0.01, 0.03, 0.08] and T.scoring_order(["a", "c"], ["a", "b", "c"]) == ["a", "c"]
    for bad in ([], ["c", "a"], ["z"]):
        with pytest.raises(ValueError):
            T.scoring_order(bad, ["a", "b", "c"])


def test_selectors(spark):
    runs = spark.createDataFrame([("ab1", "s", "2"), ("ab2", "s", "3"), ("b", "t", "1")], "id string, subject string, started_at string")
    assert L.find_run(runs, "b").id == "b" and L.find_run(runs, "ab1").id == "ab1" and L.find_run(runs, "latest:s").id == "ab2"
    with pytest.raises(Ambiguous):
        L.find_run(runs, "ab")
    with pytest.raises(NoMatch):
        L.find_run(runs, "zz")
    table = spark.createDataFrame([("1", "n", 1), ("2", "n", 2)], "id string, name string, version int")
    assert L.find_named(table, "n").id == "2" and L.add_version(table, {"id": "3"}, "n").agg(F.max("version")).first()[0] == 3
    old = spark.createDataFrame([("1", None, None), ("2", "x", "y")], "id string, retired_at string, retired_reason string")
    new, said = L.retire(old, spark.createDataFrame([("1",), ("2",), ("9",)], "id string"), F.lit("now"), "stale")
    assert {r.id: r.result for r in said.collect()} == {"1": "retired", "2": "already retired", "9": "unknown"} and L.unretired(new).count() == 0


def test_compare_refuses_in_order(spark):
    runs = spark.createDataFrame([("a", "e", None), ("b", "e", "live"), ("c", "f", None), ("d", "e", "replay")], "id string, eval_set_id string, mode string")
    rows = spark.createDataFrame([(r, t, True, 5.0, 2, 0) for r in "abd" for t in range(25) for _ in range(3)], "run string, task_id int, success boolean, tokens double, turns int, cluster int")
    with pytest.raises(U.NotPairable):
        U.compare(runs, rows, "a", "zz")
    with pytest.raises(U.NotPairable):
        U.compare(runs, rows, "a", "c")
    assert U.compare(runs, rows, "a", "b")["incompatible"]
    assert "same outcome" in U.compare(runs, rows, "a", "d")["refusal"] and "not compared" in A.comparison_line(U.compare(runs, rows, "a", "d"))
    assert "too few" in U.compare(runs, rows.where("task_id < 5"), "a", "d")["refusal"]


def test_compare_counts_each_runs_own_successes(spark):
    runs = spark.createDataFrame([("a", "e", None), ("b", "e", None)], "id string, eval_set_id string, mode string")
    rows = spark.createDataFrame([(r, t, r == "a" or t >= 7, 5.0, 2, 0) for r in "ab" for t in range(25) for _ in range(3)], "run string, task_id int, success boolean, tokens double, turns int, cluster int")
    got, back = U.compare(runs, rows, "a", "b", iterations=20)["mcnemar"], U.compare(runs, rows, "b", "a", iterations=20)["mcnemar"]
    assert (got["only_a"], got["only_b"], back["only_a"], back["only_b"]) == (7, 0, 0, 7)


def test_samples_and_windows(spark):
    said = [("system", "be kind"), ("user", "hi"), ("assistant", "one two"), ("tool", "r"), ("tool", "q"), ("assistant", "three"), ("user", "x"), ("assistant", "")]
    rows = [("a", i, r, t) for i, (r, t) in enumerate(said)] + [("b", 0, "user", "alone"), ("c", 0, "assistant", None), ("c", 1, "assistant", "y y"), ("d", 0, "system", "s")]
    df = spark.createDataFrame(rows, "trace_id string, turn int, role string, text string")
    whole = {r.trace_id: r for r in M.build_samples(df, M.word_ids, 1000).collect()}
    assert set(whole) == {"a", "c"} and (whole["a"].n_tokens, whole["a"].n_target_tokens, whole["c"].n_target_tokens) == (9 + 2 * 8, 3, 2)
    assert [x for x, y in zip(whole["a"].labels, whole["a"].input_ids, strict=True) if x not in (M.MASKED, y)] == []
    last = {r.trace_id: r.n_target_tokens for r in M.build_samples(df, M.word_ids, 1000, target="last_turn").collect()}
    assert last == {"c": 2}
    cut = M.build_samples(df, M.word_ids, 20, width=2).collect()
    assert sorted((r.trace_id, r.turn_index, r.window_start, r.n_tokens) for r in cut if r.kind == "turn_window") == [("a", 1, 0, 4 + 3 + 4), ("a", 4, 1, 4 + 4 + 3 + 3 + 3), ("a", 6, 4, 4 + 3 + 3 + 2)]
    order = M.in_order(M.tokenized(df, M.word_ids), "trace_id", "turn")
    # a window never begins at a tool's result: it begins further back
    assert [(r.turn_index, r.window_start) for r in M.windows(order, "trace_id", 1).where("trace_id = 'a'").collect()] == [(1, 0), (4, 1), (6, 5)]
    assert M.build_samples(df.limit(0), M.word_ids, 10).count() == 0


def test_argument_spans_and_masks(spark):
    cases = [
        ('f({"a":1})', '{"a":1}', [(2, 9)]), ('f({"a":1})', '{"a": 1}', [(2, 9)]), ('f({"a": 1, "b": "x:y,z"})', '{"a":1,"b":"x:y,z"}', [(2, 24)]),
        ("do x with 12", '{"q": "x", "n": 12}', [(3, 4), (10, 12)]), ("t", "{no", []), ("t", None, []), ("12 x", '{"q": "x", "n": 12}', [(3, 4)]), ("", "", []), ("a a", '{"p":"a","q":"a"}', [(0, 1), (2, 3)]),
    ]
    df = spark.createDataFrame([(i, t, a) for i, (t, a, _) in enumerate(cases)], "i int, t string, a string")
    got = {r.i: [(x.s, x.e) for x in r.spans] for r in df.select("i", M.argument_spans(F.col("t"), F.col("a")).alias("spans")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[2] for c in cases]
    tokens = F.array(*(F.struct(F.lit(s).alias("s"), F.lit(e).alias("e")) for s, e in ((0, 2), (2, 2), (2, 5), (5, 9), (9, 12))))
    spans = F.array(*(F.struct(F.lit(s).alias("s"), F.lit(e).alias("e")) for s, e in ((1, 3), (10, 11))))
    mask = spark.range(1).select(M.argument_mask(tokens, spans).alias("m")).first().m
    assert mask == [True, False, True, False, True]
    why = spark.range(1).select(M.mask_coverage(F.array(F.lit(False)), F.lit(2)).alias("a"), M.mask_coverage(F.array(F.lit(True)), F.lit(0)).alias("b"), M.mask_coverage(F.array(F.lit(True)), F.lit(1)).alias("c")).first()
    assert why.a == "calls without an argument token" and why.b == "argument tokens without a call" and why.c is None


def test_templates_and_identities(spark):
    m = [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "one two"}]
    render = lambda x, t: "".join(json.dumps(y) for y in t) + "".join(f"<|{y['role']}|> {y['content']} <|end|>" for y in x)
    assert M.template_problems(render, m, [{"name": "f"}]) == []
    assert len(M.template_problems(lambda x, t: str(len(x)), m, [{"name": "f"}])) == 3
    row = spark.createDataFrame([("i", None, "g", {"scenario": "s", "instance": "2"}), ("i", None, None, None), ("i", "t", None, {"scenario": "s"})], "id string, task_id string, grader string, metadata map<string,string>")
    assert [tuple(r.x) for r in row.select(M.eval_row_identity(F.struct("*")).alias("x")).collect()] == [("s#2", "g"), ("i", None), ("t", None)]
    called = spark.createDataFrame([([("assistant", None, [("1", "function", ("f", '{"a":1}'))], None)],)], "messages " + MESSAGES.split("messages ")[1])
    assert called.select(F.to_json(M.with_object_arguments(F.col("messages"))).alias("j")).first().j == '[{"role":"assistant","tool_calls":[{"id":"1","type":"function","function":{"name":"f","arguments":{"a":1}}}]}]'


def test_blocks_lines_and_errors(spark, tmp_path):
    blocks = [{"role": "user", "content": [{"type": "tool_result", "tool_use_id": "u", "content": [{"type": "text", "text": "a"}, {"type": "image", "x": 1}]}, {"type": "mystery"}]}]
    plain = J.blocks_to_messages([{"type": "text", "text": "x"}, {"type": "text", "text": "y"}], blocks)
    assert plain == [{"role": "system", "content": "xy"}, {"role": "tool", "tool_call_id": "u", "content": 'a{"type": "image", "x": 1}'}]
    fine = [{"role": "user", "content": "q"}, {"role": "assistant", "content": [{"type": "text", "text": "t"}, {"type": "tool_use", "id": "u", "name": "f", "input": {"a": 1}}]}, {"role": "user", "content": [{"type": "tool_result", "tool_use_id": "u", "content": "r"}]}]
    assert J.round_trip_problem("s", fine) is None
    good = json.dumps({"messages": [{"role": "user", "content": "x"}]})
    (tmp_path / "a.jsonl").write_text("\n".join([good, "", "{bad", good, "[]"]))
    traces, problems = J.load_traces(spark, str(tmp_path / "a.jsonl"), strict=False)
    assert traces.count() == 2 and sorted(r.problem.split(": ")[0] for r in problems.collect()) == ["a.jsonl:3", "a.jsonl:5"]
    texts = [None, "", "Error: x", '{"error":0}', '{"error":"false"}', '{"error":false}', '{"error":{}}', '{"status_code":"500"}', '{"status_code":404}', '["error"]', "not json"]
    got = [r.e for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(is_error_result(F.col("t")).alias("e")).collect()]
    assert got == [False, False, True, False, True, False, True, False, True, False, False]


def test_keep_first_follows_chains(spark):
    nodes = spark.range(60).select("id")
    pairs = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 52), (51, 52), (52, 53)], "a long, b long")
    want = {i: i % 2 == 0 for i in range(41)} | {52: False, 53: True}
    for most in (10**6, 2):
        got = {r.id: r.kept for r in S.keep_first(nodes, pairs, most).collect()}
        assert len(got) == 60 and all(got[i] == want.get(i, True) for i in range(60))
    assert {r.id: r.dropped for r in S.duplicate_groups(nodes, pairs.where("a >= 50")).collect()} == {50: [52]}


def test_hooks_loop_and_small_blocks(spark):
    h = A.Hooks()
    h.set_redactor(lambda s: s.upper(), python=True)
    assert spark.createDataFrame([("ab",), (None,)], "t string").select(h.redactor(F.col("t")).alias("t")).collect()[0].t == "AB"
    assert h.grader("traceloom.operators.replay.label_grade") is R.label_grade
    with pytest.raises(LookupError):
        h.environment("x")
    log = []
    stages = {"collect": lambda: {"fuzzy_share": 0.1}, "select": lambda r: 5, "pair": lambda r: 30, "train": lambda r: r, "evaluate": lambda r: r, "decide": lambda r: "promote" if len(log) < 1 else "discard", "record": log.append}
    assert [r["decision"] for r in A.on_policy(stages, 5)] == ["promote", "discard"] and len(log) == 2
    assert A.on_policy_round(stages | {"pair": lambda r: 3})["reason"] == "too few pairs" and A.on_policy_round(stages | {"collect": lambda: {"fuzzy_share": 0.9}})["reason"] == "fuzzy share"
    with pytest.raises(A.StageEmpty):
        A.stage_guard("s", False, "nothing")
    assert A.stage_guard("s", False, "", "no key", True) == "s: skipped, no key" and A.provenance(["x", "y"])["command"] == "x y"
    assert A.gate_refusal({"verdict": "usable", "feature_order": ["a"]}, ["a", "b"]) is None and A.gate_refusal(None, []) == "no calibration"
    r = A.response_of({"content": None, "tool_calls": [call("f", "{}")]}, {"prompt_tokens": 2, "completion_tokens": 3}, "messages", "i")
    assert r["stop_reason"] == "tool_use" and A.response_of({"content": "x"}, {}, "chat", "i")["choices"][0]["finish_reason"] == "stop"
    assert A.resolve_path("a/b.jsonl", "/x") == "a/b.jsonl" and A.resolve_path("./a", "/x") == "/x/a"
