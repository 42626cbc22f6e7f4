import json

import pytest

from traceloom.sources import artifact as A
from traceloom.sources import jsonl as J
from traceloom.sources import stores as R


def plain():
    return {"id": "t1", "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u"}, {"role": "assistant", "content": None, "tool_calls": [{"id": "c1", "type": "function", "function": {"name": "f", "arguments": '{"b":1,"a":2}'}}]}, {"role": "tool", "tool_call_id": "c1", "content": "r"}, {"role": "assistant", "content": "done"}], "tools": [], "success": True}


def test_dialects_round_trip():
    m = plain()["messages"]
    system, blocks = J.messages_to_blocks(m)
    back = J.blocks_to_messages(system, blocks)
    key = lambda ms: [(x["role"], x.get("content") or "", [(c["function"]["name"], json.loads(c["function"]["arguments"])) for c in x.get("tool_calls") or []]) for x in ms]
    assert key(back) == key(m)
    assert J.is_block_dialect({"messages": blocks}) and not J.is_block_dialect(plain())
    with pytest.raises(ValueError):
        J.messages_to_blocks([{"role": "robot"}])


def test_load(spark, tmp_path):
    system, blocks = J.messages_to_blocks(plain()["messages"])
    lines = [json.dumps(plain()), "", json.dumps({"system": system, "messages": blocks}), "{bad", "[1]", json.dumps({"id": "x"})]
    (tmp_path / "t.jsonl").write_text("\n".join(lines))
    good, bad = J.load_traces(spark, str(tmp_path), strict=False)
    rows = good.collect()
    assert len(rows) == 2 and bad.count() == 3
    assert rows[0].content_hash == rows[1].content_hash and rows[0].n_turns == 2 and rows[0].n_tool_calls == 1 and rows[0].task_user == "u"
    with pytest.raises(Exception, match="BadRecord|bad"):
        J.load_traces(spark, str(tmp_path))[0].collect()


def test_run_store(spark):
    runs = spark.createDataFrame([("r1", "t"), ("r2", "t")], "id string, task_id string")
    calls = spark.createDataFrame([("c1", "r1", "m", "q1", "a1", 5, 0, 0.0, "2024-01-01"), ("c2", "r1", "m", "q2", "a2", 7, 0, 0.0, "2024-01-02")], "id string, run_id string, model string, request string, response string, prompt_tokens int, completion_tokens int, cost_usd double, started_at string")
    results = spark.createDataFrame([("r1", None)], "run_id string, passed int")
    labels = spark.createDataFrame([("r1", "pass")], "run_id string, value string")
    fine, bad = R.trajectories(runs, calls, results, labels)
    r = fine.first()
    assert (r.request, r.prompt_tokens, r.completion_tokens, r.success) == ("q2", 12, None, None) and bad.count() == 1
    assert R.trajectories(runs, calls, None, labels)[0].first().success is True


def test_request_log(spark):
    rows = [(1, "2024-01-02", "student", False, True, [("assistant", None)]), (2, "2024-01-02", "Teacher", False, True, [("assistant", None)]), (3, "2024-01-02", "student", True, True, []), (4, "2024-01-02", "student", False, None, []), (5, "2024-01-02", "student", False, True, []), (6, "2023-01-01", "student", False, True, [])]
    log = spark.createDataFrame(rows, "id long, received_at string, arm string, escalated boolean, outcome boolean, messages array<struct<role:string,arm:string>>")
    t, bad, n = R.request_traces(log, "2024-01-01")
    assert [r.id for r in t.collect()] == [1] and bad.count() == 1 and tuple(n.first()) == (4, 2)


def test_artifact(spark, tmp_path):
    df = spark.createDataFrame([(f"{i:04x}" * 16, i) for i in range(50)], "sample_hash string, n int")
    p = str(tmp_path / "ds")
    m = A.write_dataset(df, p, "d", 1)
    assert A.write_dataset(df.repartition(7), p, "d", 1) == m and A.verify(spark, p) == (True, "ok")
    with pytest.raises(A.DifferentArtifact):
        A.write_dataset(df.limit(10), p, "d", 1)


def test_empty_systems_broken_arguments_and_odd_results():
    assert J.blocks_to_messages([], [{"role": "user", "content": "x"}]) == J.blocks_to_messages([{"type": "image"}], [{"role": "user", "content": "x"}]) == [{"role": "user", "content": "x"}]
    broken = [{"role": "system", "content": ""}, {"role": "system", "content": None}, {"role": "assistant", "content": None, "tool_calls": [{"id": "i", "type": "function", "function": {"name": "f", "arguments": "{no"}}]}]
    system, blocks = J.messages_to_blocks(broken)
    assert system is None and blocks[0]["content"][0]["input"] == "{no"
    assert J.blocks_to_messages(system, blocks)[0]["tool_calls"][0]["function"]["arguments"] == "{no"
    shown = [(None, ""), ("t", "t"), ([], ""), (["a", {"type": "text"}, {"type": "text", "text": "b"}, {"type": "image", "é": 1}, 7, None], 'ab{"type": "image", "é": 1}7null'), ({"type": "text", "text": "b"}, '{"text": "b", "type": "text"}'), (5, "5")]
    for content, text in shown:
        turn = [{"role": "user", "content": [{"type": "tool_result", "tool_use_id": "u", "content": content}]}]
        assert J.blocks_to_messages(None, turn) == [{"role": "tool", "tool_call_id": "u", "content": text}]
