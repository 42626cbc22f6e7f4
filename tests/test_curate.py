import json

import pytest

from traceloom.operators.curate import Config, curate
from traceloom.sources.jsonl import load_traces

TOOLS = [{"type": "function", "function": {"name": "find", "parameters": {"type": "object", "required": ["q"], "properties": {"q": {"type": "string"}}}}}]


def trace(i, words, success=True, args='{"q":"a"}', name="find", result="fine", repeat=1, task=None, **more):
    m = [{"role": "user", "content": task or f"please do task number {i} for me"}]
    for k in range(repeat):
        m += [{"role": "assistant", "content": None, "tool_calls": [{"id": f"c{k}", "type": "function", "function": {"name": name, "arguments": args}}]}, {"role": "tool", "tool_call_id": f"c{k}", "content": result}]
    m.append({"role": "assistant", "content": words})
    return {"id": f"t{i:02d}", "created_at": f"2024-01-{i + 1:02d}", "messages": m, "tools": TOOLS, "success": success, **more}


def test_every_stage(spark, tmp_path):
    text = " ".join(f"w{k}" for k in range(90))
    rows = [
        trace(0, text), trace(1, "other words entirely", success=False), trace(2, "third answer here", success=None), trace(3, "bad args", args="{"), trace(4, "unknown tool", name="nope"),
        trace(5, "missing q", args="{}"), trace(6, "loops", repeat=2), trace(8, text, task="please do task number 0 for me"), trace(9, text.replace("w7 ", "x7 ")),
        trace(10, "contaminated one", task="a b c d e f g h i j"), trace(11, "has mail", args='{"q":"me@example.com"}'), trace(12, "mail me@example.com please"), trace(13, "cap me now"),
        {"id": "t14", "created_at": "2024-01-15", "messages": [{"role": "user", "content": "x"}, {"role": "assistant", "content": "only"}], "tools": [], "success": True},
    ]
    (tmp_path / "t.jsonl").write_text("\n".join(map(json.dumps, rows)))
    traces, problems = load_traces(spark, str(tmp_path))
    assert problems.count() == 0
    tasks = spark.createDataFrame([(7, "A b c d e f g h i j!"), (8, "")], "task long, text string")
    clusters = spark.createDataFrame([("t12", 1), ("t13", 1)], "id string, cluster int")
    got = {r.id: r for r in curate(traces, Config(cap=1), tasks, None, clusters).collect()}
    stage = {k: r.drop_stage for k, r in got.items()}
    assert stage == {"t00": None, "t01": "outcome", "t02": "outcome", "t03": "schema_valid", "t04": "schema_valid", "t05": "schema_valid", "t06": "no_error_loops", "t08": "exact_dedupe", "t09": "near_dedupe", "t10": "decontaminate", "t11": "pii", "t12": None, "t13": "stratify", "t14": "length"}
    assert got["t08"].drop_reason == "copy of t00" and got["t12"].messages[-1].content == "mail <EMAIL> please"


def test_config():
    assert Config(stages=["length", "outcome"]).stages == ["outcome", "length"]
    for bad in (dict(stages=["x"]), dict(stages=["length", "length"]), dict(stages=["teacher"]), dict(least_turns=9, most_turns=2)):
        with pytest.raises(ValueError):
            Config(**bad)
