import math

from pyspark.sql import functions as F

from traceloom.operators import turns as T
from traceloom.sources.jsonl import MESSAGE


def call(name, args, id_="c"):
    return {"id": id_, "type": "function", "function": {"name": name, "arguments": args}}


def say(role, content=None, calls=None):
    return {"role": role, "content": content, "name": None, "tool_call_id": None, "tool_calls": calls}


def frame(spark, traces):
    from pyspark.sql.types import ArrayType, StringType, StructField, StructType

    return spark.createDataFrame([(k, m) for k, m in traces.items()], StructType([StructField("id", StringType()), StructField("messages", ArrayType(MESSAGE))]))


def test_labels(spark):
    teacher = {"task": [say("user", "u"), say("assistant", None, [call("f", '{"a":1}')]), say("tool", "ok"), say("assistant", "done")]}
    rollouts = {
        "same": [say("user", "u"), say("assistant", None, [call("f", '{ "a": 1 }', "z")]), say("tool", "ok"), say("assistant", "done")],
        "other": [say("user", "u"), say("assistant", None, [call("f", '{"a":2}')]), say("tool", "no"), say("assistant", None, [call("f", '{"a":3}')]), say("tool", "error: x"), say("assistant", "end")],
        "failed": [say("user", "u"), say("assistant", "bye")],
    }
    outcomes = spark.createDataFrame([("same", "task", True), ("other", "task", True), ("failed", "task", False)], "trace string, task string, success boolean")
    long = T.long_form(frame(spark, rollouts))
    got = {(r.trace, r.turn): r.how for r in T.label_turns(long, outcomes, T.long_form(frame(spark, teacher))).collect()}
    assert got == {("same", 1): "teacher_match", ("same", 3): "teacher_match", ("other", 1): "teacher_mismatch", ("other", 3): "corrected_later", ("other", 5): "uncorrected", ("failed", 1): "task_failed"}


def test_teacher_forced(spark):
    a = T.long_form(frame(spark, {"t": [say("user", "u"), say("assistant", None, [call("f", "{}")]), say("assistant", "x")]}))
    b = T.long_form(frame(spark, {"t": [say("user", "u"), say("assistant", None, [call("f", '{"k":1}')]), say("assistant", "y")]}))
    r = T.teacher_forced_summary(T.teacher_forced(a, b)).first()
    assert (r.full, r.name, r.args, r.n_tasks) == (0.5, 1.0, 0.0, 1)


def test_parsers_and_masks(spark):
    text = 'x <tool_call>{"name": "f", "arguments": {"b": 1}}</tool_call> <tool_call>{bad</tool_call>'
    assert T.parse_calls(text, "hermes") == [("f", '{"b": 1}')] and T.parse_calls('{"name":"g","parameters":{}}', "llama3_json") == [("g", "{}")]
    assert [v for _, _, v in T.json_values('a {"x": {"y": 1}} b {no} {"z": 2}')] == ['{"x": {"y": 1}}', '{"z": 2}']
    df = spark.sql("select array('ab', '', 'cde', 'f') as t, array(named_struct('a', 3, 'b', 5)) as s, array('x') as sig")
    assert df.select(T.token_mask(F.col("t"), F.col("s"))).first()[0] == [False, False, True, False]
    assert math.isnan(df.select(T.self_consistency(F.col("sig"), F.array().cast("array<array<string>>"))).first()[0])
    tokens = spark.createDataFrame([(1, -1.0, False), (1, -3.0, False), (2, -2.0, True)], "k int, logprob double, is_arg boolean")
    f = {r.k: r for r in T.turn_features(tokens, ["k"]).collect()}
    assert math.isnan(f[1].arg_mean_logprob) and f[2].arg_min_logprob == -2.0 and abs(f[1].p10_logprob + 2.8) < 1e-9
