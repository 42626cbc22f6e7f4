"""Turn-level operators on the long form: keys, labels, teacher-forced comparison, gate features, tool-call parsers.

The long form has one row a message: ``trace, turn, role, content, names, signature``; ``names`` are the called tools in order,
``signature`` the sorted distinct hashes of the calls.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from traceloom.functions.canonical import call_hash
from traceloom.operators.evaluation import turn_labels

CALLED = StructType([StructField("name", StringType()), StructField("arguments", StringType())])


def signature_udf():
    """Arrow UDF: tool calls as JSON text -> sorted distinct call hashes; arguments that aren't JSON hash as marked text."""

    @F.pandas_udf(ArrayType(StringType()))
    def signature(calls: pd.Series) -> pd.Series:
        def one(text):
            out = set()
            for c in json.loads(text) if text else []:
                f = c["function"]
                try:
                    args = json.loads(f.get("arguments"))
                except (TypeError, ValueError):
                    args = {"__unparseable__": f.get("arguments")}
                out.add(call_hash(f["name"], args))
            return sorted(out)

        return calls.map(one)

    return signature


def long_form(traces: DataFrame, id_col: str = "id") -> DataFrame:
    """Messages of nested traces, one row each."""
    m = traces.select(F.col(id_col).alias("trace"), F.posexplode("messages").alias("turn", "m"))
    names = F.transform(F.coalesce("m.tool_calls", F.array().cast(traces.select(F.col("messages")[0]["tool_calls"]).schema[0].dataType)), lambda c: c["function"]["name"])
    return m.select("trace", "turn", "m.role", "m.content", names.alias("names"), signature_udf()(F.to_json("m.tool_calls")).alias("signature"))


def with_prefix_key(turns: DataFrame) -> DataFrame:
    """Adds ``prefix``: a hash of everything before the turn, equal for trajectories that are equal so far. Each message's hash
    is chained to the prefix before it, so a trace's work is linear in its text."""
    row = F.sha2(F.to_json(F.struct("role", F.coalesce("content", F.lit("")).alias("content"), "signature")), 256)
    each = turns.groupBy("trace").agg(F.array_sort(F.collect_list(F.struct("turn", row.alias("h")))).alias("m"))
    chain = F.aggregate("m", F.array(F.sha2(F.lit(""), 256)), lambda acc, m: F.concat(acc, F.array(F.sha2(F.concat(F.element_at(acc, -1), m["h"]), 256))))
    placed = each.select("trace", F.posexplode("m").alias("i", "m"), chain.alias("c")).select("trace", F.col("m.turn").alias("turn"), F.get("c", F.col("i")).alias("prefix"))
    return turns.join(placed, ["trace", "turn"])


def corrected_later(turns: DataFrame) -> DataFrame:
    """``trace, turn, corrected`` of assistant turns: a tool error within twice as many messages as tools called, or a later turn
    that calls one of its tools with another signature. One self-join within a trace."""
    own = turns.where("role = 'assistant'").select("trace", "turn", F.array_distinct("names").alias("names"), "signature")
    later = turns.select("trace", F.col("turn").alias("lt"), F.col("role").alias("lr"), F.col("content").alias("lc"), F.col("names").alias("ln"), F.col("signature").alias("ls"))
    c = F.coalesce("lc", F.lit(""))
    error = (F.col("lr") == "tool") & (F.col("lt") - F.col("turn") <= 2 * F.greatest(F.size("names"), F.lit(1))) & (c.contains('"error"') | c.startswith("error:") | c.startswith("error "))
    retry = (F.col("lr") == "assistant") & F.arrays_overlap("names", "ln") & (F.col("ls") != F.col("signature"))
    both = own.join(later, (own.trace == later.trace) & (F.col("lt") > F.col("turn")), "left").select(own.trace, "turn", F.coalesce(error | retry, F.lit(False)).alias("hit"))
    return both.groupBy("trace", "turn").agg(F.bool_or("hit").alias("corrected"))


def label_turns(rollouts: DataFrame, outcomes: DataFrame, teacher: DataFrame) -> DataFrame:
    """``trace, turn, how, good`` of every assistant turn. ``outcomes``: trace, task, success; ``teacher``: long form keyed by
    task. A later teacher turn of the same prefix replaces an earlier one."""
    t = with_prefix_key(teacher).where("role = 'assistant'").groupBy(F.col("trace").alias("task"), "prefix").agg(F.max_by(F.struct("signature"), "turn").alias("t"))
    r = with_prefix_key(rollouts).where("role = 'assistant'").join(outcomes, "trace")
    r = r.join(t, ["task", "prefix"], "left").join(corrected_later(rollouts), ["trace", "turn"])
    known = F.col("t").isNotNull()
    how = turn_labels(~F.coalesce("success", F.lit(False)), known, F.col("signature") == F.col("t.signature"), F.col("corrected"))
    return r.select("trace", "turn", how.alias("how")).withColumn("good", F.col("how").isin("teacher_match", "uncorrected"))


def teacher_forced(student: DataFrame, teacher: DataFrame) -> DataFrame:
    """Per turn of a task: whether the kind, the tool names and the arguments match, and all three. ``trace`` is the task."""
    s, t = (x.where("role = 'assistant'").select("trace", "turn", F.array_sort(F.array_distinct("names")).alias(f"n{k}"), F.col("signature").alias(f"s{k}")) for x, k in ((student, "s"), (teacher, "t")))
    both = s.join(t, ["trace", "turn"])
    kind, name, args = (F.size("ns") > 0) == (F.size("nt") > 0), F.col("ns") == F.col("nt"), F.col("ss") == F.col("st")
    return both.select("trace", "turn", (F.size("nt") > 0).alias("tool_turn"), kind.alias("kind"), name.alias("name"), args.alias("args"), (kind & name & args).alias("full"))


def teacher_forced_summary(turns: DataFrame) -> DataFrame:
    """Task-level means; names among the teacher's tool turns, arguments among turns whose names match."""
    x = lambda c: F.col(c).cast("double")
    t = turns.groupBy("trace").agg(F.avg(x("full")).alias("full"), F.avg(F.when(F.col("tool_turn"), x("name"))).alias("name"), F.avg(F.when(F.col("tool_turn") & F.col("name"), x("args"))).alias("args"))
    return t.agg(F.avg("full").alias("full"), F.avg("name").alias("name"), F.avg("args").alias("args"), F.count(F.lit(1)).alias("n_tasks"))


def turn_features(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """Gate features from token rows (keys, logprob, is_arg): means, minima and the tenth percentile; NaN where a turn has no
    argument token."""
    lp, arg = F.col("logprob"), F.when(F.col("is_arg"), F.col("logprob"))
    nan = lambda c: F.coalesce(c, F.lit(float("nan")))
    return tokens.groupBy(*keys).agg(
        nan(F.avg(lp)).alias("mean_logprob"), nan(F.min(lp)).alias("min_logprob"), nan(F.percentile(lp, 0.1)).alias("p10_logprob"),
        nan(F.avg(arg)).alias("arg_mean_logprob"), nan(F.min(arg)).alias("arg_min_logprob"), F.count(F.lit(1)).alias("n_tokens"),
    )


def self_consistency(signature, samples) -> Column:
    """Share of samples with the turn's signature; NaN without samples."""
    n = F.size(samples)
    return F.when(n > 0, F.size(F.filter(samples, lambda s: s == signature)) / n).otherwise(float("nan"))


# How two families of models write calls.
FAMILIES = {"hermes": re.compile(r"<tool_call>\s*(\{.*?\})\s*</tool_call>", re.S), "llama3_json": re.compile(r"^\s*(?:<\|python_tag\|>)?\s*(\{.*\})\s*$", re.S)}


def parse_calls(text: str, family: str) -> list[tuple[str, str]]:
    """(name, arguments as JSON) of the calls in a model's output; text that doesn't parse holds none."""
    out = []
    for m in FAMILIES[family].finditer(text or ""):
        try:
            o = json.loads(m[1])
            out.append((o["name"], json.dumps(o.get("arguments", o.get("parameters", {})), sort_keys=True)))
        except (ValueError, KeyError, TypeError):
            continue
    return out


def parse_calls_udf(family: str):
    @F.pandas_udf(ArrayType(CALLED))
    def parsed(text: pd.Series) -> pd.Series:
        return text.map(lambda t: [{"name": n, "arguments": a} for n, a in parse_calls(t, family)])

    return parsed


def json_values(text: str) -> list[tuple[int, int, str]]:
    """(start, end, value) of every JSON object in a text, outermost first, found from the left."""
    decoder, at, out = json.JSONDecoder(), 0, []
    while (at := text.find("{", at)) >= 0:
        try:
            value, end = decoder.raw_decode(text, at)
            out.append((at, end, json.dumps(value, sort_keys=True)))
            at = end
        except ValueError:
            at += 1
    return out


def token_mask(texts, spans) -> Column:
    """For each token text whether it overlaps a span (a, b); places are running sums of lengths."""
    ends = F.aggregate(texts, F.array().cast("array<int>"), lambda acc, t: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + F.length(t))))
    return F.zip_with(texts, ends, lambda t, e: F.exists(spans, lambda s: (e - F.length(t) < s["b"]) & (e > s["a"])))
