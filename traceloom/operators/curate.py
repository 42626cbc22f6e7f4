"""The curation chain over traces: every row keeps its place, with the stage and reason that dropped it."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from traceloom.functions.canonical import canonical_arguments
from traceloom.functions.json_schema import call_problem
from traceloom.functions.text import is_error_result, redact
from traceloom.operators import curation as C
from traceloom.operators.similarity import decontaminate, near_dedupe, written

FACTS = StructType([StructField("problem", StringType()), StructField("repeats", IntegerType()), StructField("said", StringType()), StructField("sequence", StringType())])


@dataclass
class Config:
    """Stages and their parameters; the order of stages is fixed whatever order they are named in."""

    stages: list[str] = field(default_factory=lambda: [s for s in C.STAGES if s not in ("teacher", "quality_judge")])
    least_turns: int = 2
    most_turns: int = 40
    most_errors: int = 3
    most_repeats: int = 2
    teachers: list[str] = field(default_factory=list)
    least_score: float = 3.0
    near: float = 0.85
    grams: int = 8
    overlap: float = 0.5
    cap: int = 500

    def __post_init__(self):
        wrong = set(self.stages) - set(C.STAGES)
        if wrong or len(set(self.stages)) < len(self.stages):
            raise ValueError(f"unknown or repeated stages: {sorted(wrong) or self.stages}")
        if "teacher" in self.stages and not self.teachers:
            raise ValueError("the teacher stage needs models")
        if self.least_turns > self.most_turns:
            raise ValueError("least_turns is above most_turns")
        self.stages = [s for s in C.STAGES if s in self.stages]


def facts_of(messages: list[dict], tools: list[dict]) -> tuple:
    """First problem of the calls (validity, then pairing), most repeats of one call, assistant text, tool sequence."""
    parameters = {t["name"]: t.get("parameters") or "{}" for t in tools}
    problem, open_, counts, said, names = None, {}, {}, [], []
    for i, m in enumerate(messages):
        if m["role"] == "assistant":
            if m.get("content"):
                said.append(m["content"])
            for c in m.get("tool_calls") or []:
                name, args = c["function"]["name"], c["function"].get("arguments")
                why = call_problem(args, parameters.get(name))
                problem = problem or (f"turn {i}: {name}: {why}" if why else None)
                open_[c.get("id")] = i
                call = (name, canonical_arguments(args))
                counts[call] = counts.get(call, 0) + 1
                said.append(f"{name} {call[1]}")
                names.append(name)
        elif m["role"] == "tool" and open_.pop(m.get("tool_call_id"), None) is None:
            problem = problem or f"turn {i}: result without call"
    if open_:
        problem = problem or f"turn {min(open_.values())}: call without result"
    return problem, max(counts.values(), default=0), "\n".join(said), ">".join(names)


def facts_udf():
    @F.pandas_udf(FACTS)
    def facts(messages: pd.Series, tools: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([facts_of(json.loads(m or "[]"), json.loads(t or "[]")) for m, t in zip(messages, tools, strict=True)], columns=[f.name for f in FACTS])

    return facts


def error_run(messages) -> object:
    """Longest run of error results among the tool messages; other roles don't end a run."""
    results = F.filter(messages, lambda m: m["role"] == "tool")
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc, m):
        now = F.when(is_error_result(m["content"]), acc["now"] + 1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    return F.coalesce(F.aggregate(results, zero, step, lambda a: a["most"]), F.lit(0))


def redacted(messages) -> object:
    """Messages with redacted contents and arguments."""
    call = lambda c: F.struct(c["id"].alias("id"), c["type"].alias("type"), F.struct(c["function"]["name"].alias("name"), redact(c["function"]["arguments"]).alias("arguments")).alias("function"))
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), redact(m["content"]).alias("content"), m["name"].alias("name"), m["tool_call_id"].alias("tool_call_id"), F.transform(m["tool_calls"], call).alias("tool_calls")))


def curate(traces: DataFrame, config: Config = Config(), eval_tasks: DataFrame | None = None, scores: DataFrame | None = None, clusters: DataFrame | None = None) -> DataFrame:
    """``traces`` with ``drop_stage`` and ``drop_reason`` (null: kept), contents redacted if the pii stage runs. ``eval_tasks``:
    task, text; ``scores``: id, judge_score; ``clusters``: id, cluster. A stage without its input drops nothing. Each stage sees
    what the ones before it kept; the order of rows is (created_at, id)."""
    on = lambda s: s in config.stages
    t = traces.withColumn("facts", facts_udf()(F.to_json("messages"), F.to_json("tools")))
    if scores is not None:
        t = t.join(scores, "id", "left")
    why = {
        "outcome": C.outcome_reason(F.col("success")),
        "schema_valid": F.col("facts.problem"),
        "no_error_loops": F.when(error_run(F.col("messages")) >= config.most_errors, "error loop").when(F.col("facts.repeats") >= config.most_repeats, "repeated call"),
        "length": C.length_reason(F.col("n_turns"), config.least_turns, config.most_turns),
        "teacher": C.teacher_reason(F.col("teacher_model"), config.teachers),
        "quality_judge": C.quality_reason(F.col("judge_score"), config.least_score) if scores is not None else F.lit(None).cast("string"),
    }
    state = written(C.run_stages(t, [(s, why[s]) for s in config.stages if s in why]).withColumn("key", F.struct(F.coalesce("created_at", F.lit("")).alias("at"), F.col("id"))))

    def drop(state: DataFrame, stage: str, gone: DataFrame) -> DataFrame:
        """``gone``: key, why."""
        hit = state.join(gone.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"), "left").drop("_key")
        return written(hit.withColumns({"drop_stage": F.when(F.col("why").isNotNull(), stage).otherwise(F.col("drop_stage")), "drop_reason": F.coalesce("why", "drop_reason")}).drop("why"))

    left = lambda s: s.where("drop_stage is null")
    if on("exact_dedupe"):
        d = C.exact_dedupe(left(state).select("key", "content_hash"), "content_hash", "key", "key")
        state = drop(state, "exact_dedupe", d.where("survivor <> key").select("key", F.concat(F.lit("copy of "), F.col("survivor.id")).alias("why")))
    if on("near_dedupe"):
        kept = near_dedupe(left(state).select("key", F.col("facts.said").alias("said")), "key", "said", config.near)
        state = drop(state, "near_dedupe", kept.where("not kept").select(F.col("id").alias("key"), F.lit(f"near-duplicate at Jaccard >= {config.near}").alias("why")))
    if on("decontaminate") and eval_tasks is not None:
        hits = decontaminate(left(state), eval_tasks, "key", "task_user", "task", "text", config.grams, config.overlap)
        state = drop(state, "decontaminate", hits.select(F.col("id").alias("key"), F.concat(F.lit("overlaps eval task "), F.col("task").cast("string")).alias("why")))
    if on("pii"):
        state = state.withColumn("_m", redacted(F.col("messages")))
        args = lambda c: F.transform(F.col(c), lambda m: F.transform(m["tool_calls"], lambda k: k["function"]["arguments"]))
        changed = F.col("drop_stage").isNull() & ~args("_m").eqNullSafe(args("messages"))
        state = state.withColumns({"drop_stage": F.when(changed, "pii").otherwise(F.col("drop_stage")), "drop_reason": F.when(changed, "redaction changed an argument").otherwise(F.col("drop_reason"))})
        state = written(state.drop("messages").withColumnRenamed("_m", "messages"))
    if on("stratify") and clusters is not None:
        grouped = left(state).select("key", "id").join(clusters, "id", "left")
        over = grouped.join(C.keep_per_group(grouped, "cluster", ["key"], config.cap).select("key"), "key", "left_anti")
        state = drop(state, "stratify", over.select("key", F.concat(F.lit("over the cap of cluster "), F.coalesce("cluster", F.lit(-1)).cast("string")).alias("why")))
    return state.select(*traces.columns, "drop_stage", "drop_reason")
