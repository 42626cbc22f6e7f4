"""Putting results together: arm costs, cost and quantisation blocks, result lines, provenance, hooks, the on-policy loop."""

from __future__ import annotations

import hashlib
import importlib
import json
import os
import subprocess
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceloom.functions.canonical import ArgumentRules
from traceloom.functions.text import redact
from traceloom.operators import cost as C

# An estimate's cap, and the share that warns of replayed calls.
CAP, MOST_FUZZY = 2.0, 0.25


def arm_costs(means: DataFrame, prices: dict, gpu_hour: float, tokens_per_second: float = 800.0, utilization: float = 0.6) -> DataFrame:
    """Dollars a request for the student and the teacher, from one row of observed means; zero for both where a price or a mean is
    missing, so that the router doesn't trade success for a saving that nobody has measured."""
    known = prices.get("input") is not None and prices.get("output") is not None
    rate = C.student_per_mtok(F.lit(gpu_hour), F.lit(tokens_per_second), utilization)
    student = F.col("student_tokens") * rate / 1e6
    read = None if prices.get("cache_read") is None else F.lit(prices["cache_read"])
    teacher = C.teacher_per_task(F.col("teacher_prompt_tokens"), F.col("teacher_completion_tokens"), F.lit(prices.get("input") or 0.0), F.lit(prices.get("output") or 0.0), F.col("cache_hit_frac"), read)
    fine = F.lit(known) & student.isNotNull() & teacher.isNotNull()
    return means.select(F.when(fine, student).otherwise(0.0).alias("student"), F.when(fine, teacher).otherwise(0.0).alias("teacher"))


def cost_block(runs: DataFrame) -> DataFrame:
    """Per run the cascade's dollars a task, the teacher's, the saving and the break-even. Saving and break-even are null unless the
    throughput was measured in batches: one request at a time overstates the cost."""
    per = C.student_per_mtok(F.col("gpu_hour"), F.col("tokens_per_second"))
    cascade = C.cascade_per_task(F.col("student_tokens"), per, F.col("escalation_rate"), F.col("teacher_cost"), F.coalesce("wasted", F.lit(0.0)))
    batched = F.col("mode") == "batched"
    return runs.withColumn("cascade_cost", cascade).withColumns({
        "saving": F.when(batched, C.saving(F.col("teacher_cost"), F.col("cascade_cost"))),
        "breakeven_per_day": F.when(batched, C.breakeven_per_day(F.col("gpu_hour"), F.col("teacher_cost"), F.col("escalation_rate") * F.col("teacher_cost"))),
    })


def chosen_point(points: DataFrame, tau: float) -> DataFrame:
    """The verified point at the chosen threshold, or the middle one."""
    n = points.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.abs(F.col("tau") - tau) <= 1e-6, 1)).alias("hit"))
    ranked = points.withColumn("k", F.expr("row_number() over (order by tau) - 1")).join(F.broadcast(n), how="cross")  # three points, one row
    at = (F.col("hit") > 0) & (F.abs(F.col("tau") - tau) <= 1e-6)
    return ranked.where(at | ((F.col("hit") == 0) & (F.col("k") == F.floor(F.col("n") / 2)))).drop("k", "n", "hit").limit(1)


def spend(tasks: DataFrame, stages: DataFrame, prices: DataFrame) -> DataFrame:
    """``stage, usd, cap``: tasks (mean prompt and completion tokens) times each stage's repeats and passes at the newest price of its
    model; a stage without a price raises when read. The cap is twice the whole."""
    newest = prices.groupBy("model").agg(F.max_by(F.struct("input", "output"), "effective_from").alias("p"))
    use = tasks.agg(F.count(F.lit(1)).alias("n"), F.avg("prompt_tokens").alias("pt"), F.avg("completion_tokens").alias("ct"))
    x = stages.join(newest, "model", "left").join(F.broadcast(use), how="cross")  # one row
    usd = F.col("n") * F.col("repeats") * F.col("passes") * (F.col("pt") * F.col("p.input") + F.col("ct") * F.col("p.output")) / 1e6
    checked = F.when(F.col("p").isNull(), F.raise_error(F.concat(F.lit("no price of "), F.col("model"))).cast("double")).otherwise(usd)
    priced = x.select("stage", checked.alias("usd"))
    return priced.join(F.broadcast(priced.agg((F.sum("usd") * CAP).alias("cap"))), how="cross")  # one row


def upsert_prices(prices: DataFrame, new: DataFrame) -> DataFrame:
    """Prices with new ones of the same (provider, model, effective_from) in their place."""
    keys = ["provider", "model", "effective_from"]
    return prices.join(new.select(*keys), keys, "left_anti").unionByName(new)


def price_in_force(prices: DataFrame) -> DataFrame:
    """The newest price of each provider and model."""
    return prices.groupBy("provider", "model").agg(F.max_by(F.struct(*[c for c in prices.columns if c not in ("provider", "model")]), "effective_from").alias("p")).select("provider", "model", "p.*")


def comparison_line(got: dict) -> str:
    """One line for a comparison; a refusal stands alone, without a difference or a p-value."""
    pct = lambda x: "n/a" if x is None else f"{100 * x:.1f} %"
    if got.get("refusal"):
        return f"{got['run_a']} vs {got['run_b']}: not compared, {got['refusal']} (observed {pct(got['observed']['rate_a'])} and {pct(got['observed']['rate_b'])})"
    s = got["success"]
    return f"{got['run_a']} vs {got['run_b']}: {100 * s['delta']:+.1f} pp [{100 * s['low']:+.1f}, {100 * s['high']:+.1f}], {got['n_shared_tasks']} tasks, p = {got['holm']['success']['p_adjusted']:.3g}"


def judge_line(agreement: float | None, fpr: float | None, fnr: float | None, n: int, observed: float, corrected: float | None) -> str:
    """A judged rate never without how far the judge can be trusted."""
    if corrected is None:
        return f"judged {100 * observed:.1f} % (uncorrected: the judge isn't calibrated, n = {n})"
    return f"judged {100 * observed:.1f} %, corrected {100 * corrected:.1f} % (agreement {100 * agreement:.1f} %, FPR {100 * fpr:.1f} %, FNR {100 * fnr:.1f} %, n = {n})"


def judge_prompt(task: str, calls: list[tuple[str, str]], answer: str, most: int = 20) -> str:
    """What a judge is asked: the task, at most ``most`` calls, the answer."""
    lines = [f"- {t}({a})" for t, a in calls[:most]] + ([f"- and {len(calls) - most} more"] if len(calls) > most else [])
    return "\n".join([f"Task: {task}", "Calls:", *(lines or ["- none"]), f"Answer: {answer}", "Did the answer solve the task? Say yes or no."])


def teacher_forced_line(full: float, name: float | None, args: float | None, n: int) -> str:
    part = lambda x: "n/a" if x is None else f"{100 * x:.1f} %"
    return f"teacher-forced: full {part(full)}, names {part(name)}, arguments {part(args)} over {n} tasks"


def first_turns(turns: DataFrame, per_trace: int = 2, most: int = 50) -> DataFrame:
    """Turns for a metric during training: the first two of each trace, at most fifty in order of trace."""
    from pyspark.sql.window import Window

    k = F.row_number().over(Window.partitionBy("trace").orderBy("turn"))
    return turns.where("role = 'assistant'").withColumn("_k", k).where(F.col("_k") <= per_trace).drop("_k").orderBy("trace", "turn").limit(most)


def provenance(command: list[str], config_path: str | None = None, folder: str = ".") -> dict:
    """Command, commit, whether the tree is dirty, and the configuration's path and hash; what can't be told is None."""
    def git(*args):
        try:
            return subprocess.run(["git", "-C", folder, *args], capture_output=True, text=True, check=True, timeout=20).stdout.strip()
        except (OSError, subprocess.SubprocessError):
            return None

    dirty = git("status", "--porcelain")
    text = open(config_path, "rb").read() if config_path and os.path.exists(config_path) else None
    return {"command": " ".join(command), "commit": git("rev-parse", "HEAD"), "dirty": None if dirty is None else bool(dirty), "config": config_path, "config_hash": hashlib.sha256(text).hexdigest()[:12] if text is not None else None}


class StageEmpty(RuntimeError):
    """A stage ended without a row."""


def stage_guard(name: str, wrote: bool, detail: str, skipped: str | None = None, allow_skip: bool = False) -> str:
    """What to log for a stage that wrote a row or was skipped as declared; StageEmpty for one that wrote nothing."""
    if wrote:
        return f"{name}: {detail}"
    if skipped and allow_skip:
        return f"{name}: skipped, {skipped}"
    raise StageEmpty(f"{name} wrote no row: {detail}")


@dataclass
class Hooks:
    """What a project brings along: argument rules by tool, a redactor, graders and environments by name."""

    rules: dict[str, ArgumentRules] = field(default_factory=dict)
    redactor: Callable[[Column], Column] = redact
    graders: dict[str, Callable] = field(default_factory=dict)
    environments: dict[str, Callable] = field(default_factory=dict)

    def register_rules(self, tool: str, rules: ArgumentRules) -> None:
        self.rules[tool] = rules

    def set_redactor(self, redactor: Callable[[Column], Column] | Callable[[str], str], python: bool = False) -> None:
        """A function of columns, or with ``python`` one of strings, which becomes an Arrow UDF."""
        if not python:
            self.redactor = redactor
            return

        @F.pandas_udf("string")
        def one(text):
            return text.map(lambda t: None if t is None else redactor(t))

        self.redactor = one

    def grader(self, name: str) -> Callable:
        """A registered grader, or the function of a dotted path."""
        if name in self.graders:
            return self.graders[name]
        module, _, attr = name.rpartition(".")
        if not module:
            raise LookupError(f"no grader {name}")
        return getattr(importlib.import_module(module), attr)

    def environment(self, name: str) -> Callable:
        if name not in self.environments:
            raise LookupError(f"no environment {name}; there are {sorted(self.environments)}")
        return self.environments[name]


def read_source(spark, config: dict):
    """Traces of a source named by its ``type``: jsonl, store or log. An unknown type raises."""
    from traceloom.sources import jsonl, stores

    kinds = {
        "jsonl": lambda c: jsonl.load_traces(spark, c["path"], c.get("strict", True)),
        "store": lambda c: stores.trajectories(*(stores.read_store(spark, c["url"], t) for t in ("runs", "llm_calls", "eval_results"))),
        "log": lambda c: stores.request_traces(stores.read_store(spark, c["url"], c.get("table", "request_log")), c.get("since", "")),
    }
    if config.get("type") not in kinds:
        raise ValueError(f"unknown source type {config.get('type')!r}; there are {sorted(kinds)}")
    return kinds[config["type"]](config)


def resolve_path(path: str, base: str) -> str:
    """A path from a configuration, relative to its folder; names of models (owner/name without a dot or leading slash) stay."""
    if os.path.isabs(path) or (path.count("/") == 1 and not path.startswith(".") and not os.path.exists(os.path.join(base, path))):
        return path
    return os.path.normpath(os.path.join(base, path))


def gate_refusal(report: dict | None, configured: list[str]) -> str | None:
    """Why a serving process mustn't use a gate; None if it may."""
    if report is None:
        return "no calibration"
    if report.get("verdict") != "usable":
        return f"verdict {report.get('verdict')}"
    stored = report.get("feature_order") or []
    return None if stored and [f for f in configured if f in stored] == stored else "features don't fit"


def response_of(message: dict, usage: dict, dialect: str, id_: str) -> dict:
    """An assistant message as a response in either dialect, with its reason to finish and its usage."""
    calls = message.get("tool_calls") or []
    p, c = usage.get("prompt_tokens", 0), usage.get("completion_tokens", 0)
    if dialect == "messages":
        blocks = [{"type": "text", "text": message["content"]}] if message.get("content") else []
        blocks += [{"type": "tool_use", "id": x["id"], "name": x["function"]["name"], "input": json.loads(x["function"]["arguments"])} for x in calls]
        return {"id": id_, "type": "message", "role": "assistant", "content": blocks, "stop_reason": "tool_use" if calls else "end_turn", "usage": {"input_tokens": p, "output_tokens": c}}
    choice = {"index": 0, "message": {"role": "assistant", "content": message.get("content"), **({"tool_calls": calls} if calls else {})}, "finish_reason": "tool_calls" if calls else "stop"}
    return {"id": id_, "object": "chat.completion", "choices": [choice], "usage": {"prompt_tokens": p, "completion_tokens": c, "total_tokens": p + c}}


def on_policy_round(stages: dict[str, Callable], least_pairs: int = 20, most_fuzzy: float = MOST_FUZZY) -> dict:
    """One round over callables collect, select, pair, train, evaluate, decide, record: rollouts too often served by similarity or too
    few pairs end it. It is always recorded."""
    out: dict = {"decision": "discard"}
    try:
        rolls = stages["collect"]()
        out["fuzzy_share"] = rolls["fuzzy_share"]
        if rolls["fuzzy_share"] > most_fuzzy:
            out["reason"] = "fuzzy share"
            return out
        out["n_selected"] = stages["select"](rolls)
        out["n_pairs"] = stages["pair"](rolls)
        if out["n_pairs"] < least_pairs:
            out["reason"] = "too few pairs"
            return out
        out["decision"] = stages["decide"](stages["evaluate"](stages["train"](rolls)))
        return out
    finally:
        stages["record"](out)


def on_policy(stages: dict[str, Callable], rounds: int, **limits) -> list[dict]:
    """Rounds until the first that isn't promoted."""
    done = []
    for _ in range(rounds):
        done.append(on_policy_round(stages, **limits))
        if done[-1]["decision"] != "promote":
            break
    return done


def attach_features(turns: DataFrame, tokens: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Labelled turns with the features of their tokens; turns without log probabilities are left out, and a feature that is missing
    by name raises."""
    from traceloom.operators.turns import turn_features

    made = turn_features(tokens, keys)
    missing = [n for n in names if n not in made.columns and n not in turns.columns]
    if missing:
        raise ValueError(f"no such features: {missing}")
    return turns.join(made, keys)


def eval_rows(rows: DataFrame, run: str) -> DataFrame:
    """A run's rows in order, flags as booleans."""
    return rows.where(F.col("run") == run).withColumns({c: F.col(c).cast("boolean") for c in ("success", "diverged") if c in rows.columns}).orderBy("task_id", "repeat_idx")


def retrain_facts(requests: DataFrame, samples: DataFrame, runs: DataFrame, since) -> DataFrame:
    """What a retraining starts from, in one row: graded requests since a time, samples, and the newest run with its success; zeros and
    nulls where there is nothing."""
    graded = requests.where((F.col("received_at") >= since) & F.col("outcome").isNotNull()).agg(F.count(F.lit(1)).alias("graded"))
    last = runs.agg(F.max_by(F.struct("id", "success"), F.struct("started_at", "id")).alias("r")).select(F.col("r.id").alias("run_id"), F.col("r.success").alias("success"))
    return graded.join(samples.agg(F.count(F.lit(1)).alias("samples")), how="cross").join(last, how="cross")  # one row each


def excluded_note(counts) -> str | None:
    """A sentence on requests left out because the teacher wrote them; None for none."""
    return f"{counts['teacher_written']} of {counts['n']} requests were written by the teacher and left out" if counts["teacher_written"] else None


def sample_kinds(samples: DataFrame) -> DataFrame:
    """Samples, tokens and target tokens by kind."""
    return samples.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("tokens"), F.sum("n_target_tokens").alias("target_tokens"))
