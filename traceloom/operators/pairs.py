"""Preference pairs from trajectories: where two part, whether the pair can teach anything, offline and sampled sets.

A trajectory is a row ``id, task_id, success, messages``; a message holds role, content and tool calls (name, arguments as JSON).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from traceloom.functions.text import text_signature
from traceloom.operators.evaluation import diff_kind, tried_pairs
from traceloom.operators.similarity import written

# Above this share of pairs that differ in prose only, the set gets a warning.
MOST_TEXT = 0.7


def canonical_calls(message: Column) -> Column:
    """Name and arguments of a message's calls, arguments with sorted keys; text that isn't JSON is marked and kept."""
    args = lambda a: F.coalesce(F.to_json(F.try_parse_json(a)), F.concat(F.lit("<raw>"), F.coalesce(a, F.lit(""))))
    calls = F.transform(message["tool_calls"], lambda c: F.struct(c["function"]["name"].alias("name"), args(c["function"]["arguments"]).alias("arguments")))
    return F.coalesce(calls, F.array().cast("array<struct<name:string,arguments:string>>"))


def turn_key(message: Column) -> Column:
    """Identifies a turn by what it says and does, not by the calls' ids or the order of their keys."""
    return F.sha2(F.to_json(F.struct(F.coalesce(message["content"], F.lit("")).alias("c"), canonical_calls(message).alias("k"))), 256)


def whitespace_normalized(text: Column) -> Column:
    """Runs of blanks as one, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def keyed(traces: DataFrame) -> DataFrame:
    """Adds ``keys``: role and turn key of every message. Written out: a pair reads them many times."""
    return written(traces.select("id", "task_id", "success", "messages", F.transform("messages", lambda m: F.struct(m["role"].alias("role"), turn_key(m).alias("key"))).alias("keys")))


def parted(pairs: DataFrame, traces: DataFrame) -> DataFrame:
    """``pairs`` (chosen, rejected: ids) with ``at``, the first message at which the two differ, and the messages: ``prompt``, ``good``,
    ``bad``. ``at`` is null where they never differ within the shorter one, or first on a message that isn't the assistant's."""
    side = lambda n: traces.select(F.col("id").alias(n), F.col("messages").alias(f"m_{n}"), F.col("keys").alias(f"k_{n}"))
    both = pairs.join(side("chosen"), "chosen").join(side("rejected"), "rejected")
    n = F.least(F.size("k_chosen"), F.size("k_rejected"))
    at = F.array_position(F.zip_with(F.slice("k_chosen", 1, n), F.slice("k_rejected", 1, n), lambda x, y: x != y), True).cast("int")
    role = lambda k: F.get(F.col(k), at - 1)["role"]
    fine = (at > 0) & (role("k_chosen") == "assistant") & (role("k_rejected") == "assistant")
    said = lambda k: F.transform(F.filter(k, lambda m: m["role"] == "assistant"), lambda m: m["key"])
    both = both.withColumns({"at": F.when(fine, at), "same_turns": said("k_chosen") == said("k_rejected")})
    get = lambda m: F.get(F.col(m), F.col("at") - 1)
    return both.select(*pairs.columns, "at", "same_turns", F.slice("m_chosen", 1, F.greatest(F.lit(0), F.coalesce(F.col("at"), F.lit(1)) - 1)).alias("prompt"), get("m_chosen").alias("good"), get("m_rejected").alias("bad"))


def reject_reason(prompt: Column, good: Column, bad: Column) -> Column:
    """Why a pair can't teach anything; null if it can. The first reason that holds."""
    broken = lambda m: F.coalesce(F.exists(m["tool_calls"], lambda c: F.try_parse_json(F.coalesce(c["function"]["arguments"], F.lit(""))).isNull()), F.lit(False))
    reason = F.when(F.size(prompt) < 1, "prompt is empty").when(F.element_at(prompt, -1)["role"] == "assistant", "prompt ends on an assistant turn")
    for name, m in (("chosen", good), ("rejected", bad)):
        reason = reason.when(m.isNull(), f"{name} is empty").when(m["role"] != "assistant", f"{name} is not an assistant turn").when(broken(m), f"{name} has malformed arguments")
    acts = (F.size(canonical_calls(good)) > 0) | (F.size(canonical_calls(bad)) > 0)
    said = lambda m: text_signature(F.coalesce(m["content"], F.lit("")))
    return reason.when(acts & (canonical_calls(good) == canonical_calls(bad)), "same tool calls").when(~acts & (said(good) == said(bad)), "same text apart from formatting")


def kind_of(good: Column, bad: Column) -> Column:
    names = lambda m: F.transform(canonical_calls(m), lambda c: c["name"])
    return diff_kind(F.size(names(good)) > 0, F.size(names(bad)) > 0, names(good), names(bad))


def offline_pairs(traces: DataFrame, cap: int = 4) -> tuple[DataFrame, DataFrame]:
    """(pairs, statistics) of traces with a task and an outcome: per task successes against failures in order, the first ``cap`` that
    part at an assistant turn. Statistics count the pairs tried for it: those that never part, and those that part elsewhere."""
    known = keyed(traces.where("task_id is not null and success is not null"))

    def judge(p):
        why = F.when(F.col("at").isNotNull(), F.lit(None)).when(F.col("same_turns"), "no divergence").otherwise("divergent prefix")
        return parted(p, known).select("task_id", "chosen", "rejected", why.cast("string").alias("why"))

    tried = written(tried_pairs(known, cap, judge))
    made = parted(tried.where("why is null").select("task_id", "chosen", "rejected", "k"), known).drop("same_turns")
    sides = known.groupBy("task_id").agg(F.max(F.col("success").cast("int")).alias("s"), F.min(F.col("success").cast("int")).alias("f"))
    n = lambda c: F.count(F.when(c, 1))
    tasks = sides.agg(F.count(F.lit(1)).alias("tasks_seen"), n((F.col("s") == 1) & (F.col("f") == 0)).alias("tasks_with_both"))
    counts = tried.agg(n(F.col("why").isNull()).alias("pairs_built"), n(F.col("why") == "no divergence").alias("no_divergence"), n(F.col("why") == "divergent prefix").alias("divergent_prefix"))
    capped = tried.groupBy("task_id").agg(F.max("k").alias("k")).agg(n(F.col("k") >= cap).alias("capped"))
    return made, tasks.join(F.broadcast(counts), how="cross").join(F.broadcast(capped), how="cross")  # one row each


def teacher_pairs(rollouts: DataFrame, teachers: DataFrame) -> DataFrame:
    """Each failed rollout against the first successful teacher trace of its task, where they part at an assistant turn."""
    first = teachers.where("task_id is not null and success").groupBy("task_id").agg(F.min_by(F.struct("id", "messages"), "id").alias("t"))
    t = first.select(F.concat(F.lit("t:"), F.col("t.id").cast("string")).alias("id"), "task_id", F.lit(True).alias("success"), "t.messages")
    r = rollouts.where("task_id is not null and not coalesce(success, false)").withColumn("id", F.concat(F.lit("r:"), F.col("id").cast("string"))).select("id", "task_id", F.lit(False).alias("success"), "messages")
    known = keyed(t.unionByName(r))
    p = r.select("task_id", F.col("id").alias("rejected")).join(t.select("task_id", F.col("id").alias("chosen")), "task_id")
    made = parted(p, known).where("at is not null").drop("same_turns")
    return made.withColumns({"chosen": F.substring("chosen", 3, 1 << 20), "rejected": F.substring("rejected", 3, 1 << 20)})


def _drawn(*parts) -> Column:
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 8), 16, 10).cast("long")


def sampled_pairs(rollouts: DataFrame, teachers: DataFrame, cap: int = 3, ratio: float = 1.0, seed: str = "0") -> DataFrame:
    """``task_id, pair_kind, diff_kind, at, prompt, good, bad, chosen, rejected``: at most ``cap`` distinct valid pairs a task.

    A task with both outcomes gets cap * 3 draws (or as many as it has pairs) of a success and a failure, by hash of (seed, task, draw).
    One without success is paired with its teacher's, failures in hash order. Teacher pairs are at most ``ratio`` times the
    rollout pairs, or cap * 5 without any, again in hash order."""
    known = keyed(rollouts.where("task_id is not null"))
    order = Window.partitionBy("task_id", "success").orderBy("id")
    slots = known.select("task_id", "id", F.coalesce("success", F.lit(False)).alias("success"), (F.row_number().over(order) - 1).alias("slot"))
    n = slots.groupBy("task_id").agg(F.count(F.when(F.col("success"), 1)).alias("g"), F.count(F.when(~F.col("success"), 1)).alias("b"))
    draw = n.where("g > 0 and b > 0").select("task_id", "g", "b", F.explode(F.sequence(F.lit(1), F.least(F.lit(cap * 3), F.col("g") * F.col("b")).cast("int"))).alias("draw"))
    task, d = F.col("task_id").cast("string"), F.col("draw").cast("string")
    draw = draw.select("task_id", "draw", (_drawn(F.lit(seed), task, d, F.lit("g")) % F.col("g")).alias("gs"), (_drawn(F.lit(seed), task, d, F.lit("b")) % F.col("b")).alias("bs"))
    good = slots.where("success").select("task_id", F.col("slot").alias("gs"), F.col("id").alias("chosen"))
    bad = slots.where("not success").select("task_id", F.col("slot").alias("bs"), F.col("id").alias("rejected"))
    own = parted(draw.join(good, ["task_id", "gs"]).join(bad, ["task_id", "bs"]).select("task_id", "draw", "chosen", "rejected"), known).withColumn("pair_kind", F.lit("rollout"))
    own = own.withColumns({c: F.col(c).cast("string") for c in ("chosen", "rejected")})
    alone = n.where("g = 0").select("task_id")
    help_ = teacher_pairs(rollouts.join(alone, "task_id", "left_semi").where(F.lit(True)), teachers)
    help_ = help_.withColumns({"draw": _drawn(F.lit(seed), F.col("rejected")), "pair_kind": F.lit("teacher")})
    cols = ["task_id", "draw", "chosen", "rejected", "at", "prompt", "good", "bad", "pair_kind"]
    valid = own.select(*cols).unionByName(help_.select(*cols)).where(F.col("at").isNotNull() & reject_reason(F.col("prompt"), F.col("good"), F.col("bad")).isNull())
    valid = valid.withColumns({"_g": turn_key(F.col("good")), "_b": turn_key(F.col("bad")), "diff_kind": kind_of(F.col("good"), F.col("bad"))})
    first = Window.partitionBy("task_id", "_g", "_b").orderBy("draw", "rejected")
    distinct = valid.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    capped = written(distinct.withColumn("_n", F.row_number().over(Window.partitionBy("task_id").orderBy("draw", "rejected"))).where(F.col("_n") <= cap).drop("_n", "_g", "_b"))
    own, help_ = capped.where("pair_kind = 'rollout'"), capped.where("pair_kind = 'teacher'")
    k = own.count()
    most = int(k * ratio) if k else cap * 5
    if help_.count() > most:
        help_ = help_.orderBy(_drawn(F.lit(seed), F.lit("cut"), F.col("rejected")), "rejected").limit(most)
    return own.unionByName(help_).drop("draw")


def pair_statistics(pairs: DataFrame) -> dict:
    """Counts by kind and difference, pairs per task as a histogram, and a warning where most pairs differ in prose only."""
    kinds = {(r[0], r[1]): r[2] for r in pairs.groupBy("pair_kind", "diff_kind").count().collect()}  # eight rows at most
    per = pairs.groupBy("task_id").agg(F.count(F.lit(1)).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy("c").collect()  # a row for each count up to the cap
    n = sum(kinds.values())
    mix: dict = {}
    for (_, d), c in kinds.items():
        mix[d] = mix.get(d, 0) + c
    text = mix.get("text", 0) / n if n else 0.0
    warnings = [f"{text:.0%} of pairs differ only in prose (above {MOST_TEXT:.0%})"] if text > MOST_TEXT else []
    return {
        "n_pairs": n, "n_rollout": sum(c for (k, _), c in kinds.items() if k == "rollout"), "n_teacher": sum(c for (k, _), c in kinds.items() if k == "teacher"),
        "tasks_with_pairs": sum(r.n for r in per), "max_per_task": max((r.c for r in per), default=0), "diff_kind": mix, "per_task_histogram": {r.c: r.n for r in per}, "warnings": warnings,
    }


def write_pairs(pairs: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(written pairs, rejected counts by reason): valid pairs as Parquet at ``path`` with the sha256 of prompt and both sides."""
    why = reject_reason(F.col("prompt"), F.col("good"), F.col("bad"))
    judged = pairs.withColumn("why", why)
    h = F.sha2(F.to_json(F.struct("prompt", "good", "bad")), 256)
    judged.where("why is null").drop("why").withColumn("pair_hash", h).write.mode("errorifexists").parquet(path)
    return pairs.sparkSession.read.parquet(path), judged.where("why is not null").groupBy("why").agg(F.count(F.lit(1)).alias("n"))


def rendered(prompt: Column, good: Column, bad: Column, bos: str = "<s>") -> Column:
    """Prompt, chosen and rejected as plain text: a line a message; a beginning mark that the text already has isn't doubled."""
    line = lambda m: F.concat(F.lit("<|"), m["role"], F.lit("|>\n"), F.coalesce(m["content"], F.lit("")), F.when(F.size(canonical_calls(m)) > 0, F.concat(F.lit("\n"), F.to_json(canonical_calls(m)))).otherwise(""), F.lit("\n"))
    text = F.array_join(F.transform(prompt, line), "")
    start = F.when(text.startswith(bos), text).otherwise(F.concat(F.lit(bos), text))
    return F.struct(start.alias("prompt"), line(good).alias("chosen"), line(bad).alias("rejected"))
