"""Selecting registry rows: the newest, the best, by id, prefix or subject; retirement; and rows added as versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceloom.operators.registry import Ambiguous, NoMatch

# Fixed value: what a lock says of something that there isn't.
MISSING = "<missing>"


def tag_like(tag: Column, pattern: str) -> Column:
    """Whether a tag fits a pattern with * and ?; without either it must be equal."""
    if not set("*?") & set(pattern):
        return tag == pattern
    body = "".join(".*" if c == "*" else "." if c == "?" else "\\Q" + c + "\\E" for c in pattern)
    return tag.rlike(f"^{body}$")


def unretired(df: DataFrame) -> DataFrame:
    """Rows without a time of retirement."""
    return df.where("retired_at is null")


def latest(df: DataFrame, order: list[str], **filters) -> DataFrame:
    """The newest row that isn't retired and fits all filters: a value, a list of values, or for ``tag`` a pattern. None: no row."""
    kept = unretired(df) if "retired_at" in df.columns else df
    for c, v in filters.items():
        if v is not None:
            kept = kept.where(tag_like(F.col(c), v) if c == "tag" else F.col(c).isin(v) if isinstance(v, (list, tuple)) else F.col(c) == v)
    return kept.orderBy(*(F.desc_nulls_last(c) for c in order)).limit(1)


def require(df: DataFrame, what: str):
    """The first row; NoMatch where there is none."""
    rows = df.limit(1).collect()
    if not rows:
        raise NoMatch(what)
    return rows[0]


def best_adapter(adapters: DataFrame, runs: DataFrame) -> DataFrame:
    """The adapter of the highest measured success, of equals that of the newest run. Quantised, retired and unevaluated ones take no
    part. A run belongs to an adapter by id, or else by name."""
    live = unretired(adapters).where("parent_id is null").select("id", "name")
    r = runs.where("success is not null").select("subject", "success", "started_at")
    by_id = live.join(r, live.id == r.subject).select("id", "name", "success", "started_at", F.lit(0).alias("by"))
    by_name = live.join(r, live.name == r.subject).select("id", "name", "success", "started_at", F.lit(1).alias("by"))
    newest = by_id.union(by_name).groupBy("id", "name").agg(F.max_by(F.struct("success", "started_at"), F.struct(-F.col("by"), F.col("started_at"))).alias("r"))
    return newest.select("id", "name", "r.*").orderBy(F.desc("success"), F.desc("started_at"), "id").limit(1)


def adapter_results(adapters: DataFrame, runs: DataFrame) -> DataFrame:
    """Every adapter with its newest run, by id or else by name; nulls for none."""
    r = runs.groupBy("subject").agg(F.max_by(F.struct("run_id", "success"), "started_at").alias("r"))
    a, b = r.select(F.col("subject").alias("sa"), F.col("r").alias("ra")), r.select(F.col("subject").alias("sb"), F.col("r").alias("rb"))
    both = adapters.join(a, adapters["id"] == a.sa, "left").join(b, adapters["name"] == b.sb, "left")
    return both.select(adapters["*"], F.coalesce("ra", "rb").alias("r")).select(*adapters.columns, "r.run_id", "r.success")


def quantized_child(adapters: DataFrame, parent: str) -> DataFrame:
    """The newest child of an adapter that isn't retired."""
    return unretired(adapters).where(F.col("parent_id") == parent).orderBy(F.desc("created_at"), F.desc("id")).limit(1)


def find_run(runs: DataFrame, name: str):
    """A run by id, by a prefix that only one has, or as ``latest:<subject>``."""
    if name.startswith("latest:"):
        return require(runs.where(F.col("subject") == name[7:]).orderBy(F.desc("started_at"), F.desc("id")), f"no run of {name[7:]}")
    found = runs.where((F.col("id") == name) | F.col("id").startswith(name)).orderBy(F.col("id") != name, "id").limit(2).collect()
    if not found:
        raise NoMatch(f"no run {name}")
    if len(found) > 1 and found[0].id != name:
        raise Ambiguous(f"several runs begin with {name}")
    return found[0]


def find_named(df: DataFrame, name: str, what: str = "row"):
    """The row of an id or name, of the highest version."""
    return require(df.where((F.col("id") == name) | (F.col("name") == name)).orderBy(F.desc("version")), f"no {what} {name}")


def trace_order(traces: DataFrame, limit: int | None = None) -> DataFrame:
    """Traces in stable order."""
    df = traces.orderBy("created_at", "id")
    return df if limit is None else df.limit(limit)


def commands(*tables: tuple[DataFrame, str, str, str]) -> DataFrame:
    """``at, kind, id, command`` of several tables in time order. Each: table, kind, time column, command column."""
    out = None
    for df, kind, at, command in tables:
        part = df.select(F.col(at).alias("at"), F.lit(kind).alias("kind"), F.col("id").cast("string").alias("id"), F.col(command).alias("command")).where("command is not null")
        out = part if out is None else out.unionByName(part)
    return out.orderBy("at", "kind", "id")


def live_and_replay(runs: DataFrame) -> DataFrame:
    """Subjects with a run in both modes, the newest of each, and the difference of their success."""
    mode = F.coalesce("mode", F.lit("replay"))
    newest = lambda m: F.max_by(F.when(mode == m, F.struct("id", "success")), F.when(mode == m, F.struct("started_at", "id")))
    g = runs.groupBy("subject").agg(newest("live").alias("l"), newest("replay").alias("r")).where("l is not null and r is not null")
    return g.select("subject", F.col("l.id").alias("live_run"), F.col("r.id").alias("replay_run"), (F.col("l.success") - F.col("r.success")).alias("delta"))


def counts(traces: DataFrame, rounds: DataFrame, requests: DataFrame, since=None) -> DataFrame:
    """How many traces, rounds, requests (since a time) and graded requests there are."""
    asked = requests if since is None else requests.where(F.col("received_at") >= since)
    one = lambda df, n: df.agg(F.count(F.lit(1)).alias(n))
    r = asked.agg(F.count(F.lit(1)).alias("requests"), F.count("outcome").alias("graded"))
    return one(traces, "traces").join(one(rounds, "rounds"), how="cross").join(r, how="cross")  # one row each


def retire(df: DataFrame, ids: DataFrame, at, reason: str) -> tuple[DataFrame, DataFrame]:
    """(table, report): the named rows get ``retired_at`` and ``retired_reason``. The report says of each id: retired, already retired,
    or unknown."""
    named = ids.select(F.col("id").alias("_id")).distinct()
    hit = df.join(named, df["id"] == named["_id"], "left")
    new = F.col("_id").isNotNull() & F.col("retired_at").isNull()
    table = hit.withColumns({"retired_reason": F.when(new, reason).otherwise(F.col("retired_reason")), "retired_at": F.when(new, at).otherwise(F.col("retired_at"))}).select(*df.columns)
    seen = named.join(df.select(F.col("id").alias("_k"), F.col("retired_at")), F.col("_id") == F.col("_k"), "left")
    said = F.when(F.col("_k").isNull(), "unknown").when(F.col("retired_at").isNotNull(), "already retired").otherwise("retired")
    return table, seen.select(F.col("_id").alias("id"), said.alias("result"))


def add_version(df: DataFrame, row: dict, name: str) -> DataFrame:
    """The table with a row added under ``name``, its version the highest so far and one."""
    top = df.where(F.col("name") == name).agg(F.coalesce(F.max("version"), F.lit(0)).alias("v")).first().v
    return df.unionByName(df.sparkSession.createDataFrame([{**dict.fromkeys(df.columns), **row, "name": name, "version": top + 1}], df.schema))


def router_state(stored: DataFrame, updates: DataFrame | None = None, reset: bool = False) -> DataFrame:
    """The stored posteriors with updates of the same (cluster_id, arm) put in their place; none after a reset, as at a promotion."""
    base = stored.limit(0) if reset else stored
    if updates is None:
        return base
    return base.join(updates.select("cluster_id", "arm"), ["cluster_id", "arm"], "left_anti").unionByName(updates)


def disjoint(*sets: tuple[str, DataFrame], key: str) -> DataFrame:
    """Keys that more than one named set holds, with the sets; must be empty."""
    out = None
    for name, df in sets:
        part = df.select(F.col(key).alias("key"), F.lit(name).alias("name")).distinct()
        out = part if out is None else out.union(part)
    return out.groupBy("key").agg(F.array_sort(F.collect_list("name")).alias("sets")).where(F.size("sets") > 1)


def corpus_hash(rows: DataFrame, volatile: list[str]) -> DataFrame:
    """sha256 of a corpus: each row as JSON without the volatile columns, hashed, and the sorted hashes hashed in two levels, so that no
    task holds more than a 4096th of them."""
    kept = sorted(c for c in rows.columns if c not in volatile)
    h = rows.select(F.sha2(F.to_json(F.struct(*kept)), 256).alias("h"))
    part = h.groupBy(F.substring("h", 1, 3).alias("p")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "\n"), 256).alias("h"))
    return part.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "h"))), lambda x: x["h"]), "\n"), 256).alias("corpus_hash"))


def rounds_for_tag(rounds: DataFrame, tag: str) -> DataFrame:
    """The on-policy rounds of a tag pattern, in order of their number."""
    return rounds.where(tag_like(F.col("tag"), tag)).orderBy("round_idx")


def sft_hash(datasets: DataFrame, missing: str = MISSING) -> DataFrame:
    """``content_hash`` of the newest dataset for supervised training, by version and then creation; ``missing`` where there is none, or it has no hash."""
    place = F.struct(F.coalesce("version", F.lit(0)), F.coalesce(F.col("created_at").cast("string"), F.lit("")))
    newest = F.max_by(F.struct("content_hash"), F.when(F.col("kind") == "sft", place))
    return datasets.agg(F.coalesce(newest["content_hash"], F.lit(missing)).alias("content_hash"))


def calibrations_for(calibrations: DataFrame) -> DataFrame:
    """The newest calibration of every adapter, all columns; of equally new ones that with the largest id."""
    rest = [c for c in calibrations.columns if c != "adapter_id"]
    newest = calibrations.groupBy("adapter_id").agg(F.max_by(F.struct(*rest), F.struct("created_at", "id")).alias("_c"))
    return newest.select("adapter_id", "_c.*")


def cascade_decisions(turns: DataFrame, calibrations: DataFrame, features: list[str]) -> DataFrame:
    """Adds ``escalate, why`` to turns (columns adapter_id, score) under the newest calibration of their adapter.

    A missing or unusable calibration escalates everything, and so does one that was fitted on other features than ``features`` or in another order:
    a gate with a meaningless threshold is worse than none. Otherwise a turn escalates below the threshold (1 where none is stored), and without a
    score."""
    fit = calibrations_for(calibrations).select("adapter_id", F.col("usable").alias("_u"), F.coalesce("threshold", F.lit(1.0)).alias("_t"), F.col("feature_order").alias("_f"), F.lit(True).alias("_have"))
    x = turns.join(fit, "adapter_id", "left")
    why = (
        F.when(F.col("_have").isNull(), "no calibration").when(~F.coalesce("_u", F.lit(False)), "unusable").when(~F.col("_f").eqNullSafe(F.array(*map(F.lit, features))), "other features")
        .when(F.col("score").isNull(), "no score").when(F.col("score") < F.col("_t"), "below the threshold")
    )
    return x.withColumns({"escalate": why.isNotNull(), "why": why}).drop("_u", "_t", "_f", "_have")
