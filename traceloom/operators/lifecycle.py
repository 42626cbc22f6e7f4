"""Adapter statuses as events, promotion checks and retraining gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Moves that are allowed.
MOVES = {("candidate", "canary"), ("candidate", "prod"), ("candidate", "retired"), ("canary", "prod"), ("canary", "retired"), ("prod", "retired")}
# Limits of the checks.
LIMITS = {"requests": 50, "samples": 50, "regression": 0.01, "schema_valid": 0.99, "ece": 0.05, "auroc": 0.6, "quantization": 0.02}


def current_status(events: DataFrame) -> DataFrame:
    """The newest status of each adapter; a candidate until its first event."""
    return events.groupBy("adapter_id").agg(F.max_by("status", F.struct("at", "seq")).alias("status"))


def move(events: DataFrame, adapter_id: str, to: str, at: str) -> DataFrame:
    """Events with one move added. A promotion to prod retires the adapter that was prod in the same step. An illegal move
    raises; the status table is collected for the named adapter and the prod one only."""
    now = current_status(events).where((F.col("adapter_id") == adapter_id) | (F.col("status") == "prod")).collect()
    status = {r.adapter_id: r.status for r in now}
    old = status.get(adapter_id, "candidate")
    if (old, to) not in MOVES:
        raise ValueError(f"{adapter_id}: {old} -> {to} is not a legal move")
    new = [(a, "retired", at, 0) for a, s in status.items() if to == "prod" and s == "prod" and a != adapter_id]
    return events.unionByName(events.sparkSession.createDataFrame([*new, (adapter_id, to, at, 1)], "adapter_id string, status string, at string, seq int"))


def promotion_checks(c: dict) -> Column:
    """A struct of booleans. ``c``: has_eval, schema_valid, refusal, success_low, token_delta, ece."""
    fine = lambda x: F.coalesce(x, F.lit(False))
    return F.struct(
        fine(c["has_eval"]).alias("has_eval"), fine(c["schema_valid"] >= LIMITS["schema_valid"]).alias("schema_valid"),
        fine(c["refusal"].isNull() & (c["success_low"] >= -LIMITS["regression"])).alias("not_worse"),
        fine(c["token_delta"] <= 0).alias("tokens"), fine(c["ece"] <= LIMITS["ece"]).alias("calibrated"),
    )


def retrain_gates(c: dict) -> Column:
    """The first gate that stops a retraining, null if none does. ``c``: requests, samples, loss, decision, delta, ece, auroc,
    drop, checks_ok."""
    ok = lambda x: F.coalesce(x, F.lit(False))
    return (
        F.when(~ok(c["requests"] >= LIMITS["requests"]), "requests").when(~ok(c["samples"] >= LIMITS["samples"]), "samples")
        .when(~ok(~F.isnan(c["loss"]) & (F.abs(c["loss"]) < float("inf"))), "loss").when(~ok(c["decision"] == "promote"), "decision")
        .when(~ok(c["delta"] >= -LIMITS["regression"]), "regression").when(~ok((c["ece"] <= LIMITS["ece"]) & (c["auroc"] >= LIMITS["auroc"])), "calibration")
        .when(~ok(c["drop"] <= LIMITS["quantization"]), "quantization").when(~ok(c["checks_ok"]), "promotion")
    )


def orphan_runs(reported: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Run ids that a report names and the registry lacks; must be empty."""
    return reported.select(key).join(stored.select(key), key, "left_anti")
