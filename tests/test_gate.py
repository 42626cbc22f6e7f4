from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from traceloom.operators import gate as G
from traceloom.operators import statistics as S


def turns(spark, n=240, tasks=40, noise=0.2, rare=None):
    rng = np.random.default_rng(1)
    x = rng.random(n)
    y = ((x + noise * rng.normal(size=n)) > (0.5 if rare is None else 1 - rare)).astype(int)
    rows = [(int(i % tasks), float(a), None, int(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "task int, f double, empty double, y int")


@pytest.mark.parametrize("rare, method", [(None, "isotonic"), (0.12, "sigmoid")])
def test_gate_is_fitted_out_of_fold(spark, rare, method):
    df = turns(spark, rare=rare)
    gate = G.fit_calibrator(df, ["f", "empty"])
    assert gate["reason"] is None and gate["method"] == method and gate["features"] == ["f"]
    assert gate["holdout"]["n"] == 240 and 0.7 < gate["holdout"]["auroc"] < 1 and gate["holdout"]["ece"] < 0.15
    scored = gate["score"](df)
    assert scored.columns == [*df.columns, "p"]
    p = {round(r.f, 6): r.p for r in scored.collect()}
    lo, hi = np.mean([p[k] for k in p if k < 0.3]), np.mean([p[k] for k in p if k > 0.9])
    assert all(0 <= v <= 1 for v in p.values()) and hi > lo + 0.4


def test_gate_refuses(spark):
    df = turns(spark)
    assert G.fit_calibrator(df.limit(20), ["f"])["reason"] == "too_few_turns"
    assert G.fit_calibrator(df.limit(0), ["f"])["reason"] == "too_few_turns"
    assert G.fit_calibrator(df, ["empty"])["reason"] == "no_features"
    assert G.fit_calibrator(df.withColumn("y", F.lit(1)), ["f"])["reason"] == "single_class"
    assert G.fit_calibrator(df.withColumn("y", (F.col("f") > 0.97).cast("int")), ["f"])["reason"] == "fit_error"


def test_sigmoid_equals_a_plain_fit(spark):
    df = turns(spark)
    a, b = G.fit_sigmoid(df, "f", "y")
    x, y = np.array([[r.f, r.y] for r in df.collect()]).T
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    m = 1 / (1 + np.exp(-(a * x + b)))
    assert abs(((t - m) * x).sum()) < 1e-6 and abs((t - m).sum()) < 1e-6  # both derivatives are zero


def test_isotonic_between_and_beyond_its_steps(spark):
    curve = spark.createDataFrame([(0.2, 0.1), (0.4, 0.5), (0.4, 0.5), (0.8, 0.9)], "at double, value double")
    at = spark.createDataFrame([(0.0,), (0.2,), (0.3,), (0.4,), (0.6,), (1.0,), (None,)], "s double")
    got = [r.calibrated for r in G.with_isotonic(at, "s", curve).collect()]
    assert got[-1] is None and np.allclose(got[:-1], [0.1, 0.1, 0.3, 0.5, 0.7, 0.9])


def test_signed_rank_p_equals_enumeration(spark):
    for n in range(1, 9):
        sums = [sum(r for r, take in zip(range(1, n + 1), s, strict=True) if take) for s in product([0, 1], repeat=n)]
        rows = [(n, w) for w in range(n * (n + 1) // 2 + 1)]
        got = {r.w: r.p for r in spark.createDataFrame(rows, "n int, w int").select("w", S.signed_rank_p(F.col("n"), F.col("w")).alias("p")).collect()}
        assert all(abs(got[w] - min(1, 2 * sum(s <= w for s in sums) / 2**n)) < 1e-12 for w in got)
    one = spark.createDataFrame([(0, 0)], "n int, w int").select(S.signed_rank_p(F.col("n"), F.col("w")).alias("p")).first().p
    assert one == 1.0


def test_cascades_escalate_without_a_usable_calibration(spark):
    from traceloom.operators import selectors as L

    rows = [("1", "a", 1, False, 0.1, ["f"]), ("2", "a", 2, True, 0.5, ["f"]), ("3", "b", 1, False, 0.1, ["f"]), ("4", "c", 1, True, None, ["f"]), ("5", "d", 1, True, 0.1, ["g", "f"])]
    stored = spark.createDataFrame(rows, "id string, adapter_id string, created_at int, usable boolean, threshold double, feature_order array<string>")
    turns = spark.createDataFrame([(0, "a", 0.6), (1, "a", 0.4), (2, "a", None), (3, "b", 0.9), (4, "c", 0.99), (5, "d", 0.9), (6, "e", 0.9), (7, None, 0.9)], "i int, adapter_id string, score double")
    got = {r.i: r.why for r in L.cascade_decisions(turns, stored, ["f"]).collect()}
    assert got == {0: None, 1: "below the threshold", 2: "no score", 3: "unusable", 4: "below the threshold", 5: "other features", 6: "no calibration", 7: "no calibration"}
    none = spark.createDataFrame([], "kind string, version int, created_at string, content_hash string")
    assert L.sft_hash(none).first().content_hash == L.MISSING
