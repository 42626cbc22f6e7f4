import pytest
from pyspark.sql import functions as F

from traceloom.operators import curation as C
from traceloom.operators import lifecycle as L
from traceloom.operators import registry as G
from traceloom.operators import report as R
from traceloom.plans import catalog


def test_moves(spark):
    e = spark.createDataFrame([("a", "prod", "2024-01-01", 1)], "adapter_id string, status string, at string, seq int")
    e = L.move(L.move(e, "b", "canary", "2024-01-02"), "b", "prod", "2024-01-03")
    assert {r.adapter_id: r.status for r in L.current_status(e).collect()} == {"a": "retired", "b": "prod"}
    with pytest.raises(ValueError):
        L.move(e, "a", "prod", "2024-01-04")


def test_checks(spark):
    df = spark.createDataFrame([(True, 0.995, None, 0.0, -3.0, 0.02), (True, None, "few", 0.0, 1.0, None)], "has_eval boolean, schema_valid double, refusal string, success_low double, token_delta double, ece double")
    got = df.select(L.promotion_checks({c: F.col(c) for c in df.columns}).alias("c")).collect()
    assert tuple(got[0].c) == (True,) * 5 and tuple(got[1].c) == (True, False, False, False, False)
    g = spark.createDataFrame([(60, 60, 0.5, "promote", 0.0, 0.01, 0.7, 0.0, True), (60, 60, float("nan"), "promote", 0.0, 0.01, 0.7, 0.0, True), (None, 60, 0.5, "promote", 0.0, 0.01, 0.7, 0.0, True)], "requests int, samples int, loss double, decision string, delta double, ece double, auroc double, drop double, checks_ok boolean")
    assert [r[0] for r in g.select(L.retrain_gates({c: F.col(c) for c in g.columns})).collect()] == [None, "loss", "requests"]


def test_selectors(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert G.only(df.where("v = 1")).k == "a"
    with pytest.raises(G.NoMatch):
        G.only(df.where("v = 9"))
    with pytest.raises(G.Ambiguous):
        G.only(df)


def test_report(spark):
    d = "/root/testdata/sf0.001"
    cover = C.coverage(spark.range(30).selectExpr("id % 3 as k"), spark.range(5).selectExpr("id % 2 as k"), "k")
    r = R.curation_report(catalog.QUERIES["curation_funnel"](spark, d), catalog.QUERIES["reason_histogram"](spark, d), cover)
    r.add("Nothing", cover.limit(0), "no_pricing")
    block = R.markdown(r)
    once = R.inject("# Title\n", block)
    assert R.inject(once, block) == once and "no_pricing" in block and "<table>" in R.page(r)
    assert R.assert_report(r, ["Stages", "Gone"], ["no_pricing"]) == ["missing: Gone", "forbidden: no_pricing"]
    assert "polyline" in R.chart([(0, 1), (1, 2)])
    with pytest.raises(ValueError):
        r.warn("x", "y")
