import math

from traceloom.operators import gate as G
from traceloom.operators import statistics as S
from traceloom.operators import curation as C
from traceloom.functions import text as T
from pyspark.sql import functions as F


def test_mcnemar_exact(spark):
    def p_of(b, c):
        n, k = b + c, min(b, c)
        return 1.0 if n == 0 else min(1.0, 2 * sum(math.comb(n, i) for i in range(k + 1)) / 2**n)

    for b, c in [(0, 0), (3, 1), (0, 7), (5, 5), (40, 12)]:
        rows = [(i, 0.0, 1.0) for i in range(b)] + [(100 + i, 1.0, 0.0) for i in range(c)] + [(999, 1.0, 1.0)]
        r = S.mcnemar(spark.createDataFrame(rows, "task_id long, a double, b double")).first()
        assert (r.only_b, r.only_a) == (b, c) and abs(r.p - p_of(b, c)) < 1e-9


def test_wilcoxon_and_bootstrap(spark):
    rows = [(i, 0.5, 0.5 + d) for i, d in enumerate([0.1, 0.2, 0.2, -0.1, 0.0, 0.4])]
    df = spark.createDataFrame(rows, "task_id long, a double, b double")
    r = S.wilcoxon(df).first()
    assert (r.n, r.w_plus, r.w_minus) == (5, 13.5, 1.5) and 0 < r.p < 1
    same = S.wilcoxon(spark.createDataFrame([(1, 0.5, 0.5)], "task_id long, a double, b double")).first()
    assert same.p == 1.0 and same.n == 0
    b = S.bootstrap(df).first()
    assert b.low <= b.delta <= b.high
    assert math.isnan(S.bootstrap(df.limit(1)).first().delta)


def test_calibrator(spark):
    df = spark.sql("select cast(id % 2 as double) as y, if(id % 7 = 0, double('NaN'), id % 2 + rand(1)) as f, cast(null as double) as g from range(200)")
    trees, curve, cols = G.fit_calibrator(df, ["f", "g"])
    assert trees is not None and cols == ["f_v", "f_m"]
    assert G.fit_calibrator(df.withColumn("y", F.lit(1.0)), ["f"])[2] == "single class" and G.fit_calibrator(df, ["g"])[2] == "no feature has a value"


def test_filters(spark):
    df = spark.createDataFrame([("a-1",), ("a-2",), ("b-1",), (None,)], "tag string")
    assert df.where(C.tag_matches(F.col("tag"), "a-*")).count() == 2 and df.where(C.tag_matches(F.col("tag"), "b-1")).count() == 1
    d = spark.createDataFrame([("30d",), ("5m",), ("x",), (None,)], "s string").select(T.duration_seconds(F.col("s")).alias("n")).collect()
    assert [r.n for r in d] == [2592000, 300, None, None]
    texts = ["Error: x", '{"error": "no"}', '{"error": null}', '{"status": "FAILED"}', '{"status_code": 404}', "the customer reported an error", None, '{"error": false}']
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.is_error_result(F.col("t"))).collect()]
    assert got == [True, True, False, True, True, False, False, False]
    calls = spark.createDataFrame([(1, "c1", 2), (1, "c2", 4), (1, "c3", 9)], "trace long, call_id string, turn long")
    answers = spark.createDataFrame([(1, "c1", 3), (1, "c9", 5), (1, "c3", 8)], "trace long, call_id string, turn long")
    assert {(r.call_id, r.problem) for r in C.unpaired_calls(calls, answers).collect()} == {("c2", "call without result"), ("c9", "result without call"), ("c3", "result without call")}


def test_shares_of_counts_are_decimal(spark):
    from traceloom.plans.evaluation import share_of

    n = spark.createDataFrame([(90_000,), (10,), (1,), (20,)], "n long").select("n", share_of(F.col("n"), "0.7").alias("a"), share_of(F.col("n"), "0.15").alias("b"))
    assert {tuple(r) for r in n.collect()} == {(90_000, 63_000, 13_500), (10, 7, 1), (1, 0, 0), (20, 14, 3)}
