import time

from pyspark.sql import functions as F

from traceloom.operators.evaluation import nearest_call


def test_nearest_call_among_many_equal_ones(spark):
    """Pairs are those of different token sets: 20,000 calls with two sets would be 400 million pairs of calls."""
    calls = spark.range(20_000).select("id", F.lit("f").alias("tool"), F.when(F.col("id") < 19_998, F.array(*map(F.lit, "abcd"))).otherwise(F.array(*map(F.lit, "dca"))).alias("s"))
    calls = calls.union(spark.createDataFrame([(20_000, "f", ["z"]), (20_001, "g", ["a", "b"])], "id long, tool string, s array<string>"))
    start = time.monotonic()
    got = {r.id: (r.score, r.ord, r.served) for r in nearest_call(calls, calls.withColumnRenamed("id", "ord"), "tool", "s", "ord", others=True).collect()}
    assert time.monotonic() - start < 60
    assert len(got) == 20_000 and got[0] == (1.0, 1, True) and all(got[i] == (1.0, 0, True) for i in range(1, 19_998))
    assert got[19_998] == (1.0, 19_999, True) and got[19_999] == (1.0, 19_998, True)
    alone = {r.id: (r.score, r.ord) for r in nearest_call(calls.where("id in (5, 19999)"), calls.where("id in (3, 5, 7)").withColumnRenamed("id", "ord"), "tool", "s", "ord").collect()}
    assert alone == {5: (1.0, 3), 19_999: (0.75, 3)}
