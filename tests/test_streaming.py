from pyspark.sql import functions as F

from traceloom.operators import router as B
from traceloom.plans import views as V
from traceloom.streaming import router as R

SF = "/root/testdata/sf0.001"


def stream_of(spark, df, path, files=3):
    df.repartition(files).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_posterior_equals_batch_when_in_order(spark, tmp_path):
    rows = V.requests(spark, SF).withColumn("received_at", F.col("received_at").cast("timestamp"))
    for i, part in enumerate(["< '2024-01-12'", ">= '2024-01-12'"]):
        rows.where(f"received_at {part}").coalesce(1).write.parquet(str(tmp_path / f"in/p{i}"))
    src = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    got = R.run_once(R.posterior(src), "post", "update", str(tmp_path / "c"))
    last = {(r.cluster_id, r.arm): r for r in got.orderBy("n").collect()}
    want = B.posterior(rows.where("outcome is not null and not fallback"), ["cluster_id", "arm"], ["received_at", "id"]).collect()
    assert len(want) == len(last)
    for w in want:
        r = last[w.cluster_id, w.arm]
        assert r.n == w.n and abs(r.alpha - w.alpha) < 1e-6 and abs(r.beta - w.beta) < 1e-6


def test_health_windows(spark, tmp_path):
    rows = V.requests(spark, SF).withColumn("received_at", F.col("received_at").cast("timestamp"))
    got = R.run_once(R.health(stream_of(spark, rows, str(tmp_path / "in"), 1), 3600, 3600), "health", "complete", str(tmp_path / "c"))
    want = {r.s: r.n for r in rows.groupBy(F.window("received_at", "3600 seconds").start.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {r.start: r.n for r in got.collect()} == want


def test_late_outcomes_join(spark, tmp_path):
    req = spark.sql("select id, timestamp '2024-01-01' + make_interval(0,0,0,0,0,id) as received_at, cast(null as boolean) as outcome from range(10)")
    fb = spark.sql("select id, id % 2 = 0 as outcome, timestamp '2024-01-01' + make_interval(0,0,0,0,if(id = 9, 9, 0), id + 5) as at from range(10) where id <> 3")
    joined = R.with_outcomes(stream_of(spark, req, str(tmp_path / "r"), 1), stream_of(spark, fb, str(tmp_path / "f"), 1))
    got = {r.id: r.outcome for r in R.run_once(joined, "joined", "append", str(tmp_path / "c")).collect()}
    assert got == {i: i % 2 == 0 for i in range(9) if i != 3}
