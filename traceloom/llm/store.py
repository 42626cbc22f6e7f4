"""Intermediate tables in the folder that the cluster names in spark.checkpoint.dir, which all machines share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from traceloom.session import workers_find_package

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder. Where none is set, as in tests, one beside the warehouse of a local session; a cluster without
    one raises, since its machines share no folder that this session could name."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        master = spark.sparkContext.master
        if not current.isDefined() and (not master.startswith("local") or master.startswith("local-cluster")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        named = current.get() if current.isDefined() else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return named.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends, and no executor holds the only copy."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/traceloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing will read again: no result that is still lazy may come from them."""
    for t in tables:
        jvm, conf = t.sparkSession._jvm, t.sparkSession._jsparkSession.sessionState().newHadoopConf()
        place = jvm.org.apache.hadoop.fs.Path(t._path)
        place.getFileSystem(conf).delete(place, True)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bound the rows of an Arrow batch, so that long texts don't add up in a Python worker; workers find the package."""
    workers_find_package(spark)
    if int(spark.conf.get(ARROW_ROWS, "10000")) > rows:
        spark.conf.set(ARROW_ROWS, str(rows))


def smallest_by_hash(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` rows with the smallest (hash of ``keys``, keys). Rows beyond a hash that about n rows stay below are left out
    before the sort, so that no partition sends n rows of its own to the driver."""
    from pyspark.sql import functions as F

    h = F.xxhash64(*keys)
    total = df.count()
    want = n + 8 * n**0.5 + 50
    if total > 2 * want:
        some = df.where(h <= F.lit(int(-(2**63) + 2**64 * (want / total))))
        if some.count() >= n:
            df = some
    return df.orderBy(h, *keys).limit(n)


def most_frequent(df: DataFrame, count: str, most: int) -> DataFrame:
    """Rows whose ``count`` is at least a threshold, chosen so that at most ``most`` rows have it. The threshold comes from a
    histogram of logarithms, a few hundred rows, instead of a sort of which each partition would send ``most`` rows."""
    from pyspark.sql import functions as F

    bucket = F.floor(F.log2(F.col(count)) * 8)
    sizes = sorted(((r[0], r[1]) for r in df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1))).collect()), reverse=True)
    least, total = None, 0
    for b, n in sizes:
        total += n
        if total > most:
            break
        least = b
    return df.where(bucket >= least) if least is not None else df.limit(0)
