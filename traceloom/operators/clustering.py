"""Embedders, centroids and clusters."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

WORD = re.compile(r"\w+")


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def squared_distance(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2)), F.lit(0.0), lambda s, v: s + v)


def cosine(a, b) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + 1e-9)


def hash_embed(text: str, dim: int = 256) -> np.ndarray:
    """Signed hashed bag of words, of unit length unless the text has no word."""
    v = np.zeros(dim)
    for w in WORD.findall((text or "").lower()):
        h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
        v[h % dim] += 1.0 if h >> 63 else -1.0
    return v / max(float(np.linalg.norm(v)), 1e-12)


def hash_embedder(dim: int = 256):
    """Arrow UDF text -> vector."""

    @F.pandas_udf(ArrayType(DoubleType()))
    def embed(text: pd.Series) -> pd.Series:
        return text.map(lambda t: hash_embed(t, dim))

    return embed


def custom_embedder(fn):
    """Arrow UDF from a function list of texts -> 2-d array, called once a batch."""

    @F.pandas_udf(ArrayType(DoubleType()))
    def embed(text: pd.Series) -> pd.Series:
        return pd.Series(list(np.asarray(fn(text.fillna("").tolist()), float)))

    return embed


def nearest_centroid(df: DataFrame, vector: str, centroids: list[list[float]]) -> DataFrame:
    """Adds ``cluster`` and ``distance``: the smallest squared distance, then the lowest index; -1 without centroids. The
    centroids are literals, as many as there are clusters, so there is no join."""
    if not centroids:
        return df.withColumns({"cluster": F.lit(-1), "distance": F.lit(None).cast("double")})
    pairs = [F.struct(squared_distance(F.col(vector), F.array(*(F.lit(float(x)) for x in c))).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)]
    return df.withColumn("_b", F.array_min(F.array(*pairs))).withColumns({"cluster": F.col("_b.cluster"), "distance": F.col("_b.distance")}).drop("_b")


def lloyd_step(assigned: DataFrame, vector: str, cluster: str) -> DataFrame:
    """New centroids, ``cluster, dim, value``: means per dimension, with partial sums before the shuffle."""
    return assigned.select(cluster, F.posexplode(vector).alias("dim", "x")).groupBy(cluster, "dim").agg(F.avg(F.col("x").cast("double")).alias("value"))


def seeds(df: DataFrame, key: str, vector: str, k: int, seed: int = 0) -> np.ndarray:
    """k-means++ seeds of a whole table, one aggregate each: the next seed is drawn with a probability in proportion to its squared distance from
    those so far, as the smallest exponential of that rate; the exponential comes from a hash of (seed, round, key), so the draw doesn't
    depend on partitions. Fewer different vectors than ``k`` give fewer seeds."""
    chosen: list[np.ndarray] = []
    for turn in range(k):
        u = (F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), F.lit(turn), F.col(key).cast("string")), 256), 1, 12), 16, 10).cast("double") + 1) / (2.0**48 + 1)
        rate = distance_to(np.array(chosen))(F.col(vector)) if chosen else F.lit(1.0)
        draw = df.where(F.col(vector).isNotNull()).select(vector, key, rate.alias("_r"), u.alias("_u")).where("_r > 0")
        best = draw.agg(F.min_by(vector, F.struct(-F.log("_u") / F.col("_r"), F.col(key))).alias("v")).first()
        if best is None or best.v is None:
            break
        chosen.append(np.asarray(best.v, float))
    return np.array(chosen)


def distance_to(centroids: np.ndarray):
    """Arrow UDF vector -> squared distance from the nearest centroid."""

    @F.pandas_udf("double")
    def far(x: pd.Series) -> pd.Series:
        rows = np.array([np.asarray(v, float) for v in x]).reshape(len(x), -1)
        return pd.Series(np.min([((rows - c) ** 2).sum(axis=1) for c in centroids], axis=0) if len(rows) else np.zeros(0))

    return far


def cluster_of(centroids: np.ndarray):
    """Arrow UDF vector -> index of the nearest centroid, the lowest of equally near ones."""

    @F.pandas_udf("int")
    def near(x: pd.Series) -> pd.Series:
        rows = np.array([np.asarray(v, float) for v in x]).reshape(len(x), -1)
        return pd.Series(np.argmin([((rows - c) ** 2).sum(axis=1) for c in centroids], axis=0) if len(rows) else np.zeros(0, int))

    return near


def kmeans(df: DataFrame, vector: str, start: np.ndarray, most_rounds: int = 50) -> tuple[np.ndarray, DataFrame]:
    """Lloyd's rounds from ``start`` until no centroid moves, at most ``most_rounds``; the centroids and ``df`` with ``cluster`` (null for a null vector).

    A round reads the vectors once: each task sums its own rows by cluster, a few rows a task are shuffled, and the driver holds the centroids,
    as many numbers as the model has. A cluster without rows keeps its centroid. Sums are rounded to 9 places, so that their order doesn't tell."""
    centroids = np.array(start, float)
    rows = df.where(F.col(vector).isNotNull()).select(F.col(vector).cast("array<double>").alias("v"))
    for _ in range(most_rounds):
        now = centroids

        def sums(frames):
            total, n = np.zeros_like(now), np.zeros(len(now), int)
            for pdf in frames:
                x = np.array([np.asarray(v, float) for v in pdf["v"]]).reshape(len(pdf), -1)
                if len(x):
                    label = np.argmin([((x - c) ** 2).sum(axis=1) for c in now], axis=0)
                    np.add.at(total, label, x)
                    n += np.bincount(label, minlength=len(now))
            if n.any():  # a task without rows has no list whose type Arrow could see
                yield pd.DataFrame({"cluster": np.flatnonzero(n), "n": n[n > 0], "s": list(total[n > 0])})

        parts = rows.mapInPandas(sums, "cluster int, n long, s array<double>").select("cluster", "n", F.posexplode("s").alias("dim", "x"))
        means = parts.groupBy("cluster", "dim").agg((F.round(F.sum("x"), 9) / F.sum("n")).alias("value"))
        new = centroids.copy()
        for r in means.collect():  # clusters times dimensions, the size of the model
            new[r.cluster, r.dim] = r.value
        if np.array_equal(new, centroids):
            break
        centroids = new
    return centroids, df.withColumn("cluster", F.when(F.col(vector).isNotNull(), cluster_of(centroids)(vector)) if len(centroids) else F.lit(None).cast("int"))


def kmeans_fit(df: DataFrame, key: str, vector: str, k: int, seed: int = 0, most_rounds: int = 50) -> tuple[np.ndarray, DataFrame]:
    """:func:`kmeans` from :func:`seeds`."""
    return kmeans(df, vector, seeds(df, key, vector, k, seed), most_rounds)


def write_centroids(centroids: DataFrame, path: str) -> None:
    """Centroids (cluster, centroid) with their dimension, as Parquet."""
    centroids.select("cluster", F.col("centroid").cast("array<double>").alias("centroid"), F.size("centroid").alias("dim")).write.mode("overwrite").parquet(path)


def read_centroids(spark, path: str, dim: int) -> DataFrame:
    """Stored centroids; another dimension than the embedder's raises when they are read."""
    t = spark.read.parquet(path)
    fits = F.when(F.col("dim") == dim, F.col("centroid")).otherwise(F.raise_error(F.concat(F.lit("centroids of dimension "), F.col("dim").cast("string"))).cast("array<double>"))
    return t.select("cluster", fits.alias("centroid"))


def assign(df: DataFrame, vector: str, centroids: DataFrame, most: int = 4096) -> DataFrame:
    """Adds ``cluster`` and ``distance`` from a centroid table of at most ``most`` rows, which is checked before it is sent to all tasks."""
    rows = centroids.orderBy("cluster").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} centroids")
    named = nearest_centroid(df, vector, [list(r["centroid"]) for r in rows])
    names = F.array(*(F.lit(r["cluster"]) for r in rows)) if rows else None
    return named if names is None else named.withColumn("cluster", F.get(names, F.col("cluster")))
