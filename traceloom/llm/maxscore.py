"""Exact top-k inner-product search over quantised vectors by MaxScore.

Each dimension is two query terms: the rows where it is positive and those where it is negative. For a query, the sign that
agrees with its own weight adds to a score and the other subtracts, so a term's bound is its weight times the largest value
of the agreeing sign, and 0 for the other. Terms are split by bound: those whose bounds together can't reach the current
k-th score are non-essential. Only rows with a posting in an essential term can enter the result; they are scored on these
first, and the other terms are probed, largest bound first, only while a row's partial score plus what is left can compete.

Layout: rows fall into shards by hash, queries into blocks by hash; each (shard, block) cell is one task's group, its rows
bounded by the parameters. Shard results are merged by query in a second shuffle of k rows per shard and query. No side is
collected or broadcast.

Vectors that are null, or hold a null or non-finite component, take no part, neither as query nor as candidate; components
beyond the shorter vector's length count as 0. Ties go to the smaller id. Ids may repeat: a query is every distinct
(id, vector) row and its own id never is its result; equal rows give equal ranks in id order. An empty table gives no rows.
A vector with a component of 2 ** 62 or more after scaling takes no part; terms that add up to 2 ** 62 or more in size raise an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from traceloom.llm.registry import query
from traceloom.sources.tables import read_table

RESULT = "query_id long, vec_id long, score long"
BIG = np.iinfo(np.int64).min


def top_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by (score descending, id ascending)."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def maxscore(rows: np.ndarray, ids: np.ndarray, q: np.ndarray, own: int, k: int, postings: dict, bounds: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows for one query. ``postings``: per (dimension, sign) the row positions holding it;
    ``bounds``: per dimension the largest and smallest value of any row."""
    high, low = bounds
    bound = np.maximum(np.where(q > 0, q * high, q * low), 0)
    terms = np.argsort(bound, kind="stable")  # smallest first
    left = np.cumsum(bound[terms])  # what terms up to here can add
    # a first threshold: exact scores of rows that are large in the query's largest term
    best = terms[-1]
    seed = postings[best, q[best] > 0] if bound[best] else np.zeros(0, np.int64)
    seed = seed[: 4 * k] if len(seed) else np.arange(min(len(ids), 4 * k))
    seed = seed[ids[seed] != own]
    exact = rows[seed] @ q
    theta = np.sort(exact)[-k] if len(exact) >= k else BIG
    essential = terms[left >= theta] if theta > 0 else terms  # at least theta: ties may win by id
    if theta <= 0:
        live = np.arange(len(ids))  # rows without any agreeing posting may compete
    else:
        mark = np.zeros(len(ids), bool)
        for t in essential:
            if bound[t]:
                mark[postings[t, q[t] > 0]] = True
        live = np.flatnonzero(mark)
    live = live[ids[live] != own]
    order = terms[::-1]
    done = len(essential)
    partial = rows[np.ix_(live, order[:done])] @ q[order[:done]]
    rest = np.concatenate([left[::-1][1:], [0]])  # after the i-th largest term
    for i in range(done, len(order), 8):
        keep = partial + rest[i - 1] >= theta
        live, partial = live[keep], partial[keep]
        at = order[i : i + 8]
        partial = partial + rows[np.ix_(live, at)] @ q[at]
        if len(partial) >= k:  # disagreeing terms may still subtract: only what is certain raises the threshold
            sure = partial + np.minimum(np.where(q > 0, q * low, q * high), 0)[order[i + 8 :]].sum()
            theta = max(theta, np.partition(sure, len(sure) - k)[len(sure) - k])
    at = top_of(partial, ids[live], k)
    return ids[live][at], partial[at]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an int64 list column, padded with 0 to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), width), np.int64)
    flat = np.asarray(column.flatten())
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    ok = at < width
    out[row[ok], at[ok]] = flat[ok]
    return out


def search_cell(table: pa.Table, k: int) -> pa.Table:
    """Top k of one shard for every query of one block."""
    is_query = np.asarray(table.column("is_query").combine_chunks())
    ids = np.asarray(table.column("vec_id").combine_chunks())
    lengths = np.diff(np.asarray(table.column("v").combine_chunks().offsets))
    width = int(lengths.max(initial=0))
    values = matrix(table.column("v"), width)
    rows, row_ids = values[~is_query], ids[~is_query]
    out_q, out_v, out_s = [], [], []
    if len(rows) and width:
        order = np.argsort(row_ids, kind="stable")
        rows, row_ids = rows[order], row_ids[order]
        most = int(np.abs(values).max(initial=0)) ** 2 * width
        if most >= 2**63:
            sums = np.abs(rows.astype(object)) @ np.abs(values[is_query].astype(object)).T
            if sums.max(initial=0) >= 2**62:
                raise OverflowError("an inner product may leave 64 bits; use a smaller scale")
        work = rows.astype(np.float64) if most < 2**52 else rows
        postings = {}
        for d in range(width):
            by = np.argsort(-work[:, d], kind="stable")
            postings[d, True], postings[d, False] = by[work[by, d] > 0], by[::-1][work[by[::-1], d] < 0]
        bounds = (np.maximum(work.max(axis=0), 0), np.minimum(work.min(axis=0), 0))
        for own, q in zip(ids[is_query], values[is_query], strict=True):
            at, score = maxscore(work, row_ids, q.astype(work.dtype), own, k, postings, bounds)
            out_q.append(np.full(len(at), own, np.int64))
            out_v.append(at)
            out_s.append(score.astype(np.int64))
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return pa.table({"query_id": join(out_q), "vec_id": join(out_v), "score": join(out_s)})


def top_k(
    df: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding",
    shard_rows: int = 16384, block_queries: int = 4096,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best rows for every row whose id is divisible by ``every``."""
    vector = df[vector_col]
    finite = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    ints = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    finite = finite & F.forall(vector, lambda x: F.abs(F.lit(float(scale)) * x.cast("double")) < float(2**62))
    data = df.where(finite & df[id_col].isNotNull()).select(df[id_col].cast("long").alias("vec_id"), ints.alias("v"))
    asked = data.where(F.col("vec_id") % every == 0).distinct()
    sizes = data.agg(F.count(F.lit(1)), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    shards, blocks = max(1, math.ceil(sizes[0] / shard_rows)), max(1, math.ceil(sizes[1] / block_queries))
    deal = lambda n: F.pmod(F.xxhash64(F.lit(n), "vec_id", "v"), F.lit(n)).cast("int")
    every_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cells = data.select(deal(shards).alias("shard"), every_of(blocks).alias("block"), F.lit(False).alias("is_query"), "vec_id", "v").unionByName(
        asked.select(every_of(shards).alias("shard"), deal(blocks).alias("block"), F.lit(True).alias("is_query"), "vec_id", "v")
    )
    found = cells.groupBy("shard", "block").applyInArrow(lambda t: search_cell(t, k), RESULT)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query(
    "op6_maxscore",
    """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v from embeddings),
s as (select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
      from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 10
""",
)
def op6_maxscore(spark, sf_dir):
    """The ten best rows for every hundredth embedding."""
    return top_k(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
