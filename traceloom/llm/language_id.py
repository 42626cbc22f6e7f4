"""Language identification with a blended-spectrum string kernel.

A text is the set of its byte n-grams, n = 1 to 4, after ASCII letters are lower-cased and every other ASCII byte becomes a
space; sets are hashed to 2 ** 18 presence bits. The kernel of two texts is the size of their sets' intersection over the
root of the product of their sizes. Nyström landmarks are training texts spread over the languages; one-versus-rest kernel
ridge regression solves (K_nm' K_nm + ridge K_mm) a = K_nm' Y on a bounded training sample, K_nm from batched matrix
products of presence rows. A text's outputs K(x, L) a are computed as (B_x (B_L' a)): the landmark sum is taken once, for
each presence bit, so a text of any length costs one product with its own bits.

Rows: the language of a null text or one without a letter is ``und`` with score 0. With no training rows every language is
``und``. Texts are read whole; repeated ids keep their rows, and rows that are equal in id, language and text are learned
from once. Ties go to the language that sorts first. Tasks hold 1 MB for each learned language.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from traceloom.llm import arrays
from traceloom.llm.registry import query
from traceloom.llm.store import materialize, small_batches
from traceloom.sources.tables import read_table

BITS = 18
ORDERS = (1, 2, 3, 4)
_FOLD = np.full(256, 32, np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_ODD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


def grams(data: np.ndarray) -> list[np.ndarray]:
    """For each order the presence bit of the n-gram that starts at each byte."""
    b = _FOLD[data]
    out, value = [], np.zeros(len(b), np.uint32)
    for n in ORDERS:
        if len(b) >= n:
            value = value[: len(b) - n + 1] | (b[n - 1 :] << np.uint32(8 * (n - 1)))
        else:
            value = value[:0]
        h = (value ^ (value >> np.uint32(15))) * np.uint32(_ODD[n - 1])
        out.append(((h ^ (h >> np.uint32(13))) * np.uint32(0x165667B1) >> np.uint32(32 - BITS)).astype(np.int32))
    return out


def presence(texts: pa.Array):
    """Each row's distinct presence bits, in row order."""
    data, offsets = arrays.text_bytes(texts)
    last = np.zeros(1 << BITS, np.int64)
    for i, j in arrays.passes(offsets):
        start = offsets[i]
        by_order = grams(data[start : offsets[j]])
        for r in range(i, j):
            s, e = offsets[r] - start, offsets[r + 1] - start
            bits = np.concatenate([g[s : max(s, e - n + 1)] for n, g in zip(ORDERS, by_order, strict=True)])
            at = np.arange(len(bits))
            last[bits] = at
            yield bits[last[bits] == at]


def with_key(docs: DataFrame) -> DataFrame:
    """``key, lang, text, learn``: learn marks rows that may be learned from; rows equal in id, language and text share a key."""
    id_ = F.col("doc_id").cast("long")
    learn = F.coalesce(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.crc32(id_.cast("string").cast("binary")) % 4 != 2), F.lit(False))
    return docs.select(F.xxhash64(id_, "lang", "text").alias("key"), F.col("lang").cast("string"), F.col("text").cast("string"), learn.alias("learn"))


def training(keyed: DataFrame, most_rows: int, landmarks: int) -> tuple[dict, set, list]:
    """Keys of training rows with their language, at most ``most_rows``: the smallest keys of each language, as many of each.
    With more languages than ``most_rows`` only so many are learned, which that bound means. Also the keys of landmarks."""
    # one row a key, dealt by key; of each language only keys below a hash that about twice the share stays below are ranked
    keys = materialize(keyed.where("learn").groupBy("lang", "key").agg(F.count(F.lit(1)).alias("n")).select("lang", "key"), "keys")
    sizes = keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    langs = sizes.count()
    share = max(1, most_rows // max(1, langs))
    unit = (F.col("key").cast("double") + 2.0**63) / 2.0**64
    few = keys.join(F.broadcast(sizes) if langs <= 100_000 else sizes, "lang").where(unit * F.col("n") <= share + 8 * share**0.5 + 50).select("lang", "key")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    first = few.withColumn("place", place).where(F.col("place") <= share)
    got = first.orderBy("place", "lang", "key").limit(most_rows).collect()
    chosen = {r.key: r.lang for r in got}
    each = max(1, landmarks // max(1, langs))
    marks = {r.key for r in [r for r in got if r.place <= each][:landmarks]}
    return chosen, marks, sorted(set(chosen.values()))


def fit(docs: DataFrame, most_rows: int = 4_000, landmarks: int = 200, ridge: float = 1e-3) -> tuple[list, np.ndarray]:
    """Languages, and each presence bit's weight for each language."""
    keyed = with_key(docs)
    chosen, marks, langs = training(keyed, most_rows, landmarks)
    if not chosen:
        return [], np.zeros((1 << BITS, 0), np.float32)
    texts = keyed.where("learn").select("key", "text")

    def taken(batches, wanted):
        for b in batches:
            at = [k for k, i in enumerate(b.column(0).to_pylist()) if i in wanted]
            if at:
                some = b.take(pa.array(at))
                yield some.column(0).to_pylist(), list(presence(some.column(1)))

    def show(batches):
        for ids, bits in taken(batches, marks):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([np.sort(x) for x in bits], pa.list_(pa.int32()))], ["id", "bits"])

    # one row a key, however often it is repeated
    shown = texts.mapInArrow(show, "id long, bits array<int>").groupBy("id").agg(F.min("bits").alias("bits")).toArrow().to_pylist()
    first = {r["id"]: np.array(r["bits"], np.int64) for r in sorted(shown, key=lambda r: r["id"])}
    sets = [first[i] for i in sorted(first) if len(first[i])]
    if not sets:
        return [], np.zeros((1 << BITS, 0), np.float32)
    # presence matrix of the landmarks over the bits that any of them has, rows scaled by the root of their size
    used = np.unique(np.concatenate(sets))
    matrix = np.zeros((len(used), len(sets)), np.float32)
    for k, s in enumerate(sets):
        matrix[np.searchsorted(used, s), k] = 1 / np.sqrt(len(s))
    shared = docs.sparkSession.sparkContext.broadcast((used, matrix, chosen))  # bounded by the landmarks' number

    def products(batches):
        used, matrix, chosen = shared.value
        where = np.full(1 << BITS, -1, np.int64)
        where[used] = np.arange(len(used))
        for ids, bits in taken(batches, chosen):
            for s in range(0, len(ids), 64):
                rows = np.zeros((len(ids[s : s + 64]), len(used)), np.float32)
                for r, x in enumerate(bits[s : s + 64]):
                    known = where[x]
                    rows[r, known[known >= 0]] = 1 / np.sqrt(max(1, len(x)))
                k = rows @ matrix
                yield pa.RecordBatch.from_arrays([pa.array(ids[s : s + 64], pa.int64()), pa.array(list(k), pa.list_(pa.float32()))], ["id", "k"])

    table = texts.mapInArrow(products, "id long, k array<float>").groupBy("id").agg(F.min("k").alias("k")).toArrow()
    ids = table.column("id").to_pylist()
    order = np.argsort(np.array(ids, np.int64), kind="stable")
    k_nm = np.array(table.column("k").to_pylist(), float)[order]
    y = np.array([[float(chosen[ids[o]] == lang) for lang in langs] for o in order])
    k_mm = (matrix.T @ matrix).astype(float)
    m = len(sets)
    a = np.linalg.solve(k_nm.T @ k_nm + ridge * len(k_nm) * k_mm + 1e-6 * len(k_nm) * np.eye(m), k_nm.T @ y)
    weights = np.zeros((1 << BITS, len(langs)), np.float32)
    weights[used] = matrix @ a
    return langs, weights


def identify(docs: DataFrame, most_rows: int = 4_000, landmarks: int = 200) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row; needs ``doc_id, text, lang``."""
    small_batches(docs.sparkSession)
    langs, weights = fit(docs, most_rows, landmarks)
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** 18 numbers a language

    def scan(batches):
        w = shared.value
        for b in batches:
            texts = b.column(1)
            pred, score = [], []
            for r, bits in enumerate(presence(texts)):
                best, value = "und", 0.0
                text = texts[r].as_py()
                if langs and text and any(map(str.isalpha, text)):
                    out = w[bits].sum(axis=0, dtype=np.float64) / np.sqrt(len(bits))
                    at = int(np.argmax(out))
                    best, value = langs[at], float(min(1.0, max(0.0, out[at])))
                pred.append(best)
                score.append(value)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(scan, "doc_id long, lang_pred string, score double")


@query("op5_language_id")
def op5_language_id(spark, sf_dir):
    """Language of every document."""
    found = identify(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return found.select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).alias("held_out"), "lang_pred", "score")
