"""Toxicity scores after noisy-channel deobfuscation.

A text is read as a channel's output: leetspeak replaced letters, spaces or marks were put between letters, letters were
repeated. Only suspicious spans branch; a clean character is a single arc of the lattice, so decoding it changes nothing:

* ``leet``: any word of letters that holds a digit or mark; a mark is one of its letters, or itself, or nothing;
* ``spacing``: three or more single characters apart by one space or mark each; each gap may vanish;
* ``repeat``: a letter three or more times in a row; it is kept once or twice.

Viterbi decoding picks the path with the best sum of a character trigram language model's and the channel's log
probabilities. The language model counts the words of *all* documents; it needs no labels.

The score is a logistic regression on restored words and word stems that occur more in toxic than in other texts. It learns
from at most ``most_rows`` labelled rows (those with the smallest hash of the id), which is the documented bound. The model keeps the
``most_features`` words and stems that tell the classes apart best. Words are runs of three or more Latin letters: a text in another script has none
and scores as one without features.

Rows: null and empty texts score as a text without features. Repeated ids in the labels count with their largest label,
repeated ids of documents once in learning.
With no labelled rows, or labels of one class, every score is the smoothed share of toxic labels, which is 0.05 without any, so
that nothing is rejected for want of labels. Texts are scored whole.
"""

from __future__ import annotations

import math
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm import arrays
from traceloom.llm.registry import query
from traceloom.llm.store import discard, materialize, small_batches, smallest_by_hash
from traceloom.sources.tables import read_table

# What a mark or digit may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l",
}
#: Log probabilities of the channel: a letter written as a mark; a mark that stands for itself; a mark or gap put in.
SUBSTITUTED, ITSELF, INSERTED, REPEATED = math.log(0.1), math.log(0.02), math.log(0.03), math.log(0.2)
_L = "a-zà-öø-ÿœß"
MARKS = "".join(LEET)
_M = re.escape(MARKS)
#: The rest of a word; points, stars and dashes only before more of it.
_REST = rf"[{_L}{_M}]*+(?:[*._-]++[{_L}{_M}]++)*+"
# repeat and leet begin at a word's start only, so that a long word isn't tried from each of its letters; a word of two
# characters holds no word that counts
SUSPICIOUS = re.compile(
    rf"(?<![{_L}0-9])(?:[{_L}0-9@$!|+](?:[ ]|[.*_-])){{2,}}[{_L}0-9@$!|+](?![{_L}0-9])"  # spacing
    rf"|(?<![{_L}])[{_L}]*([{_L}])\1\1{_REST}"  # repeat
    rf"|(?<![{_L}{_M}])(?=[{_L}{_M}*._-]{{3}})(?:[{_L}]++(?=[*._-]*+[{_M}]|[*._-]++[{_L}])|[{_M}]++(?=[{_L}])){_REST}"  # leet
)
WORDS = re.compile(rf"[{_L}]{{3,}}")
STEM = 5
LETTERS = 27
#: Bytes that stand for a letter of the language model; accents fold to their base letter's byte pair's first: other.
SYMBOL = np.zeros(256, np.int64)
SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[65:91] = np.arange(1, 27)


def char_counts(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigram counts over all texts' letters, a word's border as 0: 27 ** 3 numbers, whatever the input's size."""

    def scan(batches):
        total = np.zeros(LETTERS**3, np.int64)
        for b in batches:
            data, offsets = arrays.text_bytes(b.column(0))
            for i, j in arrays.passes(offsets):
                s = np.concatenate([[0, 0], SYMBOL[data[offsets[i] : offsets[j]]], [0]])
                total += np.bincount(s[:-2] * LETTERS**2 + s[1:-1] * LETTERS + s[2:], minlength=LETTERS**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["code", "n"])

    table = df.select(df[text_col].cast("string")).mapInArrow(scan, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(LETTERS**3, np.int64)
    counts[np.asarray(table.column("code"))] = np.asarray(table.column("n"))
    return counts


class CharModel:
    """Interpolated character trigram log probabilities."""

    def __init__(self, counts: np.ndarray):
        c3 = counts.reshape(LETTERS, LETTERS, LETTERS).astype(float)
        c2 = c3.sum(axis=0)
        c1 = c2.sum(axis=0)
        p1 = (c1 + 1) / (c1.sum() + LETTERS)
        p2 = (c2 + 5 * p1) / (c2.sum(axis=1, keepdims=True) + 5)
        p3 = (c3 + 5 * p2) / (c3.sum(axis=2, keepdims=True) + 5)
        self.log = np.log(p3).tolist()

    @staticmethod
    def code(ch: str) -> int:
        return ord(ch) - 96 if "a" <= ch <= "z" else 0


def arcs(span: str) -> list[list[tuple[str, float]]]:
    """The lattice: for each character what it may stand for, with the channel's log probability."""
    out = []
    spaced = len(span) > 2 and all(not c.isalnum() for c in span[1::2]) and len(span) % 2 == 1
    run = 0
    tripled = {c for c in set(span) if c * 3 in span}
    for i, c in enumerate(span):
        run = run + 1 if i and c == span[i - 1] else 1
        if spaced and i % 2 == 1:
            out.append([("", INSERTED), (" ", ITSELF)])
        elif c in LEET:
            out.append([(x, SUBSTITUTED) for x in LEET[c]] + [(c, ITSELF), ("", INSERTED)])
        elif c in "*._-":
            out.append([("", INSERTED), (c, ITSELF)])
        elif run >= 2 and c in tripled:
            out.append([("", REPEATED)] if run > 2 else [("", REPEATED), (c, REPEATED)])
        else:
            out.append([(c, 0.0)])
    return out


def viterbi(span: str, log: list) -> str:
    """The best path of the span's lattice; its state is the last two characters' codes, 729 at most."""
    states = {(0, 0): (0.0, None)}
    for choices in arcs(span):
        new: dict = {}
        for (x, y), (score, back) in states.items():
            for c, cost in choices:
                z = CharModel.code(c) if c else None
                key, s = ((x, y), score + cost) if z is None else ((y, z), score + cost + log[x][y][z])
                if key not in new or s > new[key][0]:
                    new[key] = (s, (back, c) if c else back)
        states = new
    _, back = max(((s + log[x][y][0], b) for (x, y), (s, b) in states.items()), key=lambda v: v[0])
    out = []
    while back:
        back, c = back
        out.append(c)
    return "".join(reversed(out))


class Restorer:
    """Restores texts; one for each task, decoding each distinct span once, long ones each time."""

    def __init__(self, model: CharModel):
        self.long = lambda span: viterbi(span, model.log)
        self.decode = lru_cache(50_000)(self.long)

    def __call__(self, text: str) -> tuple[str, int]:
        """The lower-cased restored text and the number of spans that changed."""
        changed = 0

        def put(m):
            nonlocal changed
            span = m[0]
            new = self.decode(span) if len(span) <= 64 else self.long(span)
            changed += new != span
            return new

        return SUSPICIOUS.sub(put, text.lower()), changed


def features(words: set) -> set:
    """Words and their stems."""
    return words | {w[:STEM] + "*" for w in words if len(w) > STEM}


def train_rows(labels: DataFrame, most_rows: int) -> DataFrame:
    """At most ``most_rows`` labelled training rows, by hash of the id: ``id, y``."""
    id_ = F.col("doc_id").cast("long")
    seen = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (F.crc32(id_.cast("string").cast("binary")) % 4 != 2))
    return smallest_by_hash(seen.groupBy(id_.alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("y")), ["id"], most_rows)


def fit(docs: DataFrame, labels: DataFrame, model: CharModel, most_rows: int = 20_000, most_features: int = 4_000) -> dict:
    """``bias`` and ``weights`` by word. Reads the documents once, for the labelled rows' words."""
    sample = train_rows(labels, most_rows).toArrow()  # most_rows ids
    ids = {i: y for i, y in zip(sample.column("id").to_pylist(), sample.column("y").to_pylist(), strict=True)}
    n1, n = sum(ids.values()), len(ids)
    rate = (n1 + 0.1) / (n + 2)
    bias = math.log(rate / (1 - rate))
    if not 0 < n1 < n:
        return {"bias": bias, "weights": {}}
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def labelled(batches):
        restore = Restorer(model)
        for b in batches:
            out = [(t, ids[t], sorted(features(set(WORDS.findall(restore(b.column(1)[i].as_py() or "")[0]))))) for i, t in enumerate(b.column(0).to_pylist()) if t in ids]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.list_(pa.string()))], ["id", "y", "words"])

    # a repeated id counts once, with the smallest of its word lists; most_rows rows at most
    rows = materialize(texts.mapInArrow(labelled, "id long, y int, words array<string>").groupBy("id", "y").agg(F.min("words").alias("words")), "labelled")
    n0 = n - n1
    counted = rows.select(F.explode("words").alias("w"), "y").groupBy("w").agg(F.sum(1 - F.col("y")).alias("c0"), F.sum("y").alias("c1"))
    # z of the difference of the shares, and the ratio: both are large for words that mark a class
    share = (F.col("c0") + F.col("c1")) / n
    z = (F.col("c1") / n1 - F.col("c0") / n0) / F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)
    best = counted.where((F.col("c1") >= 2) & (z > 3)).orderBy(z.desc(), "w").limit(most_features).toArrow()
    vocabulary = {w: k for k, w in enumerate(best.column("w").to_pylist())}
    if not vocabulary:
        discard(rows)
        return {"bias": bias, "weights": {}}

    def project(batches):
        for b in batches:
            out = [sorted(vocabulary[w] for w in set(words) & vocabulary.keys()) for words in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int32()))], ["y", "x"])

    table = rows.orderBy("id").select("y", "words").mapInArrow(project, "y int, x array<int>").toArrow()
    discard(rows)
    y = np.asarray(table.column("y"), dtype=float)
    x = table.column("x").combine_chunks()
    sizes, flat = np.diff(np.asarray(x.offsets)), np.asarray(x.flatten())
    row = np.repeat(np.arange(len(y)), sizes)
    w, b, g2, gb = np.zeros(len(vocabulary)), bias, np.full(len(vocabulary), 1e-8), 1e-8
    for _ in range(300):  # full-batch AdaGrad with a ridge; the design is a bounded sparse matrix
        p = 1 / (1 + np.exp(-(b + np.bincount(row, w[flat], len(y)))))
        g = np.bincount(flat, (p - y)[row], len(w)) / len(y) + 1e-5 * w
        d = (p - y).mean()
        g2, gb = g2 + g * g, gb + d * d
        w, b = w - 0.3 * g / np.sqrt(g2), b - 0.3 * d / math.sqrt(gb)
    return {"bias": float(b), "weights": {v: float(w[k]) for v, k in vocabulary.items()}}


def score_texts(df: DataFrame, model: CharModel, fitted: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, restored, n_restored`` for every row: score, lower-cased restored text, spans that were changed."""
    small_batches(df.sparkSession)
    bias, weights = fitted["bias"], fitted["weights"]

    def scan(batches):
        restore = Restorer(model)
        for b in batches:
            score, text, changed = [], [], []
            for t in b.column(1).to_pylist():
                clean, n = restore(t or "")
                z = bias + sum(weights[w] for w in sorted(features(set(WORDS.findall(clean))) & weights.keys()))
                score.append(1 / (1 + math.exp(-max(-60.0, min(60.0, z)))))
                text.append(clean)
                changed.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(score, pa.float64()), pa.array(text, pa.string()), pa.array(changed, pa.int64())], ["doc_id", "score", "restored", "n_restored"])

    return df.select(df[id_col].cast("long"), df[text_col].cast("string")).mapInArrow(scan, "doc_id long, score double, restored string, n_restored long")


def toxicity(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000) -> DataFrame:
    """Learn from ``labels`` and score every document."""
    small_batches(docs.sparkSession)
    model = CharModel(char_counts(docs))
    return score_texts(docs, model, fit(docs, labels, model, most_rows))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, most_rows: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns; decided in the scan's tasks, without a shuffle."""
    small_batches(docs.sparkSession)
    model = CharModel(char_counts(docs))
    fitted = fit(docs, labels, model, most_rows)
    bias, weights = fitted["bias"], fitted["weights"]
    at = docs.columns.index("text")
    least = math.log(threshold / (1 - threshold))

    def scan(batches):
        restore = Restorer(model)
        for b in batches:
            keep = [bias + sum(weights[w] for w in sorted(features(set(WORDS.findall(restore(t or "")[0]))) & weights.keys())) < least for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)


def held_out(id_: int) -> bool:
    return zlib.crc32(str(id_).encode()) % 4 == 2


@query("op1_toxicity")
def op1_toxicity(spark, sf_dir):
    """Score and prediction for every document."""
    scored = toxicity(read_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "labels", "doc_id", "toxic"))
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_restored")
