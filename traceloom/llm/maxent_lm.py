"""Hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(member | class, history) * P(word | member). Classes are ranges of word endings (the
last two bytes), cut so that each holds about the same mass of training tokens, whatever the vocabulary. A class's most
frequent words are members of their own, where the last factor is 1; its other words fall into TAILS members by hash, in
which the word is the only feature, for which maximum entropy has the closed form of smoothed counts. Those members keep room
for unseen words.

Both softmaxes sum hashed feature rows: the word before, the two words before as one, and the words two and three places
before (skips); for the members without the last, and hashed together with the class.

Training runs ROUNDS rounds of gradient updates, each over its own part of the texts (by hash), so every training text takes part
once. In a round each task runs AdaGrad from the current weights, and a row's change is the mean of the tasks' changes
weighted by how often each met the row; the rows' squared gradients are carried on the same way.

Counts are exact over all training tokens, by 64-bit token hash, and stay distributed. Tasks get the counts of the most
frequent words, a bounded number; counts of all other tokens join by hash. One pass gives what a text's frequent tokens and
its classes add to the scores, and the list of its other tokens; their part is added after the join.

Rows: a null text is empty: only its end token counts. A null id is training data. Repeated ids keep their rows. With no
training tokens, N and V are 0, and the model is uniform over classes. Texts of any length are read whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm import arrays
from traceloom.llm.registry import query
from traceloom.llm.store import materialize, most_frequent, small_batches
from traceloom.sources.tables import read_table

DELTA = 0.1
#: Words whose counts every task holds: 16 bytes each.
FREQUENT = 1 << 18
#: Classes; members of each class, the last TAILS of which hold the words that are no member of their own.
CLASSES, MEMBERS, TAILS = 32, 32, 4
#: Feature rows of the class softmax: the word before, the two before, skips of two and three; of the members': the first three.
SPANS = ((0, 4096), (4096, 4096), (8192, 2048), (10240, 2048))
ROWS = 12288
MEMBER_ROWS = 1 << 15
ROUNDS = 4
#: Tokens that a training task reads at least, about, so that the weights it sends are few against what it reads.
TASK_TOKENS = 400_000
BLOCK = 1024
END, START = np.uint64(0x1234567890ABCDE1), np.uint64(0x0FEDCBA987654323)
#: Tokens of a training step, and of a scoring step.
MINIBATCH, SCORED = 16384, 4096


def sequences(texts: pa.Array):
    """Per pass: first row, each token's hash, ending, row and the hashes of the three tokens before it."""
    data, offsets = arrays.text_bytes(texts)
    for i, j in arrays.passes(offsets):
        part = data[offsets[i] : offsets[j]]
        tokens = arrays.Tokens(part, offsets[i : j + 1] - offsets[i])
        rows = j - i
        n = len(tokens.hash) + rows
        at = np.arange(len(tokens.hash)) + tokens.row()
        h = np.full(n, END, np.uint64)
        h[at] = tokens.hash
        ending = np.zeros(n, np.int32)
        last = arrays.LOWER[part[tokens.end - 1]].astype(np.int32) if len(at) else np.zeros(0, np.int32)
        two = np.where(tokens.end - tokens.start > 1, arrays.LOWER[part[np.maximum(tokens.end - 2, 0)]] if len(at) else 0, 0)
        ending[at] = last + 256 * two.astype(np.int32)
        row = np.repeat(np.arange(rows), np.diff(tokens.first) + 1)
        before = []
        for k in (1, 2, 3):
            p = np.full(n, START, np.uint64)
            p[k:] = np.where(row[k:] == row[:-k], h[:-k], START) if n > k else p[k:]
            before.append(p)
        yield i, h, ending, row, before


def feature_rows(before: list) -> np.ndarray:
    """Four hashed feature rows for each token."""
    p1, p2, p3 = before
    keys = (p1, p1 ^ arrays.mix(p2), arrays.mix(p2 ^ np.uint64(2)), arrays.mix(p3 ^ np.uint64(3)))
    return np.stack([s + (arrays.mix(k) % np.uint64(size)).astype(np.int64) for (s, size), k in zip(SPANS, keys, strict=True)])


def member_rows(before: list, k: np.ndarray) -> np.ndarray:
    """Three hashed feature rows for each token, by its class."""
    p1, p2, _ = before
    own = (k.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    keys = (p1, p1 ^ arrays.mix(p2), arrays.mix(p2 ^ np.uint64(2)))
    third = np.uint64(MEMBER_ROWS // 4)
    sizes = (third, third * np.uint64(2), third)
    first = (0, int(third), 3 * int(third))
    return np.stack([f + (arrays.mix(x ^ own) % n).astype(np.int64) for f, n, x in zip(first, sizes, keys, strict=True)])


class Shared:
    """What every task holds: frequent words' hashes and counts, the class of each ending and the members of classes.
    ``top``: hash, count, ending of frequent words; ``groups``: ending, tail, tokens, words of all."""

    def __init__(self, top: list, groups: list, n: int, v: int):
        order = np.argsort(np.array([h for h, _, _ in top], np.int64).view(np.uint64)) if top else np.zeros(0, np.int64)
        self.hash = np.array([top[i][0] for i in order], np.int64).view(np.uint64)
        self.count = np.array([top[i][1] for i in order], np.int64)
        self.n, self.v = n, v
        mass = np.zeros(65536)
        for e, _, c, _ in groups:
            mass[e] += c
        # classes: the place of an ending's middle in the running mass, so that each holds about as much
        middle = np.cumsum(mass) - mass / 2
        self.of_ending = np.minimum((middle * (CLASSES / max(1.0, mass.sum()))).astype(np.int64), CLASSES - 1)
        leaf_mass, size = np.zeros((CLASSES, MEMBERS)), np.zeros((CLASSES, MEMBERS))
        for e, tail, c, words in groups:
            leaf_mass[self.of_ending[e], MEMBERS - TAILS + tail] += c
            size[self.of_ending[e], MEMBERS - TAILS + tail] += words
        taken, own = np.zeros(CLASSES, np.int64), []
        for h, c, e in sorted(top, key=lambda r: (-r[1], r[0])):
            k = self.of_ending[e]
            if taken[k] < MEMBERS - TAILS:
                tail = MEMBERS - TAILS + int(np.uint64(h & (2**64 - 1)) % np.uint64(TAILS))
                leaf_mass[k, tail] -= c
                size[k, tail] -= 1
                leaf_mass[k, taken[k]], size[k, taken[k]] = c, 1
                own.append((h, int(taken[k])))
                taken[k] += 1
        own.sort(key=lambda r: r[0] & (2**64 - 1))
        self.own = np.array([h for h, _ in own], np.int64).view(np.uint64)
        self.own_member = np.array([m for _, m in own], np.int64)
        single = np.arange(MEMBERS) < MEMBERS - TAILS
        self.log_mass = np.where(single, np.log10(leaf_mass + DELTA), np.log10(np.maximum(leaf_mass, 0) + DELTA * (size + 1)))
        self.bias = np.log((leaf_mass.sum(axis=1) + 1) / (leaf_mass.sum() + CLASSES)).astype(np.float32)
        used = (size > 0) | ~single
        self.member_bias = np.where(used, np.log((leaf_mass + 0.5) / (leaf_mass.sum(axis=1, keepdims=True) + 0.5 * MEMBERS)), -30).astype(np.float32)

    def leaves(self, h: np.ndarray, ending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and member of each token."""
        member = MEMBERS - TAILS + (h % np.uint64(TAILS)).astype(np.int64)
        if len(self.own):
            at = np.minimum(np.searchsorted(self.own, h), len(self.own) - 1)
            member = np.where(self.own[at] == h, self.own_member[at], member)
        return self.of_ending[ending], member

    def counts(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each token is a frequent word, and its count."""
        if not len(self.hash):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return self.hash[at] == h, self.count[at]


def log_softmax(w: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = w[rows[0]]
    for r in rows[1:]:
        z += w[r]
    z += bias
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def log_of(w: np.ndarray, bias: np.ndarray, rows: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Log probability of each target, a bounded number of tokens at a time; ``bias`` is one row, or one a token."""
    parts = [slice(a, a + SCORED) for a in range(0, len(y), SCORED)]
    return np.concatenate([log_softmax(w, bias if bias.ndim == 1 else bias[p], rows[:, p])[np.arange(len(y[p])), y[p]] for p in parts])


def learn(w: np.ndarray, bias: np.ndarray, rows: np.ndarray, y: np.ndarray, square: np.ndarray, met: np.ndarray, rate: float) -> None:
    """One AdaGrad step, in place, with one step size a row; ``met`` counts how often each row was active."""
    g = w[rows[0]]
    for r in rows[1:]:
        g += w[r]
    g += bias
    g -= g.max(axis=1, keepdims=True)
    np.exp(g, out=g)
    g *= -1 / g.sum(axis=1, keepdims=True)
    g[np.arange(len(y)), y] += 1
    for r in rows:
        order = np.argsort(r.astype(np.uint16), kind="stable")
        sorted_ = r[order]
        edge = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        at = sorted_[edge]
        total = np.add.reduceat(g[order], edge, axis=0)
        square[at] += np.einsum("ij,ij->i", total, total) / total.shape[1]
        total *= (rate / np.sqrt(square[at]))[:, None]
        w[at] += total
        met[at] += np.diff(np.concatenate([edge, [len(r)]]))


def token_counts(texts: DataFrame) -> DataFrame:
    """``h, e, c`` of training tokens: hash, ending and count. A task merges its tokens before they are dealt out."""

    def scan(batches):
        kept, size = [], 0

        def merged():
            h, c = np.concatenate([k[0] for k in kept]), np.concatenate([k[2] for k in kept])
            e = np.concatenate([k[1] for k in kept])
            u, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            return u, e[first], np.bincount(inverse, c, len(u)).astype(np.int64)

        for b in batches:
            for _, h, e, _, _ in sequences(b.column(0)):
                kept.append((h, e, np.ones(len(h), np.int64)))
                size += len(h)
                if size > 3_000_000:
                    kept = [merged()]
                    size = len(kept[0][0]) + 1_000_000 if len(kept[0][0]) > 2_000_000 else len(kept[0][0])
                    if len(kept[0][0]) > 2_000_000:
                        yield batch(*kept[0])
                        kept, size = [], 0
        if kept:
            yield batch(*merged())

    def batch(h, e, c):
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(e, pa.int32()), pa.array(c, pa.int64())], ["h", "e", "c"])

    return texts.mapInArrow(scan, "h long, e int, c long").groupBy("h").agg(F.min("e").alias("e"), F.sum("c").alias("c"))


class Weights:
    """Both softmaxes' weights in one array of rows, the class softmax's first, and each row's squared gradients."""

    def __init__(self, rows: int = ROWS + MEMBER_ROWS):
        self.w, self.square = np.zeros((rows, CLASSES), np.float32), np.ones(rows, np.float32)

    def part(self, members: bool) -> tuple[np.ndarray, np.ndarray]:
        at = slice(ROWS, None) if members else slice(ROWS)
        return self.w[at], self.square[at]


def train(texts: DataFrame, shared: Shared, rounds: int = ROUNDS, rate: float = 0.2) -> Weights:
    """Weights of both softmaxes; round i learns from the texts whose hash is i modulo ``rounds``."""
    spark = texts.sparkSession
    state = Weights()
    rows = len(state.w)
    held = spark.sparkContext.broadcast(shared)
    schema = "block int, met binary, change binary, square binary"
    names = ["block", "met", "change", "square"]
    for i in range(rounds):
        start = spark.sparkContext.broadcast(state)

        def step(batches, start=start):
            s, begin = held.value, start.value
            mine = Weights()
            mine.w, mine.square, met = begin.w.copy(), begin.square.copy(), np.zeros(rows, np.int64)
            (w1, q1), (w2, q2) = mine.part(False), mine.part(True)
            for b in batches:
                for _, h, e, _, before in sequences(b.column(0)):
                    k, m = s.leaves(h, e)
                    f, g = feature_rows(before), member_rows(before, k)
                    for a in range(0, len(h), MINIBATCH):
                        p = slice(a, a + MINIBATCH)
                        learn(w1, s.bias, f[:, p], k[p], q1, met[:ROWS], rate)
                        learn(w2, s.member_bias[k[p]], g[:, p], m[p], q2, met[ROWS:], rate)
            if not met.any():
                return
            mine.w -= begin.w
            mine.w *= met[:, None]
            mine.square -= begin.square
            mine.square *= met
            blocks = [k for k in range(rows // BLOCK) if met[k * BLOCK : (k + 1) * BLOCK].any()]
            pack = lambda x, kind: pa.array([x[k * BLOCK : (k + 1) * BLOCK].astype(kind).tobytes() for k in blocks], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pack(met, np.float64), pack(mine.w, np.float32), pack(mine.square, np.float64)], names)

        def total(batches):
            sums: dict = {}
            for b in batches:
                for k, *parts in zip(*(b.column(c).to_pylist() for c in range(4)), strict=True):
                    new = [np.frombuffer(x, t).astype(np.float64) for x, t in zip(parts, (np.float64, np.float32, np.float64), strict=True)]
                    sums[k] = [a + b for a, b in zip(sums[k], new, strict=True)] if k in sums else new
            keys = sorted(sums)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), *(pa.array([sums[k][c].tobytes() for k in keys], pa.binary()) for c in range(3))], names)

        some = texts.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == i)
        some = some.coalesce(max(1, math.ceil(shared.n / rounds / TASK_TOKENS)))  # small partitions share a task
        table = some.mapInArrow(step, schema).repartition(rows // BLOCK, "block").mapInArrow(total, schema).toArrow()  # rows x CLASSES numbers
        new = Weights()
        new.w, new.square = state.w.copy(), state.square.copy()
        for k, m, c, q in zip(*(table.column(c).to_pylist() for c in range(4)), strict=True):
            at, times = slice(k * BLOCK, (k + 1) * BLOCK), np.maximum(np.frombuffer(m), 1)
            new.w[at] += (np.frombuffer(c).reshape(BLOCK, CLASSES) / times[:, None]).astype(np.float32)
            new.square[at] += (np.frombuffer(q) / times).astype(np.float32)
        state = new
    return state


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    id_ = F.col("doc_id").cast("long")
    out = F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 10 == 0, F.lit(False))
    training = docs.where(~out).select(F.col("text").cast("string").alias("text"))
    counts = materialize(token_counts(training), "counts")
    sums = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    top = [tuple(r) for r in most_frequent(counts, "c", FREQUENT).select("h", "c", "e").toArrow().to_pandas().sort_values(["c", "h"], ascending=[False, True]).itertuples(index=False)]
    # the tail of a word is its hash modulo TAILS, a power of two: 65,536 endings by TAILS rows at most
    groups = [tuple(r) for r in counts.groupBy("e", F.pmod("h", F.lit(TAILS)).cast("int").alias("tail")).agg(F.sum("c"), F.count(F.lit(1))).orderBy("e", "tail").collect()]
    shared = Shared(top, groups, int(sums[0] or 0), int(sums[1]))
    weights = train(training, shared, rounds)
    held = spark.sparkContext.broadcast((shared, weights))

    def scan(batches):
        s, w = held.value
        base_n = math.log10(s.n + DELTA * (s.v + 1))
        for b in batches:
            ids, flags = b.column(0), b.column(1)
            for i, h, e, row, before in sequences(b.column(2)):
                rows = row[-1] + 1
                known, c = s.counts(h)
                own = np.where(known, np.log10(np.maximum(c, 1) + DELTA), 0)
                k, m = s.leaves(h, e)
                of_class = (log_of(w.part(False)[0], s.bias, feature_rows(before), k) + log_of(w.part(True)[0], s.member_bias[k], member_rows(before, k), m)) / math.log(10)
                n = np.bincount(row, minlength=rows)
                local = np.bincount(row, own, rows)
                rest = np.bincount(row, of_class - s.log_mass[k, m], rows)
                bounds = np.concatenate([[0], np.cumsum(np.bincount(row[~known], minlength=rows))])
                rare = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(h[~known].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, rows), flags.slice(i, rows), pa.array(n, pa.int64()), pa.array(np.bincount(row[known], minlength=rows), pa.int64()), pa.array(local - n * base_n), pa.array(local + rest), rare],
                    ["doc_id", "held_out", "n_tokens", "known", "base", "model", "rare"],
                )

    schema = "doc_id long, held_out boolean, n_tokens long, known long, base double, model double, rare array<long>"
    first = docs.select(id_.alias("doc_id"), out.alias("held_out"), F.col("text").cast("string")).mapInArrow(scan, schema)
    first = materialize(first.withColumn("row", F.monotonically_increasing_id()), "scores")
    rare = first.select("row", F.explode("rare").alias("h")).groupBy("h", "row").agg(F.count(F.lit(1)).alias("k"))
    added = rare.join(counts.select("h", "c"), "h", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("k")).otherwise(0)).alias("more"), F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + DELTA)).alias("part")
    )
    part, more = F.coalesce("part", F.lit(0.0)), F.coalesce("more", F.lit(0))
    return first.drop("rare").join(added, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + more).cast("long").alias("n_known"), F.lit(shared.n).cast("long").alias("train_tokens"),
        (F.col("base") + part).alias("base_score"), (F.col("model") + part).alias("score"),
    )


@query("op4_maxent_lm")
def op4_maxent_lm(spark, sf_dir):
    """Unigram and maximum-entropy log probabilities of every document."""
    return score(read_table(spark, sf_dir, "documents", "doc_id", "text"))
