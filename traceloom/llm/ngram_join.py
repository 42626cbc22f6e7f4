"""N-gram Jaccard self-join by multiple global orders, reported as one class per document.

A document's set holds the 64-bit hashes of its distinct five-word shingles. Two documents link when
100 * intersection >= 75 * union. Sets that link share one of the first n - ceil(0.75 n) + 1 elements under *any* global
order, so a pair must share a prefix element under each of several orders before its sets are compared. Every order puts
frequent shingles last (found on a sixteenth of the documents; which shingles these are changes the work, never the result).

1. One scan gives each document's set size and a 128-bit key of its set. Equal sets are one node from here on.
2. Postings of the first order's prefixes, one row per (shingle, node). Known frequent shingles are salted.
3. A shingle's short list gives all its pairs. A long list gives only the pairs with its two nodes of fewest rare shingles,
   per salt, and with the one of fewest over all salts, and stays. Two sets whose first common shingle is frequent share frequent ones only, so pairs of a frequent
   shingle's list must have frequent shingles enough, besides fitting sizes.
   Sets that link share more than one prefix shingle: of the prefix whose last rank is lower, all but as many as its set
   may lack. A pair's shared lists are counted, long ones bounded by how many each node is in, and pairs below go. Lists of
   frequent shingles don't count a pair whose frequent shingles don't suffice; they are bounded by how many its prefixes hold.
4. The nodes of the pairs left are posted again under the second and then the third order, and the same count is made there:
   a pair stays only if it shares prefix shingles enough under every order. No text has moved so far.
5. The pairs left are compared exactly; links make components.
6. In a long list that still holds several components, every node outside the largest one is paired with all nodes of
   other components, and steps 4 and 5 run on these. Pairs within one component need no test: their class is known.
   So no link between different components is lost, and no group emits all its pairs.

A node's number is the first half of its set's key. Sets of different keys with equal first halves are looked for, and the
number of such sets is made of both halves instead.

Rows: a null or empty text, or one of separators only, has an empty set, links with nothing and is its own class; with
fewer than five words the whole sequence is one shingle. Ids may repeat and keep their rows. Other columns are not read.
Equality of shingles is that of 64-bit hashes, of sets that of 128-bit keys.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm import arrays
from traceloom.llm.components import connected
from traceloom.llm.registry import query
from traceloom.llm.store import discard, materialize, most_frequent, small_batches
from traceloom.sources.tables import read_table

WIDTH = 5
#: Documents whose shingles are counted to find frequent ones: one in so many, and the least count among them.
SAMPLE, FREQUENT = 16, 6
#: Frequent shingles kept for the orders: 8 bytes each in every task.
MOST_FREQUENT = 500_000
#: A list up to this long gives all its pairs.
SHORT = 96
#: Nodes of one salt of a frequent shingle, about.
SALTED = 512
#: Salt of the rows that give a node's frequent shingles.
OWN = -2
#: Partitions hold so many postings, about.
PART_ROWS = 250_000
#: Pairs that meet one copy of a shared set.
FAN = 64
#: Text that verification unpacks at once, about.
PART_BYTES = 1_000_000
ORDERS = (0x0, 0x5851F42D4C957F2D, 0x14057B7EF767814F)


def sets_of(texts: pa.Array):
    """For passes over a text column: first row, and the distinct shingle hashes of each row in ascending order with
    each row's first."""
    data, offsets = arrays.text_bytes(texts)
    for i, j in arrays.passes(offsets):
        part = offsets[i : j + 1] - offsets[i]
        tokens = arrays.Tokens(data[offsets[i] : offsets[j]], part)
        h, first = arrays.shingles(tokens, WIDTH)
        row = np.repeat(np.arange(j - i), np.diff(first))
        for s, e in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            h[s:e].sort()  # far cheaper than one sort of all by row and hash
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        h, row = h[new], row[new]
        yield i, h, np.searchsorted(row, np.arange(j - i + 1))


def keys_of(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit key of each set: sums of two mixes of its elements and its size."""

    def total(x):
        c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
        return arrays.mix((c[first[1:]] - c[first[:-1]]) ^ (np.diff(first).astype(np.uint64) << np.uint64(32)))

    return total(arrays.mix(h ^ np.uint64(0xA5A5A5A5))), total(arrays.mix(h ^ np.uint64(0x3C3C3C3C77)))


def both(k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """A number made of both halves of a key."""
    return arrays.mix(k1 ^ arrays.mix(k2))


def nodes_of(h: np.ndarray, first: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """Each set's node; ``twice`` are the ascending first halves that several keys have."""
    k1, k2 = keys_of(h, first)
    if not len(twice):
        return k1
    place = np.minimum(np.searchsorted(twice, k1), len(twice) - 1)
    return np.where(twice[place] == k1, both(k1, k2), k1)


def prefix_size(n):
    """Elements of a set of n that any linked set must share one of."""
    return n - (3 * n + 3) // 4 + 1


class Frequent:
    """Frequent shingles in ascending order with their counts in the sample; a bit table spares most look-ups."""

    def __init__(self, h: np.ndarray, counts: np.ndarray):
        self.h, self.counts = h, counts
        self.bits = np.zeros(1 << 22, bool)
        self.bits[h >> np.uint64(42)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which elements of ``h`` are frequent, by position, and each one's place in the table."""
        at = np.flatnonzero(self.bits[h >> np.uint64(42)])
        if not len(self.h) or not len(at):
            return at[:0], at[:0]
        place = np.minimum(np.searchsorted(self.h, h[at]), len(self.h) - 1)
        ok = self.h[place] == h[at]
        return at[ok], place[ok]


#: SQL for the least number of prefix shingles that two linked sets of na and nb share, from the least intersection.
_NEED = "(75L * (na + nb) + 174) div 175"
LEAST_SHARED = "least({0}, {1})".format(*(f"{n} - (3 * {n} + 3) div 4 + 1 - ({n} - {_NEED})" for n in ("na", "nb")))


def rank(h: np.ndarray, order: int, frequent: Frequent) -> np.ndarray:
    """Place of each element in a global order: rare ones by a mix of their hash, frequent ones after, by count."""
    key = (arrays.mix(h ^ np.uint64(order)) if order else h) >> np.uint64(1)
    at, place = frequent.find(h)
    key[at] = np.uint64(2**63) + frequent.counts[place] * np.uint64(2**20) + (key[at] >> np.uint64(43))
    return key


def describe(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, th, n, k1, k2, alt, sample``: the text's hash, set size and key, the node's number if k1 is not unique, and
    the set itself for sampled keys."""

    def scan(batches):
        for b in batches:
            ids, hashes = b.column(0).cast(pa.int64()), b.column(2)
            for i, h, first in sets_of(b.column(1)):
                k1, k2 = keys_of(h, first)
                rows = len(first) - 1
                n = np.diff(first)
                kept = (k2 % np.uint64(SAMPLE) == 0) & (n > 0)
                sizes = np.where(kept, n, 0)
                taken = h[np.repeat(kept, n)].view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(taken))
                columns = [ids.slice(i, rows), hashes.slice(i, rows), pa.array(n, pa.int64()), *(pa.array(k.view(np.int64)) for k in (k1, k2, both(k1, k2))), lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "th", "n", "k1", "k2", "alt", "sample"])

    text = df[text_col].cast("string")
    return df.select(df[id_col].cast("long"), text, F.xxhash64(text)).mapInArrow(scan, "doc_id long, th long, n long, k1 long, k2 long, alt long, sample array<long>")


def frequent_of(found: DataFrame) -> Frequent:
    """The most frequent shingles of the sample, MOST_FREQUENT at most."""
    once = found.where(F.size("sample") > 0).dropDuplicates(["k1", "k2"])
    counts = once.select(F.explode("sample").alias("h")).groupBy("h").count().where(F.col("count") >= FREQUENT)
    counted = materialize(counts, "frequent")
    table = most_frequent(counted, "count", MOST_FREQUENT).toArrow()
    discard(counted)
    h = np.asarray(table.column("h")).view(np.uint64)
    order = np.argsort(h)
    return Frequent(h[order], np.asarray(table.column("count"))[order].astype(np.uint64))


class Filter:
    """A Bloom filter of at most 8 MB over ids: it spares reading sets that no pair needs, whatever its error."""

    def __init__(self, ids: DataFrame, count: int):
        self.bits = 1 << min(26, max(16, math.ceil(math.log2(max(1, count) * 12))))
        bit = lambda seed: F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(self.bits))
        spots = ids.select(F.explode(F.array(bit(1), bit(2), bit(3))).alias("p"))
        words = spots.groupBy(F.shiftright("p", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(pmod(p, 64) as int)))").alias("m"))
        table = words.toArrow()
        self.words = np.zeros(self.bits // 64, np.int64)
        self.words[np.asarray(table.column("w"))] = np.asarray(table.column("m"))


def chosen_rows(df: DataFrame, id_col: str, text_col: str, few: Filter | None):
    """The text column, with the places in ``few`` of each row's id, and a function that gives the texts of batches that pass."""
    text = df[text_col].cast("string").alias("text")
    if few is None:
        return df.select(text), lambda batches: (b.column(0) for b in batches)
    held = df.sparkSession.sparkContext.broadcast(few.words)  # 8 MB at most
    at = [F.pmod(F.xxhash64(F.lit(seed), df[id_col].cast("long")), F.lit(few.bits)) for seed in (1, 2, 3)]

    def passing(batches):
        words = held.value
        for b in batches:
            hit = np.ones(b.num_rows, bool)
            for c in (1, 2, 3):
                p = np.asarray(b.column(c))
                hit &= (words[p >> 6] >> (p & 63)) & 1 == 1
            if hit.any():
                yield b.column(0).take(pa.array(np.flatnonzero(hit)))

    return df.select(text, *(c.alias(f"p{i}") for i, c in enumerate(at))), passing


def postings(df: DataFrame, id_col: str, text_col: str, frequent: Frequent, twice: np.ndarray, order: int = 0, few: Filter | None = None) -> DataFrame:
    """``t, salt, node, n, f`` for an order's prefixes, of the rows that ``few`` lets pass, salt -1 for shingles that have no salts; ``f`` is the set's
    number of frequent shingles, or n if the shingle is rare. A task gives each of its nodes once. A node whose prefix holds
    frequent shingles has one more row, of salt OWN, with the node for t."""

    held = df.sparkSession.sparkContext.broadcast(frequent)  # bounded by MOST_FREQUENT
    rows, passing = chosen_rows(df, id_col, text_col, few)

    def scan(batches):
        common = held.value
        salts = np.maximum(common.counts * np.uint64(SAMPLE) // np.uint64(SALTED), 1)
        salts = np.uint64(1) << np.ceil(np.log2(salts)).astype(np.uint64)  # powers of two: lists of one group split alike
        seen: set[int] = set()
        for texts in passing(batches):
            for _, h, first in sets_of(texts):
                k1 = nodes_of(h, first, twice)
                n = np.diff(first)
                place = rank(h, ORDERS[order], common)
                often = np.diff(np.searchsorted(common.find(h)[0], first))
                kept, nodes = [], []
                for r, (k, m, s) in enumerate(zip(k1.tolist(), n.tolist(), first.tolist(), strict=False)):
                    if m and k not in seen:
                        seen.add(k)
                        p = prefix_size(m)
                        kept.append(s + np.argpartition(place[s : s + m], p - 1)[:p])
                        nodes.append(r)
                if not nodes:
                    continue
                sizes = [len(x) for x in kept]
                t, node, size = h[np.concatenate(kept)], np.repeat(k1[nodes], sizes), np.repeat(n[nodes], sizes)
                salt = np.full(len(t), -1, np.int64)
                at, where = common.find(t)
                f = size.copy()
                f[at] = np.repeat(often[nodes], sizes)[at]
                salt[at] = np.where(salts[where] > 1, arrays.mix(node[at]) % salts[where], np.uint64(2**64 - 1)).view(np.int64)
                new = np.array(nodes)
                new = new[often[new] >= n[new] - np.array(sizes) + 1]  # more frequent ones than places after the prefix
                t, node = np.concatenate([t, k1[new]]), np.concatenate([node, k1[new]])
                salt, size, f = np.concatenate([salt, np.full(len(new), OWN)]), np.concatenate([size, n[new]]), np.concatenate([f, often[new]])
                yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(node.view(np.int64)), pa.array(size, pa.int32()), pa.array(f, pa.int32())], ["t", "salt", "node", "n", "f"])

    return rows.mapInArrow(scan, "t long, salt int, node long, n int, f int")


LISTED = "kind int, a long, b long, na int, nb int, f int"
NAMES = ["kind", "a", "b", "na", "nb", "f"]


def may_link(na, nb, fa, fb):
    """Sizes fit, and the frequent shingles suffice where the pair can share no others."""
    return (4 * np.minimum(na, nb) >= 3 * np.maximum(na, nb)) & (175 * np.minimum(fa, fb) >= 75 * (na + nb))


class Pairs:
    """Pairs of small numbers with counts; merged whenever many have come, so memory follows the distinct pairs."""

    def __init__(self, n: int):
        self.n, self.keys, self.times, self.size = max(1, n), [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray, times: int) -> None:
        if len(a):
            self.keys.append(np.minimum(a, b) * self.n + np.maximum(a, b))
            self.times.append(np.full(len(a), times, np.int32))
            self.size += len(a)
            if self.size > 2_000_000:
                self.merge()

    def merge(self) -> None:
        if self.keys:
            keys, times = np.concatenate(self.keys), np.concatenate(self.times)
            keys, inverse = np.unique(keys, return_inverse=True)
            self.keys, self.times = [keys], [np.bincount(inverse, times, len(keys)).astype(np.int32)]
        self.size = 0

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Smaller number, larger number, count."""
        self.merge()
        keys = self.keys[0] if self.keys else np.zeros(0, np.int64)
        return keys // self.n, keys % self.n, self.times[0] if self.times else np.zeros(0, np.int32)


def list_partition(batches):
    """Pairs of short lists (kind 0: a < b, f the number of lists), pairs with the first two nodes of long ones (kind 0, f
    is 0), the long lists' postings (kind 1: a is the shingle, b the node, na its size, nb the salt, f its frequent
    shingles), and the rows of salt OWN (kind 2: b is the node, na its size, f its frequent shingles)."""
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    t, salt, node, n, f = (np.concatenate([np.asarray(b.column(i)) for b in tables]) for i in range(5))
    del tables
    own = salt == OWN
    if own.any():
        b, first = np.unique(node[own], return_index=True)  # a node that several tasks gave
        na, often = n[own][first], f[own][first]
        zero = np.zeros(len(b), np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(zero + 2), pa.array(zero.astype(np.int64)), pa.array(b), pa.array(na), pa.array(zero), pa.array(often)], NAMES)
        t, salt, node, n, f = (x[~own] for x in (t, salt, node, n, f))
        if not len(t):
            return
    n, f = n.astype(np.int64), f.astype(np.int64)
    order = np.lexsort((node, n - f, salt, t))
    t, salt, node, n, f = t[order], salt[order], node[order], n[order], f[order]
    same = (t[1:] == t[:-1]) & (salt[1:] == salt[:-1])
    new = np.concatenate([[True], ~(same & (node[1:] == node[:-1]))])  # a node that several tasks gave
    t, salt, node, n, f = t[new], salt[new], node[new], n[new], f[new]
    edge = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (salt[1:] != salt[:-1])]))
    size = np.diff(np.concatenate([edge, [len(t)]]))
    salted = salt[edge] >= 0  # even a short list goes on: other salts hold the shingle's other nodes
    nodes, at_first, local = np.unique(node, return_index=True, return_inverse=True)
    found = Pairs(len(nodes))

    def offer(a, b, times):
        ok = (a != b) & may_link(n[a], n[b], f[a], f[b])
        found.add(local[a[ok]], local[b[ok]], times)

    short = (size <= SHORT) & (size > 1)
    for step in range(1, int(size[short].max(initial=0))):
        here = short & (size > step)
        lens = size[here] - step
        at = np.repeat(edge[here], lens) + np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
        offer(at, at + step, 1)
    long = size > SHORT
    to = np.flatnonzero(np.repeat(long, size))
    for k in (0, 1):
        offer(np.repeat(edge[long] + k, size[long]), to, 0)
    a, b, times = found.all()
    sizes = n[at_first].astype(np.int32)
    zero = np.zeros(len(a), np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(zero), pa.array(nodes[a]), pa.array(nodes[b]), pa.array(sizes[a]), pa.array(sizes[b]), pa.array(times)], NAMES)
    keep = np.repeat(long | salted, size)
    one = np.ones(int(keep.sum()), np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(t[keep]), pa.array(node[keep]), pa.array(n[keep], pa.int32()), pa.array(salt[keep]), pa.array(f[keep], pa.int32())], NAMES)


def texts_table(df: DataFrame, id_col: str, text_col: str, few: Filter, twice: np.ndarray) -> DataFrame:
    """``node, size, z``: a compressed text for every row that ``few`` lets pass. A text is a third of its set's size."""
    rows, passing = chosen_rows(df, id_col, text_col, few)

    def scan(batches):
        for some in passing(batches):
            raw = [(t or "").encode() for t in some.to_pylist()]
            for i, h, first in sets_of(some):
                node = nodes_of(h, first, twice)
                part = raw[i : i + len(node)]
                z = [pa.compress(x, codec="zstd", asbytes=True) for x in part]
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(list(map(len, part)), pa.int64()), pa.array(z, pa.binary())], ["node", "size", "z"])

    return rows.mapInArrow(scan, "node long, size long, z binary")


def meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which elements of the smaller ascending set the other holds."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return b[at] == a


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 75 * union of two ascending sets."""
    if 4 * min(len(a), len(b)) < 3 * max(len(a), len(b)) or not len(a):
        return False
    inter = int(np.count_nonzero(meeting(a, b)))
    return 100 * inter >= 75 * (len(a) + len(b) - inter)


def ids_of(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The id of one document for each node of ``pairs``, written out."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return materialize(reps.join(nodes, "node").select("id"), "needed")


def narrow(df, id_col, text_col, pairs: DataFrame, reps: DataFrame, frequent: Frequent, twice: np.ndarray, parts: int, total: int) -> DataFrame:
    """The ``pairs`` (``a, b, na, nb`` and u, how many shared prefix shingles the lists don't count) that share prefix shingles
    enough under the other orders too, written out. Only their own nodes are posted."""
    for order in range(1, len(ORDERS)):
        needed = ids_of(pairs, reps)
        count = needed.count()
        if not count:
            discard(needed)
            break
        posted = postings(df, id_col, text_col, frequent, twice, order, Filter(needed, count))
        n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(parts * count / max(1, total)))
        lists = materialize(posted.where(F.col("salt") != OWN).repartition(n, "t", "salt").mapInArrow(list_partition, LISTED), "lists")
        shared = lists.where("kind = 0 and f > 0").groupBy("a", "b").agg(F.sum("f").alias("c"))
        inside = materialize(lists.where("kind = 1").groupBy(F.col("b").alias("node")).agg(F.count(F.lit(1)).alias("l")), "inside")
        side = lambda c: inside.select(F.col("node").alias(c), F.col("l").alias("l" + c))  # noqa: E731, B023
        found = pairs.join(shared, ["a", "b"], "left").join(side("a"), "a", "left").join(side("b"), "b", "left").na.fill(0, ["c", "la", "lb"])
        kept = found.where(F.col("c") + F.least("la", "lb") + F.col("u") >= F.expr(LEAST_SHARED)).select(*pairs.columns)
        new = materialize(kept, "pairs")
        discard(needed, lists, inside, *([pairs] if order > 1 else []))
        pairs = new
    return pairs


def verify(df, id_col, text_col, pairs: DataFrame, reps: DataFrame, twice: np.ndarray) -> DataFrame:
    """The pairs ``a, b`` that link, written out. Pairs of one ``a`` are dealt out in parts of FAN, each with a copy of its text."""
    needed = ids_of(pairs, reps)
    degree = pairs.groupBy("a").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / FAN)).cast("int").alias("parts"))
    own = degree.select(F.col("a").alias("node"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"))
    other = pairs.join(degree, "a").select(F.col("b").alias("node"), "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b")
    texts = texts_table(df, id_col, text_col, Filter(needed, needed.count()), twice)
    dealt = texts.join(own.union(other), "node").select("a", "part", "b", "size", "z")
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)

    def compare(batches):
        kept = None
        for b in batches:
            table = pa.Table.from_batches([b] if kept is None else [*kept.to_batches(), b])
            a, part = np.asarray(table.column("a")), np.asarray(table.column("part"))
            open_ = np.flatnonzero((a != a[-1]) | (part != part[-1])) if len(a) else np.zeros(0, np.int64)
            done = int(open_[-1]) + 1 if len(open_) else 0  # the last group may go on
            if done:
                yield from parts_of(table.slice(0, done))
            kept = table.slice(done)
        if kept is not None and len(kept):
            yield from parts_of(kept)

    links = materialize(dealt.repartition(parts, "a", "part").sortWithinPartitions("a", "part").mapInArrow(compare, "a long, b long"), "links")
    discard(needed)
    return links


def parts_of(table: pa.Table):
    """:func:`linked_of` over whole groups of about PART_BYTES of text together, so that long texts don't add up."""
    a, part, size = (np.asarray(table.column(c)) for c in ("a", "part", "size"))
    edges = np.concatenate([[0], np.flatnonzero((a[1:] != a[:-1]) | (part[1:] != part[:-1])) + 1, [len(a)]])
    total = np.concatenate([[0], np.cumsum(size)])
    start = 0
    for i in range(1, len(edges)):
        if i == len(edges) - 1 or total[edges[i + 1]] - total[start] > PART_BYTES:
            yield linked_of(table.slice(start, edges[i] - start))
            start = edges[i]


def linked_of(table: pa.Table) -> pa.RecordBatch:
    """The pairs that link, among whole groups of one ``a`` and part; a row without ``b`` holds the text of ``a``."""
    a, b = np.asarray(table.column("a")), np.asarray(table.column("b").fill_null(0))
    own = np.asarray(table.column("b").is_null())
    texts = [pa.decompress(z, decompressed_size=n, codec="zstd", asbytes=True) for z, n in zip(table.column("z").to_pylist(), table.column("size").to_pylist(), strict=True)]
    sets = []
    for _, h, first in sets_of(pa.array(texts, pa.binary()).cast(pa.string())):
        sets += [h[s:e] for s, e in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    at: dict = {k: i for i, k in zip(np.flatnonzero(own).tolist(), a[own].tolist(), strict=True)}
    out = []
    for i in np.flatnonzero(~own).tolist():
        j = at.get(int(a[i]))
        if j is not None and linked(sets[i], sets[j]):
            out.append(i)
    return pa.RecordBatch.from_arrays([pa.array(a[out], pa.int64()), pa.array(b[out], pa.int64())], ["a", "b"])


def shared_halves(shape: DataFrame) -> np.ndarray:
    """First halves that several keys have, ascending. Of n sets about n * n / 2 ** 65 are expected, so hardly ever any."""
    per = shape.where("n > 0").groupBy("k1").agg(F.min("k2").alias("lo"), F.max("k2").alias("hi")).where("lo <> hi")
    found = [r[0] for r in per.select("k1").limit(10_001).collect()]
    if len(found) > 10_000:
        raise RuntimeError("far more equal halves of set keys than chance gives")
    return np.sort(np.array(found, np.int64).view(np.uint64))


def class_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, th, n_shingles, root, component_id`` for every row of ``df``: the text's hash, and the class by its root,
    which is null for empty sets, and by its smallest id."""
    spark = df.sparkSession
    small_batches(spark)
    found = materialize(describe(df, id_col, text_col), "shapes")
    twice = shared_halves(found)
    node = F.when(F.col("k1").isin(twice.view(np.int64).tolist()), F.col("alt")).otherwise(F.col("k1")) if len(twice) else F.col("k1")
    shape = found.select("doc_id", "th", "n", node.alias("node"))
    reps = materialize(shape.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("id"), F.max("n").alias("n")), "nodes")
    frequent = frequent_of(found)
    total, count = reps.agg(F.sum(F.col("n") / 4 + 1), F.count(F.lit(1))).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((total or 0) / PART_ROWS))
    posted = postings(df, id_col, text_col, frequent, twice)
    lists = materialize(posted.repartition(parts, "t", "salt").mapInArrow(list_partition, LISTED), "lists")
    long = lists.where("kind = 1").select(F.col("a").alias("t"), F.col("b").alias("node"), F.col("na").alias("n"), F.col("nb").alias("salt"), "f")
    # every node of a long list meets the list's first node: one row a posting, and few distinct pairs. What a list has in
    # common reaches its postings by (shingle, salt), so that a hot list's work stays dealt out
    place = F.struct(F.col("n") - F.col("f"), F.col("node"))
    of_salt = materialize(long.groupBy("t", "salt").agg(F.min_by(F.struct("node", "n", "f"), place).alias("top"), F.min(place).alias("place")), "salts")
    head = of_salt.groupBy("t").agg(F.min_by("top", "place").alias("top"))
    meet = long.join(of_salt.select("t", "salt").join(head, "t"), ["t", "salt"]).select(
        F.col("top.node").alias("a"), F.col("node").alias("b"), F.col("top.n").alias("na"), F.col("n").alias("nb"), F.col("top.f").alias("fa"), F.col("f").alias("fb")
    )
    near = F.expr("a <> b and 4 * least(na, nb) >= 3 * greatest(na, nb) and 175L * least(fa, fb) >= 75L * (na + nb)")
    flip = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.expr("if(a < b, na, nb)").alias("na"), F.expr("if(a < b, nb, na)").alias("nb")]
    seen = lists.where("kind = 0").select("a", "b", "na", "nb", F.col("f").alias("c")).union(meet.where(near).select(*flip, F.lit(0).alias("c")))
    seen = seen.groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.sum("c").alias("c"))
    # how many long lists a node is in, its frequent shingles, and those in its prefix (none if it has no row of kind 2)
    mine = lists.where("kind = 2").select(F.col("b").alias("node"), F.lit(0).alias("l"), F.col("f").alias("g"), F.expr("f - (na - (na - (3 * na + 3) div 4 + 1))").alias("q"))
    each = long.select("node", F.lit(1).alias("l"), F.lit(0).alias("g"), F.lit(0).alias("q")).union(mine)
    inside = materialize(each.groupBy("node").agg(F.sum("l").alias("l"), F.max("g").alias("g"), F.max("q").alias("q")), "inside")
    side = lambda c: inside.select(F.col("node").alias(c), *(F.col(x).alias(x + c) for x in "lgq"))
    seen = seen.join(side("a"), "a", "left").join(side("b"), "b", "left").na.fill(0, [x + c for x in "lgq" for c in "ab"])
    # the lists of frequent shingles count for the pairs only whose frequent shingles suffice
    uncounted = F.expr("if(175L * least(ga, gb) >= 75L * (na + nb), 0, least(qa, qb))")
    enough = F.col("c") + F.least("la", "lb") + uncounted >= F.expr(LEAST_SHARED)
    seen = materialize(seen.select("a", "b", "na", "nb", uncounted.alias("u"), enough.alias("may")), "seen")
    pairs = narrow(df, id_col, text_col, seen.where("may").drop("may"), reps, frequent, twice, parts, count)
    links = verify(df, id_col, text_col, pairs, reps, twice)
    label = connected(links)
    # long lists that still hold several components
    rooted = long.join(label, "node", "left").select("t", "salt", "node", "n", "f", F.coalesce("root", "node").alias("root"))
    per = rooted.groupBy("t", "root").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("low"))
    several = per.groupBy("t").agg(F.count(F.lit(1)).alias("k"), F.max_by("root", F.struct("c", "root")).alias("largest"), F.min("low").alias("low")).where("k > 1")
    # a node whose frequent shingles don't suffice even with the list's smallest set has no partner in it
    may = F.expr("175L * f >= 75L * (n + greatest(low, (3 * n + 3) div 4))")
    by_salt = of_salt.select("t", "salt").join(several, "t")
    open_lists = materialize(rooted.join(by_salt, ["t", "salt"]).where(may).select("t", "node", "n", "f", "root", "largest"), "open")
    if open_lists.limit(1).count():
        x = open_lists.where("root <> largest").select("t", F.col("node").alias("a"), F.col("n").alias("na"), F.col("f").alias("fa"), F.col("root").alias("ra"))
        y = open_lists.select("t", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("f").alias("fb"), F.col("root").alias("rb"))
        cross = x.join(y, "t").where("ra <> rb").where(near).select("t", *flip).distinct().groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("c"))
        cross = cross.join(seen.select("a", "b"), ["a", "b"], "left_anti").join(side("a"), "a").join(side("b"), "b")
        cross = cross.where(F.col("c") + uncounted >= F.expr(LEAST_SHARED))
        cross = materialize(cross.select("a", "b", "na", "nb", uncounted.alias("u")), "cross")
        fewer = narrow(df, id_col, text_col, cross, reps, frequent, twice, parts, count)
        more = verify(df, id_col, text_col, fewer, reps, twice)
        discard(label)
        label = connected(links.union(more))
        discard(more, cross)
    discard(lists, of_salt, inside, seen, links, open_lists)
    # the class id is the smallest document id of the component
    node_root = reps.join(label, "node", "left").select("node", "id", F.coalesce("root", "node").alias("root"))
    least = node_root.groupBy("root").agg(F.min("id").alias("component_id"))
    of_node = node_root.join(least, "root").select("node", "root", "component_id")
    with_class = shape.where("n > 0").join(of_node, "node").select("doc_id", "th", F.col("n").alias("n_shingles"), "root", "component_id")
    alone = shape.where("n = 0").select("doc_id", "th", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id"))
    return with_class.union(alone)


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``df``."""
    return class_rows(df, id_col, text_col).select("doc_id", "n_shingles", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` but copies, all columns: of each class the row with the smallest id, then text hash; a null id comes
    last. Rows with equal id and text are one document, of which the row with the smallest columns stays. Rows whose text has
    no words are in no class and stay. Ids may repeat with other texts: the class is each row's own."""
    found = materialize(class_rows(df, id_col, text_col), "classes").where("root is not null")
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("th"))
    each = found.groupBy("doc_id", "th", "root").agg(F.count(F.lit(1)).alias("rows"))
    first = each.groupBy("root").agg(F.min(place).alias("first"))
    marked = each.join(first, "root").select(F.col("doc_id").alias("id_"), F.col("th").alias("th_"), (place != F.col("first")).alias("gone"), "rows")
    out = materialize(marked.where("gone or rows > 1"), "copies")
    names, text = df.columns, F.xxhash64(df[text_col].cast("string"))
    dealt = df.select(F.struct(*(df[c] for c in names)).alias("r"), df[id_col].cast("long").alias("id"), text.alias("th"))  # no name clashes
    same = F.col("id").eqNullSafe(F.col("id_")) & (F.col("th") == F.col("th_"))
    rest = dealt.join(out, same, "left_anti").select("r.*")
    if out.where("not gone").limit(1).count():
        repeated = dealt.join(out.where("not gone").select("id_", "th_"), same, "left_semi")
        rest = rest.union(repeated.groupBy("id", "th").agg(F.min("r").alias("r")).select("r.*"))
    return rest


@query(
    "op10_ngram_join",
    r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from w),
e as (select doc_id, len(s) as n, unnest(s) as g from s),
p as (select a.doc_id as a, b.doc_id as b, count(*) as i, any_value(a.n) as na, any_value(b.n) as nb
      from e a join e b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
l as (select a, b from p where 100 * i >= 75 * (na + nb - i)),
r(doc_id, c) as (select doc_id, doc_id from documents union select r.doc_id, l.b from r join l on r.c = l.a)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, m.c as component_id
from s join (select doc_id, min(c) as c from r group by 1) m on m.doc_id = s.doc_id
""",
)
def op10_ngram_join(spark, sf_dir):
    """The class of every document by links of five-word shingle sets."""
    return classes(read_table(spark, sf_dir, "documents", "doc_id", "text"))
