"""Benchmark decontamination by CGK embeddings and bit-sampling LSH, with exact edit verification.

Texts and items become words: runs of ASCII letters and digits in lower case and of non-ASCII characters, so case,
punctuation and marks between words don't matter. An item of L words is found in a text where some stretch of words is
within floor(max_edit * L) word edits (insertion, deletion, substitution) of it.

1. CGK embedding. A random walk reads a window: at step t it outputs the current word and moves on if a shared random bit of
   (t, word) says so. Windows that are few edits apart give outputs at a small Hamming distance: walks that part meet again.
2. Bit-sampling LSH. Each of ``tables`` repetitions has its own walk and samples a few of its outputs. Samples lie within the
   walk's first steps, where two walks have parted least; instead the walk starts at every word of an item, and at every
   word of a text, so each part of an item has its own signature. A text's signatures are looked up in the tables of the
   items'; a hit at an item's word o proposes the item-sized window that starts o words before.
3. Verification. A window with fewer than L - d of the item's words can't match. For the others, the exact smallest edit distance
   between the item and any stretch of the window, widened by d words at both ends.

How many outputs are sampled, and of how many steps, follows from an item's length (SHAPES). Items of under 1 / max_edit words
allow no edit, and the walk's first output, their first word, is their signature, which loses none. The number of repetitions
follows from ``recall``: a walk of s steps reads about w = s / 2 + 1 words, all unedited with probability (1 - max_edit) ** w, and
starts half of w apart are taken as independent.

Items are signed in tasks and held in blocks of about ``block_items``, fewer where items are long (a bounded broadcast each, with the
signatures of all places of its items); texts are scanned once a block, without a shuffle.

Rows: null and empty texts match nothing; items without a word match nothing. Repeated ids keep their rows and each row is
judged by its own text; equal items are all reported. Texts are scanned whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm import arrays
from traceloom.llm.registry import query
from traceloom.llm.store import materialize, small_batches
from traceloom.sources.tables import read_table

# Bytes that separate words: every ASCII byte but letters and digits.
APART = np.ones(256, bool)
APART[48:58] = APART[65:91] = APART[97:123] = APART[128:] = False
MAX_EDIT = 0.2
RECALL = 0.99
SEED = 20240601
#: No word: what lies beyond a text's or an item's end.
END = np.uint64(0)
#: Least length of an item, sampled outputs and steps of its walks, longest items first; the last shape is that of items
#: that allow no edit.
SHAPES = ((30, 8, 18), (14, 6, 12), (10, 4, 10), (5, 3, 5), (1, 1, 1))
EXACT = len(SHAPES) - 1
GAP = SHAPES[0][2]
#: Words an item on average, from which on a block has fewer items.
BLOCK_WORDS = 64
#: Elements that verification unpacks at once.
PIECE = 1_000_000
#: Windows that are proposed before they are looked at: about 100 bytes each while they are.
MOST_PROPOSED = 500_000
ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(texts: pa.Array):
    """Per pass: first row, word hashes and each row's first word."""
    data, offsets = arrays.text_bytes(texts)
    for i, j in arrays.passes(offsets):
        tokens = arrays.Tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], separator=APART)
        yield i, tokens.hash, tokens.first


def tables_for(recall: float, max_edit: float, shape: int) -> int:
    """Repetitions for the target recall."""
    least, _, steps = SHAPES[shape]
    if shape == EXACT:
        return 1
    words = steps / 2 + 1
    same = (1 - max_edit) ** words
    return max(1, math.ceil(math.log(1 - recall) / (least / (words / 2) * math.log(1 - same))))


def shape_of(length: int, limit: int) -> int:
    """Which of SHAPES an item of so many words and allowed edits has."""
    return next(k for k, (least, _, _) in enumerate(SHAPES) if length >= least) if limit else EXACT


def signatures(h: np.ndarray, table: int, shapes: list[int]) -> dict[int, np.ndarray]:
    """For each shape the signature of one repetition for the walk that starts at each word of ``h``, which ends with GAP times
    END; 0 if a sample lies beyond the end. One walk serves all shapes."""
    sampled = {k: sorted(np.random.default_rng([SEED, table, k]).choice(SHAPES[k][2], SHAPES[k][1], replace=False).tolist()) for k in shapes}
    coins = (arrays.mix(h ^ arrays.mix(np.full(1, SEED + table, np.uint64))) >> np.uint64(32)).astype(np.uint32)
    n = len(h) - GAP
    at, step = np.arange(n), np.empty(n, np.uint32)
    sign = {k: np.zeros(n, np.uint64) for k in shapes}
    last = max(v[-1] for v in sampled.values())
    for t in range(last + 1):
        mine = [k for k, v in sampled.items() if t in v]
        if mine:
            word = np.take(h, at, mode="clip")
            for k in mine:
                sign[k] ^= word
                sign[k] *= ODD
                if t == sampled[k][-1]:  # the walk only moves on, so earlier samples lie before this one
                    sign[k] = np.where(word == END, END, sign[k] | np.uint64(1))
        if t < last:
            np.take(coins, at, out=step, mode="clip")
            step >>= np.uint32(t)
            step &= np.uint32(1)
            at += step
    return sign


def edit_distances(item: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of ``windows`` the smallest word edit distance of ``item`` to any stretch of it, with the stretch's start and
    end; ties go to the first end and the last start. A cell is (cost, width - start) in one number."""
    m, width = windows.shape
    one = np.int64(1) << np.int64(32)
    step = np.arange(width + 1, dtype=np.int64) * one
    row = np.broadcast_to(width - np.arange(width + 1, dtype=np.int64), (m, width + 1))
    for i, w in enumerate(item, 1):
        new = np.empty((m, width + 1), np.int64)
        new[:, 0] = i * one + width
        np.minimum(row[:, :-1] + np.where(windows != w, one, 0), row[:, 1:] + one, out=new[:, 1:])
        new -= step
        np.minimum.accumulate(new, axis=1, out=new)
        new += step
        row = new
    cost = row >> np.int64(32)
    end = np.argmin(cost, axis=1)
    at = np.arange(m)
    return cost[at, end], width - (row[at, end] & (one - 1)), end


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """:func:`edit_distances` for one text."""
    return tuple(int(x[0]) for x in edit_distances(item, text[None, :]))


def ragged(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of ``sizes`` elements: each element's run, and its place in the run."""
    run = np.repeat(np.arange(len(sizes)), sizes)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class Block:
    """Items of one block: words, allowed edits, and a table of signatures for each shape and repetition."""

    def __init__(self, ids: list, items: list[np.ndarray], max_edit: float, recall: float):
        self.ids, self.items = ids, items
        self.length = np.array([len(x) for x in items], np.int64)
        self.limit = np.floor(max_edit * self.length + 1e-9).astype(np.int64)
        shapes = np.array([shape_of(n, d) for n, d in zip(self.length.tolist(), self.limit.tolist(), strict=True)], np.int64)
        self.shapes = np.unique(shapes).tolist()
        repeats = {k: tables_for(recall, max_edit, k) for k in self.shapes}
        run, place = ragged(self.length + GAP)
        h = np.zeros(len(run) + GAP, np.uint64)
        h[np.flatnonzero(place < self.length[run])] = np.concatenate(items)
        self.tables = []
        for table in range(max(repeats.values())):
            mine = [k for k in self.shapes if table < repeats[k]]
            held = {}
            for k, sign in signatures(h, table, mine).items():
                ok = np.flatnonzero((shapes[run] == k) & (sign != END) & ((place == 0) | (k != EXACT)))
                held[k] = self.sorted(sign[ok], run[ok], place[ok])
            self.tables.append(held)
        words = [arrays.mix(x ^ arrays.mix(np.full(1, k, np.uint64))) for k, x in enumerate(items)]
        self.shift = np.uint64(64 - max(16, min(26, math.ceil(math.log2(16 * max(1, self.length.sum()))))))
        self.has = np.zeros(1 << (64 - int(self.shift)), bool)
        self.has[np.concatenate(words) >> self.shift] = True

    @staticmethod
    def sorted(sign: np.ndarray, item: np.ndarray, place: np.ndarray) -> tuple:
        """By signature, every place that has it; and a bit table."""
        kept = np.lexsort((place, item, sign))
        shift = np.uint64(64 - max(16, min(26, math.ceil(math.log2(16 * max(1, len(kept)))))))
        bit = np.zeros(1 << (64 - int(shift)), bool)
        bit[sign[kept] >> shift] = True
        return sign[kept], item[kept].astype(np.int32), place[kept].astype(np.int32), shift, bit

    def proposed(self, text: np.ndarray, begin: np.ndarray) -> Iterator[np.ndarray]:
        """Ascending item * (len(text) + 1) + start of the windows that a signature proposes, of a :func:`padded` text. A part holds about MOST_PROPOSED of
        them, or all of one place: items that begin alike each propose every place where a text has that beginning."""
        found, size = [], 0
        for table, held in enumerate(self.tables):
            signs = signatures(text, table, list(held))
            for k, (sign, item, place, shift, bit) in held.items():
                at = np.flatnonzero(bit[signs[k] >> shift])
                mine = signs[k][at]
                low, high = np.searchsorted(sign, mine, "left"), np.searchsorted(sign, mine, "right")
                own = begin[np.searchsorted(begin, at, "right") - 1]  # a text may begin within an item
                total = np.cumsum(high - low)
                cut = 0
                while cut < len(at):
                    end = max(cut + 1, int(np.searchsorted(total, (total[cut - 1] if cut else 0) + MOST_PROPOSED - size, "right")))
                    run, i = ragged((high - low)[cut:end])
                    i += low[cut:end][run]
                    found.append(np.unique(item[i].astype(np.int64) * (len(text) + 1) + np.maximum(at[cut:end][run] - place[i], own[cut:end][run])))
                    size += len(found[-1])
                    cut = end
                    if size >= MOST_PROPOSED:
                        yield np.unique(np.concatenate(found))
                        found, size = [], 0
        if found:
            yield np.unique(np.concatenate(found))

    def windows(self, keys: np.ndarray, text: np.ndarray, begin: np.ndarray, first: np.ndarray) -> tuple:
        """Item, start, text, and first and last place of each proposed window, with room for the allowed edits."""
        item, start = keys // (len(text) + 1), keys % (len(text) + 1)
        row = np.searchsorted(begin, start, "right") - 1
        lo = np.maximum(begin[row], start - self.limit[item])
        hi = np.minimum(begin[row] + np.diff(first)[row], start + self.length[item] + self.limit[item])
        return item, start, row, lo, hi

    def shares_words(self, keys: np.ndarray, text: np.ndarray, begin: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Whether each proposed window has as many words of its item as the allowed edits leave at least."""
        item, start, row, lo, hi = self.windows(keys, text, begin, first)
        enough = np.zeros(len(keys), bool)
        size = np.maximum(hi - lo, 0)
        total = np.cumsum(size)
        cut = 0
        while cut < len(keys):  # pieces of about PIECE words
            end = max(cut + 1, int(np.searchsorted(total, (total[cut - 1] if cut else 0) + PIECE, "right")))
            run, place = ragged(size[cut:end])
            word = text[lo[cut:end][run] + place]
            hit = self.has[arrays.mix(word ^ arrays.mix(item[cut:end].astype(np.uint64))[run]) >> self.shift]
            enough[cut:end] = np.bincount(run, hit, end - cut) >= (self.length - self.limit)[item[cut:end]]
            cut = end
        return enough

    def find(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Rows of (row, item, start word, end word, edits): the best stretch for each row and item."""
        text, begin = padded(h, first)
        plausible = [keys[self.shares_words(keys, text, begin, first)] for keys in self.proposed(text, begin)]
        keys = np.unique(np.concatenate(plausible)) if plausible else np.zeros(0, np.int64)
        item, start, row, lo, hi = self.windows(keys, text, begin, first)
        out = []
        for k in np.unique(item).tolist():
            mine = np.flatnonzero(item == k)
            width = int(self.length[k] + 2 * self.limit[k])
            each = max(1, PIECE // (width + 1))
            for s in range(0, len(mine), each):
                some = mine[s : s + each]
                at = (start[some] - self.limit[k])[:, None] + np.arange(width)
                inside = (at >= lo[some][:, None]) & (at < hi[some][:, None])
                windows = np.where(inside, text[np.clip(at, 0, len(text) - 1)], END)
                edits, a, b = edit_distances(self.items[k], windows)
                ok = edits <= self.limit[k]
                base = (start[some] - self.limit[k] - begin[row[some]])[ok]
                out.append(np.stack([row[some][ok], np.full(ok.sum(), k), edits[ok], base + a[ok], base + b[ok]]))
        if not out:
            return np.zeros((0, 5), np.int64)
        found = np.concatenate(out, axis=1)
        found = found[:, np.lexsort(found[::-1])]
        new = np.ones(found.shape[1], bool)
        new[1:] = (found[:2, 1:] != found[:2, :-1]).any(axis=0)
        return found[:, new].T[:, [0, 1, 3, 4, 2]]


def padded(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts with END after each as often as the longest walk has steps, and each text's start."""
    begin = first[:-1] + GAP * np.arange(len(first) - 1)
    out = np.zeros(len(h) + GAP * len(first), np.uint64)
    run, place = ragged(np.diff(first))
    out[begin[run] + place] = h
    return out, begin


def blocks_of(benchmark: DataFrame, max_edit: float, recall: float, block_items: int):
    """Broadcast blocks, one at a time; the words of items are hashed in tasks."""
    spark = benchmark.sparkSession

    def hashed(batches):
        for b in batches:
            for i, h, first in words_of(b.column(1)):
                words = [h[s:e].tobytes() for s, e in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, len(words)), pa.array(words, pa.binary())], ["item_id", "words"])

    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    items = materialize(items.mapInArrow(hashed, "item_id long, words binary").where(F.length("words") > 0), "items")
    total = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("words")), F.lit(0)).alias("size")).first()
    blocks = math.ceil(max(total.n, total.size / 8 / BLOCK_WORDS) / block_items)
    for k in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == k).toArrow().to_pylist()  # about block_items
        mine.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["words"]))
        if mine:
            yield spark.sparkContext.broadcast(Block([r["item_id"] for r in mine], [np.frombuffer(r["words"], np.uint64) for r in mine], max_edit, recall))


def find_leaks(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT, recall: float = RECALL, block_items: int = 10_000) -> DataFrame:
    """``doc_id, item_id, start_word, end_word, edits`` for every document and item that occurs in it, its best stretch."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, start_word int, end_word int, edits int"
    out = None

    def scan_with(held):
        def scan(batches):
            b = held.value
            for batch in batches:
                for i, h, first in words_of(batch.column(1)):
                    found = b.find(h, first) if len(h) else np.zeros((0, 5), np.int64)
                    ids = batch.column(0).take(pa.array(found[:, 0] + i))
                    items = pa.array([b.ids[k] for k in found[:, 1].tolist()], pa.int64())
                    yield pa.RecordBatch.from_arrays([ids, items, *(pa.array(found[:, c], pa.int32()) for c in (2, 3, 4))], ["doc_id", "item_id", "start_word", "end_word", "edits"])

        return scan

    for held in blocks_of(benchmark, max_edit, recall, block_items):
        part = texts.mapInArrow(scan_with(held), schema)
        out = part if out is None else out.union(part)
    return spark.createDataFrame([], schema) if out is None else out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT, recall: float = RECALL, block_items: int = 10_000) -> DataFrame:
    """The rows of ``docs`` in which no item occurs, all columns; each row is judged by its own text in the scan's tasks, so
    neither ids nor other columns matter."""
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def scan_with(held):
        def scan(batches):
            b = held.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for i, h, first in words_of(batch.column(at).cast(pa.string())):
                    if len(h):
                        keep[b.find(h, first)[:, 0] + i] = False
                yield batch.filter(pa.array(keep))

        return scan

    out = docs
    for held in blocks_of(benchmark, max_edit, recall, block_items):
        out = out.mapInArrow(scan_with(held), docs.schema)
    return out


@query("op7_decontamination")
def op7_decontamination(spark, sf_dir):
    """One row for each document that holds a benchmark item: the items, and the fewest edits."""
    leaks = find_leaks(read_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "benchmark", "item_id", "text"))
    return leaks.groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.min("edits").alias("edits"))
