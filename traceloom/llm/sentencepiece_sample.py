"""Sampled subword segmentations without replacement: Gumbel top-k by perturbed A* over the segmentation lattice.

Lattice. A text gets a leading space and is read as bytes, a piece's word mark as a space. Arcs are the vocabulary's pieces;
a character that has no piece of its own is spelled in byte pieces. A piece's weight is that of its rank under Zipf's law
(the vocabularies at hand hold ranks, not probabilities). A segmentation's probability is its weight over the lattice's sum.
No piece has a space after another character, so a text's lattice is a chain of units (spaces and the characters after
them); equal units share one lattice, and backward sums are taken level by level for all of them at once.

Search. Every segmentation has its log probability plus a Gumbel variable as its key; the k largest keys are a sample
without replacement. The root's key is drawn first; a node's key is the largest below it, so the arc that keeps it is drawn
by probability, and the other arcs as one set get the largest of their keys, a truncated Gumbel variable. A* takes open sets
by key: the heuristic is the exact backward sum, so no node is opened in vain, and a new path is followed to its end. The
paths of all texts of a pass go on together as numpy arrays.

Random numbers are a hash of the seed, the row's key, the round and the byte's place, so a row's samples don't depend on
partitions, order or retries. ``inclusion`` is 1 - exp(-exp(log_prob - threshold)), threshold being the next key: the
probability that the segmentation is in a sample with that threshold; 1 if nothing is left outside.

Rows: a null or empty text has one segmentation, without pieces, of log probability 0. A text with fewer than k
segmentations gives all of them. Repeated ids with equal texts give equal samples. Texts are read whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm import arrays
from traceloom.llm.registry import query
from traceloom.llm.store import small_batches
from traceloom.sources.tables import read_table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = 32
PASS = 500_000
PIECE, BEGINS = 1, 2
NEAR = 40  # bytes before a unit's end within which backward sums are numbers, not logarithms: a piece's weight is over 1e-7
IDENTITY = np.arange(256, dtype=np.uint8)


class Vocabulary:
    """Pieces as bytes, their log weights, and hash tables by length. A few MB, whatever the input."""

    def __init__(self, pieces: list[bytes], byte_ids: dict[int, int], ids: list[int], size: int):
        self.bytes = [b""] * size
        rank = np.arange(1, len(ids) + 1)
        weight = np.full(size, -math.log(size + 1.0))
        weight[ids] = -np.log(rank + 1.0)
        self.weight = weight - math.log(np.exp(weight).sum())
        self.mass = np.exp(self.weight)
        self.byte_id = np.array([byte_ids[b] for b in range(256)])
        for b, i in byte_ids.items():
            self.bytes[i] = bytes([b])
        by: dict[int, list] = {}
        for i, p in zip(ids, pieces, strict=True):
            self.bytes[i] = p
            by.setdefault(len(p), []).append((p, i))
        self.sizes = np.array([len(b) for b in self.bytes])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.tables = {}
        most = max(by, default=0)
        begun = {n: sorted({p[:n] for p in pieces if len(p) > n}) for n in range(1, most)}
        for n in range(1, most + 1):
            found = by.get(n, [])
            data = np.frombuffer(b"".join(p for p, _ in found), np.uint8)
            h = hashes(data, np.arange(len(found)) * n, n)
            order = np.argsort(h)
            h = h[order]
            bit = np.zeros(1 << 20, np.uint8)  # 1: may be a piece, 2: may begin a longer one
            bit[h >> np.uint64(44)] = PIECE
            if begun.get(n):
                bit[hashes(np.frombuffer(b"".join(begun[n]), np.uint8), np.arange(len(begun[n])) * n, n) >> np.uint64(44)] |= BEGINS
            near = np.searchsorted(h >> np.uint64(48), np.arange(1 << 16)).astype(np.int32)
            self.tables[n] = (np.append(h, np.uint64(2**64 - 1)), np.append([i for _, i in found], -1)[np.append(order, len(h))], bit, near)


def load(path: str) -> Vocabulary:
    """Read a SentencePiece model on the driver; tasks get the vocabulary, not the file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, ids, byte_ids = [], [], {}
    for i in range(model.get_piece_size()):
        text = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(text[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces.append(text.replace("▁", " ").encode())
            ids.append(i)
    if any(b" " in p.lstrip(b" ") for p in pieces) or len(byte_ids) < 256:
        raise ValueError("needs a vocabulary of byte pieces and of pieces that have spaces at their start only")
    return Vocabulary(pieces, byte_ids, ids, model.get_piece_size())


def prefix_sums(data: np.ndarray) -> np.ndarray:
    value = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(arrays._RANDOM[data] * arrays.powers(max(1, len(data)))[: len(data)], out=value[1:], dtype=np.uint64)
    return value


def hashes(data: np.ndarray, starts: np.ndarray, n, value: np.ndarray | None = None) -> np.ndarray:
    value = prefix_sums(data) if value is None else value
    return arrays.mix((value[starts + n] - value[starts]) * arrays.powers(max(1, len(data)), -1)[starts])


class Lattice:
    """Lattices of several units. A place is a byte's index plus its unit's, so each unit has an end place of its own."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary):
        units = len(offsets) - 1
        unit = np.arange(units)
        self.begin, ends, places = offsets[:-1] + unit, offsets[1:] + unit, len(data) + units
        self.is_end = np.zeros(places, bool)
        self.is_end[ends] = True
        at = np.flatnonzero(~self.is_end)
        padded = np.zeros(places, np.uint8)  # indexed by place
        padded[at] = data
        left = np.repeat(ends, np.diff(offsets)) - at
        value = prefix_sums(padded)
        lead = (padded & 0xC0) != 0x80
        lead[ends] = False
        width = np.where(padded < 0x80, 1, np.where(padded < 0xE0, 2, np.where(padded < 0xF0, 3, 4)))
        covered = ~lead
        start, length, piece = [], [], []
        open_, room, back = at, left, arrays.powers(max(1, places), -1)[at]
        for n, (table, ids, bit, near) in vocabulary.tables.items():  # ascending: fewer places have room and begin a piece each time
            h = arrays.mix((value[open_ + n] - value[open_]) * back)
            may = bit[(h >> np.uint64(44)).view(np.int64)]
            maybe = np.flatnonzero(may & PIECE)
            s, h = open_[maybe], h[maybe]
            go = np.flatnonzero((may >= BEGINS) & (room > n))
            open_, room, back = open_[go], room[go], back[go]
            k = near[(h >> np.uint64(48)).view(np.int64)]
            low = np.flatnonzero(table[k] < h)
            while len(low):
                k[low] += 1
                low = low[table[k[low]] < h[low]]
            ok = table[k] == h
            s, k = s[ok], k[ok]
            start.append(s)
            length.append(n)
            piece.append(ids[k])
            if n <= 4:
                covered[s[width[s] == n]] = True
            if not len(open_):
                break
        # the bytes of characters that no piece covers alone
        first = np.flatnonzero(~covered)
        span = width[first]
        s = np.repeat(first, span) + np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
        start.append(s)
        length.append(1)
        piece.append(vocabulary.byte_id[padded[s]])
        # by place, long pieces first: they are likelier as a rule, so that a draw looks at few arcs
        count = np.bincount(np.concatenate(start), minlength=places)
        self.first = np.concatenate([[0], np.cumsum(count)])
        spot = self.first[:-1].copy()
        self.end, self.piece = np.empty(self.first[-1], np.int64), np.empty(self.first[-1], np.int64)
        for s, n, found in zip(start[::-1], length[::-1], piece[::-1], strict=True):  # a place has one arc of a length
            to = spot[s]
            self.piece[to], self.end[to] = found, s + n
            spot[s] = to + 1
        self.start = np.repeat(np.arange(places), count)
        # backward sums, from the ends on, all units at once: numbers near a unit's end, logarithms before that
        mass = vocabulary.mass[self.piece]
        sums = np.zeros(places)
        sums[ends] = 1
        logs = None
        most = left.max(initial=0)
        order = np.argsort(left.astype(np.uint8 if most < 256 else np.uint16 if most < 65536 else np.int64), kind="stable")
        order = order[count[at[order]] > 0]
        place, left = at[order], left[order]
        level = np.concatenate([[0], np.flatnonzero(left[1:] != left[:-1]) + 1, [len(left)]]) if len(left) else np.zeros(1, np.int64)
        many = count[place]
        stop = np.concatenate([[0], np.cumsum(many)])
        arc = np.repeat(self.first[place] - stop[:-1], many) + np.arange(stop[-1])
        end, by = self.end[arc], mass[arc]
        for a, b in zip(level[:-1].tolist(), level[1:].tolist(), strict=True):
            span, edge = slice(stop[a], stop[b]), stop[a:b] - stop[a]
            if left[a] <= NEAR:
                sums[place[a:b]] = np.add.reduceat(by[span] * sums[end[span]], edge)
            else:
                if logs is None:
                    with np.errstate(divide="ignore"):
                        logs = np.log(sums)
                logs[place[a:b]] = np.logaddexp.reduceat(vocabulary.weight[self.piece[arc[span]]] + logs[end[span]], edge)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.p = mass * sums[self.end] / np.repeat(sums, count)
            if logs is not None:
                far = arc[stop[np.searchsorted(left, NEAR, "right")] :]
                self.p[far] = np.exp(vocabulary.weight[self.piece[far]] + logs[self.end[far]] - logs[self.start[far]])
        self.p[np.isnan(self.p)] = 0  # from where no path leads to the end

    def draw(self, place: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The arc that leaves each place with its probability."""
        arc, last = self.first[place], self.first[place + 1] - 1
        over = u - self.p[arc]
        go = np.flatnonzero((over >= 0) & (arc < last))
        while len(go):
            arc[go] += 1
            over[go] -= self.p[arc[go]]
            go = go[(over[go] >= 0) & (arc[go] < last[go])]
        bad = self.p[arc] == 0  # rounding at a share's edge
        for k in np.flatnonzero(bad):
            span = slice(self.first[place[k]], self.first[place[k] + 1])
            arc[k] = span.start + int(np.argmax(self.p[span]))
        return arc


def salted(key: np.ndarray, salt: int) -> np.ndarray:
    """The row keys of one round."""
    return arrays.mix(key + np.array(salt, np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def uniform(key: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from a hash of salted keys and places."""
    h = arrays.mix(key ^ at.astype(np.uint64))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def truncated(key: np.ndarray, u: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """The largest Gumbel key of a set of the given probability, below ``key``."""
    with np.errstate(divide="ignore", over="ignore"):
        return -np.log(np.exp(-key) - np.log(u) / np.maximum(mass, 0.0))


class Walk:
    """Follows many tracks to their units' ends: arcs and open sets' keys, flat, with each track's first."""

    def __init__(self, lattice: Lattice, place: np.ndarray, row_key: np.ndarray, offset: np.ndarray, bound: np.ndarray, salt: int):
        steps = []
        now = place.copy()
        choose, rest = salted(row_key, 2 * salt), salted(row_key, 2 * salt + 1)
        live = np.flatnonzero(~lattice.is_end[now])
        while len(live):
            p = now[live]
            arc = lattice.draw(p, uniform(choose[live], p + offset[live]))
            steps.append((live, arc))
            now[live] = lattice.end[arc]
            live = live[~lattice.is_end[now[live]]]
        count = np.zeros(len(place), np.int64)
        for live, _ in steps:
            count[live] += 1
        self.first = np.concatenate([[0], np.cumsum(count)])
        self.arcs = np.empty(self.first[-1], np.int64)
        for k, (live, arc) in enumerate(steps):
            self.arcs[self.first[live] + k] = arc
        track = np.repeat(np.arange(len(place)), count)
        mass = 1 - lattice.p[self.arcs]  # 0 where a place has one arc: its weight and its backward sum are the same numbers
        mass[mass < 1e-14] = 0
        self.keys = truncated(bound[track], uniform(rest[track], lattice.start[self.arcs] + offset[track]), mass)
        self.track = track


def sample_pass(data: np.ndarray, offsets: np.ndarray, row_key: np.ndarray, vocabulary: Vocabulary, k: int):
    """For each text (with its leading space) up to k samples (piece ids, log probability, key) and the next key."""
    rows = len(offsets) - 1
    space = data == SPACE
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    start = np.flatnonzero(cut)
    stop = np.concatenate([start[1:], [len(data)]]) if len(start) else start
    value = prefix_sums(data)
    h = hashes(data, start, stop - start, value)
    _, first, which = np.unique(h, return_index=True, return_inverse=True)
    lengths = (stop - start)[first]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    take = np.repeat(start[first], lengths) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], lengths)
    lattice = Lattice(data[take], bounds, vocabulary)
    row_of = np.searchsorted(offsets, start, "right") - 1
    unit_first = np.searchsorted(start, offsets)
    place = lattice.begin[which]
    shift = (start - offsets[row_of]) - place  # place + shift is the byte's place in its text
    key = -np.log(-np.log(uniform(salted(row_key, 1 << 20), np.zeros(rows))))
    walk = Walk(lattice, place, row_key[row_of], shift, key[row_of], 0)
    # per row: paths (arcs, units), open sets (keys, path, depth of the first, excluded arcs by position)
    paths, fronts, found = [[] for _ in range(rows)], [[] for _ in range(rows)], [[] for _ in range(rows)]
    for r in range(rows):
        s, e = walk.first[unit_first[r]], walk.first[unit_first[r + 1]]
        paths[r].append((walk.arcs[s:e], walk.track[s:e]))
        fronts[r].append((walk.keys[s:e].copy(), 0, 0, {}))
        found[r].append(key[r])
    for round_ in range(1, k):
        owner, best, limit = [], [], []
        for r in range(rows):
            at, top = None, -np.inf
            for f, (keys, *_) in enumerate(fronts[r]):
                if len(keys):
                    i = int(keys.argmax())
                    if keys[i] > top:
                        at, top = (f, i), keys[i]
            if at is not None:
                owner.append(r)
                best.append(at)
                limit.append(top)
        if not owner:
            break
        opened = [fronts[r][f] for r, (f, _) in zip(owner, best, strict=True)]
        heads = [paths[r][p] for r, (_, p, _, _) in zip(owner, opened, strict=True)]
        depths = [depth + i for (_, i), (_, _, depth, _) in zip(best, opened, strict=True)]
        arc = np.array([arcs[at] for (arcs, _), at in zip(heads, depths, strict=True)])
        unit = np.array([of[at] for (_, of), at in zip(heads, depths, strict=True)])
        here = lattice.start[arc]
        low, high = lattice.first[here], lattice.first[here + 1]
        own, spot, limit = row_key[owner], here + shift[unit], np.array(limit)
        draws = uniform(salted(own, 2 * round_ + (1 << 21)), spot)
        new, left = [], []
        for (_, i), (*_, out), was, a, b, u in zip(best, opened, arc.tolist(), low.tolist(), high.tolist(), draws.tolist(), strict=True):
            gone = out.setdefault(i, {was})
            share = lattice.p[a:b].copy()
            share[[x - a for x in gone]] = 0
            total = share.cumsum()
            j = min(int(total.searchsorted(u * total[-1], "right")), b - a - 1)
            if share[j] == 0:
                j = int(share.argmax())
            gone.add(a + j)
            rest = total[-1] - share[j]
            new.append(a + j)
            left.append(rest if rest > 1e-14 and b - a > len(gone) else 0.0)
        below = truncated(limit, uniform(salted(own, 2 * round_ + 1 + (1 << 21)), spot), np.array(left))
        places, units, prefix = [], [], []
        for r, (_, i), (keys, *_), (arcs, of), at, x, u0, key_, top in zip(owner, best, opened, heads, depths, new, unit.tolist(), below, limit, strict=True):
            keys[i] = key_
            places.append(np.concatenate([lattice.end[x : x + 1], place[u0 + 1 : unit_first[r + 1]]]))
            units.append(np.arange(u0, unit_first[r + 1]))
            prefix.append((np.append(arcs[:at], x), np.append(of[:at], u0)))
            found[r].append(top)
        counts = [len(x) for x in places]
        unit = np.concatenate(units)
        walk = Walk(lattice, np.concatenate(places), np.repeat(own, counts), shift[unit], np.repeat(limit, counts), round_)
        track = 0
        for r, (arcs, of), here in zip(owner, prefix, places, strict=True):
            s, e = walk.first[track], walk.first[track + len(here)]
            paths[r].append((np.concatenate([arcs, walk.arcs[s:e]]), np.concatenate([of, unit[walk.track[s:e]]])))
            fronts[r].append((walk.keys[s:e].copy(), len(paths[r]) - 1, len(arcs), {}))
            track += len(here)
    out = []
    for r in range(rows):
        nxt = max((float(f[0].max()) for f in fronts[r] if len(f[0])), default=-np.inf)
        out.append(([(lattice.piece[a], float(np.log(lattice.p[a]).sum()), key_) for (a, _), key_ in zip(paths[r], found[r], strict=True)], nxt))
    return out


def with_space(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a leading space; an empty text stays empty."""
    extra = np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])
    new = offsets + extra
    out = np.full(new[-1], SPACE, np.uint8)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    out[np.arange(len(data)) + extra[row + 1]] = data
    return out, new


def row_keys(ids: np.ndarray, seed: int) -> np.ndarray:
    return arrays.mix(ids.astype(np.int64).view(np.uint64) ^ arrays.mix(np.full(1, seed, np.uint64)))


def decode_ids(ids, pieces: list[bytes]) -> str:
    """The text of a row's piece ids."""
    raw = b"".join(map(pieces.__getitem__, ids))
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def decode_flat(flat: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of many rows' piece ids, and where each piece's bytes begin, with the end."""
    size = vocabulary.sizes[flat]
    begin = np.concatenate([[0], np.cumsum(size)])
    return vocabulary.flat[np.arange(begin[-1]) + np.repeat(vocabulary.starts[flat] - begin[:-1], size)], begin


def round_trips(flat: np.ndarray, first: np.ndarray, row: np.ndarray, data: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Whether each segmentation ``flat[first[i]:first[i + 1]]`` decodes to the text of its row."""
    raw, begin = decode_flat(flat, vocabulary)
    begin = begin[first]
    same = np.diff(begin) == np.diff(offsets)[row]
    for i, r in enumerate(row.tolist()):
        if same[i]:
            same[i] = np.array_equal(raw[begin[i] : begin[i + 1]], data[offsets[r] : offsets[r + 1]])
    return same


RESULT = "doc_id long, rank int, ids array<int>, log_prob double, inclusion double, round_trip boolean"


def encode(df: DataFrame, k: int = 2, seed: int = 17, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, rank, ids, log_prob, inclusion, round_trip``: up to k distinct segmentations for every row, by key. Each is
    decoded again; ``round_trip`` tells whether that gives the text."""
    spark = df.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast(load(model))

    def scan(batches):
        vocabulary = held.value
        for b in batches:
            ids = b.column(0).cast(pa.int64())
            keys = row_keys(np.asarray(ids.fill_null(0)), seed)
            data, offsets = arrays.text_bytes(b.column(1))
            for i, j in arrays.passes(offsets, PASS):
                part, bounds = with_space(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                at, rank, pieces, log, inclusion = [], [], [], [], []
                for r, (samples, nxt) in enumerate(sample_pass(part, bounds, keys[i:j], vocabulary, k)):
                    for n, (p, lp, _) in enumerate(samples, 1):
                        at.append(i + r)
                        rank.append(n)
                        pieces.append(p)
                        log.append(lp)
                        inclusion.append(-math.expm1(-math.exp(min(700.0, lp - nxt))) if nxt > -math.inf else 1.0)
                first = np.concatenate([[0], np.cumsum([len(p) for p in pieces], dtype=np.int64)])
                flat = np.concatenate(pieces).astype(np.int32) if pieces else np.zeros(0, np.int32)
                same = round_trips(flat, first, np.array(at, np.int64) - i, part, bounds, vocabulary)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at)), pa.array(rank, pa.int32()), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(flat)), pa.array(log, pa.float64()), pa.array(inclusion, pa.float64()), pa.array(same)],
                    ["doc_id", "rank", "ids", "log_prob", "inclusion", "round_trip"],
                )

    return df.select(df[id_col].cast("long"), df[text_col].cast("string")).mapInArrow(scan, RESULT)


def decode(df: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from piece ids; null ids give a null text, and ids outside the vocabulary nothing."""
    spark = df.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast(load(model).bytes)

    def scan(batches):
        pieces = held.value
        for b in batches:
            texts = [None if x is None else decode_ids([i for i in x if i is not None and 0 <= i < len(pieces)], pieces) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return df.select(df[id_col].cast("long"), df[ids_col].cast("array<int>")).mapInArrow(scan, "doc_id long, text string")


@query("op2_sentencepiece")
def op2_sentencepiece(spark, sf_dir):
    """Two sampled segmentations of every document, with their ids, each decoded and compared with the text."""
    found = encode(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.withColumn("n_pieces", F.size("ids"))
