import math

import numpy as np
import pytest

from traceloom.llm import sentencepiece_sample as S

TEXTS = ["Hello world", "", None, "  two  spaces ", "tab\tand\nline", "naïve Ünïcode 漢字 🙂 x", "▁ mark", "a", "%%%### the", "x" * 300, "word " * 200]


@pytest.fixture(scope="module")
def vocabulary():
    return S.load(S.MODEL)


def segmentations(raw, v):
    """All segmentations of a short text with their weights."""
    by = {}
    for i, p in enumerate(v.bytes):
        if p and i not in set(v.byte_id.tolist()):
            by[p] = i
    text, out = raw.decode(), {}

    def go(at, ids):
        if at == len(raw):
            out[tuple(ids)] = sum(v.weight[i] for i in ids)
            return
        n = next(n for n in range(1, 5) if at + n > len(raw) or (at + n == len(raw) or raw[at + n] & 0xC0 != 0x80))
        if raw[at : at + n] not in by:
            go(at + n, [*ids, *(int(v.byte_id[b]) for b in raw[at : at + n])])
        for e in range(at + 1, len(raw) + 1):
            if raw[at:e] in by:
                go(e, [*ids, by[raw[at:e]]])

    go(0, [])
    assert text
    return out


def draw(texts, keys, v, k):
    import pyarrow as pa

    from traceloom.llm import arrays

    data, offsets = S.with_space(*arrays.text_bytes(pa.array(texts, pa.string())))
    return S.sample_pass(data, offsets, keys, v, k)


def test_every_segmentation_is_decoded(spark, vocabulary):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = S.encode(df, k=2).collect()
    assert len(got) > len(TEXTS) and all(r.round_trip for r in got)
    raw = np.frombuffer(b" ab ab", np.uint8)
    flat = vocabulary.byte_id[raw]
    assert S.round_trips(flat, np.array([0, 3, 6]), np.array([0, 1]), raw, np.array([0, 3, 6]), vocabulary).tolist() == [True, True]
    flat[4] = vocabulary.byte_id[ord("c")]
    assert S.round_trips(flat, np.array([0, 3, 6]), np.array([0, 1]), raw, np.array([0, 3, 6]), vocabulary).tolist() == [True, False]
    assert S.round_trips(flat[:5], np.array([0, 3, 5]), np.array([0, 1]), raw, np.array([0, 3, 6]), vocabulary).tolist() == [True, False]


@pytest.mark.parametrize("text", ["the", "to é", "a 漢"])
def test_probabilities_and_exhaustive_samples(vocabulary, text):
    want = segmentations(b" " + text.encode(), vocabulary)
    total = np.logaddexp.reduce(list(want.values()))
    ((samples, nxt),) = draw([text], S.row_keys(np.array([5]), 1), vocabulary, 10_000)
    assert {tuple(p.tolist()) for p, _, _ in samples} == set(want) and nxt == -math.inf
    for p, lp, _ in samples:
        assert math.isclose(lp, want[tuple(p.tolist())] - total, abs_tol=1e-9)
    keys = [key for _, _, key in samples]
    assert keys == sorted(keys, reverse=True)


def lattice(units, v):
    return S.Lattice(np.frombuffer(b"".join(units), np.uint8), np.concatenate([[0], np.cumsum([len(u) for u in units])]), v)


def test_places_are_hashed_only_while_a_piece_may_go_on(vocabulary, monkeypatch):
    rng = np.random.default_rng(3)
    units = [b" " + bytes(rng.choice(np.frombuffer(b"aeinorstqxzj", np.uint8), 30)) for _ in range(200)]
    hashed = []
    mix = S.arrays.mix
    monkeypatch.setattr(S.arrays, "mix", lambda h: (hashed.append(len(h)), mix(h))[1])
    lattice(units, vocabulary)
    assert sum(hashed) < 4.5 * 200 * 31  # 13.9 if every length that has room is looked up


def test_backward_sums_of_units_shorter_and_longer_than_the_linear_part(vocabulary):
    units = [u.encode() for u in (" a", " there", " " + "ab" * 19, " " + "there" * 8, " " + "x" * 300, " " + "漢é" * 30, " 🙂" * 1 + "z" * 38)]
    got = lattice(units, vocabulary)
    beta = np.full(len(got.is_end), -np.inf)
    beta[got.is_end] = 0
    for arc in range(len(got.start) - 1, -1, -1):  # places in descending order
        beta[got.start[arc]] = np.logaddexp(beta[got.start[arc]], vocabulary.weight[got.piece[arc]] + beta[got.end[arc]])
    assert np.isfinite(beta[got.begin]).all() and {len(u) > S.NEAR for u in units} == {True, False}
    want = np.exp(vocabulary.weight[got.piece] + beta[got.end] - beta[got.start])
    assert np.allclose(got.p, want, rtol=1e-9, atol=0)


def test_inclusion_frequencies(vocabulary):
    want = segmentations(b" there", vocabulary)
    total = np.logaddexp.reduce(list(want.values()))
    p = {s: math.exp(w - total) for s, w in want.items()}
    n = 4000
    first, pairs = {}, {}
    for samples, _ in draw(["there"] * n, S.row_keys(np.arange(n), 3), vocabulary, 2):
        a, b = (tuple(x[0].tolist()) for x in samples)
        first[a] = first.get(a, 0) + 1
        pairs[a, b] = pairs.get((a, b), 0) + 1
    for s, c in first.items():
        assert abs(c / n - p[s]) < 4 * math.sqrt(p[s] / n) + 1e-3
    for (a, b), c in pairs.items():  # without replacement: p(a) * p(b) / (1 - p(a))
        q = p[a] * p[b] / (1 - p[a])
        assert abs(c / n - q) < 4 * math.sqrt(q / n) + 2e-3


def test_round_trip_and_determinism(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    got = S.encode(df, k=3).collect()
    again = {(r.doc_id, r["rank"]): r.ids for r in S.encode(df.repartition(7), k=3).collect()}
    assert all(again[r.doc_id, r["rank"]] == r.ids and 0 < r.inclusion <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(tuple(r.ids))
    assert all(len(set(x)) == len(x) for x in by.values()) and set(by) == set(range(len(TEXTS)))
    one = spark.createDataFrame([(r.doc_id, r.ids) for r in got], "doc_id long, ids array<int>")
    assert all(r.text == (TEXTS[r.doc_id] or "") for r in S.decode(one).collect())


def test_agrees_with_the_library_on_decoding(vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=S.MODEL)
    for t in ["Hello world", "naïve Ünïcode 漢字 🙂 x"]:
        ((samples, _),) = draw([t], S.row_keys(np.array([1]), 1), vocabulary, 1)
        assert model.decode(samples[0][0].tolist()) == t


def test_empty(spark):
    assert S.encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0
