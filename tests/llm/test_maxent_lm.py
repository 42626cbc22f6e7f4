import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from traceloom.llm import maxent_lm as M


def words(text):
    return [w for w in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w] + [None]


def brute(rows):
    out = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(w for i, t in rows if not out(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    made = []
    for i, t in rows:
        w = words(t)
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        made.append((i, out(i), len(w), sum(c[x] > 0 for x in w), n, base))
    return sorted(made)


@pytest.mark.parametrize("frequent", [1 << 18, 30])
def test_counts_equal_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(M, "FREQUENT", frequent)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(9000, None), (9001, ""), (9002, "É É x y"), (9002, "É É x y"), (9003, "Only ONCE only")]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, base double")
    got = sorted(M.score(df, rounds=1).collect(), key=lambda r: r.doc_id)
    for r, want in zip(got, brute(rows), strict=True):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[:5]
        assert math.isclose(r.base_score, want[5], rel_tol=1e-9) and r.score < 0


def test_model_beats_unigrams_on_held_out_text(spark):
    got = M.op4_maxent_lm(spark, "/root/testdata/sf0.01").where("held_out").collect()
    base, model = sum(r.base_score for r in got), sum(r.score for r in got)
    print(base, model)
    assert model > base


def test_softmaxes_are_normalised():
    rng = np.random.default_rng(0)
    w, bias = rng.normal(size=(M.ROWS, M.CLASSES)).astype(np.float32), np.zeros(M.CLASSES, np.float32)
    rows = np.stack([rng.integers(s, s + n, 50) for s, n in M.SPANS])
    assert np.allclose(np.exp(M.log_softmax(w, bias, rows)).sum(axis=1), 1, atol=1e-4)


def test_gradient_step_equals_the_formula():
    """One step of the in-place update against the softmax gradient written out by token."""
    rng = np.random.default_rng(1)
    w = rng.normal(size=(40, M.CLASSES)).astype(np.float32)
    bias = rng.normal(size=M.CLASSES).astype(np.float32)
    rows = np.stack([rng.integers(0, 20, 30), rng.integers(20, 40, 30)])
    y = rng.integers(0, M.CLASSES, 30)
    want, gradient = w.astype(float), np.zeros((40, M.CLASSES))
    for t in range(30):
        z = w[rows[0, t]].astype(float) + w[rows[1, t]] + bias
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        for r in rows[:, t]:
            gradient[r] += np.eye(M.CLASSES)[y[t]] - p
    square = np.ones(40) + (gradient**2).mean(axis=1)
    want = want + 0.2 * gradient / np.sqrt(square)[:, None]
    met = np.zeros(40, np.int64)
    M.learn(w, bias, rows, y, np.ones(40, np.float32), met, 0.2)
    assert np.allclose(w, want, atol=1e-4) and met.sum() == 60


def brute_score(rows, shared, state):
    """log10 P(text) from the factors, word by word, with plain dictionaries of counts."""
    out = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    training = [t for i, t in rows if not out(i)]
    seen = {}
    for t in training:
        for _, h, e, _, _ in M.sequences(pa.array([t], pa.string())):
            for x, y in zip(h.tolist(), e.tolist(), strict=True):
                seen[x] = [seen.get(x, [0, y])[0] + 1, y]
    leaf = lambda x, e: tuple(int(a[0]) for a in shared.leaves(np.array([x], np.uint64), np.array([e])))
    mass, words_in = {}, {}
    for x, (c, e) in seen.items():
        at = leaf(x, e)
        mass[at], words_in[at] = mass.get(at, 0) + c, words_in.get(at, 0) + 1
    made = []
    for _, t in rows:
        total = 0.0
        for _, h, e, _, before in M.sequences(pa.array([t], pa.string())):
            for j in range(len(h)):
                b = [p[j : j + 1] for p in before]
                k, m = leaf(int(h[j]), int(e[j]))
                total += M.log_softmax(state.part(False)[0], shared.bias, M.feature_rows(b))[0, k] / math.log(10)
                total += M.log_softmax(state.part(True)[0], shared.member_bias[k], M.member_rows(b, np.array([k])))[0, m] / math.log(10)
                if m >= M.MEMBERS - M.TAILS:
                    c = seen.get(int(h[j]), [0])[0]
                    total += math.log10((c + M.DELTA) / (mass.get((k, m), 0) + M.DELTA * (words_in.get((k, m), 0) + 1)))
        made.append(total)
    return made


def test_score_equals_the_factors(spark, monkeypatch):
    held = {}
    monkeypatch.setattr(M, "train", lambda texts, shared, rounds, f=M.train: held.setdefault("w", (shared, f(texts, shared, rounds)))[1])
    rows = [(i, t) for i, t in enumerate(["the cat sat on the mat", "a dog sat on the log and barked", "", None, "the dog and the cat", "unseen words Here"] * 6)]
    got = sorted(M.score(spark.createDataFrame(rows, "doc_id long, text string"), rounds=2).collect(), key=lambda r: r.doc_id)
    for r, want in zip(got, brute_score(rows, *held["w"]), strict=True):
        assert math.isclose(r.score, want, rel_tol=1e-4)


def test_very_long_text_and_hot_word(spark):
    rows = [(1, "word " * 300_000), (2, "x" * 1_000_000), (3, "a b")] + [(4, "same line")] * 50
    got = M.score(spark.createDataFrame(rows, "doc_id long, text string"), rounds=2).collect()
    assert len(got) == 53 and all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_empty(spark):
    assert M.score(spark.createDataFrame([], "doc_id long, text string"), rounds=1).count() == 0
