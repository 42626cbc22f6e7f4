import zlib

import numpy as np
import pyarrow as pa

from traceloom.llm import language_id as L

SF = "/root/testdata/sf0.01"


def test_presence_is_the_set_of_grams():
    for text in ["", "a", "Abc, déf!", "xyz" * 50]:
        raw = text.encode()
        folded = bytes(int(L._FOLD[b]) for b in raw)
        want = set()
        for n in L.ORDERS:
            one = {folded[i : i + n] for i in range(len(folded) - n + 1)}
            want |= {int(L.grams(np.frombuffer(g, np.uint8))[n - 1][0]) for g in one}
        (got,) = L.presence(pa.array([text]))
        assert sorted(got.tolist()) == sorted(want)


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = L.op5_language_id(spark, SF).collect()
    assert len(got) == len(docs)
    out = [r for r in got if r.held_out and any(map(str.isalpha, docs[r.doc_id].text))]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in out]) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)


def brute(rows, ridge=1e-3):
    """Kernel ridge regression written out: every training text is a landmark, kernels from Python sets."""
    sets = [set(next(L.presence(pa.array([t]))).tolist()) for _, t, _ in rows]
    learn = [k for k, (i, _, lang) in enumerate(rows) if lang is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    kernel = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    k = np.array([[kernel(sets[i], sets[j]) for j in learn] for i in learn])
    langs = sorted({rows[i][2] for i in learn})
    y = np.array([[float(rows[i][2] == lang) for lang in langs] for i in learn])
    a = np.linalg.solve(k.T @ k + ridge * len(k) * k + 1e-6 * len(k) * np.eye(len(k)), k.T @ y)
    return [(langs, np.array([kernel(s, sets[j]) for j in learn]) @ a) for s in sets]


def test_query_equals_brute_force(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(90).collect()
    rows = [(r.doc_id, r.text[:400], r.lang) for r in docs if any(map(str.isalpha, r.text[:400]))]
    want = brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(L, "read_table", lambda *a: df)
    monkeypatch.setattr(L, "identify", lambda d, f=L.identify: f(d, 4000, 4000))
    got = {r.doc_id: r for r in L.op5_language_id(spark, "").collect()}
    for (i, _, _), (langs, out) in zip(rows, want, strict=True):
        at = int(np.argmax(out))
        assert np.isclose(got[i].score, min(1, max(0, out[at])), atol=2e-3)
        assert got[i].lang_pred == langs[at] or np.sort(out)[-1] - np.sort(out)[-2] < 4e-3


def test_every_language_is_learned(spark):
    """300 languages, of two words each."""
    word = lambda k: "".join(chr(97 + (k * 7 + j * (k % 5 + 1)) % 26) for j in range(6)) + chr(0x4E00 + k)
    rows = [(i, f"{word(i % 300)} {word(i % 300)}x", f"l{i % 300:03d}") for i in range(1800)]
    got = L.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_rows=4000, landmarks=600).collect()
    assert np.mean([r.lang_pred == rows[r.doc_id][2] for r in got]) > 0.95


def test_two_languages_of_one_id_and_ties(spark):
    rows = [(1, "hello there world", "en"), (1, "bonjour le monde", "fr")] * 20 + [(9, "hello there", "en"), (9, "bonjour le", "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = L.identify(df).collect()
    assert {(r.doc_id, r.lang_pred) for r in got} == {(1, "en"), (1, "fr"), (9, "en"), (9, "fr")}
    tie = spark.createDataFrame([(1, "same text", "b"), (1, "same text", "a"), (3, "same text", None)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in L.identify(tie).collect()} == {"a"}


def test_edges(spark):
    rows = [(1, None, "en", "x"), (2, "", None, "x"), (3, "12 34 !!", "en", "x"), (4, "word " * 50000, "en", "x"), (4, "word", "en", "x"), (6, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = L.identify(df).collect()
    assert len(got) == 6 and sum(r.lang_pred == "und" for r in got) == 4
    assert L.identify(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
