import re

import numpy as np
import pytest

from traceloom.llm import quality as Q
from traceloom.llm.store import materialize

SEP = " \t\n\x0b\x0c\r"
WORD = re.compile("[^ \t-\r]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    inside = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(8)}
    n = len(words)
    failed = n < 20 or 100 * len(inside) > 30 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed


SENTENCE = "one two three four five six seven eight"
TEXTS = [
    None, "", " \t\n", "a", "a\nb\na\n a\n\na", SENTENCE, SENTENCE + " " + SENTENCE, SENTENCE + " x " + SENTENCE, "w " * 7, "w " * 8, "w " * 9, "w " * 30, f"{SENTENCE} nine {SENTENCE} nine",
    "# * $%&|<> \U0001d11e ä\xa0b", "l1\r\nl1\r\nl1", "x\x1cy z", "^]-\\[ a", SENTENCE + " two three four five six seven eight one two three four five six seven",
    " ".join(map(str, range(19))), " ".join(map(str, range(20))), " ".join(f"w{i % 4001}" for i in range(120_000)),
]


def test_counts(spark):
    rows = [(i, t, "en", None, 1, "x") for i, t in enumerate(TEXTS)] + [(None, "a b", None, "s", 2, "y"), (1, "a b", "en", "s", 2, "y"), (1, "a b", "en", "s", 2, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int, kept string")
    got = Q.judge(df).collect()
    assert len(got) == len(rows)
    want = sorted(((r[0], *brute(r[1])) for r in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=str) == want
    assert all(r.kept == (not r.base_failed) for r in got)  # too few rows for an estimate


def test_empty_table(spark):
    assert Q.judge(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).count() == 0


def test_base_columns_of_a_whole_table(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}
    got = Q.op12_quality_rules(spark, d).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    good = [r for r in got if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    noisy = [r for r in got if r.n_symbols > 2 * r.n_words > 200 and not r.base_failed]  # short texts are shrunk towards the usual
    assert noisy and not any(r.kept for r in noisy)


def plain_mcd(x, share=0.75):
    """Concentration steps from many random starts, by sorting; then the reweighting step."""
    rng, n, p = np.random.default_rng(0), *x.shape
    h, eye = int(np.ceil(share * n)), np.eye(p) * Q.FLOOR**2
    far = lambda m, c: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
    best = None
    for _ in range(60):
        some = x[rng.choice(n, p + 1, replace=False)]
        m, c = some.mean(0), np.cov(some.T, bias=True) + eye
        for _ in range(40):
            near = x[np.argsort(far(m, c), kind="stable")[:h]]
            m, c = near.mean(0), Q.consistency(share) * np.cov(near.T, bias=True) + eye
        if best is None or np.linalg.slogdet(c)[1] < best[0]:
            best = np.linalg.slogdet(c)[1], m, c
    near = x[far(*best[1:]) <= Q.chi2_quantile(0.975, p)]
    return far(near.mean(0), Q.consistency(0.975) * np.cov(near.T, bias=True) + eye)


def planted(n=600, bad=90):
    rng = np.random.default_rng(3)
    rows = {}
    for lang, spread, at in (("en", 0.3, 1.0), ("de", 0.6, 2.0)):
        mix = rng.normal(size=(Q.P, Q.P)) * spread
        x = rng.normal(size=(n, Q.P)) @ mix + at
        x[:bad] = rng.normal(size=(bad, Q.P)) * 0.1 + at + 6 * spread * rng.normal(size=Q.P)
        rows[lang] = x
    return rows


@pytest.mark.parametrize("most", [20_000, 0])
def test_estimate_equals_a_plain_one(spark, monkeypatch, most):
    """Distances of clustered outliers and of all others; estimates broadcast, and joined by salt."""
    monkeypatch.setattr(Q, "MOST_BROADCAST", most)
    x = planted()
    rows = [(f"2:{g}", i % Q.SALTS, i, *map(float, v)) for g in x for i, v in enumerate(x[g])]
    df = materialize(spark.createDataFrame(rows, "grp string, salt int, i int, " + ", ".join(f"{f} double" for f in Q.FEATURES)), "planted")
    found = Q.estimates(df)
    got = df.join(found, "grp").select("grp", "i", Q.distance().alias("d2")).collect()
    for g in x:
        want = plain_mcd(x[g])
        have = np.array([r.d2 for r in sorted((r for r in got if r.grp == f"2:{g}"), key=lambda r: r.i)])
        assert np.median(np.abs(have / want - 1)) < 0.1
        cut = Q.chi2_quantile(1 - 1e-6, Q.P)
        assert (have[:90] > cut).all() and (have[90:] <= cut).mean() > 0.995
        clear = (want < 0.7 * cut) | (want > 1.4 * cut)
        assert ((have > cut) == (want > cut))[clear].all()


def test_classical_estimate_would_miss_them():
    x = planted()["en"]
    c = np.cov(x.T)
    d2 = np.einsum("ij,jk,ik->i", x - x.mean(0), np.linalg.inv(c), x - x.mean(0))
    assert (d2[:90] > Q.chi2_quantile(1 - 1e-6, Q.P)).mean() < 0.1


def test_each_group_has_its_own_estimate_and_small_ones_share(spark):
    """A text that is usual for one source is an outlier in another; sources of a few rows are pooled by language."""
    usual = lambda i: " ".join(f"word{(i * 7 + k * k) % 900} and" for k in range(60))
    loud = lambda i: " ".join(f"### {(i * 5 + k * k) % 900} *** $$" for k in range(60))
    rows = [(i, usual(i), "en", "a") for i in range(150)] + [(200 + i, loud(i), "en", "b") for i in range(150)]
    rows += [(400, loud(1000), "en", "a"), (401, usual(1000), "en", "b")] + [(500 + i, usual(i), "fr", f"s{i}") for i in range(120)] + [(700, loud(7), "fr", "z"), (800, loud(3), "xx", None)]
    got = {r.doc_id: r.kept for r in Q.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert {k for k, kept in got.items() if not kept} == {400, 401, 700}


def test_chi_square():
    assert abs(Q.chi2_quantile(0.95, 6) - 12.5916) < 1e-3 and abs(Q.chi2_quantile(0.5, 8) - 7.3441) < 1e-3


def test_main_path_has_no_python(spark):
    rows = spark.createDataFrame([(i, f"some words {i} " * 15, "en", "a") for i in range(300)], "doc_id long, text string, lang string, source string")
    plan = Q.judge(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
