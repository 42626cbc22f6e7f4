import hashlib
import random
import re

from traceloom.llm import boosted
from traceloom.llm import pii as P


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


digits = lambda v: re.sub("[^0-9]", "", v)
BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(digits(v)) <= 19 and luhn(digits(v))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(digits(v)) <= 15),
]


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in BASE for m in re.finditer(p, text or "") if ok(m[0])]


def cases():
    rng = random.Random(7)
    parts = ["a@b.c", "x.y_z%+@h-1.co.uk", "@", ".", "1.2.3.4", "256.1.1.1", "001.02.3.0255", "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111112", "+49 (30) 123-4567", "+1", "+123456789012345678", "é", " ", "\n", "_", "a.b", "12", "🙂", "\u0001", "\u0002", "-", "  ", "9" * 20]
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))) for _ in range(400)]
    return [None, "", "a@b.c_d@e.f", "a@b@c.d.", "1.2.3.4.5.6.7.8.9", "4111 1111 1111 1111 4111", "1" * 3000 + "x", "a" * 20000, "7 " * 6000, *made]


def check(got, texts):
    for r in got:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (texts[r.doc_id], want, r.spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in P.KINDS]
        assert r.spans.split(",")[: len(want)] == want or not want


def test_base_equals_brute_force(spark, monkeypatch):
    texts = cases()
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)] + [(0, None, "z")], "doc_id long, text string, email string")
    monkeypatch.setattr(P, "read_table", lambda *a: df)
    got = P.op9_pii(spark, "").collect()
    assert len(got) == len(texts) + 1
    check(got, texts)


def test_many_matches_in_one_text(spark, monkeypatch):
    text = "x 10.0.0.1 " * 3000
    monkeypatch.setattr(P, "read_table", lambda *a: spark.createDataFrame([(1, text)], "doc_id long, text string"))
    check(P.op9_pii(spark, "").collect(), {1: text})


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = P.op9_pii(spark, sf).collect()
    assert len(got) == len(texts) and sum(r.n_card for r in got) > 0
    check(got, texts)


def test_trees_choose_candidates(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        phone = f"{rng.randrange(100, 999)} {rng.randrange(100, 999)} {rng.randrange(1000, 9999)}"
        rows.append((i, [f"call +{phone} now", f"order {rng.randrange(10**9, 10**10)} of", f"call {phone} now"][i % 3 if i % 30 == 2 else i % 2]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.extra for r in P.find_pii(df).collect()}
    assert not any(got[i] for i, t in rows if t.startswith("order"))
    open_ = [(i, t) for i, t in rows if t.startswith("call ") and "+" not in t]
    assert len(open_) == 20 and all([x.v.removeprefix("call ") for x in got[i]] == [t[5:17]] for i, t in open_)
    assert P.find_pii(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_spelled_addresses_are_chosen(spark):
    rng = random.Random(2)
    name = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = [(i, f"write to {name()}@{name()}.com today") for i in range(400)] + [(i, f"write to {name()} at {name()} dot com today") for i in range(400, 420)]
    rows += [(i, f"meet {name()} at {name()} today") for i in range(420, 500)]
    got = {r.doc_id: r.extra for r in P.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(len(got[i]) == 1 and " dot com" in got[i][0].v for i in range(400, 420)) and not any(got[i] for i in range(420, 500))


def test_isotonic_is_monotone_and_keeps_the_mean():
    import numpy as np

    rng = np.random.default_rng(0)
    score = rng.random(300).round(2)
    y = (rng.random(300) < score).astype(float)
    at, p = boosted.isotonic(score, y)
    assert (np.diff(p) >= 0).all() and np.isclose(p[np.searchsorted(at, score)].sum(), y.sum())


def test_clashing_columns_and_long_runs(spark):
    import time

    start = time.time()
    rows = [(i, t, 1) for i, t in enumerate(["7 " * 50_000 + "7x", "12." * 30_000, "phone " * 20_000, "a at b " * 20_000, "x@" * 30_000])]
    assert P.find_pii(spark.createDataFrame(rows, "doc_id long, text string, sample_id int")).count() == 5 and time.time() - start < 60
