import random
import re

import pytest

from oracle import assert_same
from traceloom.llm import ngram_join as J
from traceloom.llm.registry import ORACLES


def brute(rows):
    sets = {}
    for i, t in rows:
        w = [x for x in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 75 * len(sets[a] | sets[b]):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return sorted((i, len(sets[i]), find(i)) for i, _ in rows)


def corpus(seed, n, groups):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop") + str(rng.randrange(30))
    rows = []
    for g in range(groups):
        base = [word() for _ in range(rng.choice([8, 30, 120]))]
        for _ in range(n // groups):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                w[rng.randrange(len(w))] = word()
            rows.append(" ".join(w))
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,n,groups,short", [(1, 120, 30, 48), (2, 160, 3, 5), (3, 150, 2, 2)])
def test_random_groups(spark, monkeypatch, seed, n, groups, short):
    monkeypatch.setattr(J, "SHORT", short)
    monkeypatch.setattr(J, "SAMPLE", 2)
    monkeypatch.setattr(J, "SALTED", 16)
    monkeypatch.setattr(J, "FAN", 4)
    rows = corpus(seed, n, groups) + [(9001, None), (9002, ""), (9003, " \t\n"), (9004, "One two"), (9005, "one  TWO"), (9006, "é è"), (9004, "One two")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, node int")
    assert sorted(tuple(r) for r in J.classes(df).collect()) == brute(rows)


@pytest.mark.parametrize("short", [2, 96])
def test_frequent_passage_in_short_documents(spark, monkeypatch, short):
    """Pairs share 85 frequent shingles, too few to link, and 5 rare ones; longer documents hold the passage after their prefix."""
    monkeypatch.setattr(J, "SAMPLE", 1)
    monkeypatch.setattr(J, "SHORT", short)
    words = lambda name, n: [f"{name}x{k}" for k in range(n)]
    rows = [words("p", 89) + words(f"long{i}", 300) for i in range(30)]
    rows += [words("p", 89) + words(f"pair{i // 2}", 5) + words(f"own{i}", 10) for i in range(6)]
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    want = brute(rows)
    assert len({c for _, _, c in want}) == 33
    assert sorted(tuple(r) for r in J.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == want


def test_query_equals_oracle(spark):
    sf = "/root/testdata/sf0.001"
    assert_same(J.op10_ngram_join(spark, sf), ORACLES["op10_ngram_join"], sf)


def test_empty(spark):
    assert J.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
