import random
import re
import zlib
from collections import Counter

import pytest

from oracle import assert_same
from traceloom.llm import variants as V

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def count(docs):
    out = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute(words):
    form, near = {}, {}
    for w, n in words.items():
        near[w] = [x for x in words if abs(len(x) - len(w)) < 2 and x != w and distance(w, x) == 1]
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(rows, key=str)


def got(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=str)


def some_words(seed, n=400):
    rng = random.Random(seed)
    letters = "abé"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(7, 9))) for _ in range(n)}
    return {w: rng.choice([2, 3, 25, 40, 300, 5000]) for w in words}


@pytest.mark.parametrize("shard_words, few", [(20_000, 12), (7, 1), (1, 0)])
def test_near_words_equal_brute_force(spark, monkeypatch, shard_words, few):
    """Dense words of three letters: most have many near ones; shards and shared halves large and small."""
    monkeypatch.setattr(V.Rests, "FEW", few)
    words = some_words(shard_words)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(V.group_variants(df, shard_words=shard_words)) == brute(words)


def test_one_half_shared_by_very_many_words(spark):
    rng = random.Random(1)
    words = {"prefixes" + "".join(rng.choice("abcdefgh") for _ in range(8)): rng.choice([2, 50]) for _ in range(30_000)}
    for w in list(words)[:50]:
        words[w[:12] + "z" + w[13:]] = 1000
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = {r.word: r for r in V.group_variants(df, shard_words=8_000).collect()}
    assert len(rows) == len(words)
    for w in list(words)[:50]:
        assert rows[w].form == w[:12] + "z" + w[13:] and rows[w].form_n == 1000
    for w in rng.sample(list(words), 20):
        assert rows[w].n_near == sum(V.differ_by_one(w, x) for x in words)


DOCS = [
    (1, "Straßen STRASSEN strassen, straßen! naïveté naïveté naivete×naivete÷x"), (2, None), (3, ""), (4, "short words only"), (None, "letters letters Letters"), (5, "abcdefg abcdefg abcdefgh " * 40),
    (5, "abcdefg abcdefg abcdefgh " * 40), (6, "\U0001d11elettersĀletters_letters9letters"), *((i, "abcdefg abcdefgh international internation " * 3) for i in range(10, 90)), (7, "verylongword" * 20_000 + " x"), (8, "manyagain " * 60_000),
]


def test_counts_of_texts(spark):
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in DOCS], "doc_id long, text string, n long, word string")
    have = V.word_counts(df)
    want = count(DOCS)
    assert {r.word: r.n for r in have.collect()} == want
    short = {w: n for w, n in want.items() if len(w) < 100}
    assert got(V.group_variants(have.where("length(word) < 100"))) == brute(short)
    assert {r.word: r.n for r in V.word_counts(df, every=None, least_length=5, least_count=1).where("length(word) = 5").collect()} == {"short": 1, "words": 1}


def test_chains_end_at_the_last_form(spark):
    words = {"a" * 7: 2, "a" * 8: 20, "a" * 9: 200, "a" * 10: 2000, "b" * 9: 5}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = got(V.group_variants(df))
    assert rows == brute(words) and rows[0][2] == "a" * 10


def test_empty(spark):
    assert V.group_variants(V.word_counts(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


def test_differ_by_one():
    rng = random.Random(2)
    for _ in range(4000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 5))) for _ in range(2))
        assert V.differ_by_one(a, b) == (distance(a, b) == 1)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_oracle(spark, sf):
    from traceloom.llm.registry import ORACLES

    d = f"/root/testdata/sf{sf}"
    assert_same(V.op13_spelling_variants(spark, d), ORACLES["op13_spelling_variants"], d)
