import random
import re
import tracemalloc

import numpy as np
import pytest

from traceloom.llm import decontaminate as D

SF = "/root/testdata/sf0.01"


def words(text):
    return re.findall("[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def distance(item, text):
    """Plain dynamic programme: smallest edit distance of item to any stretch of text."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (w != x), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(60):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 9))] for _ in range(2))
        d, s, e = D.edit_distance(np.array(a, np.uint64), np.array(b, np.uint64))
        assert d == distance(a, b)
        assert 0 <= s <= e <= len(b)


def test_recall_and_exactness_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [a + b + c for a in "bcdfgh" for b in "aeiou" for c in "klmnp"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([10, 20, 40])))) for i in range(12)] + [(50, None), (51, "!!"), (52, "two words")]
    docs, planted = [], set()
    for n in range(150):
        w = rng.choices(vocabulary, k=60)
        if n % 2:
            i, text = rng.choice(items[:12])
            x = text.split()
            for _ in range(rng.randrange(0, int(0.2 * len(x)) + 1)):
                k = rng.randrange(len(x))
                x[k : k + 1] = rng.choice([[], [rng.choice(vocabulary)], [x[k], rng.choice(vocabulary)]])
            w[20:20] = x
        docs.append((n, ", ".join(w).title()))
    docs += [(900, None), (901, ""), (902, "x TWO, words y"), (903, "two big words")]
    want = set()
    for n, t in docs:
        for i, x in items:
            iw = words(x)
            if iw and distance(iw, words(t)) <= int(0.2 * len(iw)):
                want.add((n, i))
    df = spark.createDataFrame([(n, t, "z") for n, t in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.find_leaks(df, bench, block_items=5).collect()
    pairs = {(r.doc_id, r.item_id) for r in got}
    assert pairs <= want and len(pairs) >= 0.97 * len(want) and (902, 52) in pairs
    by = dict(docs)
    for r in got[:40]:
        iw = words(dict(items)[r.item_id])
        assert r.edits == distance(iw, words(by[r.doc_id])[r.start_word : r.end_word])
    kept = {r.doc_id for r in D.drop_leaks(df, bench).collect()}
    assert kept == {n for n, _ in docs} - {n for n, _ in pairs}


@pytest.mark.parametrize("length", [5, 6, 9, 12, 25, 60])
@pytest.mark.parametrize("rate", [0.0, 0.1, 0.2])
def test_recall_of_the_look_up(length, rate):
    """The signatures alone propose a window that holds the edited item, for 0.9 of the items at least."""
    rng = np.random.default_rng(length)
    item = [rng.integers(1, 300, length).astype(np.uint64) * D.ODD for _ in range(200)]
    block = D.Block(list(range(200)), item, D.MAX_EDIT, D.RECALL)
    edits = int(np.floor(rate * length + 1e-9))
    found = 0
    for k in range(200):
        x = item[k].tolist()
        for _ in range(edits):
            i, kind = rng.integers(len(x)), rng.integers(3)
            new = (rng.integers(1, 300, 1).astype(np.uint64) * D.ODD).tolist()
            x[i : i + 1] = [[], new, [x[i], *new]][kind]
        noise = lambda: (rng.integers(1, 300, 40).astype(np.uint64) * D.ODD).tolist()
        h = np.array([*noise(), *x, *noise()], np.uint64)
        text, begin = D.padded(h, np.array([0, len(h)]))
        key = np.concatenate(list(block.proposed(text, begin)))
        size = len(text) + 1
        starts = key[key // size == k] % size
        found += bool((np.abs(starts - 40) <= int(0.2 * length)).any())
    print(length, rate, found / 200)
    assert found >= 0.97 * 200


def test_short_items_allow_their_edits_and_columns_may_clash(spark):
    docs = spark.createDataFrame([(1, "so a b c X e f there", 5), (1, "clean text", 6), (2, "a b c X Y f", 7), (4, "b c d e f", 10), (None, "q a b c d e f", 8), (3, None, 9)], "doc_id long, text string, leak_id int")
    bench = spark.createDataFrame([(7, "a b c d e f"), (8, "a b c d e f")], "item_id long, text string")
    assert sorted((r.doc_id or 0, r.item_id, r.edits) for r in D.find_leaks(docs, bench).collect()) == [(0, 7, 0), (0, 8, 0), (1, 7, 1), (1, 8, 1), (4, 7, 1), (4, 8, 1)]
    assert sorted(r.leak_id for r in D.drop_leaks(docs, bench).collect()) == [6, 7, 9]


def test_very_long_texts(spark):
    import time

    start = time.time()
    item = " ".join(f"w{i % 9}" for i in range(40))
    docs = spark.createDataFrame([(1, "w1 w2 " * 200_000), (2, item.replace("w8", "x") + " " + (item + " z ") * 5_000)], "doc_id long, text string")
    got = D.find_leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.edits) for r in got] == [(2, 0)] and time.time() - start < 90


def test_query_finds_every_verbatim_passage(spark):
    bench = [(r.item_id, words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        line = " " + " ".join(words(r.text)) + " "
        want |= {(r.doc_id, i) for i, w in bench if " " + " ".join(w) + " " in line}
    got = {(r.doc_id, i) for r in D.op7_decontamination(spark, SF).collect() for i in r.item_ids}
    assert len(want) > 10 and want <= got


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert D.find_leaks(none, bench).count() == 0 and D.drop_leaks(spark.createDataFrame([(1, "a")], "doc_id long, text string"), bench).count() == 1


def test_items_that_begin_alike_stay_within_memory(monkeypatch):
    """2,000 items with the same 14 words first, and a text that repeats these words: all items are proposed at each repetition, a part at a time."""
    monkeypatch.setattr(D, "MOST_PROPOSED", 50_000)
    monkeypatch.setattr(D, "PIECE", 100_000)
    rng = np.random.default_rng(0)
    word = lambda n: (rng.integers(1, 2**62, n).astype(np.uint64) * np.uint64(2)) + np.uint64(1)
    head = word(14)
    items = [np.concatenate([head, word(26)]) for _ in range(2_000)]
    block = D.Block(list(range(2_000)), items, D.MAX_EDIT, D.RECALL)
    text = np.concatenate([np.tile(head, 15), items[7], np.tile(head, 15), items[1_234][:30], word(2), items[1_234][32:]])
    first = np.array([0, len(text)])
    sizes = [len(p) for p in block.proposed(*D.padded(text, first))]
    assert len(sizes) > 1 and max(sizes) < D.MOST_PROPOSED + 2_100
    tracemalloc.start()
    found = block.find(text, first)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(found[:, 1].tolist()) == [7, 1_234] and sorted(found[:, 4].tolist()) == [0, 2]
    assert peak < 100_000_000


@pytest.mark.parametrize("most", [1, 50, 10**6])
def test_parts_of_proposals_change_nothing(monkeypatch, most):
    monkeypatch.setattr(D, "MOST_PROPOSED", most)
    rng = np.random.default_rng(5)
    items = [(rng.integers(1, 40, int(n)).astype(np.uint64) * D.ODD) for n in rng.integers(5, 60, 40)]
    block = D.Block(list(range(40)), items, D.MAX_EDIT, D.RECALL)
    text = np.concatenate([x for k in rng.permutation(40)[:15] for x in (items[k], rng.integers(1, 40, 9).astype(np.uint64) * D.ODD)])
    assert len(block.find(text, np.array([0, len(text)]))) >= 15
    key = lambda x: x.tolist()
    monkeypatch.setattr(D, "MOST_PROPOSED", 10**7)
    whole = key(block.find(text, np.array([0, len(text)])))
    monkeypatch.setattr(D, "MOST_PROPOSED", most)
    assert key(block.find(text, np.array([0, len(text)]))) == whole


def test_every_place_of_a_long_item_is_signed():
    """No signature of an item is left out, however many it has and however many items share them."""
    item = D.arrays.mix(np.arange(1, 401, dtype=np.uint64))
    block = D.Block([1, 2], [item, item], 0.2, 0.99)
    for held in block.tables:
        for _, items, place, _, _ in held.values():
            assert all(set(place[items == k].tolist()) >= set(range(380)) for k in (0, 1))
