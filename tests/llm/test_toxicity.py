import itertools
import math

import pytest

from traceloom.llm import toxicity as T

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    words = ["the idiot was a clown and a loser", "this is plain text with words", "what a stupid moron", "clean and tidy"] * 50
    return T.CharModel(T.char_counts(spark.createDataFrame([(w,) for w in words], "text string")))


def best_path(span, log):
    best = None
    for path in itertools.product(*T.arcs(span)):
        s, x, y = 0.0, 0, 0
        for c, cost in path:
            s += cost
            if c:
                z = T.CharModel.code(c)
                s, x, y = s + log[x][y][z], y, z
        s += log[x][y][0]
        if best is None or s > best[0] + 1e-12:
            best = (s, "".join(c for c, _ in path))
    return best


def path_score(out, span, log):
    return best_path(span, log)[0]


@pytest.mark.parametrize("span", ["1d10t", "i d i o t", "st*pid", "m0r0n", "looooser", "c.l.o.w.n", "cl@wn!"])
def test_viterbi_equals_enumeration(model, span):
    assert T.viterbi(span, model.log) == best_path(span, model.log)[1]


def test_restores(model):
    restore = T.Restorer(model)
    assert [restore(x)[0] for x in ["an 1d10t here", "an i d i o t here", "such a cl0wn", "a looooser"]] == ["an idiot here", "an idiot here", "such a clown", "a loser"]
    assert restore("Nothing to do, at 12:30 on 2024-01-01.") == ("nothing to do, at 12:30 on 2024-01-01.", 0)


def test_restores_long_spans_and_any_place_of_marks(model):
    restore = T.Restorer(model)
    sentence = " ".join(["the idiot was a clown and a loser"] * 3)
    spelled = " ".join(sentence.replace(" ", ""))
    restored, changed = restore(spelled)
    assert len(spelled) > 64 and changed == 1 and restored.replace(" ", "") == sentence.replace(" ", "")
    assert {"idiot", "clown"} <= set(T.WORDS.findall(restored))
    assert [restore(x)[0] for x in ["57up1d", "l053r", "idio7", "clow+", "a 57up1d moron"]] == ["stupid", "loser", "idiot", "clow", "a stupid moron"]


def test_long_words_take_linear_time(model):
    import time

    start = time.time()
    T.Restorer(model)("abc" * 100_000 + " " + "a1" * 50_000 + " " + "a b " * 30_000)
    assert time.time() - start < 10


def test_held_out_quality(spark):
    got = {r.doc_id: r for r in T.op1_toxicity(spark, SF).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == 10000
    pairs = [(got[i].predicted, y) for i, y in labels.items() if got[i].held_out]
    tp = sum(p and y for p, y in pairs)
    print("precision", tp / max(1, sum(p for p, _ in pairs)), "recall", tp / sum(y for _, y in pairs))
    assert tp / sum(y for _, y in pairs) > 0.75 and tp / max(1, sum(p for p, _ in pairs)) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == T.held_out(i) for i, r in got.items())


def test_edges(spark):
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in [(1, None), (2, ""), (2, ""), (3, "idiot " * 20000)]], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = T.toxicity(docs, none).collect()
    assert len(got) == 4 and all(math.isclose(r.score, 0.05) for r in got)
    assert T.toxicity(spark.createDataFrame([], "doc_id long, text string"), none).count() == 0
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    texts = spark.createDataFrame([(i, "plain words " + ("1d10t idiot" if i % 3 == 0 else "good")) for i in range(300)], "doc_id long, text string")
    kept = {r.doc_id for r in T.reject_toxic(texts, labels).collect()}
    assert kept == {i for i in range(300) if i % 3}


def test_a_repeated_labelled_id_counts_once(spark, model):
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(200)], "doc_id long, toxic int")
    rows = [(i, "some idiot words" if i % 2 == 0 else "some plain words") for i in range(200)]
    once = T.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels, model)
    many = T.fit(spark.createDataFrame(rows + [(3, rows[3][1])] * 500, "doc_id long, text string"), labels, model)
    assert once == many and once["weights"]["idiot"] > 0
