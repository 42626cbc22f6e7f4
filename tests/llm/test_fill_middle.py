import hashlib
import re

import pytest

from oracle import assert_same
from traceloom.llm import fill_middle as M

UNIT = re.compile("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")


def brute(doc_id, text):
    text = text or ""
    d = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(s in text for s in M.SENTINELS) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", pre, mid, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", pre, mid, f"<P>{pre}<S>{suf}<M>{mid}"


TEXTS = [
    None, "", " ", "a", "a b  c\n", "\t\r\n", "x <P> y", "almost <P <S M> <<S>", "<", ">P> a <", "ä \U0001d11e b c  d", "one two three four five six", "a\x00b c\x1cd e",
    "<M <M <M", "P> S> M>", "word " * 50_000,
]


def test_every_text_under_many_ids(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS * 40)] + [(None, t, "x", 1) for t in TEXTS] + [(5, "a b c", "x", 1)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, n int")
    got = M.restore(M.transform(df)).collect()
    assert len(got) == len(rows)
    want = sorted(((r[0], *brute(r[0], r[1]), r[1] or "") for r in rows), key=str)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix, r.middle, r.output, r.restored) for r in got), key=str) == want
    assert {w[2] for w in want} == {"plain", "spm", "psm"}


def test_other_sentinels_rates_and_string_ids(spark):
    df = spark.createDataFrame([(f"k{i}", f"a.b c|d {i} e") for i in range(100)], "doc_id string, text string")
    marks = ("|pre|", "[suf]", "(mid)")
    got = M.restore(M.transform(df, seed=7, rate=100, spm=0, sentinels=marks), marks).collect()
    assert {r.form for r in got} == {"psm"} and all(r.restored == f"a.b c|d {r.doc_id[1:]} e" for r in got)
    assert {r.form for r in M.transform(df, rate=0).collect()} == {"plain"}


def test_damaged_output_gives_null(spark):
    df = spark.createDataFrame([("psm", "<P>a<S>b"), ("spm", "<P>a<S>b<M>c"), ("psm", None), ("psm", "<P>a<S>b<M>c")], "form string, output string")
    assert [r.restored for r in M.restore(df).collect()] == [None, None, None, "acb"]


def test_empty_table(spark):
    assert M.restore(M.transform(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_oracle(spark, sf):
    from traceloom.llm.registry import ORACLES

    d = f"/root/testdata/sf{sf}"
    assert_same(M.op11_fill_middle(spark, d), ORACLES["op11_fill_middle"], d)


def test_plan_stays_in_the_jvm(spark):
    plan = M.op11_fill_middle(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
