import numpy as np

from oracle import assert_same
from traceloom.llm import maxscore as M


def brute(rows, k, every, scale):
    ok = {i: [int(np.floor(scale * float(x))) for x in v] for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q in ok:
        if q % every == 0:
            s = sorted(((-sum(a * b for a, b in zip(ok[q], v)), i) for i, v in ok.items() if i != q))[:k]
            out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return sorted(out)


def test_random_and_degenerate_vectors(spark):
    rng = np.random.default_rng(1)
    for trial in range(3):
        rows = [(i, [float(x) for x in np.round(rng.normal(size=5) * (rng.random(5) < 0.6), 1)]) for i in range(120)]
        rows += [(200 + i, [0.5, 0.5, 0.0, 0.0, -0.25]) for i in range(30)] + [(400, None), (401, [1.0, None, 0.0, 0.0, 0.0]), (402, [float("nan")] * 5), (403, [float("inf")] * 5), (404, [])]
        df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, score int")
        got = sorted(tuple(r) for r in M.top_k(df, k=7, every=10, shard_rows=40, block_queries=5).collect())
        assert got == brute(rows, 7, 10, 1024), trial


def test_query_equals_oracle(spark):
    sf = "/root/testdata/sf0.01"
    from traceloom.llm.registry import ORACLES

    assert_same(M.op6_maxscore(spark, sf), ORACLES["op6_maxscore"], sf)


def test_empty(spark):
    assert M.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
