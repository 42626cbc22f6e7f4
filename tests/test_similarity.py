from traceloom.operators import similarity as S


def shingles(t):
    w = t.split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def greedy(rows, threshold):
    kept, out = [], {}
    for i, t in sorted(rows):
        s = shingles(t or "")
        dup = bool(s) and any(len(s & k) / len(s | k) >= threshold for k in kept)
        out[i] = not dup
        if not dup and s:
            kept.append(s)
    return out


def test_greedy_keep_first(spark):
    import random

    rng = random.Random(4)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(40)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    rows += [(100, None), (101, ""), (102, " "), (103, rows[0][1])]
    df = spark.createDataFrame(rows, "id long, text string")
    got = {r.id: r.kept for r in S.near_dedupe(df, "id", "text", 0.7).collect()}
    assert got == greedy(rows, 0.7)


def test_near_pairs_compared_follow_the_texts_not_their_square(spark, monkeypatch):
    """Of 40 texts that are all alike 39 pairs are compared; a chain longer than the rounds gives the greedy result, and so does an id with two
    texts that are alike."""
    base = [f"w{i}" for i in range(300)]
    alike = [(i, " ".join(base[:i] + ["other"] + base[i + 1 :])) for i in range(40)]
    chain = [(100 + i, " ".join(f"c{k}" for k in range(4 * i, 4 * i + 60))) for i in range(15)]
    rows, seen = alike + chain, []
    whole = S.compared
    monkeypatch.setattr(S, "compared", lambda pairs, *rest: (seen.append(pairs.where("a < 40").count()), whole(pairs, *rest))[1])
    for sketches in (False, True):
        got = {r.id: r.kept for r in S.near_dedupe(spark.createDataFrame(rows, "id long, text string"), "id", "text", sketches=sketches).collect()}
        assert got == greedy(rows, 0.85) and sum(got.values()) == 1 + 8
    assert sum(seen) == 2 * 39
    two = [(1, alike[0][1]), (1, alike[1][1]), (2, alike[2][1]), (3, "quite another text")]
    got = {(r.id, r.kept) for r in S.near_dedupe(spark.createDataFrame(two, "id long, text string"), "id", "text").collect()}
    assert got == {(1, True), (2, False), (3, True)}


def test_decontaminate(spark):
    task = "one two three four five six seven eight nine ten"
    rows = [(1, task), (2, task + " eleven twelve"), (3, "other words entirely here for once and all the time"), (4, None), (5, "!!"), (6, "Short one")]
    tasks = spark.createDataFrame([(7, task), (8, ""), (9, "short ONE")], "task long, body string")
    got = {r.id: (r.task, r.share) for r in S.decontaminate(spark.createDataFrame(rows, "id long, text string"), tasks, "id", "text", "task", "body").collect()}
    assert got == {1: (7, 1.0), 2: (7, 0.6), 6: (9, 1.0)}


def test_pairs_of_copies_repeated_ids_and_long_texts(spark):
    """Ids that repeat with the same or another text, copies, and sets so large that 16 bits a shingle collide."""
    import random

    rng = random.Random(7)
    long = [f"v{rng.randrange(10**9)}" for _ in range(9_000)]
    near = [w if i % 900 else "other" for i, w in enumerate(long)]
    short = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(1, " ".join(long)), (2, " ".join(near)), (3, short), (3, short), (3, "quite another text of more than five words"), (4, short), (5, short + " end"), (6, "quite another text of more than five words"), (7, ""), (8, "x"), (9, None), (10, " ".join(rng.sample(long, 9_000)))]
    df = spark.createDataFrame(rows, "id long, text string")
    want = {(1, 2), (3, 4), (3, 5), (3, 6), (4, 5)}
    for found in (S.jaccard_pairs(df, "id", "text", 0.85), S.minhash_pairs(df, "id", "text")):
        got = {(r.a, r.b): r.jaccard for r in found.collect()}
        assert set(got) == want and got[3, 4] == 1.0 and got[4, 5] == 22 / 23 and 0.98 < got[1, 2] < 1
    assert {r.id for r in S.near_dedupe(df, "id", "text").where("not kept").collect()} <= {2, 3, 4, 5, 6}


def test_no_set_is_written_before_candidates_are_known(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(200))) for i in range(50)]
    corpus = S.Corpus(spark.createDataFrame(rows, "id long, text string"), "id", "text")
    assert corpus.rows.columns == ["id", "key", "n"] and corpus.heads.columns == ["key", "head", "n"]
    wanted = corpus.heads.where("head in (3, 4)").select("key")
    assert 2 <= corpus.sets_of(wanted).count() < 10


def test_bits_bound_the_difference_and_no_alike_pair_is_lost(spark):
    """Odd bits never claim more differences than there are, also where one set has twice the places of the other; texts of null pair with nothing."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(11)
    sets = []
    for size in (0, 1, 60, 64, 65, 70, 128, 130, 500):
        a = [rng.randrange(-(2**63), 2**63) for _ in range(size)]
        for gone in (0, 1, size // 10):
            b = a[gone:] + [rng.randrange(-(2**63), 2**63) for _ in range(gone % 3)]
            sets.append((len(sets), a, b, len(set(a) ^ set(b))))
    bits = S.parity_bits()
    df = spark.createDataFrame(sets, "i int, a array<bigint>, b array<bigint>, d int").select("i", "d", bits("a").alias("x"), bits("b").alias("y"))
    got = df.select("i", "d", S.apart(F.col("x"), F.col("y")).alias("p")).collect()
    assert all(r.p <= r.d and (r.p - r.d) % 2 == 0 for r in got) and sum(r.p for r in got) > 0.7 * sum(r.d for r in got)

    base = [f"w{i}" for i in range(80)]
    rows = [(100, None), (101, None), (102, "")]
    for i in range(70):
        w = base[: rng.randrange(55, 81)]
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(5)}"
        rows.append((i, " ".join(w)))
    want, known = {}, sorted((i, shingles(t or "")) for i, t in rows)
    for k, (i, s) in enumerate(known):
        want |= {(i, j): len(s & t) / len(s | t) for j, t in known[k + 1 :] if s and t and len(s & t) / len(s | t) >= 0.75}
    assert len(want) > 50
    found = S.jaccard_pairs(spark.createDataFrame(rows, "id long, text string"), "id", "text", 0.75, sample=2, frequent=2)
    assert {(r.a, r.b): r.jaccard for r in found.collect()} == want


def test_pairs_that_are_not_alike_move_no_sets(spark):
    """Near misses share a prefix shingle, so they are candidates; their bits rule them out before any set is made."""
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(w if i % 12 or i // 12 % 7 != k % 7 else f"{w}x{k}" for i, w in enumerate(words))) for k in range(12)]
    corpus = S.Corpus(spark.createDataFrame(rows, "id long, text string"), "id", "text", mark=S.prefixes(0.95))
    asked = []
    make, corpus.sets_of = corpus.sets_of, lambda keys: asked.append(keys.count()) or make(keys)
    assert S.prefix_candidates(corpus, 0.95).count() > 0
    assert S.verified(S.prefix_candidates(corpus, 0.95), corpus, 0.95).count() == 0 and asked == [0]


def test_estimates_stay_below_what_sizes_and_bits_allow(spark):
    """Two sets that share every least value, so all places of their sketches, but only three quarters of their elements."""
    import random

    rng = random.Random(5)
    everything = [rng.randrange(-(2**63), 2**63) for _ in range(600)]
    frame = lambda sets: spark.createDataFrame(sets, "i long, s array<bigint>").select("i", "s", S.minhash()("s").alias("sketch"))
    places = {r.i: r.sketch for r in frame([(k, [h]) for k, h in enumerate(everything)]).collect()}
    least = {min(places, key=lambda k: places[k][p]) for p in range(128)}
    rest = [h for k, h in enumerate(everything) if k not in least]
    a, b = set(everything) - set(rest[:75]), set(everything) - set(rest[75:150])
    sets = frame([(1, sorted(a)), (2, sorted(b))]).selectExpr("named_struct('a', i, 'b', i) as key", "size(s) as n", "s", "sketch")
    (r,) = S.banded_candidates(sets.withColumn("bits", S.parity_bits()("s")), 0.85).collect()
    true = len(a & b) / len(a | b)
    assert (r.ka, r.kb, true) == (1, 2, 0.75) and true <= r.estimate < true + 0.177


def test_pairs_by_bands_write_no_sketch(spark):
    rows = [(i, " ".join(f"w{k}x{i // 2 if k else i}" for k in range(60))) for i in range(8)]
    df = spark.createDataFrame(rows, "id long, text string")
    corpus = S.Corpus(df, "id", "text", mark=S.band_marks(0.85))
    bands = S.banding(0.85)[0]
    assert {len(r.mark) for r in corpus.first_marks().collect()} == {bands} and bands < 32
    assert {(r.a, r.b) for r in S.minhash_pairs(df, "id", "text").collect()} == {(0, 1), (2, 3), (4, 5), (6, 7)}


def test_no_filter_waits_for_python_with_the_rows(spark, monkeypatch):
    """Rows queue on local disk while Python works on them; a filter of up to 8 MB in each of them would be there as often as there are texts."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(20)]
    df, plans, write = spark.createDataFrame(rows, "id long, text string"), [], S.written
    monkeypatch.setattr(S, "written", lambda t: (plans.append(t._jdf.queryExecution().sparkPlan()), write(t))[1])
    for mark in (None, S.prefixes(0.85), S.band_marks(0.85), S.sketch_marks()):
        S.Corpus(df, "id", "text", mark=mark)

    def below(node):
        yield node
        for i in range(node.children().size()):
            yield from below(node.children().apply(i))

    queued = [str(n.children().apply(0).output()) for p in plans for n in below(p) if n.nodeName() == "ArrowEvalPython"]
    assert len(queued) >= 4 and not [columns for columns in queued if "bloom" in columns]
