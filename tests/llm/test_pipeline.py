import re

from pyspark.sql import functions as F

import corpus_pipeline as C
from test_ngram_join import brute as brute_classes
from test_secret_scan import brute as brute_secrets
from traceloom.llm import sentencepiece_sample as S
from traceloom.llm import toxicity as T

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall("[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    score = {r.doc_id: r.score for r in T.toxicity(docs, labels).collect()}
    kept = C.toxicity(spark, docs, SF)
    assert kept.columns == names
    assert {r.doc_id for r in kept.collect()} == {i for i in rows if score[i] < 0.3}

    one = C.near_duplicates(spark, kept, SF)
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    assert one.columns == names and {r.doc_id for r in one.collect()} == {i for i, _, c in brute_classes(texts) if i == c}

    bench = [" " + " ".join(words(r.text)) + " " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = C.decontamination(spark, one, SF)
    left = {r.doc_id for r in clean.collect()}
    holds = {r.doc_id for r in one.collect() if any(b in " " + " ".join(words(r.text)) + " " for b in bench)}
    assert clean.columns == names and left == {r.doc_id for r in one.collect()} - holds

    masked = C.secrets(spark, clean, SF)
    got = masked.collect()
    assert masked.columns == names and {r.doc_id for r in got} == left
    assert all(brute_secrets(r.text) == "" and r.n_chars == len(r.text) for r in got)
    assert all(r.text == rows[r.doc_id].text for r in got if not brute_secrets(rows[r.doc_id].text) and "[SECRET]" not in r.text)

    out = C.sentencepiece(spark, masked, SF)
    back = {r.doc_id: r.text for r in S.decode(out.where("rank = 1")).collect()}
    assert back == {r.doc_id: r.text for r in got}


def test_run_and_edges(spark):
    assert C.run(spark, SF).where("rank = 1").count() > 100
    df = spark.createDataFrame([(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (None, "z", None, None, None), (2, None, "en", "s", 0), (3, "token = abcdefgh", "en", "s", None)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = C.near_duplicates(spark, df, SF)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3]
    for _, stage in C.STAGES:
        assert stage(spark, df, SF).count() >= 4
        assert stage(spark, df.limit(0), SF).count() == 0


def test_repeated_ids_keep_other_texts_and_columns_may_clash(spark):
    words = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    rows = [
        (1, words("a", 30), 10, 1), (1, words("b", 30), 11, 2), (2, words("a", 30), 12, 3), (3, words("b", 30) + " extra", 13, 4), (None, words("c", 30), 14, 5), (None, words("c", 30), 15, 6),
        (4, "", 16, 7), (4, None, 17, 8), (5, words("d", 30), 18, 9), (5, words("d", 30), 19, 10),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, copy_id int, leak_id int").withColumns({"n_chars": F.length("text").cast("long"), "id": F.lit(1), "th": F.lit(2), "root": F.lit(3), "r": F.lit(4)})
    kept = C.near_duplicates(spark, df, SF)
    assert kept.columns == df.columns and sorted(r.copy_id for r in kept.collect()) == [10, 11, 14, 16, 17, 18]
    for _, stage in C.STAGES[1:4]:
        assert stage(spark, df, SF).columns == df.columns


def test_very_long_texts(spark):
    rows = [(1, "word " * 200_000, 1), (2, "a=b=" * 50_000, 2), (3, "x" * 500_000, 3), (4, "i d i o t " * 20_000, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    for _, stage in C.STAGES[:4]:
        assert stage(spark, df, SF).count() >= 3
