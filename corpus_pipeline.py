"""A corpus cleaning pipeline: each stage's rows are written as Parquet and reread as the next stage's documents.

Stages, in order: documents that the toxicity model rejects go; one document of each n-gram Jaccard group stays, the one with
the smallest id; documents that hold a benchmark item go; secrets are masked; texts become sampled SentencePiece ids. All
but the last return the columns of documents. Rows with a null id take part in the second stage, after all others, and are
kept by the third. Rows that repeat an id keep their own texts: each is judged by its own class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.llm.decontaminate import drop_leaks
from traceloom.llm.ngram_join import keep_one
from traceloom.llm.secret_scan import redact_secrets
from traceloom.llm.sentencepiece_sample import encode
from traceloom.llm.store import discard, materialize
from traceloom.llm.toxicity import reject_toxic
from traceloom.sources.tables import read_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose deobfuscated text scores below 0.3, learned from the training labels."""
    return reject_toxic(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets masked and n_chars counted anew."""
    clean = redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document."""
    return encode(docs, k=2)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secrets),
    ("sentencepiece", sentencepiece),
]
#: The stages hold learned models and random walks, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)  # nothing reads a stage's rows but the next stage
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
