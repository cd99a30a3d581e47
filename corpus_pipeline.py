"""A corpus pipeline of five stages over ``documents``.

Each stage takes what its predecessor kept. All but the last return the columns
of ``documents``; the last returns one row of token ids per document copy. Stages
use a document's id, text and source; null and repeated ids are rows like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.llm import minhash, mixing, pieces, quality_classifier, suffix_dedup
from oreline.llm.common import discard, documents, kept, scratch, stored
from oreline.llm.queries import GOOD_SCORE, pieces_path

# Bytes of a repeated string; fifty words have some 240 to 470.
REPEAT_BYTES = 240

# SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts; it learns from the labelled ones that are left."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.fit(quality_classifier.training_rows(docs, labels))
    scored = quality_classifier.score(docs, model, name="pipeline_score")
    return scored.where(F.col("pipeline_score") >= GOOD_SCORE).drop("pipeline_score")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the least id."""
    return minhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that also stand elsewhere."""
    out = suffix_dedup.remove_repeats(docs, length=REPEAT_BYTES)
    changed = F.col("n_removed") > 0
    if "n_chars" in docs.columns:
        count = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(changed, count).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.copies(docs, mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of ids and decoded text."""
    rows = docs.select("doc_id", "source", "text")
    return pieces.encode_digests(rows, pieces_path()).drop("text")


STAGES = [
    ("quality_classifier", keep_good),
    ("minhash", keep_one_of_near_copies),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        with scratch(spark):
            out = kept(stage(spark, docs, sf_dir), name)
        if k:
            discard(docs)
        docs = out
    return docs
