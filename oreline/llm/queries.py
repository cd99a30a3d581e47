"""Registered queries of this package: one for each operator, over its whole table."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.llm import (
    chat,
    fill_middle,
    html_text,
    line_dedup,
    line_rules,
    manifest,
    minhash,
    mixing,
    pieces,
    quality_classifier,
    sharding,
    suffix_dedup,
    vectors,
)
from oreline.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the registered queries.
GOOD_SCORE = 0.7
REPEAT_BYTES = 400
SHARD_BYTES = 1 << 20
# The tool that turns of a conversation call.
REPLY_SCHEMA = "values ('reply', 'text', 'string', true), ('reply', 'turn', 'integer', true)"
PIECES = "piece_bpe_32k.model"


def pieces_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECES)


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality_classifier.Model:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.fit(quality_classifier.training_rows(docs, labels))


def _quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = quality_classifier.score(docs.select("doc_id", "text"), quality_model(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        quality_classifier.held_out().alias("held_out"),
        "score",
        (F.col("score") >= GOOD_SCORE).cast("int").alias("predicted"),
    )


def _sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = documents(spark, sf_dir).select("doc_id", sharding.byte_size(F.col("text")).alias("n_bytes"))
    return sharding.assign_shards(sizes, SHARD_BYTES)


def _chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    calls, results = chat.calls_of(turns)
    schemas = spark.sql(f"select * from {REPLY_SCHEMA} as t(tool, field, type, required)")
    return chat.link_calls(calls, results, schemas)


def _chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    schemas = spark.sql(f"select * from {REPLY_SCHEMA} as t(tool, field, type, required)")
    return chat.turn_rows(turns, schemas)


def _html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = line_rules.clean(documents(spark, sf_dir).select("doc_id", "text"))
    return rules.drop("text", "clean_text")


def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pieces.encode_digests(docs, pieces_path()).drop("text")


def _suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs, length=REPEAT_BYTES)


def _minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(documents(spark, sf_dir), width=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return manifest.proofs_of(documents(spark, sf_dir), tampered, text=lower)


def _line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


def _fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.restore(fill_middle.assemble(fill_middle.pieces(documents(spark, sf_dir))))


def queries() -> dict[str, Query]:
    return {
        "op1_quality_classifier": _quality_classifier,
        "op2_sharding": _sharding,
        "op3_chat": _chat,
        "op3_chat_turns": _chat_turns,
        "op4_line_rules": _line_rules,
        "op5_mixing": _mixing,
        "op6_html_text": _html_text,
        "op7_sentencepiece": _pieces,
        "op8_suffix_dedup": _suffix_dedup,
        "op9_minhash": _minhash,
        "op10_vectors": _vectors,
        "op11_manifest": _manifest,
        "op12_line_dedup": _line_dedup,
        "op13_fill_middle": _fill_middle,
    }
