"""The corpus operators applied to the tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import format_chats
from .common import table
from .decontamination import contamination
from .jaccard_join import near_duplicates
from .mixing import mix
from .periodic_runs import run_digests
from .quality_classifier import classify as classify_quality
from .quality_rules import rule_verdicts
from .sentencepiece_lattice import round_trip
from .sharding import shard_rows
from .suffix_dedup import dedup_digests
from .token_store import stored_token_digests
from .toxicity import classify as classify_toxicity
from .vector_codes import vector_codes


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_digests(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_rows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rule_verdicts(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "failures")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).taken()


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = vector_codes(table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_store": op1_token_store,
    "op2_decontamination": op2_decontamination,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_sharding": op7_sharding,
    "op8_toxicity": op8_toxicity,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_quality_rules": op10_quality_rules,
    "op11_mixing": op11_mixing,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_vector_codes": op13_vector_codes,
}
