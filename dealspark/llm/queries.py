"""The operators' registered queries; ``SQL`` has the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.llm import (alignment, byte_bpe, fingerprints, language_model, near_dedup, packing, quality_rules, simhash,
                           spelling, substring_dedup, suffix_dedup, url_filters, warc)
from dealspark.llm.common import table
from dealspark.llm.sql import SQL

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=200)
    return df.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                     F.sha2("kept", 256).alias("kept_sha256"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = warc.round_trip(table(spark, sf_dir, "pages"))
    return df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fingerprints.compare(table(spark, sf_dir, "documents"))
    return df.select("doc_id", "n_chars", F.sha2(F.encode("edited_text", "UTF-8"), 256).alias("edited_sha256"),
                     "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = quality_rules.judge(table(spark, sf_dir, "documents"), "doc_id")
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     "base_failed", "kept")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=50)
    return df.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = byte_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                         public_tokenizers.PATTERN)
    return df.select("doc_id", "n_tokens", F.sha2(F.encode("ids", "UTF-8"), 256).alias("ids_sha256"),
                     F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_suffix_array_dedup, op2_warc, op3_document_fingerprints, op4_quality_classifier, op5_quality_rules,
    op6_substring_dedup, op7_byte_bpe, op8_best_fit_packing, op9_url_filters, op10_minhash_near_dedup,
    op11_tokenizer_alignment, op12_spelling_variants, op13_simhash_near_dedup)}
