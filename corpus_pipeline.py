"""The corpus pipeline: operators of ``llm`` applied one after another to documents.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read back as the next
stage's documents. All but the last return the columns of ``docs``. ``run``
applies them to the ``documents`` table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dealspark.llm import language_model, near_dedup, packing, quality_rules, suffix_dedup
from dealspark.llm.common import ship, stored, table
from dealspark.sources.scratch import mark, release


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.filter_documents(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model, trained on the trusted ones among ``docs``, rejects go."""
    ship(spark)
    return language_model.filter_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8 or more) one document stays."""
    ship(spark)
    return near_dedup.filter_documents(docs, size=5, percent=80)


def suffix_array_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur more than once are cut out of the texts."""
    ship(spark)
    return suffix_dedup.clean_documents(docs, length=200)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' tokens and their places in sequences of 2048."""
    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("minhash near-dedup", near_dedup_stage),
    ("suffix-array dedup", suffix_array_stage),
    ("best-fit packing", packing_stage),
]

#: SQL cannot express the model, induced sorting or the tokenizer; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        since = mark(spark)
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        release(spark, since, mark(spark) - 1)  # the stage's own intermediate tables, not its result
    return docs
