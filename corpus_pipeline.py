"""Corpus pipeline: classify, clean, drop near copies, drop repeated passages, pack.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)`` and
returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from apportion.llm.common import table, tokenizer_folder, written
from apportion.llm.line_quality import clean_documents
from apportion.llm.lpf_dedup import drop_repeats
from apportion.llm.minmax_dedup import keep_one
from apportion.llm.nbsvm import keep_good
from apportion.llm.packing import pack_power_of_two
from apportion.session import ship_package


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of ``sf_dir``, predicts good."""
    ship_package(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line rules, without their failing lines."""
    ship_package(spark)
    return clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more)."""
    ship_package(spark)
    return keep_one(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of passages of 200 bytes or more."""
    ship_package(spark)
    return drop_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of what is left, with their ids."""
    ship_package(spark)
    return pack_power_of_two(docs, f"{tokenizer_folder()}/word_bpe_49k.json")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", passage_dedup),
    ("packing", packing),
]

#: SQL has neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
