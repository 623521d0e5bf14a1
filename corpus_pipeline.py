"""The corpus pipeline: language ID, exact and near deduplication, decontamination and packing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return
the columns of documents, the last returns the packed pieces.

What a stage decides of nulls, empty and very long texts, ties and repeated rows is stated by its operator:
in short, a text that is null or has no letter has no language and goes at the first stage, of rows that are equal or
near copies one stays (with the largest doc_id among equal texts, the smallest among near ones, and one row where
several have it), a null doc_id is kept like any other, and an empty table passes every stage as an empty table.
Columns beyond those of documents, whatever their names, are carried up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm.common import stored, table
from tidewell.llm.decontaminate import keep_clean
from tidewell.llm.exact_dedup import keep_one
from tidewell.llm.langid import keep_identified
from tidewell.llm.minhash import keep_one_of_each
from tidewell.llm.packing import pack


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("best_fit_packing", best_fit_packing),
]
#: Shingle sets, fingerprints and token ids are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
