"""The corpus pipeline: language ID, near-dedup, substring dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all
but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvia.llm import decontaminate, langid, simhash, substring_dedup
from pluvia.llm.common import staged, table
from pluvia.llm.queries import fold, pack_documents

# Share of a text's n-grams that must be known for its language to count: any text of a
# learned language is far above, strings without words are below.
MIN_COVERAGE = 0.1


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the filters know; texts that are null, without a letter
    or made of unknown n-grams go."""
    return langid.accepted(docs, langid.fit(docs, fold() != 1), MIN_COVERAGE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id.  Rows that
    repeat that id are the same document and stay with it; rows without an id name no
    group and stay."""
    found = simhash.near_duplicates(docs)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document (or place) already has."""
    return substring_dedup.cut_spans(docs, substring_dedup.repeated_spans(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    leaked = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaked, "doc_id", "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces: ids, place in the document, sequence and offset."""
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", passage_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Hashes, models and tokens are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
