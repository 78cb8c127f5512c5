"""The corpus pipeline: documents of good quality, one of each group of exact and
of near copies, packed into sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of documents. Null texts count as empty; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farebox.llm import exact_dedup, jaccard_join, packing, quality
from farebox.llm.common import stored
from farebox.llm.queries import BYTE_BPE, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject (score of 0.5 or more)."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, into="__quality")
    return scored.where("__quality >= 0.5").select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal normalised texts the smallest doc_id stays."""
    return exact_dedup.kept_documents(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the smallest doc_id stays."""
    return jaccard_join.kept_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, with a checksum of their ids."""
    return packing.with_ids_crc32(packing.pack(docs, BYTE_BPE))


STAGES = [
    ("quality", good_quality),
    ("exact", without_copies),
    ("near", without_near_copies),
    ("packing", packed),
]

#: Trained trees and a tokenizer are beyond SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
