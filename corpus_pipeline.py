"""A corpus from raw documents to padded batches, in five stages.

Each stage takes (spark, docs, sf_dir) and all documents its predecessor kept; its
result is written as Parquet and read again as the next one's ``docs``. All but the
last return the columns they were given. Every row is judged by itself, whatever its doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tremora.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from tremora.llm.common import materialise, table, with_row


def _without(docs: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows named in ``gone``, and without the column that names them."""
    gone = gone.select(F.col("row").alias("_gone"))
    return docs.join(gone, docs[row] == gone["_gone"], "left_anti").drop(row)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scoring under the toxicity threshold.

    The model is fitted on the labelled documents of the whole table, in the learning folds.
    """
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.below(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows equal but for white space, the one that exact_dedup keeps."""
    docs, row = with_row(docs)
    return _without(docs, row, exact_dedup.exact_dedup(docs, row=row).where("not kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, the row with the smallest id."""
    docs, row = with_row(docs)
    return _without(docs, row, simhash.simhash_components(docs, row=row).where("not kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated by benchmark items; those that stay are unchanged."""
    docs, row = with_row(docs)
    return _without(docs, row, decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), row=row).where("contaminated"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token sequence of the documents with its bucket, batch and slot."""
    return packing.length_buckets(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("packing", pack),
]

#: a trained classifier and dynamic programming are not SQL; the tests compare run() with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
