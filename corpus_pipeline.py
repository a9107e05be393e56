"""The corpus pipeline: each stage reads what its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.llm import bpe, exact_dedup, jaccard_join, suffix_match, toxicity
from farelens.llm.common import fold, shared_dir, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score as toxic. The labels of a third of the
    ids are never learnt from, as in the query of the operator. NULL and empty
    texts stay, as do rows with a NULL id; repeated rows and equal texts go or
    stay together; texts of any length are scored whole. Without labels, or with
    one class only, every text has the same score."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), allowed=fold(F.col("doc_id"), 3) != 1)
    return toxicity.reject(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: that of the largest id, NULL being smallest;
    ties are settled by the other columns. NULL text counts as empty, and of
    repeated rows one stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the least id, NULL
    first, then of the least text digest. Texts without words all stay."""
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a window of a benchmark item. NULL and
    empty texts stay; so do all documents if the benchmark is empty."""
    return suffix_match.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of what is left; NULL
    text counts as empty. All stages read no other columns than they name, keep
    them whatever they are called, and give an empty table for an empty one."""
    return bpe.digest(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

#: No stage but exact dedup can be said in SQL; the tests hold ``run`` against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the
    shared folder as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
