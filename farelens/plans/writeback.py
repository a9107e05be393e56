"""Labels written back to a stored staging table, rewriting only what changes.

Staging is stored in ``folders`` folders by a hash of the id, each bucketed by
the id. Labels that come as a separate table are shuffled to those buckets and
joined there, so staging itself is read where it lies, without a shuffle. Only
folders that hold a labelled row are read again and replaced, each by a rename
once its new files are complete; the others stay as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.operators import rules

FOLDER = "_folder"
#: Rows of a bucket, over all folders: what one task sorts at once.
BUCKET_ROWS = 500_000
_MODE = "spark.sql.sources.partitionOverwriteMode"


def buckets_for(rows: int, least: int = 4) -> int:
    """Buckets for a table of so many rows, so that a task's share of it doesn't
    grow with the table."""
    return max(least, math.ceil(rows / BUCKET_ROWS))


def store(staging: DataFrame, table: str, path: str, folders: int = 64, buckets: int = 16, key: str = "id") -> None:
    """``staging`` as a table at ``path``; choose folders x buckets so that a
    bucket of a folder is a file of a few hundred MB."""
    rows = staging.withColumn(FOLDER, F.pmod(F.xxhash64(key), F.lit(folders)).cast("int"))
    # One task for each bucket writes its file in every folder.
    rows.repartition(buckets, key).write.partitionBy(FOLDER).bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def labelled_rows(spark: SparkSession, table: str, labels: DataFrame, key: str = "id") -> DataFrame:
    """(folder, n): stored rows with a label, by folder; only ids are read."""
    rows = spark.table(table).select(key, FOLDER)
    return rows.join(labels.select(key).hint("merge"), key).groupBy(FOLDER).agg(F.count(F.lit(1)).alias("n"))


def updated(spark: SparkSession, table: str, labels: DataFrame, touched: list[int], key: str = "id") -> DataFrame:
    """The rows of some folders with their new labels; the others keep theirs."""
    rows = spark.table(table).where(F.col(FOLDER).isin(touched))
    return rules.apply_labels(rows, labels.hint("merge"), key).select(*spark.table(table).columns)


def write_back(spark: SparkSession, table: str, labels: DataFrame, key: str = "id") -> int:
    """Puts the labels of a (key, is_valid, validation_errors) table on the rows
    of a stored table; returns how many rows got one.

    Labels without a row change nothing, and two labels for one key are refused.
    An empty label table rewrites nothing.
    """
    counts = {r[FOLDER]: r["n"] for r in labelled_rows(spark, table, labels, key).collect()}  # a row for each folder
    if counts:
        fresh = updated(spark, table, labels, sorted(counts), key)
        old = spark.conf.get(_MODE)
        spark.conf.set(_MODE, "dynamic")  # folders that aren't written stay
        try:
            fresh.write.mode("overwrite").insertInto(table)
        finally:
            spark.conf.set(_MODE, old)
    return sum(counts.values())
