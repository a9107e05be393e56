"""Stored staging and fact tables, and optional JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_staging(spark: SparkSession, path: str, valid_only: bool = False) -> DataFrame:
    """Staging rows; ``valid_only`` keeps the rows labelled valid.

    Staging is stored partitioned by ``is_valid``, so the filter prunes whole
    folders instead of scanning the invalid rows.
    """
    df = spark.read.parquet(path)
    if "is_valid" in df.columns:
        # Folder names hold the partition value as text; the filter on the
        # cast value still prunes folders, as it reads partition values only.
        df = df.withColumn("is_valid", F.col("is_valid").cast("boolean"))
    return df.where(F.col("is_valid")) if valid_only else df


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, partitions: int | None = None) -> DataFrame:
    """A database table as a source (driver jar and server supplied by the user).

    Give ``partition_column`` with bounds to read in parallel ranges instead of
    through one connection.
    """
    reader = spark.read
    if partition_column is not None:
        return reader.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=partitions,
                           properties=properties or {})
    return reader.jdbc(url, table, properties=properties or {})
