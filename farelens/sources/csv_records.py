"""CSV with quoted line breaks, read by splits.

A file is read line by line, and byte ranges of it by different tasks. A line
starts a record if the quotes before it in its file are even in number. That
takes two passes over the lines:

1. Every split is reduced to one row: how many quotes it holds, and how many of
   its lines start a record if an even or an odd number of quotes stands before
   it. The sum over a file's splits, in order, tells which of the two holds, and
   which record a split's first lines belong to.
2. Lines are dealt out by split, numbered, and put together to records; what a
   record has in later splits is joined to it. ``from_csv`` parses the records.

A cell that holds a quote must be quoted itself, with its quotes doubled, as in
RFC 4180; lines end in a line feed, with or without a carriage return.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SPLIT = ("file", "split")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, at, quotes, line): every line, ``at`` rising within a split."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"),
        F.length(F.regexp_replace("value", '[^"]', "")).alias("quotes"), F.col("value").alias("line"))


def _in_split() -> Window:
    return Window.partitionBy(*_SPLIT).orderBy("at")


def _odd_before(quotes: Column) -> Column:
    """Whether an odd number of quotes stands before a line in its split."""
    return (F.coalesce(F.sum(quotes).over(_in_split().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2) == 1


def splits(rows: DataFrame) -> DataFrame:
    """One row for each split: file, split, odd (whether its file has an odd
    number of quotes before it), starts (records that start in it), and the last
    split before it in which one starts, with their number there."""
    counted = rows.select(*_SPLIT, "at", "quotes").withColumn("odd_here", _odd_before(F.col("quotes")))
    each = counted.groupBy(*_SPLIT).agg(F.sum("quotes").alias("quotes"), F.count_if(~F.col("odd_here")).alias("if_even"), F.count_if("odd_here").alias("if_odd"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as a file has splits
    odd = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2) == 1
    known = each.select(*_SPLIT, odd.alias("odd"), F.when(odd, F.col("if_odd")).otherwise(F.col("if_even")).alias("starts"))
    last = F.last(F.when(F.col("starts") > 0, F.struct("split", "starts")), ignorenulls=True).over(before)
    return known.select("*", last["split"].alias("last_split"), last["starts"].alias("last_nth"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, nth, record): every record of the files with its place;
    the record numbered 1 of the split 0 is a file's first."""
    rows = lines(spark, path)
    placed = rows.withColumn("odd_here", _odd_before(F.col("quotes"))).join(splits(rows), list(_SPLIT))
    starts = F.col("odd_here") == F.col("odd")
    nth = F.sum(starts.cast("long")).over(_in_split().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n")
    parts = placed.select(*_SPLIT, "at", "line", "last_split", "last_nth", nth.alias("nth")).groupBy(*_SPLIT, "nth", "last_split", "last_nth").agg(text.alias("record"))
    whole = parts.where("nth > 0").select(*_SPLIT, "nth", "record")
    later = parts.where("nth = 0 AND last_nth IS NOT NULL").groupBy("file", F.col("last_split").alias("split"), F.col("last_nth").alias("nth")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("split"), "record"))), lambda x: x["record"]), "\n").alias("rest"))
    joined = whole.join(later, [*_SPLIT, "nth"], "left").select(*_SPLIT, "nth", F.concat_ws("\n", "record", "rest").alias("record"))
    return joined.withColumn("record", F.regexp_replace("record", "\r$", ""))
