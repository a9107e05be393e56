"""Exact dedup by skew-safe combining.

Three combining stages, each grouping by the digest *and* the full text, so two
texts are merged only when their contents are identical:

1. local: the map-side half of the first aggregate leaves one row per text and
   task, so a text that fills a third of the table shrinks to one row per task;
2. salted: those rows meet under (digest, salt), the salt being dealt by task,
   so one text is merged by ``salts`` tasks side by side;
3. global: at most ``salts`` winners per text meet and give the final winner.

Every input row is then linked to its winner by a join on the digest, which
adaptive execution splits when one digest is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def _content(text_col: str):
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def _keys(text):
    """Digest, second hash and length: the link between a row and its group."""
    return [F.sha2(text.cast("binary"), 256).alias("text_sha256"), F.xxhash64(text).alias("text_xx"),
            F.octet_length(text).alias("text_bytes")]


def _salt(salts: int):
    return F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt")


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays. NULL text counts as empty.
    A NULL id stays only when every id of its group is NULL. Rows repeated with
    the same id and text are all marked alike (``drop_copies`` leaves one).
    Other columns, whatever their names, are not read. An empty table gives an
    empty result.
    """
    text = _content(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), _salt(salts))
    keyed = rows.select("doc_id", "text", *_keys(F.col("text")), "salt")
    digest = ["text_sha256", "text_xx", "text_bytes"]
    salted = keyed.groupBy(*digest, "salt", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    winners = salted.groupBy(*digest, "text").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    linked = keyed.select("doc_id", *digest).join(winners.drop("text"), digest, "left")
    return linked.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                         "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """``docs`` with one whole row per distinct text: the largest id (NULL is
    smallest), ties settled by the other columns, which must be orderable. The
    winners carry their row through the same three stages, so no join is needed.
    """
    others = [c for c in docs.columns if c != text_col]
    row = F.struct(F.col(id_col).alias("rank_id"), F.col(text_col).isNotNull().alias("has_text"),
                   *[F.col(c).alias(f"c{i}") for i, c in enumerate(others)])
    rows = docs.select(row.alias("row"), _content(text_col).alias("text"), _salt(salts))
    keyed = rows.select("row", "text", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "salt")
    salted = keyed.groupBy("digest", "salt", "text").agg(F.max("row").alias("row"))
    winners = salted.groupBy("digest", "text").agg(F.max("row").alias("row"))
    back = {c: F.col(f"row.c{i}") for i, c in enumerate(others)}
    back[text_col] = F.when(F.col("row.has_text"), F.col("text"))
    return winners.select(*[back[c].alias(c) for c in docs.columns])


def op10_exact_dedup(spark, sf_dir):
    from .common import table

    return mark_copies(table(spark, sf_dir, "documents"))


OP10_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size,
       d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
