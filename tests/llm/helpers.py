"""Small inputs for the corpus operators."""

import hashlib

from pyspark.sql import types as T

#: ``documents`` with columns whose names clash with those that operators use.
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
CLASHING = ("score", "words", "n", "salt", "hash", "pos", "keep_id", "id", "span", "value", "row", "k", "match", "spans", "k1", "body", "a b: c")


def documents(spark, rows, clash=False, partitions=3):
    """A frame of (doc_id, text) rows with the other columns of ``documents``."""
    extra = [T.StructField(c, T.StringType()) for c in CLASHING] if clash else []
    data = [(i, t, "en", "src0", None if t is None else len(t), *["x"] * len(extra)) for i, t in rows]
    return spark.createDataFrame(data, T.StructType([*SCHEMA.fields, *extra])).repartition(partitions)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def as_dicts(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}
