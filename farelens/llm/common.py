"""Helpers shared by the corpus operators: tables, the shared folder, workers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes to one space or, where they belong to a word, to the lower-case letter.
LOWER_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: Rows of a batch that are turned into Python values at once.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors see.

    Only a session that names none, and runs in a single process, gets a
    temporary folder (tests).
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpus-checkpoint-"))
        path = sc.getCheckpointDir()
    return path.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage
    so that a lost executor costs a re-read, not a recomputation."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: bytes | None) -> list[bytes]:
    """Words of letters, digits and any non-ASCII characters, A-Z lower-cased."""
    return text.translate(LOWER_WORDS).split() if text else []


def texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterable[pa.RecordBatch]:
    """The rows of some batches, a few at a time: what a worker makes of long
    texts is then as large as a slice, not as a batch."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def per_text(docs: DataFrame, text_col: str, carry: list[str], schema: str, make: Callable[[], Callable]) -> DataFrame:
    """``row`` (a struct of the carried columns) and the columns of ``schema``.

    ``make()`` is called once in each task and returns a function from a string
    column to the list of result columns. The carried columns travel inside one
    struct, so their names can't clash with those of the results.
    """
    inside = text_col in carry
    row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")
    text = [] if inside else [F.col(f"`{text_col}`").cast("string").alias("text")]
    frame = docs.select(row, *text)
    at = carry.index(text_col) if inside else -1
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]):
        f = make()
        for b in batches:
            column = b.column(0).flatten()[at] if inside else b.column(1)
            yield pa.RecordBatch.from_arrays([b.column(0), *f(column)], ["row", *names])

    return frame.mapInArrow(run, with_row(frame, schema))


def with_row(frame: DataFrame, schema: str) -> T.StructType:
    """The ``row`` field of a frame and the fields of a DDL string. The type is
    passed on as it is, as names inside a row need not be valid in DDL."""
    return T.StructType([frame.schema["row"], *T.StructType.fromDDL(schema).fields])


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a NULL id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def labelled(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(id, label, body) of at most ``rows`` labelled documents for which
    ``allowed`` holds. Rows without a label are left out; of several labels of
    one id the largest counts, of several texts that with the largest SHA-256."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & allowed)
    known = known.groupBy(F.col(id_col).alias("label_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    known = known.orderBy(F.xxhash64("label_id"), "label_id").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    found = texts.join(F.broadcast(known), texts["id"] == known["label_id"])
    one = F.max(F.struct(F.sha2(F.col("body").cast("binary"), 256).alias("digest"), "body"))["body"].alias("body")
    return found.groupBy("id", "label").agg(one).select("id", "label", "body")
