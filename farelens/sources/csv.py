"""Raw fare CSV source: existence check, header check, rename, provenance."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.model import CSV_COLUMN_MAP, NA_STRINGS
from farelens.sources.csv_records import records


def check_source_file(spark: SparkSession, path: str) -> str:
    """Stop early, naming the path, if the input is missing or empty.

    Lists the files through Spark (no content is read: only ``length`` is
    selected) and reduces them to one row, so a folder of many files costs a
    listing, not a scan.
    """
    try:
        listing = spark.read.format("binaryFile").load(path).select("length")
        row = listing.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")).first()
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"No file to read at {path}") from exc
        raise
    if not row["files"] or not row["bytes"]:
        raise ValueError(f"{path} holds no bytes: empty source")
    return path


QUOTING = {"quote": '"', "escape": '"'}
_BROKEN = "_broken_record"
_MARK = "\u0002"


def read_csv_text(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Every cell as text, header names as written in the file.

    Doubled quotes inside quoted fields are the CSV escape. ``multiLine`` is
    opt-in because it stops Spark from splitting a file across tasks. A record
    that the header can't hold stops the read, with its text in the message: one
    with more fields than the header, or one whose quotes don't pair up, which
    is a quoted line break met without ``multiLine``. A record with fewer fields
    is filled with NULL.
    """
    reader = (
        spark.read.options(**QUOTING)
        .option("header", True)
        .option("inferSchema", False)
        .option("mode", "PERMISSIVE")
        .option("multiLine", multiline)
        .option("enforceSchema", False)
    )
    header = reader.csv(path).schema
    if not header.fields:
        return reader.csv(path)
    schema = T.StructType([*header.fields, T.StructField(_BROKEN, T.StringType())])
    text = reader.schema(schema).option("columnNameOfCorruptRecord", _BROKEN).csv(path)
    # Only records with another number of fields have their text in this column.
    record = F.col(_BROKEN)
    # A mark put behind the record shows up among the header's cells or the one
    # after them, unless there are more fields or an open quote takes it in.
    parsed = F.from_csv(F.concat(record, F.lit("," + _MARK)), ", ".join(f"c{i} string" for i in range(len(header.fields) + 1)), QUOTING)
    surplus = ~F.array_contains(F.array(*[F.coalesce(parsed[f"c{i}"], F.lit("")) for i in range(len(header.fields) + 1)]), _MARK)
    unpaired = F.length(F.regexp_replace(record, '[^"]', "")) % 2 == 1
    stop = F.raise_error(F.concat(
        F.lit(f"A record has more fields than the header of {len(header.fields)}, or a quoted line break "
              "(read those with multiline_csv=True): "), F.left(record, F.lit(200)))).cast("boolean")
    # The first column takes part because Spark reads no column of broken records alone.
    sound = F.when(record.isNotNull() & (surplus | unpaired) & (F.length(F.concat_ws("", F.col(f"`{header.fields[0].name}`"))) >= 0), stop)
    return text.where(sound.otherwise(F.lit(True))).drop(_BROKEN)


def read_csv_split(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``read_csv_text(multiline=True)`` and ``_source_file``, with
    large files read by many tasks (see ``csv_records``).

    Every file must have the same header. A record with more fields than it, or
    with quotes that don't pair up, stops the read, with its text in the
    message; one with fewer fields is filled with NULL, an empty line is left out.
    """
    header = spark.read.options(**QUOTING, header=True, multiLine=True, inferSchema=False).csv(path).columns
    fields = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header) + 1)])
    rows = records(spark, path).where("record <> ''").withColumn("first", (F.col("split") == 0) & (F.col("nth") == 1))
    cells = rows.select("file", "first", "record", F.from_csv("record", fields.simpleString()[7:-1].replace(":", " "), {**QUOTING, "multiLine": "true"}).alias("x"))
    # A mark put behind the record shows up as a cell of its own, unless an open
    # quote takes it in or there are more fields than the header has.
    marked = F.from_csv(F.concat("record", F.lit("," + _MARK)), fields.simpleString()[7:-1].replace(":", " "), {**QUOTING, "multiLine": "true"})
    ended = F.array_contains(F.array(*[F.coalesce(marked[f"c{i}"], F.lit("")) for i in range(len(header) + 1)]), _MARK)
    same = F.array(*[F.coalesce(F.col(f"x.c{i}"), F.lit("")) for i in range(len(header))]) == F.array(*[F.lit(h) for h in header])
    stop = lambda text: F.raise_error(F.concat(F.lit(text), F.left("record", F.lit(200)))).cast("boolean")
    sound = F.when(~ended, stop(f"A record has more fields than the header of {len(header)}, or quotes that don't pair up: ")).when(
        F.col("first"), F.when(same, F.lit(False)).otherwise(stop("A file's header differs from that of the others: "))).otherwise(F.lit(True))
    name = F.url_decode(F.replace(F.element_at(F.split("file", "/"), -1), F.lit("+"), F.lit("%2B")))
    return cells.where(sound).select(*[F.col(f"x.c{i}").alias(h) for i, h in enumerate(header)], name.alias("_source_file"))


def plain_file_name():
    """The name of the file a row comes from, as it is on disk: the metadata
    column has it in the form of a URL, in which a plus stands for itself."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def map_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Header check, rename to staging names, drop unknown columns.

    The pandas missing-value spellings become NULL here. ``keep`` lists extra
    columns to carry through unchanged.
    """
    missing = sorted(set(CSV_COLUMN_MAP) - set(df.columns))
    if missing:
        raise ValueError(
            f"The CSV header lacks {missing}; it has {sorted(df.columns)}"
        )
    cols = []
    for header, name in CSV_COLUMN_MAP.items():
        c = F.col(f"`{header}`")
        cols.append(F.when(~c.isin(*NA_STRINGS), c).alias(name))
    return df.select(*cols, *keep)


def read_raw_csv(spark: SparkSession, path: str, multiline: bool | str = False) -> DataFrame:
    """Raw rows in staging names, with ``_source_file`` set to each row's file name.

    Plain CSV is split by byte ranges, so a large file is read by many tasks.
    With ``multiline=True`` every file is read whole by one task; the rows are
    then rebalanced (a round-robin shuffle that AQE sizes), so one big file does
    not leave the labelling of a third of the data to a single task. With
    ``multiline="split"`` files with quoted line breaks are read by byte ranges,
    too, for one shuffle of their lines.
    """
    if multiline == "split":
        return map_columns(read_csv_split(spark, path), keep=("_source_file",))
    text = read_csv_text(spark, path, multiline)
    with_file = text.withColumn("_source_file", plain_file_name())
    raw = map_columns(with_file, keep=("_source_file",))
    return raw.hint("rebalance") if multiline else raw
