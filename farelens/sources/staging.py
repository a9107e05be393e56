"""Turns raw rows (CSV text or typed columns) into the typed staging frame.

Staging keeps a faithful record of what arrived: columns are typed, nothing is
cleaned or dropped. Where a numeric column arrives as text and the text does not
parse, the original string is kept beside the (NULL) typed value as
``_raw_<column>``, so the non-numeric rule can tell "missing" from "present but
not a number". The raw column is NULL on every row that parsed, so it costs
almost nothing to store.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.functions.exprs import (
    parse_decimal,
    parse_double,
    parse_int,
    parse_timestamp,
)
from farelens.model import NUMERIC_COLUMNS, STAGED_TYPES


def raw_column_name(column: str) -> str:
    return f"_raw_{column}"


def _typed(df: DataFrame, name: str, target: T.DataType, timestamp_format: str | None = None) -> Column:
    current = df.schema[name].dataType
    col = F.col(name)
    if isinstance(current, T.StringType) and not isinstance(target, T.StringType):
        if isinstance(target, T.DecimalType):
            return parse_decimal(col, target)
        if isinstance(target, T.DoubleType):
            return parse_double(col)
        if isinstance(target, T.IntegerType):
            return parse_int(col)
        if isinstance(target, T.TimestampNTZType):
            return parse_timestamp(col, timestamp_format)
    if current == target:
        if isinstance(target, T.DoubleType):
            return F.when(~F.isnan(col), col)  # NaN is missing, as in a CSV reader
        return col
    if isinstance(current, (T.FloatType, T.DoubleType)):
        col = F.when(~F.isnan(col), col)
    return col.try_cast(target)


def conform(df: DataFrame, timestamp_format: str | None = None) -> DataFrame:
    """Cast every known staging column present to its staging type.

    Numeric columns that arrive as text keep an unparseable string in
    ``_raw_<c>`` (NULL where the value parsed or was missing). Unknown columns
    pass through unchanged; absent optional columns stay absent. Timestamps are
    read as ISO text and, where given, by ``timestamp_format``.
    """
    out, kept = [], []
    for name in df.columns:
        target = STAGED_TYPES.get(name)
        if target is None:
            out.append(F.col(name))
        elif name in NUMERIC_COLUMNS and isinstance(df.schema[name].dataType, T.StringType):
            # The raw column reads the parsed one, so each text is parsed once.
            out += [F.col(name).alias(raw_column_name(name)), _typed(df, name, target).alias(name)]
            kept.append(name)
        else:
            out.append(_typed(df, name, target, timestamp_format).alias(name))
    typed = df.select(*out)
    return typed.withColumns({raw_column_name(c): F.when(F.col(c).isNull(), F.col(raw_column_name(c))) for c in kept})


def stage(df: DataFrame, source_file: str | None = None,
          ingested_at: datetime | None = None, with_id: bool = True,
          timestamp_format: str | None = None) -> DataFrame:
    """Typed staging rows with provenance and a row id.

    ``_source_file`` is kept when the source already set it (one name per input
    file); otherwise ``source_file`` is stamped. ``_ingested_at`` is one value
    per run, fixed on the driver so every partition and every retry agrees.
    ``id`` is unique but not consecutive; it is stable only once staging is
    written, which the pipeline does before anything reads it.
    """
    staged = conform(df, timestamp_format)
    if "_source_file" not in staged.columns:
        staged = staged.withColumn("_source_file", F.lit(source_file).cast("string"))
    when = ingested_at or datetime.now(timezone.utc).replace(tzinfo=None)
    staged = staged.withColumn("_ingested_at", F.lit(when).cast(T.TimestampNTZType()))
    if with_id:
        staged = staged.select(F.monotonically_increasing_id().alias("id"), "*")
    return staged
