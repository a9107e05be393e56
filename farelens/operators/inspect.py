"""Inspection queries over labelled staging rows.

Each is a single aggregate or a top-n over one scan. Percentages follow SQL
numeric ``ROUND`` (half away from zero).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.functions.exprs import round_half_up, to_double
from farelens.model import (
    FARE_CASE_EXACT,
    FARE_CASE_MISMATCH,
    FARE_CASE_UPLIFT,
    FARE_RECONCILIATION_TOLERANCE,
    KNOWN_FARE_UPLIFT_FACTOR,
    NOT_NULL_COLUMNS,
    SQL_UPLIFT_TOLERANCE,
)


def staging_verdict(staging: DataFrame) -> DataFrame:
    """Total, valid, invalid and unlabelled rows, and the valid percentage."""
    valid = F.count_if(F.col("is_valid"))
    return staging.agg(
        F.count(F.lit(1)).alias("total_rows"),
        valid.alias("valid_rows"),
        F.count_if(~F.col("is_valid")).alias("invalid_rows"),
        F.count_if(F.col("is_valid").isNull()).alias("unlabelled_rows"),
        round_half_up(F.try_divide(valid * 100.0, F.count(F.lit(1))), 2).alias("valid_pct"),
    )


def failure_signatures(staging: DataFrame) -> DataFrame:
    """Distinct ``validation_errors`` strings of invalid rows with their counts."""
    return (
        staging.where(~F.col("is_valid"))
        .groupBy("validation_errors")
        .agg(F.count(F.lit(1)).alias("rows_affected"))
        .orderBy(F.desc("rows_affected"), "validation_errors")
    )


FLAGGED_COLUMNS = ("airline", "source", "destination", "base_fare_bdt",
                   "tax_surcharge_bdt", "total_fare_bdt", "validation_errors")


def flagged_rows(staging: DataFrame, n: int = 100,
                 order_by: Sequence[str] = ("id",)) -> DataFrame:
    """The first ``n`` invalid rows in ``order_by`` order (a top-n, not a sort).

    ``order_by`` columns are kept in the output; the listed fare columns are
    returned as doubles. Remaining ties are broken by every output column.
    """
    cols = [*order_by, *[c for c in FLAGGED_COLUMNS if c not in order_by]]
    out = [F.col(c) if not c.endswith("_bdt") else to_double(c).alias(c) for c in cols]
    return (
        staging.where(~F.col("is_valid"))
        .select(*out)
        .orderBy(*[F.asc_nulls_first(c) for c in cols])
        .limit(n)
    )


def fare_case(staging: DataFrame):
    comp = F.col("base_fare_bdt") + F.col("tax_surcharge_bdt")
    exact = F.abs(F.col("total_fare_bdt") - comp) <= F.lit(FARE_RECONCILIATION_TOLERANCE).cast("decimal(3,2)")
    ratio = F.try_divide(to_double(F.col("total_fare_bdt")), to_double(comp))
    uplift = (comp != 0) & (F.abs(ratio - F.lit(KNOWN_FARE_UPLIFT_FACTOR)) <= F.lit(SQL_UPLIFT_TOLERANCE))
    return (
        F.when(exact, F.lit(FARE_CASE_EXACT))
        .when(uplift, F.lit(FARE_CASE_UPLIFT))
        .otherwise(F.lit(FARE_CASE_MISMATCH))
    )


def fare_cases(staging: DataFrame) -> DataFrame:
    """Rows per fare case (exact / 1.20x uplift / mismatch) and % of all rows.

    The table total is a scalar subquery over the per-case counts (three
    rows, shuffle reused), so the scan is not repeated and nothing is joined.
    """
    per_case = staging.groupBy(fare_case(staging).alias("fare_case")).agg(
        F.count(F.lit(1)).alias("rows_affected")
    )
    total = per_case.agg(F.sum("rows_affected")).scalar()
    pct = F.try_divide(F.col("rows_affected") * 100.0, total)
    return (
        per_case.select("fare_case", "rows_affected", round_half_up(pct, 2).alias("pct_of_table"))
        .orderBy(F.desc("rows_affected"), "fare_case")
    )


def null_counts(staging: DataFrame, columns: Sequence[str] = NOT_NULL_COLUMNS) -> DataFrame:
    """NULL count per required column: one aggregate, then unpivoted."""
    agg = staging.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return agg.unpivot([], list(columns), "column_name", "null_rows")


def _text_key(c: str, case_insensitive: bool):
    """A grouping key; optionally compared case- and accent-insensitively, as a
    database with a case-insensitive collation would group it."""
    return F.collate(F.col(c), "UNICODE_CI_AI") if case_insensitive else F.col(c)


def source_codes(staging: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """Distinct source values as staged, with counts."""
    return (
        staging.groupBy(_text_key("source", case_insensitive).alias("code"))
        .agg(F.count(F.lit(1)).alias("rows_affected"))
        .orderBy(F.asc_nulls_first("code"))
    )


def airline_validity(staging: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """Rows and invalid rows per airline, airlines with invalid rows only."""
    return (
        staging.groupBy(_text_key("airline", case_insensitive).alias("airline"))
        .agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(~F.col("is_valid")).alias("invalid_rows"))
        .where(F.col("invalid_rows") > 0)
        .orderBy(F.desc("invalid_rows"), F.asc_nulls_first("airline"))
    )


def provenance(staging: DataFrame, with_time: bool = True) -> DataFrame:
    """Rows per (source file, ingest time)."""
    keys = ["_source_file", "_ingested_at"] if with_time else ["_source_file"]
    return staging.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_loaded"))


def declared_lengths(staged: DataFrame, lengths: dict[str, int]) -> DataFrame:
    """Per text column with a declared length: that length, the longest value and
    how many values are over it, in one pass."""
    known = {c: n for c, n in lengths.items() if c in staged.columns}
    row = staged.agg(*[F.max(F.length(c)).alias(f"longest_{c}") for c in known], *[F.count_if(F.length(c) > n).alias(f"over_{c}") for c, n in known.items()])
    lines = [F.struct(F.lit(c).alias("column_name"), F.lit(n).cast("long").alias("declared"), F.col(f"longest_{c}").cast("long").alias("longest"),
                      F.col(f"over_{c}").alias("overlong")) for c, n in known.items()]
    return row.select(F.inline(F.array(*lines)))
