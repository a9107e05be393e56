"""Cleaning and enrichment of validated rows into the fact table.

All steps are projections (no shuffle). The stated total always wins; a total
is computed from its parts only where it is missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.functions.exprs import clean_column, require_columns, strip, upper_code
from farelens.model import (
    BASELINE_SEASON,
    CODE_COLUMNS,
    FACT_COLUMNS,
    FARE_TYPE,
    PEAK_SEASONS,
    TEXT_COLUMNS,
)
from farelens.sources.staging import conform


def _cleaned(df: DataFrame, c: str, how) -> Column:
    """The column as ``rules.label`` cleaned it (``keep_clean``), else cleaned here."""
    return F.col(clean_column(c)) if clean_column(c) in df.columns else how(c)


def clean_text(df: DataFrame) -> DataFrame:
    """Strip the free-text columns that are present."""
    return df.withColumns({c: _cleaned(df, c, strip) for c in TEXT_COLUMNS if c in df.columns})


def clean_codes(df: DataFrame) -> DataFrame:
    """Strip and upper-case the two location codes."""
    return df.withColumns({c: _cleaned(df, c, upper_code) for c in CODE_COLUMNS})


def clean(df: DataFrame) -> DataFrame:
    """Text, codes and types; fare values are not changed."""
    return clean_codes(clean_text(conform(df)))


def reconcile_total_fare(df: DataFrame) -> DataFrame:
    """Fill a NULL total with base + tax (NULL if either part is NULL)."""
    computed = (F.col("base_fare_bdt") + F.col("tax_surcharge_bdt")).try_cast(FARE_TYPE)
    return df.withColumn("total_fare_bdt", F.coalesce(F.col("total_fare_bdt"), computed))


def add_route(df: DataFrame) -> DataFrame:
    """``SRC-DST``; NULL when either code is NULL."""
    return df.withColumn("route", F.concat(F.col("source"), F.lit("-"), F.col("destination")))


def add_peak_flag(df: DataFrame) -> DataFrame:
    """``is_peak_season``; an unknown or NULL season is not peak."""
    return df.withColumn(
        "is_peak_season", F.coalesce(strip("seasonality").isin(*PEAK_SEASONS), F.lit(False))
    )


def add_uplift_flag(df: DataFrame, flag_column: str | None = "has_known_uplift") -> DataFrame:
    """``has_fare_uplift`` from the validation flag computed before cleaning.

    The flag is a column of the same row, so no join is needed; without it the
    value is false.
    """
    if flag_column and flag_column in df.columns:
        value = F.coalesce(F.col(flag_column), F.lit(False))
    else:
        value = F.lit(False)
    return df.withColumn("has_fare_uplift", value)


def unknown_seasons(df: DataFrame) -> DataFrame:
    """Distinct non-NULL seasons that are neither peak nor the baseline.

    The known set is a constant, so this is a filter plus a distinct (partial
    aggregation on each task), not a join.
    """
    season = strip("seasonality")
    known = (*PEAK_SEASONS, BASELINE_SEASON)
    return (
        df.select(season.alias("seasonality"))
        .where(F.col("seasonality").isNotNull() & ~F.col("seasonality").isin(*known))
        .distinct()
    )


def enrich(df: DataFrame, flag_column: str | None = "has_known_uplift") -> DataFrame:
    return add_uplift_flag(add_peak_flag(add_route(df)), flag_column)


def select_fact_columns(df: DataFrame) -> DataFrame:
    require_columns(df, FACT_COLUMNS, "Fact table")
    return df.select(*FACT_COLUMNS)


def transform(df: DataFrame, flag_column: str | None = "has_known_uplift",
              require_rows: bool = False) -> DataFrame:
    """clean -> reconcile -> enrich -> project, over rows already chosen.

    Lazy. ``require_rows`` adds an ``isEmpty`` probe (one small job) and raises
    on empty input; the pipeline skips it because the quality report already
    holds the valid row count.
    """
    if require_rows and df.isEmpty():
        raise ValueError("No valid row is left to make fact rows from.")
    return select_fact_columns(enrich(reconcile_total_fare(clean(df)), flag_column))


def fact_from_labelled(labelled: DataFrame) -> DataFrame:
    """Valid rows of a labelled frame as fact rows."""
    return transform(labelled.where(F.col("is_valid")))
