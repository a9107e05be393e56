"""The four KPI tables over the fact table.

Each KPI is one grouped aggregate: partial aggregation runs in every task
before the shuffle, so a hot key (one airline holding a third of the rows)
costs one pre-aggregated row per task, not a third of the data in one task.

Every KPI takes fact rows or ``base`` of them: one row for each combination of
their keys, with counts, sums, minima and maxima that can be put together. So
all four come from one pass over the fact.

Shared semantics: NULL group keys are dropped; means skip NULL values while
counts count rows; means over fares are exact decimal sums divided by the
non-NULL count; means are rounded half-to-even at 4 decimals, percentages at 2.
Ties are broken by the group key so results are deterministic.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelens.functions.exprs import exact_mean, require_columns, round_half_even, to_double
from farelens.model import (
    BASELINE_SEASON,
    KPI_AVERAGE_FARE_TABLE,
    KPI_BOOKING_COUNT_TABLE,
    KPI_POPULAR_ROUTES_TABLE,
    KPI_SEASONAL_VARIATION_TABLE,
    TOP_N_ROUTES,
)


BASE_KEYS = ("airline", "seasonality", "route", "source", "destination")
FARES = ("base_fare_bdt", "tax_surcharge_bdt", "total_fare_bdt")
_N = "n_rows"


def base(fact: DataFrame) -> DataFrame:
    """Counts, exact fare sums, minima and maxima for each combination of keys."""
    require_columns(fact, (*BASE_KEYS, *FARES, "is_peak_season"), "base")
    each = [a for c in FARES for a in (F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"n_{c}"))]
    return fact.groupBy(*BASE_KEYS).agg(
        F.count(F.lit(1)).alias(_N), *each, F.min("total_fare_bdt").alias("min_total_fare_bdt"),
        F.max("total_fare_bdt").alias("max_total_fare_bdt"), F.max("is_peak_season").alias("is_peak_season"))


class _Rows:
    """Aggregates over fact rows."""

    rows = staticmethod(lambda: F.count(F.lit(1)))
    mean = staticmethod(exact_mean)
    lowest = staticmethod(F.min)
    highest = staticmethod(F.max)


class _Base:
    """The same aggregates over ``base``."""

    rows = staticmethod(lambda: F.sum(_N))
    mean = staticmethod(lambda c: F.try_divide(to_double(F.sum(f"sum_{c}")), F.sum(f"n_{c}")))
    lowest = staticmethod(lambda c: F.min(f"min_{c}"))
    highest = staticmethod(lambda c: F.max(f"max_{c}"))


def _aggregates(df: DataFrame, needed: tuple[str, ...], what: str):
    if _N in df.columns:
        return _Base
    require_columns(df, needed, what)
    return _Rows


def average_fare_by_airline(fact: DataFrame) -> DataFrame:
    """KPI 1: mean base, tax and total fare per airline, min/max total, rows."""
    of = _aggregates(fact, ("airline", *FARES), "average_fare_by_airline")
    return (
        fact.where(F.col("airline").isNotNull())
        .groupBy("airline")
        .agg(
            round_half_even(of.mean("base_fare_bdt"), 4).alias("average_base_fare"),
            round_half_even(of.mean("tax_surcharge_bdt"), 4).alias("average_tax_charge"),
            round_half_even(of.mean("total_fare_bdt"), 4).alias("average_total_fare"),
            to_double(of.lowest("total_fare_bdt")).alias("min_total_fare"),
            to_double(of.highest("total_fare_bdt")).alias("max_total_fare"),
            of.rows().alias("flight_count"),
        )
        .orderBy(F.desc_nulls_last("average_total_fare"), "airline")
    )


def seasonal_fare_variation(fact: DataFrame) -> DataFrame:
    """KPI 2: mean total per season and its % difference from the baseline.

    The percentage uses the unrounded means. The baseline is a scalar subquery
    over the per-season rows (run once, its shuffle reused, no join); with no
    baseline rows, or a zero baseline, the percentage is NULL.
    """
    of = _aggregates(fact, ("seasonality", "is_peak_season", "total_fare_bdt"), "seasonal_fare_variation")
    per_season = (
        fact.where(F.col("seasonality").isNotNull())
        .groupBy("seasonality")
        .agg(
            F.max("is_peak_season").alias("is_peak_season"),
            of.mean("total_fare_bdt").alias("mean_total"),
            of.rows().alias("flight_count"),
        )
    )
    # The subquery takes the whole baseline row (a struct of every per-season
    # column), so column pruning leaves its aggregate identical to the main one
    # and Spark reuses that shuffle instead of aggregating the input again.
    baseline_row = F.struct(*[F.col(c) for c in per_season.columns])
    baseline = per_season.agg(
        F.max(F.when(F.col("seasonality") == BASELINE_SEASON, baseline_row))
    ).scalar().getField("mean_total")
    pct = F.try_divide(F.col("mean_total") - baseline, baseline) * 100
    return (
        per_season.select(
            "seasonality",
            F.coalesce(F.col("is_peak_season"), F.lit(False)).alias("is_peak_season"),
            round_half_even("mean_total", 4).alias("average_total_fare"),
            "flight_count",
            round_half_even(pct, 2).alias("variation_vs_baseline_pct"),
        )
        .orderBy(F.desc_nulls_last("average_total_fare"), "seasonality")
    )


def booking_count_by_airline(fact: DataFrame) -> DataFrame:
    """KPI 3: rows per airline and their share of rows with an airline.

    The total is a scalar subquery over the per-airline counts (run once, its
    shuffle reused): no join and no unpartitioned window.
    """
    of = _aggregates(fact, ("airline",), "booking_count_by_airline")
    counts = (
        fact.where(F.col("airline").isNotNull())
        .groupBy("airline")
        .agg(of.rows().alias("booking_count"))
    )
    total = counts.agg(F.sum("booking_count")).scalar()
    share = F.try_divide(F.col("booking_count").cast("double"), F.nullif(total, F.lit(0))) * 100
    return (
        counts.select("airline", "booking_count", round_half_even(share, 2).alias("booking_share_pct"))
        .orderBy(F.desc("booking_count"), "airline")
    )


def popular_routes(fact: DataFrame, top_n: int | None = None) -> DataFrame:
    """KPI 4: top routes by rows, ranked over all routes, then cut.

    Ranking every route and keeping the first n equals sorting, taking n and
    numbering them, so the plan is a top-n (each task keeps n candidates, one
    task merges them) and the window runs over n rows only.
    """
    of = _aggregates(fact, ("route", "source", "destination", "total_fare_bdt"), "popular_routes")
    limit = TOP_N_ROUTES if top_n is None else top_n
    order = [F.desc("booking_count"), F.asc("route"), F.asc("source"), F.asc("destination")]
    top = (
        fact.where(F.col("route").isNotNull() & F.col("source").isNotNull()
                   & F.col("destination").isNotNull())
        .groupBy("route", "source", "destination")
        .agg(of.rows().alias("booking_count"), of.mean("total_fare_bdt").alias("mean_total"))
        .orderBy(*order)
        .limit(limit)
    )
    return (
        top.withColumn("rank_position", F.row_number().over(Window.orderBy(*order)))
        .select("route", "source", "destination", "booking_count",
                round_half_even("mean_total", 4).alias("average_total_fare"), "rank_position")
        .orderBy("rank_position")
    )


# Report order of each stored KPI table.
KPI_ORDER = {
    KPI_AVERAGE_FARE_TABLE: (("average_total_fare", "desc"), ("airline", "asc")),
    KPI_SEASONAL_VARIATION_TABLE: (("average_total_fare", "desc"), ("seasonality", "asc")),
    KPI_BOOKING_COUNT_TABLE: (("booking_count", "desc"), ("airline", "asc")),
    KPI_POPULAR_ROUTES_TABLE: (("rank_position", "asc"),),
}


def ordered(kpi_table: DataFrame, table: str) -> DataFrame:
    """A stored KPI table in its report order (the tables are a few rows each)."""
    return kpi_table.orderBy(*[F.desc(c) if d == "desc" else F.asc(c) for c, d in KPI_ORDER[table]])


def compute_all(fact: DataFrame) -> dict[str, DataFrame]:
    """Every KPI keyed by its table name (lazy frames), of fact rows or a stored ``base``."""
    return {
        KPI_AVERAGE_FARE_TABLE: average_fare_by_airline(fact),
        KPI_SEASONAL_VARIATION_TABLE: seasonal_fare_variation(fact),
        KPI_BOOKING_COUNT_TABLE: booking_count_by_airline(fact),
        KPI_POPULAR_ROUTES_TABLE: popular_routes(fact),
    }


def stacked(tables: dict[str, DataFrame]) -> DataFrame:
    """The four KPI tables as one: kpi, name, rows_counted, average_total_fare,
    and each table's own figure (highest fare, variation, share, rank)."""
    parts = ((KPI_AVERAGE_FARE_TABLE, "airline", "flight_count", "average_total_fare", "max_total_fare"),
             (KPI_SEASONAL_VARIATION_TABLE, "seasonality", "flight_count", "average_total_fare", "variation_vs_baseline_pct"),
             (KPI_BOOKING_COUNT_TABLE, "airline", "booking_count", None, "booking_share_pct"),
             (KPI_POPULAR_ROUTES_TABLE, "route", "booking_count", "average_total_fare", "rank_position"))
    frames = [tables[t].select(F.lit(t).alias("kpi"), F.col(name).alias("name"), F.col(n).cast("long").alias("rows_counted"),
                               (F.col(mean) if mean else F.lit(None)).cast("double").alias("average_total_fare"), to_double(own).alias("figure"))
              for t, name, n, mean, own in parts]
    return functools.reduce(DataFrame.unionByName, frames)
