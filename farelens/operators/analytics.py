"""Analytical queries over the fact table (and the KPI tables).

Grouped aggregates with conditional means (SQL ``FILTER``), two-level
aggregates and top-n cuts. Means over fares are exact decimal sums divided by
the count; reported values are rounded half away from zero at 2 decimals.
Every top-n carries a full tie-break.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.functions.exprs import exact_mean, round_half_up, to_double
from farelens.model import LEAD_TIME_BUCKETS, OPEN_LEAD_TIME_BUCKET, TAX_FLOOR_BDT


def _mean_where(cond, column: str = "total_fare_bdt"):
    return exact_mean(F.when(cond, F.col(column)))


def uplift_effect(fact: DataFrame) -> DataFrame:
    """Per airline: rows, uplift rows, mean fare with and without uplift rows."""
    all_mean = exact_mean("total_fare_bdt")
    excl = _mean_where(~F.col("has_fare_uplift"))
    return (
        fact.groupBy("airline")
        .agg(
            F.count(F.lit(1)).alias("total_flights"),
            F.count_if(F.col("has_fare_uplift")).alias("uplift_flights"),
            round_half_up(all_mean, 2).alias("avg_fare_all"),
            round_half_up(excl, 2).alias("avg_fare_excluding_uplift"),
            round_half_up(all_mean - excl, 2).alias("uplift_effect_bdt"),
        )
        .orderBy(F.desc_nulls_last("uplift_effect_bdt"), F.asc_nulls_first("airline"))
    )


def uplift_ratio(fact: DataFrame) -> DataFrame:
    """Count and min/max of total / (base + tax) over uplift rows."""
    comp = F.col("base_fare_bdt") + F.col("tax_surcharge_bdt")
    ratio = to_double(F.col("total_fare_bdt")) / to_double(comp)
    return fact.where(F.col("has_fare_uplift") & (comp != 0)).agg(
        F.count(F.lit(1)).alias("uplift_rows"),
        F.min(ratio).alias("min_ratio"),
        F.max(ratio).alias("max_ratio"),
    )


def peak_vs_offpeak(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("is_peak_season")
        .agg(
            F.count(F.lit(1)).alias("flights"),
            round_half_up(exact_mean("total_fare_bdt"), 2).alias("avg_total_fare"),
            round_half_up(exact_mean("base_fare_bdt"), 2).alias("avg_base_fare"),
            round_half_up(exact_mean("tax_surcharge_bdt"), 2).alias("avg_tax_surcharge"),
        )
        .orderBy(F.desc_nulls_first("is_peak_season"))
    )


def peak_premium(fact: DataFrame) -> DataFrame:
    """Per airline with peak rows: peak and off-peak means and the premium %."""
    peak = _mean_where(F.col("is_peak_season"))
    off = _mean_where(~F.col("is_peak_season"))
    premium = F.try_divide((peak - off) * 100, F.nullif(off, F.lit(0.0)))
    return (
        fact.groupBy("airline")
        .agg(
            round_half_up(peak, 2).alias("avg_peak_fare"),
            round_half_up(off, 2).alias("avg_offpeak_fare"),
            round_half_up(premium, 2).alias("peak_premium_pct"),
            F.count_if(F.col("is_peak_season")).alias("_peak_rows"),
        )
        .where(F.col("_peak_rows") > 0)
        .drop("_peak_rows")
        .orderBy(F.desc_nulls_last("peak_premium_pct"), F.asc_nulls_first("airline"))
    )


def monthly_trend(fact: DataFrame) -> DataFrame:
    month = F.date_trunc("month", F.col("departure_datetime")).cast("date")
    return (
        fact.where(F.col("departure_datetime").isNotNull())
        .groupBy(month.alias("departure_month"))
        .agg(F.count(F.lit(1)).alias("flights"),
             round_half_up(exact_mean("total_fare_bdt"), 2).alias("avg_total_fare"))
        .orderBy("departure_month")
    )


def lead_time_bucket():
    days = F.col("days_before_departure")
    expr = None
    for bound, name in LEAD_TIME_BUCKETS:
        expr = F.when(days <= bound, F.lit(name)) if expr is None else expr.when(days <= bound, F.lit(name))
    return expr.otherwise(F.lit(OPEN_LEAD_TIME_BUCKET))


def lead_time(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("days_before_departure").isNotNull())
        .groupBy(lead_time_bucket().alias("lead_time_bucket"))
        .agg(F.count(F.lit(1)).alias("flights"),
             round_half_up(exact_mean("total_fare_bdt"), 2).alias("avg_total_fare"))
        .orderBy("lead_time_bucket")
    )


def airline_class(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("airline", "flight_class")
        .agg(F.count(F.lit(1)).alias("flights"),
             round_half_up(exact_mean("total_fare_bdt"), 2).alias("avg_total_fare"))
        .orderBy(F.asc_nulls_first("airline"), F.desc_nulls_first("avg_total_fare"),
                 F.asc_nulls_first("flight_class"))
    )


def tax_share(fact: DataFrame) -> DataFrame:
    """Per class: rows, rows at the tax floor, mean tax share of the total (%)."""
    share = F.try_divide(100 * to_double("tax_surcharge_bdt"),
                         F.nullif(to_double("total_fare_bdt"), F.lit(0.0)))
    return (
        fact.groupBy("flight_class")
        .agg(
            F.count(F.lit(1)).alias("flights"),
            F.count_if(F.col("tax_surcharge_bdt") == TAX_FLOOR_BDT).alias("at_tax_floor"),
            round_half_up(F.avg(share), 2).alias("avg_tax_pct_of_total"),
        )
        .orderBy(F.desc_nulls_first("avg_tax_pct_of_total"), F.asc_nulls_first("flight_class"))
    )


def route_spread(fact: DataFrame, n: int = 20) -> DataFrame:
    """Busiest routes with cheapest / mean / dearest fare and airlines serving.

    ``count(distinct airline)`` per route is planned as an aggregate on
    (route, airline) first, so a hot route is spread over its airlines.
    """
    fare_type = fact.schema["total_fare_bdt"].dataType
    return (
        fact.groupBy("route")
        .agg(
            F.count(F.lit(1)).alias("bookings"),
            round_half_up(F.min("total_fare_bdt"), 2, fare_type).alias("cheapest"),
            round_half_up(exact_mean("total_fare_bdt"), 2).alias("average"),
            round_half_up(F.max("total_fare_bdt"), 2, fare_type).alias("dearest"),
            F.countDistinct("airline").alias("airlines_serving"),
        )
        .orderBy(F.desc("bookings"), F.asc_nulls_first("route"))
        .limit(n)
    )


def route_airline_spread(fact: DataFrame, n: int = 20) -> DataFrame:
    """Routes whose airline means differ most (two-level aggregate, top n).

    After the inner group (route, airline) is unique, so the outer distinct
    airline count is a plain count of non-NULL airlines.
    """
    per_airline = fact.groupBy("route", "airline").agg(exact_mean("total_fare_bdt").alias("airline_avg"))
    return (
        per_airline.groupBy("route")
        .agg(
            F.count("airline").alias("airlines_serving"),
            F.min("airline_avg").alias("lo"),
            F.max("airline_avg").alias("hi"),
        )
        .where(F.col("airlines_serving") > 1)
        .select(
            "route",
            "airlines_serving",
            round_half_up("lo", 2).alias("cheapest_airline_avg"),
            round_half_up("hi", 2).alias("dearest_airline_avg"),
            round_half_up(F.col("hi") - F.col("lo"), 2).alias("spread_bdt"),
        )
        .orderBy(F.desc_nulls_first("spread_bdt"), F.asc_nulls_first("route"))
        .limit(n)
    )


def stopovers(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("stopovers")
        .agg(
            F.count(F.lit(1)).alias("flights"),
            round_half_up(F.avg("duration_hrs"), 2).alias("avg_duration_hrs"),
            round_half_up(exact_mean("total_fare_bdt"), 2).alias("avg_total_fare"),
        )
        .orderBy(F.desc_nulls_first("avg_total_fare"), F.asc_nulls_first("stopovers"))
    )


def fact_provenance(fact: DataFrame) -> DataFrame:
    """Per source file: latest load time (when stored), rows, airlines, routes, uplift rows."""
    sums = {"rows_loaded": F.count(F.lit(1)), "uplift_rows": F.count_if(F.col("has_fare_uplift"))}
    stamp = {"loaded_at": F.max("_loaded_at")} if "_loaded_at" in fact.columns else {}
    counted = distinct_counts(fact, {"airlines": ("airline",), "routes": ("route",)}, sums, by=("_source_file",), latest=stamp)
    return counted.select("_source_file", *stamp, "rows_loaded", "airlines", "routes", "uplift_rows")


def distinct_counts(df: DataFrame, distinct: dict[str, tuple[str, ...]], sums: dict, by: tuple[str, ...] = (),
                    latest: dict | None = None) -> DataFrame:
    """Sums and distinct counts in one pass over ``df``.

    ``distinct`` names column tuples whose distinct values without a NULL are
    counted, ``sums`` aggregates that add up, ``latest`` aggregates that take a
    maximum, all by ``by``. The rows are reduced once, to one for each
    combination of the columns that occurs; the distinct counts come from that
    small result, so no row of ``df`` is copied for each of them.
    """
    latest = latest or {}
    columns = list(dict.fromkeys(c for t in distinct.values() for c in t))
    groups = df.groupBy(*by, *columns).agg(*[a.alias(k) for k, a in {**sums, **latest}.items()])
    # For each count a copy of the small result that keeps only its own columns,
    # and one that keeps none, for the sums.
    of = lambda kind, cols: F.struct(F.lit(kind).alias("kind"), *[(F.col(c) if c in cols else F.lit(None)).cast(groups.schema[c].dataType).alias(f"of_{c}") for c in columns])
    kinds = F.array(of(-1, ()), *[of(i, cols) for i, cols in enumerate(distinct.values())])
    each = groups.select(*by, *sums, *latest, F.inline(kinds))
    each = each.groupBy(*by, "kind", *[f"of_{c}" for c in columns]).agg(*[F.sum(k).alias(k) for k in sums], *[F.max(k).alias(k) for k in latest])
    whole = F.col("kind") == -1
    known = lambda cols: functools.reduce(lambda a, b: a & b, [F.col(f"of_{c}").isNotNull() for c in cols])
    return each.groupBy(*by).agg(
        *[F.coalesce(F.sum(F.when(whole, F.col(k))), F.lit(0)).alias(k) for k in sums],
        *[F.max(F.when(whole, F.col(k))).alias(k) for k in latest],
        *[F.count_if((F.col("kind") == i) & known(cols)).alias(k) for i, (k, cols) in enumerate(distinct.items())],
    )


def reconciliation(fact: DataFrame, booking_kpi: DataFrame, fare_kpi: DataFrame) -> DataFrame:
    """Fact and KPI totals side by side as (metric, value-as-text) rows.

    Each input is reduced to a single row first; the union is five rows.
    """
    fact_counts = fact.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("airline").alias("airlines"))
    parts = [
        fact_counts.select(F.lit("fact rows").alias("metric"), F.col("rows").cast("string").alias("value")),
        booking_kpi.agg(F.sum("booking_count").cast("string").alias("value"))
        .select(F.lit("sum of KPI bookings").alias("metric"), "value"),
        fare_kpi.agg(F.sum("flight_count").cast("string").alias("value"))
        .select(F.lit("sum of KPI flights").alias("metric"), "value"),
        fact_counts.select(F.lit("distinct fact airlines").alias("metric"),
                           F.col("airlines").cast("string").alias("value")),
        fare_kpi.agg(F.count(F.lit(1)).cast("string").alias("value"))
        .select(F.lit("KPI airline rows").alias("metric"), "value"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
