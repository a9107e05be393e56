"""Every registered query, built over the driver tables mapped to the fare model.

``tpch_frames`` derives the raw rows from the TPC-H-like tables (see
``farelens.sources.mapping``) and stacks staging, labels and fact on them, all
lazily; each query is a function of those frames. Fares are returned as
doubles and engine-made values (row id, load times) are left out, so results
can be compared with an independent SQL engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.model import (
    KPI_AVERAGE_FARE_TABLE,
    KPI_BOOKING_COUNT_TABLE,
    KPI_POPULAR_ROUTES_TABLE,
    KPI_SEASONAL_VARIATION_TABLE,
    KPI_TABLES,
    NUMERIC_COLUMNS,
    STAGED_LENGTHS,
    STAGED_TYPES,
    TEXT_COLUMNS,
)
from farelens.operators import analytics, enrich, inspect, kpis, rules
from farelens.plans import ids, pipeline, sinks, writeback
from farelens.session import METHOD_LIMIT, set_defaults
from farelens.sources.csv import map_columns
from farelens.sources.mapping import TEXT_TIME_FORMAT, raw_from_tpch, text_from_tpch
from farelens.sources.staging import conform, raw_column_name, stage

LINEAGE = ("l_orderkey", "l_linenumber")
# A fixed stamp for the mapped source, so repeated runs give equal frames.
MAPPED_INGEST_TIME = datetime(2025, 1, 1)
RULE_FAMILIES = ("null", "negative", "blank", "malformed_code", "same_endpoints",
                 "fare_mismatch", "arrival_order", "duration", "lead_time")


@dataclass(frozen=True)
class Frames:
    staged: DataFrame
    labelled: DataFrame
    valid: DataFrame
    enriched: DataFrame
    fact: DataFrame
    text: DataFrame  # as read from text: staging names, missing spellings NULL
    text_staged: DataFrame


def tpch_frames(spark: SparkSession, sf_dir: str) -> Frames:
    staged = stage(raw_from_tpch(spark, sf_dir), ingested_at=MAPPED_INGEST_TIME, with_id=False)
    # Labels take every fare, airline and code, most of them several times.
    labelled = rules.label(stage(raw_from_tpch(spark, sf_dir, once=True), ingested_at=MAPPED_INGEST_TIME, with_id=False), keep_clean=True)
    valid = labelled.where(F.col("is_valid"))
    enriched = enrich.enrich(enrich.reconcile_total_fare(enrich.clean(valid)))
    text = map_columns(text_from_tpch(spark, sf_dir), keep=(*LINEAGE, "_source_file"))
    text_staged = conform(text, TEXT_TIME_FORMAT)
    return Frames(staged, labelled, valid, enriched, enrich.select_fact_columns(enriched), text, text_staged)


def shared_frames(spark: SparkSession, sf_dir: str) -> Frames:
    """``tpch_frames`` anew at every call: the file listing is never kept.

    The rules compile to methods that HotSpot would leave interpreted, so a
    session that wasn't built by ``build_session`` gets that limit here too.
    """
    set_defaults(spark, METHOD_LIMIT)
    return tpch_frames(spark, sf_dir)


def fares_as_double(df: DataFrame) -> DataFrame:
    return df.withColumns({
        f.name: F.col(f.name).cast(T.DoubleType())
        for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)
    })


def _with_lineage(df: DataFrame, *cols: str) -> DataFrame:
    return fares_as_double(df.select(*LINEAGE, *cols))


def _rule_family(family: str) -> Callable[[Frames], DataFrame]:
    return lambda fr: rules.rule_hits(fr.staged, family).select(*LINEAGE, "rule")


def _top_routes(n: int) -> Callable[[Frames], DataFrame]:
    return lambda fr: kpis.popular_routes(fr.fact, n)


def _loaded(fr: Frames) -> tuple[SparkSession, str]:
    """The fact and its KPIs written as the run writes them, to the shared
    folder; each call writes its own tables."""
    spark = fr.fact.sparkSession
    return spark, pipeline.load_tables(fr.fact, f"{sinks.scratch_dir(spark)}/loaded-{uuid.uuid4().hex}", "v1", MAPPED_INGEST_TIME)


def row_counts(fr: Frames) -> DataFrame:
    """Rows of the stored fact and KPI tables, counted from storage."""
    return pipeline.stored_row_counts(*_loaded(fr))


def reconciliation(fr: Frames) -> DataFrame:
    """Fact and KPI totals side by side, from the stored tables."""
    return pipeline.stored_reconciliation(*_loaded(fr))


def compute_all(fr: Frames) -> DataFrame:
    """The four stored KPI tables as one."""
    spark, out = _loaded(fr)
    return kpis.stacked({t: sinks.read_current(spark, out, t) for t in KPI_TABLES})


def labels_written_back(fr: Frames) -> DataFrame:
    """Labels computed from stored rows and written back to the stored table by
    id, in two label tables."""
    spark = fr.staged.sparkSession
    folder, name = f"{sinks.scratch_dir(spark)}/written-back-{uuid.uuid4().hex}", f"staging_{uuid.uuid4().hex}"
    fr.staged.select(F.monotonically_increasing_id().alias("id"), "*").write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    empty = {"is_valid": F.lit(None).cast("boolean"), "validation_errors": F.lit(None).cast("string")}
    writeback.store(rows.select("id", *LINEAGE).withColumns(empty), name, f"{folder}/table", folders=4, buckets=writeback.buckets_for(rows.count()))
    labels = rules.label(rows).select("id", "is_valid", "validation_errors")
    for half in (0, 1):
        writeback.write_back(spark, name, labels.where(F.pmod("id", F.lit(2)) == half))
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return spark.read.parquet(f"{folder}/table").select(*LINEAGE, "is_valid", "validation_errors")


def fact_summary(fr: Frames) -> DataFrame:
    """The load's summary, in one pass over the labelled rows."""
    every = enrich.enrich(enrich.clean(fr.labelled))
    valid = lambda c: F.when(F.col("is_valid"), F.col(c)).alias(c)
    rows = every.select("is_valid", (F.col("is_valid") & F.col("has_fare_uplift")).alias("uplift"), valid("airline"), valid("route"))
    return analytics.distinct_counts(rows, {"distinct_airlines": ("airline",), "distinct_routes": ("route",)}, {
        "fact_rows_loaded": F.count_if("is_valid"), "staged_rows": F.count(F.lit(1)),
        "excluded_invalid_rows": F.count_if(~F.col("is_valid")), "rows_with_fare_uplift": F.count_if("uplift")})


QUERIES: dict[str, Callable[[Frames], DataFrame]] = {
    # sources and staging
    "valid_rows": lambda fr: _with_lineage(fr.valid, *STAGED_TYPES, "_source_file"),
    "provenance": lambda fr: inspect.provenance(fr.staged, with_time=False),
    "row_ids": lambda fr: ids.numbered(fr.staged.select(*LINEAGE), LINEAGE),
    "labels_written_back": labels_written_back,
    "declared_lengths": lambda fr: inspect.declared_lengths(fr.staged, STAGED_LENGTHS),
    # row rules
    "rule_labels": lambda fr: fr.labelled.select(*LINEAGE, "is_valid", "validation_errors"),
    "invalid_rows": lambda fr: fr.labelled.where(~F.col("is_valid")).select(*LINEAGE, "validation_errors"),
    "fare_flags": lambda fr: fr.labelled.select(*LINEAGE, "reconciles_exactly", "has_known_uplift"),
    "rule_counts": lambda fr: rules.rule_counts(fr.staged),
    "quality_report": lambda fr: rules.quality_report(fr.labelled),
    **{f"rule_{fam}": _rule_family(fam) for fam in RULE_FAMILIES},
    # the text path: missing spellings, typing, and the rules that only text can break
    "na_spellings": lambda fr: fr.text.select(*LINEAGE, "airline", "seasonality", F.col("tax_surcharge_bdt").isNull().alias("no_tax"),
                                              F.col("duration_hrs").isNull().alias("no_duration")),
    "text_staged": lambda fr: _with_lineage(fr.text_staged, *STAGED_TYPES, *[raw_column_name(c) for c in NUMERIC_COLUMNS]),
    "text_rule_labels": lambda fr: rules.label(fr.text_staged).select(*LINEAGE, "is_valid", "validation_errors"),
    "text_rule_counts": lambda fr: rules.rule_counts(fr.text_staged),
    "rule_non_numeric": lambda fr: rules.rule_hits(fr.text_staged, "non_numeric").select(*LINEAGE, "rule"),
    # cleaning and enrichment
    "clean_text": lambda fr: _with_lineage(enrich.clean_text(fr.valid), *TEXT_COLUMNS),
    "clean_codes": lambda fr: _with_lineage(enrich.clean_codes(fr.valid), "source", "destination"),
    "reconcile_total": lambda fr: _with_lineage(enrich.reconcile_total_fare(fr.staged), "total_fare_bdt"),
    "enrich_route": lambda fr: _with_lineage(fr.enriched, "route"),
    "enrich_peak": lambda fr: _with_lineage(fr.enriched, "seasonality", "is_peak_season"),
    "enrich_uplift": lambda fr: _with_lineage(fr.enriched, "has_fare_uplift"),
    "unknown_seasons": lambda fr: enrich.unknown_seasons(fr.valid),
    "fact_table": lambda fr: fares_as_double(fr.fact),
    # KPIs
    "kpi_average_fare": lambda fr: kpis.average_fare_by_airline(fr.fact),
    "kpi_seasonal_variation": lambda fr: kpis.seasonal_fare_variation(fr.fact),
    "kpi_booking_count": lambda fr: kpis.booking_count_by_airline(fr.fact),
    "kpi_popular_routes": _top_routes(20),
    "kpi_popular_routes_top5": _top_routes(5),
    "compute_all": compute_all,
    # staging inspection
    "staging_verdict": lambda fr: inspect.staging_verdict(fr.labelled),
    "failure_signatures": lambda fr: inspect.failure_signatures(fr.labelled),
    "flagged_rows": lambda fr: inspect.flagged_rows(fr.labelled, 100, order_by=LINEAGE),
    "fare_cases": lambda fr: inspect.fare_cases(fr.labelled),
    "null_counts": lambda fr: inspect.null_counts(fr.staged),
    "source_codes": lambda fr: inspect.source_codes(fr.staged),
    "airline_validity": lambda fr: inspect.airline_validity(fr.labelled),
    # fact analytics
    "uplift_effect": lambda fr: analytics.uplift_effect(fr.fact),
    "uplift_ratio": lambda fr: analytics.uplift_ratio(fr.fact),
    "peak_vs_offpeak": lambda fr: analytics.peak_vs_offpeak(fr.fact),
    "peak_premium": lambda fr: analytics.peak_premium(fr.fact),
    "monthly_trend": lambda fr: analytics.monthly_trend(fr.fact),
    "lead_time": lambda fr: analytics.lead_time(fr.fact),
    "airline_class": lambda fr: analytics.airline_class(fr.fact),
    "tax_share": lambda fr: analytics.tax_share(fr.fact),
    "route_spread": lambda fr: analytics.route_spread(fr.fact),
    "route_airline_spread": lambda fr: analytics.route_airline_spread(fr.fact),
    "stopovers": lambda fr: analytics.stopovers(fr.fact),
    "fact_provenance": lambda fr: analytics.fact_provenance(fr.fact),
    "reconciliation": reconciliation,
    # load checks
    "row_counts": row_counts,
    "fact_summary": fact_summary,
}

KPI_TABLE_OF_KEY = {
    "kpi_average_fare": KPI_AVERAGE_FARE_TABLE,
    "kpi_seasonal_variation": KPI_SEASONAL_VARIATION_TABLE,
    "kpi_booking_count": KPI_BOOKING_COUNT_TABLE,
    "kpi_popular_routes": KPI_POPULAR_ROUTES_TABLE,
}
