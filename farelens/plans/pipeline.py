"""The batch run: source -> labelled staging -> report and gate -> fact -> KPIs.

Stage boundaries are written tables, which cut lineage: a lost executor costs
a recomputation within one stage, never a replay of the whole run.

* staging: one scan of the source stages, labels and writes every row,
  partitioned by ``is_valid``; the quality report is observed during that same
  write (no second scan);
* the report is written before the gate, so a failing run keeps its evidence;
* fact: reads only the ``is_valid=true`` folder, cleans and enriches;
* KPIs: one scan of the fact gives a small table of counts, sums, minima and
  maxima by the KPIs' keys; the four KPIs, the distinct counts of the summary
  and the unknown seasons come from that table.
"""

from __future__ import annotations

import functools
import json
import logging
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.model import (
    FACT_SCHEMA,
    FACT_TABLE,
    KNOWN_FARE_UPLIFT_FACTOR,
    KPI_AVERAGE_FARE_TABLE,
    KPI_BOOKING_COUNT_TABLE,
    KPI_POPULAR_ROUTES_TABLE,
    KPI_SCHEMAS,
    KPI_SEASONAL_VARIATION_TABLE,
    MIN_VALID_ROW_RATIO,
    REPORT_FILENAME,
    STAGED_LENGTHS,
    STAGING_TABLE,
)
from farelens.operators import analytics, enrich, kpis, rules
from farelens.plans import sinks
from farelens.sources import csv as csv_source
from farelens.sources import tables
from farelens.sources.staging import stage

log = logging.getLogger(__name__)

KPI_KEYS = {
    KPI_AVERAGE_FARE_TABLE: ("airline",),
    KPI_SEASONAL_VARIATION_TABLE: ("seasonality",),
    KPI_BOOKING_COUNT_TABLE: ("airline",),
    KPI_POPULAR_ROUTES_TABLE: ("route",),
}
#: Not an analytics table: what the KPIs are put together from.
KPI_BASE = "kpi_base"
FACT_NOT_NULL = ("airline", "source", "destination", "base_fare_bdt", "tax_surcharge_bdt",
                 "total_fare_bdt", "_loaded_at")


@dataclass
class RunResult:
    run_id: str
    report: dict
    fact_summary: dict = field(default_factory=dict)
    row_counts: dict = field(default_factory=dict)
    timings: dict = field(default_factory=dict)
    load_summary: dict = field(default_factory=dict)
    completed_at: str | None = None
    unknown_seasons: list[str] = field(default_factory=list)
    n_unknown_seasons: int = 0


def _run_id(now: datetime) -> str:
    return now.strftime("%Y%m%dT%H%M%S%fZ")


def load_staging(raw: DataFrame, out_dir: str, run_id: str, source_file: str | None,
                 ingested_at: datetime, timestamp_format: str | None = None,
                 compact: bool = False, check_lengths: bool = False) -> dict:
    """Stage, label and write every row; returns the quality report.

    Written straight from the input splits, each task may write two files, one
    of them with the few invalid rows. ``compact`` deals the rows out by
    ``is_valid`` first, a shuffle of all rows that adaptive execution cuts to
    its advisory size, so files are few and full. ``check_lengths`` refuses
    text over its declared length.
    """
    staged = stage(raw, source_file=source_file, ingested_at=ingested_at, timestamp_format=timestamp_format)
    labelled = rules.label(staged, keep_bits=True)
    rs = rules.rules(staged)
    if compact:
        labelled = labelled.hint("rebalance", "is_valid")
    observed = sinks.publish(
        labelled, out_dir, STAGING_TABLE, run_id,
        partition_by=("is_valid",), allow_empty=False,
        observe=rules.report_columns(labelled, with_total=False),
        drop=(rules.RULE_BITS,),
        lengths=STAGED_LENGTHS if check_lengths else None,
    )
    total = observed["_rows"]
    valid = observed["valid_rows"]
    return {
        "total_rows": total,
        "valid_rows": valid,
        "invalid_rows": total - valid,
        "valid_ratio": round(valid / total, 6) if total else 0.0,
        "failed_checks": {r.label: observed[r.label] for r in rs if observed[r.label]},
        "rows_with_known_fare_uplift": observed["rows_with_known_fare_uplift"],
        "fare_uplift_factor": KNOWN_FARE_UPLIFT_FACTOR,
        "min_valid_ratio_required": MIN_VALID_ROW_RATIO,
    }


def publish_fact(fact: DataFrame, out_dir: str, run_id: str, loaded_at: datetime) -> dict:
    """Fact rows written and published with their load stamp and id."""
    stamped = fact.withColumns({
        "_loaded_at": F.lit(loaded_at).cast("timestamp_ntz"),
        "id": F.monotonically_increasing_id(),
    })
    return sinks.publish(
        stamped, out_dir, FACT_TABLE, run_id, schema=FACT_SCHEMA, not_null=FACT_NOT_NULL,
        observe=[F.count_if(F.col("has_fare_uplift")).alias("uplift_rows")],
    )


def load_fact(spark: SparkSession, out_dir: str, run_id: str, loaded_at: datetime,
              report: dict) -> dict:
    # This run's own versions are read by path; readers outside the run follow
    # the version log.
    valid = tables.read_staging(spark, sinks.version_path(out_dir, STAGING_TABLE, run_id), valid_only=True)
    observed = publish_fact(enrich.transform(valid), out_dir, run_id, loaded_at)
    return {
        "fact_rows_loaded": observed["_rows"],
        "staged_rows": report["total_rows"],
        "excluded_invalid_rows": report["invalid_rows"],
        "rows_with_fare_uplift": observed["uplift_rows"],
    }


def load_kpi_base(spark: SparkSession, out_dir: str, run_id: str) -> DataFrame:
    """``kpis.base`` of this run's fact, written once: the only scan of the fact
    that the KPIs need. It has a row for each combination of keys that occurs."""
    path = sinks.version_path(out_dir, KPI_BASE, run_id)
    kpis.base(spark.read.parquet(sinks.version_path(out_dir, FACT_TABLE, run_id))).write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def distinct_summary(base: DataFrame) -> dict:
    return base.agg(F.count_distinct("airline").alias("distinct_airlines"), F.count_distinct("route").alias("distinct_routes")).first().asDict()


def load_kpis(spark: SparkSession, out_dir: str, run_id: str, computed_at: datetime,
              parallel: int = 4, base: DataFrame | None = None) -> dict[str, int]:
    """Compute and publish the four KPI tables as independent concurrent jobs.

    All read the stored ``kpis.base``, not the fact. A KPI table has one row per
    group (airlines, seasons, top routes), so it is written as one file:
    ``repartition(1)`` after the final aggregate moves only those rows, where
    ``coalesce(1)`` would pull the final aggregation itself into one task.
    """
    base = load_kpi_base(spark, out_dir, run_id) if base is None else base

    def one(item):
        table, frame = item
        stamped = frame.repartition(1).withColumn("computed_at", F.lit(computed_at).cast("timestamp_ntz"))
        required = tuple(f.name for f in KPI_SCHEMAS[table].fields if not f.nullable)
        metrics = sinks.publish(stamped, out_dir, table, run_id, schema=KPI_SCHEMAS[table],
                                key=KPI_KEYS[table], not_null=(*required, "computed_at"))
        return table, metrics["_rows"]

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return dict(pool.map(one, kpis.compute_all(base).items()))


def load_tables(fact: DataFrame, out_dir: str, run_id: str, stamp: datetime) -> str:
    """Fact rows and their KPIs as published tables under ``out_dir``."""
    publish_fact(fact, out_dir, run_id, stamp)
    load_kpis(fact.sparkSession, out_dir, run_id, stamp)
    return out_dir


def unknown_seasons(rows: DataFrame, named: int = 20) -> tuple[list[str], int]:
    """Warns of seasons of fact or KPI base rows that are neither peak nor
    baseline; the first ``named`` of them by name, and how many there are."""
    every = enrich.unknown_seasons(rows)
    found = [r["seasonality"] for r in every.orderBy("seasonality").limit(named).collect()]
    n = len(found) if len(found) < named else every.count()
    if n > len(found):
        log.warning("Seasons counted as off-peak because they are not known: %s and %d more; the query unknown_seasons lists all", found, n - len(found))
    elif found:
        log.warning("Seasons counted as off-peak because they are not known: %s", found)
    return found, n


def stored_row_counts(spark: SparkSession, out_dir: str, version: str | None = None) -> DataFrame:
    """(table_name, rows) of every stored analytics table, counted in one job.

    ``version`` counts that run's folders; by default the current versions.
    """
    def one(t: str) -> DataFrame:
        path = sinks.version_path(out_dir, t, version) if version else sinks.current_path(spark, out_dir, t)
        return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows")

    return functools.reduce(DataFrame.unionByName, [one(t) for t in (FACT_TABLE, *KPI_SCHEMAS)])


def row_counts(spark: SparkSession, out_dir: str, version: str | None = None) -> dict[str, int]:
    """Recount every analytics table from storage; fail if any is empty."""
    counts = {r["table_name"]: r["rows"] for r in stored_row_counts(spark, out_dir, version).collect()}
    empty = [t for t, n in counts.items() if n == 0]
    if empty:
        raise ValueError(f"The run left these tables without rows: {empty}")
    return counts


def stored_reconciliation(spark: SparkSession, out_dir: str) -> DataFrame:
    """``analytics.reconciliation`` of the published fact and KPI tables."""
    read = lambda t: sinks.read_current(spark, out_dir, t)
    return analytics.reconciliation(read(FACT_TABLE), read(KPI_BOOKING_COUNT_TABLE), read(KPI_AVERAGE_FARE_TABLE))


def run(spark: SparkSession, source: str | DataFrame, out_dir: str, *,
        min_valid_ratio: float = MIN_VALID_ROW_RATIO, multiline_csv: bool | str = False,
        source_file: str | None = None, timestamp_format: str | None = None,
        compact_staging: bool = False, check_lengths: bool = False) -> RunResult:
    """The whole run. ``source`` is a CSV path (file or folder) or a raw frame.

    ``multiline_csv`` allows quoted line breaks: True reads each file whole,
    "split" reads large files by byte ranges. ``timestamp_format`` names the
    pattern of timestamps that aren't ISO text. ``compact_staging`` and
    ``check_lengths`` are those of ``load_staging``.
    """
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    run_id = _run_id(now)
    if isinstance(source, str):
        csv_source.check_source_file(spark, source)
        raw = csv_source.read_raw_csv(spark, source, multiline_csv)
        name = source_file or source.rstrip("/").rsplit("/", 1)[-1]
    else:
        raw, name = source, source_file

    rules.validate_required_columns(raw)
    timings = {}
    t0 = time.perf_counter()
    report = load_staging(raw, out_dir, run_id, name, now, timestamp_format, compact_staging, check_lengths)
    timings["staging"] = time.perf_counter() - t0
    rules.check_not_empty(report)
    sinks.write_report_json(spark, {**report, "source_file": name}, f"{out_dir}/{REPORT_FILENAME}")
    log.info("quality report %s", json.dumps(report))
    rules.enforce_quality_threshold(report, min_valid_ratio)
    if report["valid_rows"] == 0:
        raise ValueError("Every staged row failed a rule, so there is no fact to load.")

    t0 = time.perf_counter()
    fact_summary = load_fact(spark, out_dir, run_id, now, report)
    timings["fact"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    base = load_kpi_base(spark, out_dir, run_id)
    load_kpis(spark, out_dir, run_id, now, base=base)
    fact_summary |= distinct_summary(base)
    seasons = unknown_seasons(base)
    timings["kpis"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    counts = row_counts(spark, out_dir, run_id)
    timings["summary"] = time.perf_counter() - t0
    load_summary = {"source_file": name, "rows_loaded": report["total_rows"],
                    "ingested_at": now.isoformat()}
    done = datetime.now(timezone.utc).isoformat()
    return RunResult(run_id, report, fact_summary, counts, timings, load_summary, done, *seasons)
