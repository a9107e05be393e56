"""Benchmark: the batch run plus every report over the stored tables.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].
Setup (timed apart): the driver tables are mapped onto raw fare rows and
written once as a fare CSV with the source headers, split over several files.
Measured: the pipeline reads that CSV, stages, labels, reports, gates, builds
the fact table and the four KPI tables, each written as a table; then the
inspection and analytics queries run over the stored staging and fact tables,
as an analyst would run them. BENCH_SOURCE=frame feeds the mapped frame to the
pipeline directly instead (mapping joins inside the measured run).

Prints one JSON line; "value" is the median wall time of $BENCH_RUNS (default
3) measured runs, each into fresh output folders; per-query values are medians.
"""

from __future__ import annotations

import json
import statistics
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from farelens.model import FACT_TABLE, KPI_BOOKING_COUNT_TABLE, KPI_AVERAGE_FARE_TABLE, STAGING_TABLE  # noqa: E402
from farelens.operators import analytics, inspect, kpis  # noqa: E402
from farelens.plans import pipeline, sinks  # noqa: E402
from farelens.session import build_session  # noqa: E402
from farelens.sources import tables  # noqa: E402
from farelens.sources.mapping import raw_from_tpch  # noqa: E402


def write_fare_csv(raw, path: str, files: int) -> None:
    """The mapped rows as a fare CSV with the source headers (setup only)."""
    from pyspark.sql import functions as F

    from farelens.model import CSV_COLUMN_MAP

    cols = [F.col(name).cast("string").alias(header) for header, name in CSV_COLUMN_MAP.items()]
    (raw.select(*cols).repartition(files).write.mode("overwrite")
        .option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path))


def reports(staging, fact, booking, fares) -> dict:
    """The inspection and analytics reports over the stored tables."""
    return {
        "staging_verdict": inspect.staging_verdict(staging),
        "failure_signatures": inspect.failure_signatures(staging),
        "flagged_rows": inspect.flagged_rows(staging),
        "fare_cases": inspect.fare_cases(staging),
        "null_counts": inspect.null_counts(staging),
        "source_codes": inspect.source_codes(staging),
        "airline_validity": inspect.airline_validity(staging),
        "provenance": inspect.provenance(staging),
        "uplift_effect": analytics.uplift_effect(fact),
        "uplift_ratio": analytics.uplift_ratio(fact),
        "peak_vs_offpeak": analytics.peak_vs_offpeak(fact),
        "peak_premium": analytics.peak_premium(fact),
        "monthly_trend": analytics.monthly_trend(fact),
        "lead_time": analytics.lead_time(fact),
        "airline_class": analytics.airline_class(fact),
        "tax_share": analytics.tax_share(fact),
        "route_spread": analytics.route_spread(fact),
        "route_airline_spread": analytics.route_airline_spread(fact),
        "stopovers": analytics.stopovers(fact),
        "fact_provenance": analytics.fact_provenance(fact),
        "reconciliation": analytics.reconciliation(fact, booking, fares),
        "kpi_popular_routes_top5": kpis.popular_routes(fact, 5),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": "16g"})
    out = tempfile.mkdtemp(prefix="farelens-bench-", dir=os.environ.get("BENCH_OUT", "/tmp"))

    mode = os.environ.get("BENCH_SOURCE", "csv")

    def source(sf: str, name: str):
        if mode == "frame":
            return raw_from_tpch(spark, sf)
        path = f"{out}/{name}-csv"
        write_fare_csv(raw_from_tpch(spark, sf), path, cpus * 2)
        return path

    # One untimed warm-up run on the smallest tables (JVM start, JIT, codegen
    # caches); its time is reported apart from the measured run.
    t0 = time.perf_counter()
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir):
        pipeline.run(spark, source(warm_dir, "warmup"), f"{out}/warmup", source_file="fares")
    warmup = time.perf_counter() - t0
    t0 = time.perf_counter()
    src = source(sf_dir, "measured")
    setup = time.perf_counter() - t0
    root = out

    def measured_run(out: str):
        times: dict[str, float] = {}
        t_all = time.perf_counter()
        result = pipeline.run(spark, src, out, source_file="fares")
        for k, v in result.timings.items():
            times[f"pipeline_{k}"] = v
        staging = tables.read_staging(spark, sinks.current_path(spark, out, STAGING_TABLE))
        fact = sinks.read_current(spark, out, FACT_TABLE)
        booking = sinks.read_current(spark, out, KPI_BOOKING_COUNT_TABLE)
        fares = sinks.read_current(spark, out, KPI_AVERAGE_FARE_TABLE)
        for name, df in reports(staging, fact, booking, fares).items():
            t0 = time.perf_counter()
            df.collect()
            times[name] = time.perf_counter() - t0
        return time.perf_counter() - t_all, times, result

    runs = [measured_run(f"{root}/measured-{i}") for i in range(int(os.environ.get("BENCH_RUNS", "3")))]
    totals = [r[0] for r in runs]
    total = statistics.median(totals)
    times = {k: statistics.median(r[1][k] for r in runs) for k in runs[0][1]}
    result = runs[0][2]

    print(json.dumps({
        "metric": "pipeline_and_reports_wall",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "rows_staged": result.report["total_rows"],
        "rows_valid": result.report["valid_rows"],
        "cpus": cpus,
        "warmup_sec": round(warmup, 3),
        "source": mode,
        "setup_sec": round(setup, 3),
        "runs_sec": [round(t, 3) for t in totals],
    }))


if __name__ == "__main__":
    main()
