"""Compact physical plans of every pipeline stage and report, as Markdown.

Runs the pipeline on a small fare CSV derived from the driver tables, then
prints, for each stage and report, the executed plan's operator tree with the
details that matter for scale (exchanges, joins, pushed and partition filters,
read schemas), expressions elided. Usage: python tools/plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import write_fare_csv  # noqa: E402
from farelens.model import FACT_TABLE, KPI_AVERAGE_FARE_TABLE, KPI_BOOKING_COUNT_TABLE, STAGING_TABLE  # noqa: E402
from farelens.operators import analytics, enrich, inspect, kpis, rules  # noqa: E402
from farelens.plans import pipeline, sinks  # noqa: E402
from farelens.session import build_session  # noqa: E402
from farelens.sources import csv as csv_source  # noqa: E402
from farelens.sources import tables  # noqa: E402
from farelens.sources.mapping import raw_from_tpch  # noqa: E402
from farelens.sources.staging import stage  # noqa: E402

KEEP = re.compile(r"(PushedFilters: \[[^\]]*\]|PartitionFilters: \[[^\]]*\]|ReadSchema: \S+)")


def outline(df) -> str:
    df.collect() if df.isStreaming is False else None
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    out = []
    for line in text.split("\n"):
        m = re.match(r"^([\s:|+\-]*)(\*\(\d+\) )?([A-Za-z]+)", line)
        if not m:
            continue
        indent, codegen, node = m.group(1), m.group(2) or "", m.group(3)
        detail = ""
        if node in ("Exchange",):
            detail = " " + line.split("Exchange", 1)[1].split(", [plan_id")[0].strip()[:80]
        elif "Join" in node:
            keys = re.findall(r"\[([^\]]*)\]", line)[:2]
            detail = " " + " = ".join(re.sub(r"#\d+L?", "", k) for k in keys) + (" " + line.split(",")[-2].strip() if "Join" in node else "")
        elif node == "FileScan":
            fmt = line.split("FileScan", 1)[1].split("[", 1)[0].strip()
            detail = " " + fmt + " " + " ".join(re.sub(r"#\d+L?", "", k) for k in KEEP.findall(line))
        elif node in ("TakeOrderedAndProject", "HashAggregate", "SortAggregate", "ObjectHashAggregate"):
            keys = re.search(r"keys=\[([^\]]*)\]", line)
            detail = f" keys=[{re.sub(r'#[0-9]+L?', '', keys.group(1))}]" if keys else ""
            if node == "TakeOrderedAndProject":
                lim = re.search(r"limit=(\d+)", line)
                detail = f" limit={lim.group(1)}" if lim else ""
        out.append(re.sub(r"#\d+L?", "", f"{indent}{codegen}{node}{detail}"))
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    work = tempfile.mkdtemp(prefix="farelens-plans-")
    src = f"{work}/csv"
    write_fare_csv(raw_from_tpch(spark, sf_dir), src, 16)
    out = f"{work}/tables"
    pipeline.run(spark, src, out, source_file="fares")

    staging = tables.read_staging(spark, sinks.current_path(spark, out, STAGING_TABLE))
    fact = sinks.read_current(spark, out, FACT_TABLE)
    frames = {
        "staging: CSV -> typed, labelled rows (written partitioned by is_valid)":
            rules.label(stage(csv_source.read_raw_csv(spark, src))),
        "fact: valid staging rows -> cleaned, enriched":
            enrich.transform(tables.read_staging(spark, sinks.current_path(spark, out, STAGING_TABLE), True)),
        "mapping of the driver tables (test adapter)": raw_from_tpch(spark, sf_dir),
        **{f"KPI {t}": f for t, f in kpis.compute_all(fact).items()},
        "quality report (lazy form)": rules.quality_report(staging),
        "failure_signatures": inspect.failure_signatures(staging),
        "flagged_rows": inspect.flagged_rows(staging),
        "fare_cases": inspect.fare_cases(staging),
        "null_counts": inspect.null_counts(staging),
        "uplift_effect": analytics.uplift_effect(fact),
        "peak_premium": analytics.peak_premium(fact),
        "lead_time": analytics.lead_time(fact),
        "route_spread": analytics.route_spread(fact),
        "route_airline_spread": analytics.route_airline_spread(fact),
        "reconciliation": analytics.reconciliation(
            fact, sinks.read_current(spark, out, KPI_BOOKING_COUNT_TABLE),
            sinks.read_current(spark, out, KPI_AVERAGE_FARE_TABLE)),
    }
    print("# PLANS\n")
    print(f"Executed physical plans (AQE final plans) on `{os.path.basename(sf_dir)}`, `local[8]`, "
          "expressions elided. Generated by `python tools/plans.py`.\n")
    for title, df in frames.items():
        print(f"## {title}\n\n```\n{outline(df)}\n```\n")


if __name__ == "__main__":
    main()
