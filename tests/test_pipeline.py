"""End-to-end batch run: staging, report before the gate, fact, KPIs, versions."""

import json
import logging
import os
from datetime import timedelta

import pytest

from farelens.model import (
    FACT_COLUMNS,
    FACT_TABLE,
    KPI_TABLES,
    STAGING_TABLE,
    QualityGateError,
    SchemaValidationError,
)
from farelens.plans import pipeline, sinks
from tests.test_csv import good_values, write_csv


def fares_csv(path, n_good=40, n_bad=1):
    """Sound rows of three airlines and two routes, every tenth with the uplift,
    then rows without an airline."""
    airlines, seasons = ["Kite Air", "Gull", "Heron Lines"], ["Regular", "Eid", "Winter Holidays", "Hajj"]
    rows = [good_values(Airline=airlines[i % 3], Seasonality=seasons[i % 4], Destination=["QBB", "QCC"][i % 2],
                        **{"Total Fare (BDT)": "840" if i % 10 == 0 else "700"}) for i in range(n_good)]
    return write_csv(path, rows + [good_values(Airline="")] * n_bad)


def report_at(out):
    with open(f"{out}/data_quality_report.json", encoding="utf-8") as f:
        return json.load(f)


def test_full_run(spark, tmp_out):
    src = fares_csv(os.path.join(tmp_out, "my fares.csv"))
    out = os.path.join(tmp_out, "out")
    res = pipeline.run(spark, src, out)
    assert res.report["total_rows"] == 41 and res.report["valid_rows"] == 40
    assert res.report["failed_checks"] == {"null_airline": 1, "blank_airline": 1}
    assert res.report["rows_with_known_fare_uplift"] == 4
    written = report_at(out)
    assert written["source_file"] == "my fares.csv" and written["valid_rows"] == 40
    fact = sinks.read_current(spark, out, FACT_TABLE)
    assert fact.columns == [*FACT_COLUMNS, "_loaded_at", "id"]
    rows = fact.select("id", "_source_file").collect()
    assert len({r["id"] for r in rows}) == 40 and {r["_source_file"] for r in rows} == {"my fares.csv"}
    assert res.fact_summary == {"fact_rows_loaded": 40, "staged_rows": 41, "excluded_invalid_rows": 1,
                                "rows_with_fare_uplift": 4, "distinct_airlines": 3, "distinct_routes": 2}
    assert res.row_counts[FACT_TABLE] == 40 and set(res.row_counts) == {FACT_TABLE, *KPI_TABLES}
    for table in KPI_TABLES:
        stamps = {r["computed_at"] for r in sinks.read_current(spark, out, table).collect()}
        assert len(stamps) == 1 and None not in stamps
    booking = sinks.read_current(spark, out, "kpi_booking_count_by_airline")
    assert sum(r["booking_count"] for r in booking.collect()) == 40
    assert sinks.read_current(spark, out, STAGING_TABLE).count() == 41
    assert res.load_summary["source_file"] == "my fares.csv" and res.load_summary["rows_loaded"] == 41
    assert res.completed_at is not None and res.unknown_seasons == []


def test_load_checks_see_a_broken_table(spark, tmp_out):
    """What is stored is counted: a KPI table with rows lost or changed shows."""
    out = os.path.join(tmp_out, "out")
    res = pipeline.run(spark, fares_csv(os.path.join(tmp_out, "fares.csv")), out)
    read = lambda: dict(map(tuple, pipeline.stored_reconciliation(spark, out).collect()))
    sound = {"fact rows": "40", "sum of KPI bookings": "40", "sum of KPI flights": "40", "distinct fact airlines": "3", "KPI airline rows": "3"}
    assert read() == sound
    fares = sinks.read_current(spark, out, "kpi_average_fare_by_airline")
    sinks.publish(fares.where("airline <> 'Gull'"), out, "kpi_average_fare_by_airline", "lost")
    booking = sinks.read_current(spark, out, "kpi_booking_count_by_airline")
    sinks.publish(booking.withColumn("booking_count", booking["booking_count"] + 1), out, "kpi_booking_count_by_airline", "changed")
    assert read() == sound | {"sum of KPI bookings": "43", "sum of KPI flights": "27", "KPI airline rows": "2"}
    assert pipeline.row_counts(spark, out)["kpi_average_fare_by_airline"] == 2
    assert pipeline.row_counts(spark, out, res.run_id)["kpi_average_fare_by_airline"] == 3
    sinks.publish(booking.where("false"), out, "kpi_booking_count_by_airline", "empty")
    with pytest.raises(ValueError, match="kpi_booking_count_by_airline"):
        pipeline.row_counts(spark, out)


def test_gate_failure_keeps_report_and_previous_tables(spark, tmp_out):
    out = os.path.join(tmp_out, "out")
    first = pipeline.run(spark, fares_csv(os.path.join(tmp_out, "good.csv")), out)
    with pytest.raises(QualityGateError):
        pipeline.run(spark, fares_csv(os.path.join(tmp_out, "bad.csv"), n_good=10, n_bad=10), out)
    assert report_at(out)["source_file"] == "bad.csv"  # written before the gate, over the old one
    assert [f for f in os.listdir(out) if f.startswith("data_quality_report.json")] == ["data_quality_report.json"]
    assert sinks.current_version(spark, out, FACT_TABLE) == first.run_id
    assert sinks.read_current(spark, out, FACT_TABLE).count() == 40


def test_a_header_alone_is_refused_and_not_published(spark, tmp_out):
    out = os.path.join(tmp_out, "out")
    with pytest.raises(SchemaValidationError):
        pipeline.run(spark, write_csv(os.path.join(tmp_out, "h.csv"), []), out)
    with pytest.raises(FileNotFoundError):
        sinks.current_version(spark, out, STAGING_TABLE)


def test_unknown_seasons_are_warned_of(spark, tmp_out, caplog):
    rows = [good_values(), good_values(Seasonality="Monsoon"), good_values(Seasonality="Harvest")]
    with caplog.at_level(logging.WARNING):
        res = pipeline.run(spark, write_csv(os.path.join(tmp_out, "u.csv"), rows), os.path.join(tmp_out, "out"))
    assert res.unknown_seasons == ["Harvest", "Monsoon"] and "Monsoon" in caplog.text


def test_unknown_seasons_beyond_the_named_are_counted(spark, tmp_out, caplog):
    rows = [good_values(), *[good_values(Seasonality=f"Season {k:02}") for k in range(23)]]
    with caplog.at_level(logging.WARNING):
        res = pipeline.run(spark, write_csv(os.path.join(tmp_out, "u.csv"), rows), os.path.join(tmp_out, "out"))
    assert len(res.unknown_seasons) == 20 and res.n_unknown_seasons == 23
    assert "3 more" in caplog.text and "query unknown_seasons" in caplog.text


def test_rerun_gives_the_same_tables_and_keeps_the_old(spark, tmp_out):
    src, out = fares_csv(os.path.join(tmp_out, "fares.csv")), os.path.join(tmp_out, "out")
    read = lambda: sorted(map(str, sinks.read_current(spark, out, "kpi_average_fare_by_airline").drop("computed_at").collect()))
    a = pipeline.run(spark, src, out)
    kpi_a = read()
    b = pipeline.run(spark, src, out)
    assert a.run_id != b.run_id and kpi_a == read() and a.fact_summary == b.fact_summary
    versions = sorted(d for d in os.listdir(f"{out}/{FACT_TABLE}") if d.startswith("v="))
    assert versions == sorted([f"v={a.run_id}", f"v={b.run_id}"])
    assert sinks.current_version(spark, out, FACT_TABLE) == b.run_id


def test_constraints_keep_a_table_from_being_published(spark, tmp_out):
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "airline string, n int")
    with pytest.raises(sinks.LoadCheckError, match="airline"):
        sinks.publish(twice, tmp_out, "t", "v1", key=("airline",))
    with pytest.raises(sinks.LoadCheckError, match="NOT NULL"):
        sinks.publish(spark.createDataFrame([(None,)], "n int"), tmp_out, "t", "v2", not_null=("n",))
    with pytest.raises(FileNotFoundError):
        sinks.current_version(spark, tmp_out, "t")


def folders(root):
    return sorted(d for d in os.listdir(f"{root}/t") if d.startswith("v="))


def test_publishing_deletes_nothing(spark, tmp_out):
    df = spark.createDataFrame([(1,)], "x int")
    os.makedirs(f"{tmp_out}/t/v=inflight")  # another run is still writing it
    for v in ("v1", "v2", "v3", "v4"):
        sinks.publish(df, tmp_out, "t", v)
    assert folders(tmp_out) == ["v=inflight", "v=v1", "v=v2", "v=v3", "v=v4"]


def test_pruning_takes_old_recorded_versions_only(spark, tmp_out):
    df = spark.createDataFrame([(1,)], "x int")
    os.makedirs(f"{tmp_out}/t/v=inflight")
    for v in ("v1", "v2", "v3"):
        sinks.publish(df, tmp_out, "t", v)
    assert sinks.prune_versions(spark, tmp_out, "t", older_than=timedelta(hours=1)) == []
    assert sorted(sinks.prune_versions(spark, tmp_out, "t", older_than=timedelta(0), keep=1)) == ["v1", "v2"]
    assert folders(tmp_out) == ["v=inflight", "v=v3"]
    assert sinks.read_current(spark, tmp_out, "t").count() == 1
