"""Raw CSV source: checks, header map, record structure, missing spellings, provenance."""

import csv
import os

import pytest

from farelens.model import CSV_COLUMN_MAP, NA_STRINGS
from farelens.sources import csv as csv_source
from farelens.sources.staging import stage
from tests.helpers import SOUND, plan_of

HEADERS = list(CSV_COLUMN_MAP)


def good_values(**changes):
    """The sound row under the CSV's headers."""
    return {h: SOUND[name] for h, name in CSV_COLUMN_MAP.items()} | changes


def write_csv(path, rows, headers=HEADERS):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(headers)
        for r in rows:
            w.writerow([r.get(h, "") for h in headers] if isinstance(r, dict) else r)
    return path


def test_missing_path_names_the_path(spark, tmp_out):
    with pytest.raises(FileNotFoundError, match="nope.csv"):
        csv_source.check_source_file(spark, os.path.join(tmp_out, "nope.csv"))


def test_empty_file_is_refused(spark, tmp_out):
    path = os.path.join(tmp_out, "void.csv")
    open(path, "w").close()
    with pytest.raises(ValueError, match="void.csv"):
        csv_source.check_source_file(spark, path)


def test_missing_header_names_the_column(spark, tmp_out):
    path = write_csv(os.path.join(tmp_out, "f.csv"), [good_values()], [h for h in HEADERS if h != "Class"])
    with pytest.raises(ValueError, match="Class"):
        csv_source.read_raw_csv(spark, path)


@pytest.mark.parametrize("name", ["plain.csv", "my fares 50%.csv", "a+b&c.csv", "très.csv"])
def test_names_are_mapped_and_the_file_is_named_plainly(spark, tmp_out, name):
    path = write_csv(os.path.join(tmp_out, name), [good_values() | {"Extra": "x"}], [*HEADERS, "Extra"])
    df = csv_source.read_raw_csv(spark, path)
    assert df.columns == [*CSV_COLUMN_MAP.values(), "_source_file"]
    r = df.first()
    assert r["flight_class"] == "Premium" and r["_source_file"] == name


def test_quoted_cells(spark, tmp_out):
    path = write_csv(os.path.join(tmp_out, "q.csv"), [good_values(Airline='Kite, "the" Air'), good_values(Airline='say ""')])
    assert [r["airline"] for r in csv_source.read_raw_csv(spark, path).collect()] == ['Kite, "the" Air', 'say ""']


def test_a_quoted_line_break_needs_whole_file_reading(spark, tmp_out):
    path = write_csv(os.path.join(tmp_out, "m.csv"), [good_values(**{"Source Name": "Quay\nNorth"})])
    with pytest.raises(Exception, match="multiline_csv=True"):
        csv_source.read_raw_csv(spark, path).collect()
    r = csv_source.read_raw_csv(spark, path, multiline=True).collect()
    assert [x["source_name"] for x in r] == ["Quay\nNorth"]


@pytest.mark.parametrize("extra", [["surplus"], [""], ["a", "b", "c"]])
@pytest.mark.parametrize("multiline", [False, True])
def test_a_record_with_too_many_fields_stops_the_read(spark, tmp_out, extra, multiline):
    path = write_csv(os.path.join(tmp_out, "l.csv"), [good_values(), [*good_values().values(), *extra]])
    with pytest.raises(Exception, match="more fields"):
        csv_source.read_raw_csv(spark, path, multiline).collect()


def test_a_short_record_is_filled(spark, tmp_out):
    path = write_csv(os.path.join(tmp_out, "s.csv"), [list(good_values().values())[:10]])
    df = csv_source.read_raw_csv(spark, path)
    r = df.first()
    assert r["aircraft_type"] == "T-70" and r["flight_class"] is None and r["total_fare_bdt"] is None
    assert df.count() == 1


def test_missing_value_spellings_read_as_null(spark, tmp_out):
    rows = [good_values(Seasonality=na) for na in NA_STRINGS] + [good_values(Seasonality="  NA"), good_values()]
    path = write_csv(os.path.join(tmp_out, "na.csv"), rows)
    values = [r["seasonality"] for r in csv_source.read_raw_csv(spark, path).collect()]
    assert values == [None] * len(NA_STRINGS) + ["  NA", "Regular"]


def test_staging_types_and_provenance(spark, tmp_out):
    path = write_csv(os.path.join(tmp_out, "t.csv"), [good_values(), good_values(**{"Base Fare (BDT)": "abc"})])
    st = stage(csv_source.read_raw_csv(spark, path)).orderBy("id").collect()
    assert st[0]["base_fare_bdt"] is not None and st[1]["base_fare_bdt"] is None
    assert st[1]["_raw_base_fare_bdt"] == "abc" and st[0]["_raw_base_fare_bdt"] is None
    assert st[0]["_ingested_at"] == st[1]["_ingested_at"] and len({r["id"] for r in st}) == 2


def test_timestamps_of_another_format(spark, tmp_out):
    path = write_csv(os.path.join(tmp_out, "d.csv"), [good_values(**{"Departure Date & Time": "11/17/2031 06:25"}), good_values()])
    raw = csv_source.read_raw_csv(spark, path)
    assert [r["departure_datetime"] is None for r in stage(raw).collect()] == [True, False]
    got = [str(r["departure_datetime"]) for r in stage(raw, timestamp_format="MM/dd/yyyy HH:mm").collect()]
    assert got == ["2031-11-17 06:25:00", "2031-07-09 22:40:00"]


def test_whole_file_reads_are_rebalanced(spark, tmp_out):
    path = write_csv(os.path.join(tmp_out, "w.csv"), [good_values()] * 20)
    assert "Exchange" not in plan_of(csv_source.read_raw_csv(spark, path))
    whole = csv_source.read_raw_csv(spark, path, multiline=True)
    assert "RebalancePartitions" in whole._jdf.queryExecution().optimizedPlan().toString()
    assert whole.count() == 20
