"""CSV with quoted line breaks read by splits: the rows of a whole-file read."""

import csv
import os
import random

import pytest

from farelens.plans import pipeline
from farelens.sources import csv as csv_source
from farelens.sources.csv_records import lines, records, splits
from tests.test_csv import HEADERS, good_values, write_csv


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, str(n)) for k in old]
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def made(path, rng, end="\n"):
    pieces = ["plain", 'say "so"', "two\nlines", "a,b", '"', "\n", "\n\n\n", "é\r\nü", "", " padded ", "x" * 300, '""\n""', ","]
    rows = [[rng.choice(pieces) for _ in range(4)] for _ in range(rng.randint(1, 60))]
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["h1", "h 2", 'h"3', "h\n4"])
        w.writerows(rows)


@pytest.mark.parametrize("size", [40, 700, 1 << 20])
def test_same_rows_as_whole_files(spark, tmp_out, small_splits, size):
    rng = random.Random(size)
    for k in range(4):
        made(os.path.join(tmp_out, f"f {k}.csv"), rng)
    key = lambda rows: sorted(map(str, map(list, rows)))
    whole = csv_source.read_csv_text(spark, tmp_out, multiline=True).withColumn("_source_file", csv_source.plain_file_name())
    want = key(whole.collect())
    small_splits(size)
    got = csv_source.read_csv_split(spark, tmp_out)
    assert got.columns == whole.columns
    assert key(got.collect()) == want


def test_carriage_returns_end_records_only_outside_quotes(spark, tmp_out, small_splits):
    path = os.path.join(tmp_out, "crlf.csv")
    made(path, random.Random(2), "\r\n")
    with open(path, newline="", encoding="utf-8") as f:
        header, *rows = csv.reader(f)
    small_splits(64)
    got = csv_source.read_csv_split(spark, path)
    assert got.columns == [*header, "_source_file"]
    assert sorted(map(str, (list(r)[:-1] for r in got.collect()))) == sorted(str([c or None for c in r]) for r in rows)


def test_one_file_is_read_by_many_tasks(spark, tmp_out, small_splits):
    path = write_csv(os.path.join(tmp_out, "big.csv"), [good_values(**{"Source Name": f"Quay\n{k}\nNorth"}) for k in range(400)])
    small_splits(1024)
    assert lines(spark, path).rdd.getNumPartitions() > 20 and splits(lines(spark, path)).count() > 20
    got = csv_source.read_raw_csv(spark, path, multiline="split")
    assert sorted(r["source_name"] for r in got.collect()) == sorted(f"Quay\n{k}\nNorth" for k in range(400))
    assert {r["_source_file"] for r in got.select("_source_file").collect()} == {"big.csv"}


def test_a_record_over_many_splits(spark, tmp_out, small_splits):
    long = "\n".join(f"line {k}" for k in range(500))
    path = write_csv(os.path.join(tmp_out, "long.csv"), [good_values(), good_values(**{"Source Name": long}), good_values(**{"Source Name": "after"})])
    small_splits(64)
    assert sorted(r["source_name"] for r in csv_source.read_raw_csv(spark, path, multiline="split").collect()) == sorted(["Quay North", long, "after"])
    assert records(spark, path).count() == 4


def test_broken_records_stop_the_read(spark, tmp_out):
    surplus = write_csv(os.path.join(tmp_out, "s.csv"), [good_values(), [*good_values().values(), "more"]])
    with pytest.raises(Exception, match="more fields"):
        csv_source.read_raw_csv(spark, surplus, multiline="split").collect()
    with open(os.path.join(tmp_out, "open.csv"), "w", encoding="utf-8") as f:
        f.write(",".join(f'"{h}"' for h in HEADERS) + '\n"never closed,1\n2\n')
    with pytest.raises(Exception, match="pair up"):
        csv_source.read_raw_csv(spark, f.name, multiline="split").collect()


def test_headers_must_agree(spark, tmp_out):
    write_csv(os.path.join(tmp_out, "a.csv"), [good_values()])
    write_csv(os.path.join(tmp_out, "b.csv"), [good_values()], [*HEADERS[1:], HEADERS[0]])
    with pytest.raises(Exception, match="header differs"):
        csv_source.read_raw_csv(spark, tmp_out, multiline="split").collect()


def test_short_records_and_empty_lines(spark, tmp_out):
    path = write_csv(os.path.join(tmp_out, "s.csv"), [list(good_values().values())[:10], [], good_values()])
    got = csv_source.read_raw_csv(spark, path, multiline="split").collect()
    assert len(got) == 2 and sorted(r["flight_class"] is None for r in got) == [False, True]


def test_run_over_split_records(spark, tmp_out, small_splits):
    rows = [good_values(**{"Source Name": "Quay\nNorth"}) for _ in range(60)]
    path, out = write_csv(os.path.join(tmp_out, "m.csv"), rows), os.path.join(tmp_out, "out")
    small_splits(2048)
    res = pipeline.run(spark, path, out, multiline_csv="split")
    assert res.report["total_rows"] == res.report["valid_rows"] == 60
