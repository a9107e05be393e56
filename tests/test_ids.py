"""Consecutive ids over stored tables; staging of few files; declared lengths."""

import os

import pytest
from pyspark.sql import functions as F

from farelens.model import STAGED_LENGTHS, STAGING_TABLE
from farelens.operators import inspect
from farelens.plans import ids, pipeline, sinks
from tests.helpers import text_rows
from tests.test_csv import good_values, write_csv
from tests.test_pipeline import fares_csv


def test_consecutive_ids_of_a_stored_table(spark, tmp_out):
    df = spark.range(1000).repartition(7).select(F.monotonically_increasing_id().alias("id"), F.col("id").alias("x"))
    df.write.parquet(f"{tmp_out}/t")
    stored = spark.read.parquet(f"{tmp_out}/t")
    got = ids.consecutive(stored)
    assert got.columns == ["id", "x"]
    rows = sorted(map(tuple, got.collect()))
    assert [r[0] for r in rows] == list(range(1, 1001))
    old = {r["x"]: r["id"] for r in stored.collect()}
    assert [old[x] for _, x in rows] == sorted(old.values())  # in the order they had
    assert sorted(map(tuple, ids.consecutive(spark.read.parquet(f"{tmp_out}/t")).collect())) == rows  # the same again
    assert ids.consecutive(stored.where("false")).count() == 0
    with pytest.raises(sinks.LoadCheckError, match="numbered rows"):
        ids.consecutive(stored.where("x <> 17"))


def test_ids_in_the_order_of_columns(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("k")).repartition(6)
    assert sorted(map(tuple, ids.numbered(df, ("k",)).collect())) == [(k + 1, k) for k in range(500)]


def test_ids_of_a_run(spark, tmp_out):
    """Staging's ids are 1 to n over both its folders, in the order of the file."""
    out = os.path.join(tmp_out, "out")
    pipeline.run(spark, fares_csv(os.path.join(tmp_out, "f.csv"), n_good=30, n_bad=1), out)
    got = ids.consecutive(sinks.read_current(spark, out, STAGING_TABLE)).select("id", "is_valid").collect()
    assert sorted(r["id"] for r in got) == list(range(1, 32))
    assert [r["id"] for r in got if str(r["is_valid"]).lower() != "true"] == [31]


def test_compact_staging_has_few_files(spark, tmp_out):
    src = text_rows(spark, [{} if k % 20 else {"airline": None} for k in range(2000)]).repartition(200)
    files = {}
    for compact in (False, True):
        out = os.path.join(tmp_out, str(compact))
        res = pipeline.run(spark, src, out, min_valid_ratio=0.5, compact_staging=compact)
        assert res.report["total_rows"] == 2000 and res.report["invalid_rows"] == 100
        assert res.report["failed_checks"] == {"null_airline": 100, "blank_airline": 100}
        files[compact] = sum(f.endswith(".parquet") for _, _, names in os.walk(f"{out}/{STAGING_TABLE}") for f in names)
    assert files[True] <= 4 < 200 < files[False], files


@pytest.mark.parametrize("column", [c for c in STAGED_LENGTHS if c != "_source_file"])
def test_overlong_values_are_refused_where_asked(spark, tmp_out, column):
    n = STAGED_LENGTHS[column]
    fits, over = ({column: "é" * size} for size in (n, n + 1))
    ok = text_rows(spark, [{}, fits])
    assert {r["column_name"]: r["overlong"] for r in inspect.declared_lengths(ok, STAGED_LENGTHS).collect()}[column] == 0
    assert {r["column_name"]: (r["longest"], r["overlong"]) for r in inspect.declared_lengths(text_rows(spark, [{}, over, over]), STAGED_LENGTHS).collect()}[column] == (n + 1, 2)
    sinks.publish(ok, tmp_out, "t", "v1", lengths=STAGED_LENGTHS)
    with pytest.raises(sinks.LoadCheckError, match=f"'{column}': 1"):
        sinks.publish(text_rows(spark, [{}, over]), tmp_out, "t", "v2", lengths=STAGED_LENGTHS)
    assert sinks.current_version(spark, tmp_out, "t") == "v1"


def test_lengths_in_a_run(spark, tmp_out):
    path = write_csv(os.path.join(tmp_out, "f.csv"), [good_values(), good_values(Stopovers="x" * 51)])
    out = os.path.join(tmp_out, "out")
    with pytest.raises(sinks.LoadCheckError, match="stopovers"):
        pipeline.run(spark, path, out, check_lengths=True)
    assert pipeline.run(spark, path, out).report["total_rows"] == 2
