"""Labels written back to a stored table: only folders with a labelled row change."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from farelens.plans import catalog, writeback
from farelens.sources.staging import conform
from tests.helpers import text_rows

LABELS = "id long, is_valid boolean, validation_errors string"


@pytest.fixture()
def stored(spark, tmp_out):
    name = f"stg_{uuid.uuid4().hex}"
    rows = spark.range(400).select("id", F.concat(F.lit("air"), "id").alias("airline"), F.lit(True).alias("is_valid"), F.lit(None).cast("string").alias("validation_errors"))
    writeback.store(rows, name, f"{tmp_out}/stg", folders=10, buckets=4)
    yield name, f"{tmp_out}/stg"
    spark.sql(f"DROP TABLE {name}")


def files(path):
    return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith(writeback.FOLDER)}


def test_only_matched_folders_are_rewritten(spark, stored):
    name, path = stored
    before = files(path)
    folder = {r["id"]: r[writeback.FOLDER] for r in spark.table(name).collect()}
    labels = spark.createDataFrame([(7, False, "bad"), (8, False, None), (10_000, False, "no such row")], LABELS)
    assert writeback.write_back(spark, name, labels) == 2
    after = files(path)
    changed = {d for d in before if before[d] != after[d]}
    assert changed == {f"{writeback.FOLDER}={folder[k]}" for k in (7, 8)}
    rows = {r["id"]: r for r in spark.table(name).collect()}
    assert len(rows) == 400 and {k: r[writeback.FOLDER] for k, r in rows.items()} == folder
    assert [k for k, r in rows.items() if not r["is_valid"]] in ([7, 8], [8, 7])
    assert rows[7]["validation_errors"] == "bad" and rows[8]["validation_errors"] is None and rows[9]["airline"] == "air9"


def test_nothing_is_written_without_a_match(spark, stored):
    name, path = stored
    before = files(path)
    assert writeback.write_back(spark, name, spark.createDataFrame([], LABELS)) == 0
    assert writeback.write_back(spark, name, spark.createDataFrame([(-1, False, "x")], LABELS)) == 0
    assert files(path) == before


def test_two_labels_for_one_row_are_refused(spark, stored):
    name, path = stored
    before = files(path)
    with pytest.raises(ValueError, match="More than one label"):
        writeback.write_back(spark, name, spark.createDataFrame([(7, False, "a"), (7, True, None)], LABELS))
    assert files(path) == before


def test_staging_is_not_shuffled(spark, stored):
    name, _ = stored
    labels = spark.createDataFrame([(7, False, "bad")], LABELS)
    for df in (writeback.updated(spark, name, labels, [3]), writeback.labelled_rows(spark, name, labels)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scan = next(i for i, line in enumerate(plan.split("\n")) if "FileScan" in line)
        above = plan.split("\n")[: scan]
        join = max(i for i, line in enumerate(above) if "SortMergeJoin" in line)
        assert not any("Exchange" in line for line in above[join:]), plan
        assert "Bucketed: true" in plan
    plan = writeback.updated(spark, name, labels, [3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and f"{writeback.FOLDER}" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    rows = text_rows(spark, [{"airline": f"Air {i}", "source": None if i % 5 == 0 else "QAA"} for i in range(60)])
    staged = conform(rows).select(F.monotonically_increasing_id().alias("l_orderkey"), F.lit(1).alias("l_linenumber"), "*")
    used = []
    store = writeback.store
    monkeypatch.setattr(writeback, "BUCKET_ROWS", 10)
    monkeypatch.setattr(writeback, "store", lambda *a, **k: (used.append(k["buckets"]), store(*a, **k)))
    out = catalog.labels_written_back(catalog.Frames(staged, *[None] * 6)).collect()
    assert used == [6]
    assert len(out) == 60 and sum(not r["is_valid"] for r in out) == 12
    assert writeback.buckets_for(0) == writeback.buckets_for(1) == 4
