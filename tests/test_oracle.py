"""Every registered query against its SQL statement, run by DuckDB.

Same check as the driver's correctness gate: row count, column names and the
order-insensitive multiset of values. Runs on the smallest driver tables.
"""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from farelens.plans.catalog import QUERIES  # noqa: E402

SF_DIR = os.environ.get("FARELENS_ORACLE_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(ocols, want)


def test_the_data_can_break_every_rule(spark):
    for name, labels in (("rule_counts", 19), ("text_rule_counts", 23)):
        counts = {r["rule"]: r["rows"] for r in queries()[name](spark, SF_DIR).collect()}
        assert len(counts) == labels and all(counts.values()), name
    assert queries()["unknown_seasons"](spark, SF_DIR).count() > 0


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns[0] == "airline" and df.count() > 0
