"""KPI tables against plain Python over the same rows."""

import math
from collections import defaultdict
from decimal import Decimal

import numpy as np
import pytest

from farelens.model import KPI_BOOKING_COUNT_TABLE, KPI_SCHEMAS
from farelens.operators import analytics, kpis
from tests.helpers import fact_rows, plan_of

AIRLINES = ["Kite Air", "Gull", "Heron Lines", None]
SEASONS = ["Regular", "Hajj", "Monsoon", None]
ROWS = [
    {"airline": AIRLINES[i % 4], "season": SEASONS[(i // 3) % 4], "peak": SEASONS[(i // 3) % 4] == "Hajj",
     "source": ["QAA", "QCC", None][i % 3], "destination": ["QBB", "QDD"][i % 2], "base": 100 + i, "tax": None if i % 7 == 0 else 3.125 * i, "total": None if i % 11 == 0 else 150.0625 + i * i}
    for i in range(60)
]


def mean(values):
    known = [Decimal(str(v)) for v in values if v is not None]
    return float(sum(known)) / len(known) if known else None


def grouped(key):
    out = defaultdict(list)
    for r in ROWS:
        if r[key] is not None:
            out[r[key]].append(r)
    return out


@pytest.fixture(scope="module")
def fact(spark):
    return fact_rows(spark, ROWS)


def test_average_fares(fact):
    got = {r["airline"]: r.asDict() for r in kpis.average_fare_by_airline(fact).collect()}
    assert got.keys() == grouped("airline").keys()
    for airline, rows in grouped("airline").items():
        totals = [r["total"] for r in rows if r["total"] is not None]
        assert got[airline]["flight_count"] == len(rows)
        for column, part in (("average_base_fare", "base"), ("average_tax_charge", "tax"), ("average_total_fare", "total")):
            assert got[airline][column] == float(np.round(mean([r[part] for r in rows]), 4))
        assert (got[airline]["min_total_fare"], got[airline]["max_total_fare"]) == (min(totals), max(totals))


def test_seasons_against_the_baseline(fact):
    rows = grouped("season")
    base = mean([r["total"] for r in rows["Regular"]])
    for r in kpis.seasonal_fare_variation(fact).collect():
        own = rows[r["seasonality"]]
        m = mean([x["total"] for x in own])
        assert r["flight_count"] == len(own) and r["is_peak_season"] is (r["seasonality"] == "Hajj")
        assert math.isclose(r["variation_vs_baseline_pct"], round((m - base) / base * 100, 2), abs_tol=0.0051)


@pytest.mark.parametrize("rows", [[{"season": "Hajj"}], [{"season": "Hajj"}, {"total": 0}], [{"season": "Hajj"}, {"total": None}]])
def test_no_variation_without_a_baseline(spark, rows):
    got = {r["seasonality"]: r["variation_vs_baseline_pct"] for r in kpis.seasonal_fare_variation(fact_rows(spark, rows)).collect()}
    assert got["Hajj"] is None


def test_booking_shares(fact):
    rows = grouped("airline")
    named = sum(map(len, rows.values()))
    got = {r["airline"]: (r["booking_count"], r["booking_share_pct"]) for r in kpis.booking_count_by_airline(fact).collect()}
    assert got == {a: (len(x), float(np.round(len(x) / named * 100, 2))) for a, x in rows.items()}


def test_routes_by_bookings_then_name(fact):
    count = defaultdict(list)
    for r in ROWS:
        if r["source"]:
            count[f"{r['source']}-{r['destination']}"].append(r["total"])
    order = sorted(count, key=lambda k: (-len(count[k]), k))
    got = kpis.popular_routes(fact).collect()
    assert [(r["route"], r["booking_count"], r["rank_position"]) for r in got] == [(k, len(count[k]), i + 1) for i, k in enumerate(order)]
    cut = kpis.popular_routes(fact, top_n=2).collect()
    assert [r["route"] for r in cut] == order[:2] and [r["rank_position"] for r in cut] == [1, 2]


def test_tables_have_their_layout_even_when_empty(spark):
    for table, frame in kpis.compute_all(fact_rows(spark, [])).items():
        assert frame.columns == KPI_SCHEMAS[table].fieldNames() and frame.count() == 0, table


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    frame = kpis.average_fare_by_airline(fact_rows(spark, [{"airline": "Gull" if i % 3 else f"small {i}"} for i in range(90)]))
    assert "partial_count" in plan_of(frame)
    assert {r["airline"]: r["flight_count"] for r in frame.collect()}["Gull"] == 60


def test_stored_tables_read_in_report_order(spark):
    stored = spark.createDataFrame([("Kite Air", 2), ("Gull", 5), ("Heron Lines", 2)], "airline string, booking_count long")
    assert [r["airline"] for r in kpis.ordered(stored, KPI_BOOKING_COUNT_TABLE).collect()] == ["Gull", "Heron Lines", "Kite Air"]


def test_distinct_counts_copy_no_row(fact):
    counted = analytics.distinct_counts(fact, {"a": ("airline",), "r": ("source", "destination")}, {"n": kpis.F.count(kpis.F.lit(1))}, by=("is_peak_season",))
    assert "Expand" not in plan_of(counted)
    for r in counted.collect():
        own = [x for x in ROWS if x["peak"] == r["is_peak_season"]]
        assert r["n"] == len(own) and r["a"] == len({x["airline"] for x in own} - {None})
        assert r["r"] == len({(x["source"], x["destination"]) for x in own if x["source"]})


def test_kpis_of_the_base_equal_those_of_the_rows(spark, fact):
    base = kpis.base(fact)
    assert base.count() == len({tuple(r) for r in fact.select(*kpis.BASE_KEYS).collect()})
    for df in (fact, fact.where("false")):
        rows, merged = kpis.compute_all(df), kpis.compute_all(kpis.base(df))
        for table in rows:
            assert rows[table].columns == merged[table].columns
            assert list(map(tuple, rows[table].collect())) == list(map(tuple, merged[table].collect())), table


def test_base_takes_one_scan_and_combines_hot_keys_early(fact):
    text = plan_of(kpis.base(fact))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text and "partial_count" in text
