"""Cleaning and enrichment, as properties of the resulting columns."""

from datetime import datetime
from decimal import Decimal

import pytest

from farelens.model import FACT_COLUMNS
from farelens.operators import enrich, rules
from tests.helpers import text_rows

# change to the sound row -> what the fact row says
CASES = [
    ({"source": " qaa\t", "destination": "qBb"}, {"source": "QAA", "destination": "QBB", "route": "QAA-QBB"}),
    ({"source": None}, {"source": None, "route": None}),
    ({"destination": None}, {"route": None}),
    ({"airline": "　Kite\xa0Air\x1c", "stopovers": " 2 Stops\n", "flight_class": "\x85Premium"}, {"airline": "Kite\xa0Air", "stopovers": "2 Stops", "flight_class": "Premium"}),
    ({"seasonality": "Hajj"}, {"is_peak_season": True}),
    ({"seasonality": "\tWinter Holidays "}, {"is_peak_season": True, "seasonality": "Winter Holidays"}),
    ({"seasonality": "eid"}, {"is_peak_season": False}),
    ({"seasonality": None}, {"is_peak_season": False, "seasonality": None}),
    ({"total_fare_bdt": None}, {"total_fare_bdt": Decimal("700.0000")}),
    ({"total_fare_bdt": None, "base_fare_bdt": None}, {"total_fare_bdt": None}),
    ({"total_fare_bdt": "1.25"}, {"total_fare_bdt": Decimal("1.2500")}),
    ({"days_before_departure": "14.0"}, {"days_before_departure": 14}),
    ({"days_before_departure": "1e2"}, {"days_before_departure": 100}),
    ({"days_before_departure": "14.7"}, {"days_before_departure": None}),
    ({"days_before_departure": "soon", "departure_datetime": "07/09/2031 22:40"}, {"days_before_departure": None, "departure_datetime": None}),
    ({}, {"duration_hrs": 2.5, "departure_datetime": datetime(2031, 7, 9, 22, 40)}),
]


@pytest.fixture(scope="module")
def facts(spark):
    rows = enrich.transform(text_rows(spark, [c | {"_source_file": str(i)} for i, (c, _) in enumerate(CASES)]), flag_column=None).collect()
    return {int(r["_source_file"]): r for r in rows}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_fact_values(facts, i):
    for column, value in CASES[i][1].items():
        assert facts[i][column] == value, CASES[i][0]


def test_columns_are_those_of_the_table(spark):
    wider = text_rows(spark, [{}]).selectExpr("*", "7 as id", "true as is_valid", "'x' as more")
    assert tuple(enrich.transform(wider).columns) == FACT_COLUMNS


def test_uplift_flag_is_the_one_of_the_rules(spark):
    frame = text_rows(spark, [{"total_fare_bdt": t, "_source_file": t} for t in ("840", "700", "777")])
    flagged = {r["_source_file"]: r["has_fare_uplift"] for r in enrich.transform(rules.classify_fare_consistency(frame)).collect()}
    assert flagged == {"840": True, "700": False, "777": False}
    assert not any(r["has_fare_uplift"] for r in enrich.transform(frame).collect())


def test_only_valid_rows_become_facts(spark):
    labelled = rules.label(text_rows(spark, [{}, {"airline": " "}, {"total_fare_bdt": "840"}, {"total_fare_bdt": "1"}]))
    assert sorted(r["total_fare_bdt"] for r in enrich.fact_from_labelled(labelled).collect()) == [700, 840]


def test_seasons_that_nobody_knows(spark):
    frame = text_rows(spark, [{"seasonality": s} for s in ("Monsoon", " Monsoon", "Harvest", "Regular", "Eid", "Hajj", None)])
    assert sorted(r["seasonality"] for r in enrich.unknown_seasons(frame).collect()) == ["Harvest", "Monsoon"]


def test_empty_input(spark):
    none = text_rows(spark, [])
    assert enrich.transform(none).count() == 0
    with pytest.raises(ValueError):
        enrich.transform(none, require_rows=True)
