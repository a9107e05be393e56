"""The row rules: one table of single defects, and what is built on the labels."""

import pytest
from pyspark.sql import functions as F

from farelens.model import QualityGateError, SchemaValidationError
from farelens.operators import rules
from farelens.sources.staging import conform
from tests.helpers import REQUIRED, plan_of, text_rows

MISMATCH = "fare_mismatch"
# change to the sound row -> labels in rule order, known uplift
DEFECTS = [
    ({}, [], False),
    # missing and blank text
    ({"airline": None}, ["null_airline", "blank_airline"], False),
    ({"airline": ""}, ["blank_airline"], False),
    ({"airline": " 　\xa0\x1f"}, ["blank_airline"], False),
    ({"airline": "\tKite Air "}, [], False),
    ({"source": None}, ["null_source", "blank_source"], False),
    ({"source": "  "}, ["blank_source", "malformed_source_code"], False),
    ({"destination": None}, ["null_destination", "blank_destination"], False),
    # codes
    ({"source": "Q1A"}, ["malformed_source_code"], False),
    ({"source": "QAAA"}, ["malformed_source_code"], False),
    ({"source": "\nqaa "}, [], False),
    ({"destination": "qb"}, ["malformed_destination_code"], False),
    ({"destination": " qaa"}, ["source_equals_destination"], False),
    # fares
    ({"base_fare_bdt": None}, ["null_base_fare_bdt", MISMATCH], False),
    ({"tax_surcharge_bdt": None}, ["null_tax_surcharge_bdt", MISMATCH], False),
    ({"total_fare_bdt": None}, ["null_total_fare_bdt", MISMATCH], False),
    ({"base_fare_bdt": "six"}, ["non_numeric_base_fare_bdt", MISMATCH], False),
    ({"tax_surcharge_bdt": "59,5"}, ["non_numeric_tax_surcharge_bdt", MISMATCH], False),
    ({"total_fare_bdt": "700f"}, ["non_numeric_total_fare_bdt", MISMATCH], False),
    ({"tax_surcharge_bdt": "-59.50", "total_fare_bdt": "581"}, ["negative_tax_surcharge_bdt"], False),
    ({"base_fare_bdt": "-640.5"}, ["negative_base_fare_bdt", MISMATCH], False),
    ({"total_fare_bdt": "-700"}, ["negative_total_fare_bdt", MISMATCH], False),
    ({"base_fare_bdt": "0", "tax_surcharge_bdt": "0", "total_fare_bdt": "0.0"}, [], False),
    ({"total_fare_bdt": "700.01"}, [], False),
    ({"total_fare_bdt": "699.99"}, [], False),
    ({"total_fare_bdt": "700.0101"}, [MISMATCH], False),
    ({"total_fare_bdt": "840"}, [], True),
    ({"total_fare_bdt": "840.0008"}, [], True),
    ({"total_fare_bdt": "840.0009"}, [MISMATCH], False),
    ({"total_fare_bdt": "839"}, [MISMATCH], False),
    # times, duration, lead time
    ({"arrival_datetime": "2031-07-09 22:39:59"}, ["arrival_before_departure"], False),
    ({"arrival_datetime": "2031-07-09 22:40:00"}, [], False),
    ({"departure_datetime": "tonight"}, [], False),
    ({"duration_hrs": "0"}, ["non_positive_duration"], False),
    ({"duration_hrs": "-0.1"}, ["non_positive_duration"], False),
    ({"duration_hrs": "2.5d"}, ["non_numeric_duration_hrs"], False),
    ({"duration_hrs": "nan"}, ["non_numeric_duration_hrs"], False),
    ({"days_before_departure": "-3.0"}, ["negative_days_before_departure"], False),
    ({"days_before_departure": "-1"}, ["negative_days_before_departure"], False),
    ({"days_before_departure": "0.0"}, [], False),
    ({"days_before_departure": None, "duration_hrs": None}, [], False),
    ({"seasonality": "Monsoon"}, [], False),
]


@pytest.fixture(scope="module")
def frame(spark):
    return text_rows(spark, [change | {"_source_file": str(i)} for i, (change, _, _) in enumerate(DEFECTS)])


@pytest.fixture(scope="module")
def labelled(frame):
    return {int(r["_source_file"]): r for r in rules.label(frame).collect()}


@pytest.mark.parametrize("i", range(len(DEFECTS)))
def test_labels_of_single_defects(labelled, i):
    change, labels, uplift = DEFECTS[i]
    row = labelled[i]
    assert (row["validation_errors"] or "").split(";") == (labels or [""]), change
    assert row["is_valid"] is (not labels)
    assert row["has_known_uplift"] is uplift


def test_bits_and_conjunction_agree(frame, labelled):
    by_bits = {int(r["_source_file"]): r["is_valid"] for r in rules.label(frame, keep_bits=True).collect()}
    assert by_bits == {i: r["is_valid"] for i, r in labelled.items()}


def test_counts_hits_and_report_tell_the_same(frame):
    want = {}
    for _, labels, _ in DEFECTS:
        for name in labels:
            want[name] = want.get(name, 0) + 1
    counts = {r["rule"]: r["rows"] for r in rules.rule_counts(frame).orderBy("rule_order").collect()}
    assert list(counts) == rules.all_rule_labels()
    assert {k: n for k, n in counts.items() if n} == want
    hits = rules.rule_hits(frame)
    assert {r["rule"]: r["count"] for r in hits.groupBy("rule").count().collect()} == want
    assert rules.rule_hits(frame, "lead_time").count() == 2
    report = rules.report_dict(rules.quality_report(rules.label(frame)).first())
    assert report["failed_checks"] == want and list(report["failed_checks"]) == [k for k in counts if k in want]
    sound = sum(not labels for _, labels, _ in DEFECTS)
    assert (report["total_rows"], report["valid_rows"], report["invalid_rows"]) == (len(DEFECTS), sound, len(DEFECTS) - sound)
    assert report["rows_with_known_fare_uplift"] == 2


def test_nan_in_a_typed_fare_is_missing(spark):
    typed = conform(text_rows(spark, [{}])).withColumn("base_fare_bdt", F.lit(float("nan")))
    assert rules.label(typed).first()["validation_errors"] == "null_base_fare_bdt;fare_mismatch"


@pytest.mark.parametrize("gone", REQUIRED)
def test_a_required_column_must_be_there(spark, gone):
    with pytest.raises(SchemaValidationError, match=gone):
        rules.label(text_rows(spark, [{}]).drop(gone))


def test_only_the_required_columns_are_enough(spark):
    assert rules.label(text_rows(spark, [{}], REQUIRED)).first()["is_valid"] is True


def test_no_rows_give_an_empty_report_that_is_refused(spark):
    report = rules.report_dict(rules.quality_report(rules.label(text_rows(spark, []))).first())
    assert report["total_rows"] == 0
    with pytest.raises(SchemaValidationError):
        rules.check_not_empty(report)


@pytest.mark.parametrize("ratio,passes", [(1.0, True), (0.95, True), (0.949999, False), (0.0, False)])
def test_gate(ratio, passes):
    report = {"valid_ratio": ratio, "failed_checks": {"blank_airline": 4}}
    if passes:
        rules.enforce_quality_threshold(report)
    else:
        with pytest.raises(QualityGateError, match="blank_airline"):
            rules.enforce_quality_threshold(report)


def test_labels_of_another_table(spark):
    staging = spark.createDataFrame([(1, "a", True, None), (2, "b", False, "old"), (3, "c", None, None)],
                                    "id long, airline string, is_valid boolean, validation_errors string")
    labels = spark.createDataFrame([(1, False, "new"), (9, True, None)], "id long, is_valid boolean, validation_errors string")
    got = {r["id"]: (r["airline"], r["is_valid"], r["validation_errors"]) for r in rules.apply_labels(staging, labels).collect()}
    assert got == {1: ("a", False, "new"), 2: ("b", False, "old"), 3: ("c", None, None)}
    assert rules.label_updates(staging, labels) == 1
    bare = rules.apply_labels(staging.select("id", "airline"), labels)
    assert {r["id"]: r["is_valid"] for r in bare.collect()} == {1: False, 2: None, 3: None}
    with pytest.raises(ValueError, match="More than one"):
        rules.apply_labels(staging, labels.union(labels))


def test_labelling_is_one_narrow_stage(frame):
    assert "Exchange" not in plan_of(rules.label(frame))


def test_labels_that_are_not_filtered_evaluate_each_rule_once(frame):
    text = rules.label(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in text
    for c in ("source", "destination"):
        assert text.count(f"RLIKE(_clean_{c}") == 1


def test_labels_for_filters_are_the_same(frame):
    columns = ["_source_file", *rules.LABEL_COLUMNS]
    assert sorted(rules.label(frame, keep_clean=True).select(columns).collect()) == sorted(rules.label(frame).select(columns).collect())
