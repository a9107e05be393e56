"""Expression helpers against their Python / pandas definitions (property tests)."""

from decimal import Decimal

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farelens.functions.exprs import (
    WHITESPACE,
    parse_decimal,
    parse_double,
    round_half_even,
    round_half_up,
    strip,
    with_columns_once,
)

_ALPHABET = st.sampled_from(list(WHITESPACE) + list("aZ9-é中 ") + ["​", "﻿"])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=_ALPHABET, max_size=12), min_size=50, max_size=200))
def test_strip_equals_python_strip(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r["t"] for r in df.select(strip("s").alias("t")).collect()]
    assert got == [t.strip() for t in texts]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=20, max_size=100))
def test_rounding_matches_numpy_and_sql(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    rows = df.select(round_half_even("x", 4).alias("e"), round_half_up("x", 2).alias("u")).collect()
    for x, r in zip(xs, rows):
        assert r["e"] == float(np.round(x, 4))
        # half away from zero on the double value, sign-symmetric
        m = np.floor(abs(x) * 100.0 + 0.5) / 100.0
        assert r["u"] == (-m if x < 0 else m)


def test_decimal_rounding_is_exact_half_up(spark):
    df = spark.createDataFrame([(Decimal("1.0050"),), (Decimal("-1.0050"),), (Decimal("2.0049"),)],
                               "x decimal(14,4)")
    got = [r[0] for r in df.select(round_half_up("x", 2, df.schema["x"].dataType)).collect()]
    assert got == [1.01, -1.01, 2.0]


def test_text_numbers(spark):
    values = ["12", " 12 ", "1e3", "1.0d", "2F", "NaN", "inf", "abc", "1,000", None, "-0.5"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    rows = df.select(parse_decimal("s").alias("d"), parse_double("s").alias("x")).collect()
    assert [r["d"] for r in rows] == [Decimal("12.0000"), Decimal("12.0000"), Decimal("1000.0000"), None, None,
                                      None, None, None, None, None, Decimal("-0.5000")]
    assert [r["x"] for r in rows] == [12.0, 12.0, 1000.0, None, None, None, float("inf"), None, None, None, -0.5]


def test_strip_is_pythons_at_either_end(spark):
    cases = ["", " ", "ab", "!a~", "a\x7f", "\x7fa", "\x1fa", "a\x1c", "a b", " ab", "ab\t", " ab", "ab　", "é", "aé ", "東京", "a​", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string")
    got = {r["i"]: r["s"] for r in df.select("i", strip("c").alias("s")).collect()}
    assert got == {i: None if c is None else c.strip() for i, c in enumerate(cases)}


def test_columns_added_once_keep_rows_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, c string")
    out = with_columns_once(df, {"u": F.upper("c"), "n": F.col("i") * 2})
    assert sorted(map(tuple, out.collect())) == [(1, "a", "A", 2), (2, None, None, 4)]
    assert out.columns == ["i", "c", "u", "n"]
    kept = out.where((F.col("u") == "A") & (F.length("u") < 2)).select("i")
    assert "upper" not in "".join(x for x in kept._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Filter" in x)
    assert [r["i"] for r in kept.collect()] == [1]


def test_doubles_at_odd_ends(spark):
    inf = float("inf")
    cases = {"2.5": 2.5, " 1e3\t": 1000.0, "2.": 2.0, ".5": 0.5, "7 ": 7.0, "1.0d": None, "2F ": None, "1x2": None, "": None,
             "nan": None, "NaN\x1c": None, "-NaN": None, "+NaN ": None, "inf": inf, " +Inf　": inf, " -infinity": -inf, "Infinity": inf, "-inf ": -inf, "1٢": None}
    df = spark.createDataFrame([*enumerate(cases), (len(cases), None)], "i int, s string")
    got = {r["i"]: r["x"] for r in df.select("i", parse_double("s").alias("x")).collect()}
    assert got == dict(enumerate([*cases.values(), None]))
