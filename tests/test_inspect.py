"""Inspection and analytics helpers beyond the oracle-checked keys."""

from farelens.operators import analytics, inspect, rules
from tests.helpers import text_rows


def test_case_insensitive_grouping_merges_codes(spark):
    df = rules.label(text_rows(spark, [{"source": "qcc"}, {"source": "QCC"}, {"source": "QDD"}]))
    plain = {r["code"]: r["rows_affected"] for r in inspect.source_codes(df).collect()}
    assert plain == {"qcc": 1, "QCC": 1, "QDD": 1}
    merged = sorted(r["rows_affected"] for r in inspect.source_codes(df, case_insensitive=True).collect())
    assert merged == [1, 2]


def test_flagged_rows_is_a_top_n_by_id(spark):
    from farelens.sources.staging import stage

    rows = [{"airline": None}] * 5 + [{}] * 3
    df = rules.label(stage(text_rows(spark, rows)))
    out = inspect.flagged_rows(df, n=3)
    assert out.count() == 3
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_verdict_counts_unlabelled(spark):
    df = rules.label(text_rows(spark, [{}, {"airline": None}]))
    df = df.unionByName(df.limit(1).withColumn("is_valid", df["is_valid"].cast("string").cast("boolean") & None))
    r = inspect.staging_verdict(df).first()
    assert (r["total_rows"], r["valid_rows"], r["invalid_rows"], r["unlabelled_rows"]) == (3, 1, 1, 1)


def test_lead_time_buckets(spark):
    from farelens.operators import enrich

    rows = [{"days_before_departure": str(d)} for d in (0, 7, 8, 14, 30, 31, 60, 61, 200)]
    fact = enrich.transform(text_rows(spark, rows))
    got = {r["lead_time_bucket"]: r["flights"] for r in analytics.lead_time(fact).collect()}
    assert got == {"1. 0-7 days": 2, "2. 8-14 days": 2, "3. 15-30 days": 1, "4. 31-60 days": 2, "5. 61+ days": 2}
