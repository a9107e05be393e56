"""Plan shape: no Python in the hot path, pruning and pushdown reach the scan."""

import os
import re

import pytest

from farelens.plans.catalog import QUERIES, shared_frames
from farelens.operators import kpis
from farelens.plans import pipeline, sinks
from farelens.model import FACT_TABLE, STAGING_TABLE
from farelens.sources import tables
from tests.test_pipeline import fares_csv

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_no_python_udf_in_any_query(spark):
    frames = shared_frames(spark, SF_DIR)
    for name, q in QUERIES.items():
        text = plan(q(frames))
        assert "PythonUDF" not in text and "EvalPython" not in text, name


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_windows_only_over_top_n_rows(spark):
    frames = shared_frames(spark, SF_DIR)
    for name, q in QUERIES.items():
        df = q(frames)
        text = df._jdf.queryExecution().optimizedPlan().toString()
        if "Window" in text:
            assert name.startswith("kpi_popular_routes"), name
            assert text.index("Window") < text.index("Limit"), name  # the window sits above the cut


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
@pytest.mark.parametrize("name", ["fact_summary", "fact_provenance"])
def test_summaries_pass_the_rows_once(spark, name):
    """One scan of lineitem, no row copied for a distinct count."""
    text = QUERIES[name](shared_frames(spark, SF_DIR))._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in text and text.count("l_extendedprice") and text.count("lineitem.parquet") <= 1
    assert len([line for line in text.split("\n") if "Relation" in line and "l_orderkey" in line]) == 1


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
@pytest.mark.parametrize("name", ["reconciliation", "row_counts", "compute_all"])
def test_load_checks_read_stored_tables(spark, name):
    text = QUERIES[name](shared_frames(spark, SF_DIR))._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in text and "l_orderkey" not in text and "Relation" in text


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_fare_rules_go_below_the_joins(spark):
    text = shared_frames(spark, SF_DIR).valid._jdf.queryExecution().optimizedPlan().toString().split("\n")
    scan = next(i for i, line in enumerate(text) if "Relation" in line and "l_orderkey" in line)
    below = [line for line in text[:scan] if "Filter" in line and "l_discount" in line and "Join" not in line]
    assert below, "no fare rule in a filter over the lineitem scan"


def test_a_new_file_is_seen_by_the_next_call(spark, tmp_path):
    """Nothing is kept between two calls on one folder."""
    tables_dir = str(tmp_path)
    for t in ("orders", "customer", "supplier", "part"):
        os.symlink(f"{SF_DIR}/{t}.parquet", f"{tables_dir}/{t}.parquet")
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").limit(50)
    lines.coalesce(1).write.parquet(f"{tables_dir}/lineitem.parquet")
    count = lambda: shared_frames(spark, tables_dir).labelled.count()
    first = count()
    lines.coalesce(1).write.mode("append").parquet(f"{tables_dir}/lineitem.parquet")
    assert count() == 2 * first


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("plans"))
    src = fares_csv(os.path.join(out, "fares.csv"))
    pipeline.run(spark, src, f"{out}/tables")
    return f"{out}/tables"


def test_valid_rows_read_prunes_partitions(spark, stored):
    df = tables.read_staging(spark, sinks.current_path(spark, stored, STAGING_TABLE), valid_only=True)
    text = plan(df)
    assert "PartitionFilters: [isnotnull(is_valid" in text and "is_valid" in text
    assert df.count() == 40


def test_kpis_read_only_their_columns(spark, stored):
    fact = sinks.read_current(spark, stored, FACT_TABLE)
    text = plan(kpis.booking_count_by_airline(fact))
    read = text[text.index("ReadSchema: "):].split("\n")[0]
    assert "airline" in read and "aircraft_type" not in read and "total_fare_bdt" not in read
    text = plan(kpis.popular_routes(fact))
    assert "TakeOrderedAndProject" in text


def test_filters_reach_the_fact_scan(spark, stored):
    from farelens.operators import analytics

    fact = sinks.read_current(spark, stored, FACT_TABLE)
    text = plan(analytics.lead_time(fact))
    assert "PushedFilters: [IsNotNull(days_before_departure)]" in text


def test_labelling_and_fact_are_narrow_stages(spark, stored, tmp_path):
    """No shuffle between the CSV scan and the labelled rows, nor between the
    stored staging rows and the fact rows."""
    from farelens.operators import enrich, rules
    from farelens.sources import csv as csv_source
    from farelens.sources.staging import stage

    src = fares_csv(str(tmp_path / "f.csv"))
    labelled = rules.label(stage(csv_source.read_raw_csv(spark, src)))
    assert "Exchange" not in plan(labelled)
    valid = tables.read_staging(spark, sinks.current_path(spark, stored, STAGING_TABLE), valid_only=True)
    assert "Exchange" not in plan(enrich.transform(valid))


def test_global_totals_are_scalar_subqueries_not_joins(spark, stored):
    fact = sinks.read_current(spark, stored, FACT_TABLE)
    for df in (kpis.booking_count_by_airline(fact), kpis.seasonal_fare_variation(fact)):
        text = plan(df)
        assert "Join" not in text and "Subquery" in text


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
@pytest.mark.parametrize("name", ["kpi_popular_routes", "fact_table", "clean_codes", "flagged_rows"])
def test_filters_and_joins_work_out_no_fare_or_code_anew(spark, name):
    """Their conditions read fares, airline and codes that were worked out once a row."""
    text = QUERIES[name](shared_frames(spark, SF_DIR))._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in text.split("\n") if "Filter " in line or "Join " in line]
    assert any("l_total_fare" in line or "total_fare" in line for line in lines)
    for line in lines:
        assert "l_extendedprice" not in line and "chr(" not in line and "upper(" not in line and "p_brand" not in line
    assert text.count("cast(l_extendedprice") == 2  # the base fare and the tax


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
@pytest.mark.parametrize("name", ["text_rule_labels", "text_staged"])
def test_texts_are_parsed_once(spark, name):
    text = QUERIES[name](shared_frames(spark, SF_DIR))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("RLIKE(duration_hrs") == 1 and "Generate" not in text
    for c in ("base_fare_bdt", "tax_surcharge_bdt", "total_fare_bdt"):
        assert len(re.findall(rf"try_cast\({c}#\d+ as decimal", text)) == 1
