"""The physical plans keep the properties that matter at scale."""

from __future__ import annotations

import re

import pytest

from billmill.queries import registered

# Windows and sorts over a bounded number of rows: cells of the median search, ranges of a numbering, and the
# final step of a global aggregate or a top-k.
BOUNDED = {
    "median_kwh",
    "high_usage_flag",
    "optional_columns",
    "build_staging",
    "sink_csv_roundtrip",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, small):
    return {name: plan_of(query(spark, small)) for name, query in registered().items()}


def test_no_python_per_row_and_no_cross_join(plans):
    for name, plan in plans.items():
        assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|MapInPandas|ArrowEval", plan), name


def test_no_window_over_everything(plans):
    for name, plan in plans.items():
        if name in BOUNDED:
            continue
        for window in re.findall(r"Window \[row_number\(\)[^\n]*", plan):
            assert "], [" in window, (name, window)


def test_flagship_reads_only_its_columns(plans):
    plan = plans["fact_borough_year_usage"]
    scans = re.findall(r"ReadSchema: struct<([^>]*)", plan)
    assert "orders" not in plan and "customer" not in plan and "part.parquet" not in plan
    assert not any("l_returnflag" in scan or "s_acctbal" in scan for scan in scans)
    assert plan.count("row_number(), 1, Partial") == 1 and plan.count("row_number(), 1, Final") == 1
    assert "partial_sum" in plan and "median" not in plan.lower()


def test_filters_reach_the_files(plans):
    assert "PushedFilters: [IsNotNull(ts)]" in plans["dim_time"]


def test_top_k_does_not_sort_everything(plans):
    for name in ("preview_dim_date", "preview_dim_meter", "preview_raw_bills"):
        assert "TakeOrderedAndProject" in plans[name], name


def test_counts_for_the_median_are_shuffled_once(spark, small):
    from billmill.operators.median import exact_median

    median = exact_median(spark.read.parquet(f"{small}/lineitem.parquet"), "l_extendedprice")
    median.collect()
    final = plan_of(median).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1
    assert final.count("ReusedExchange") >= 2


def test_generated_code_is_small_enough_to_be_compiled(spark, small, capsys):
    """Java interprets methods above 8000 bytes; all 26 bill columns must stay below."""
    from billmill.plans.staging import clean_bills, first_bills
    from billmill.sources.sales_bills import SALES_ORDER, read_sales_bills
    from billmill.workspace import stored

    raw = stored(read_sales_bills(spark, small), "raw")
    kept = first_bills(clean_bills(raw, SALES_ORDER), SALES_ORDER)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.codegen.hugeMethodLimit")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        kept.explain("codegen")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000, sizes


def test_bills_are_parsed_and_deduplicated_once(spark, small, monkeypatch):
    """Also the step that runs while the query is built."""
    from billmill.plans import staging
    from billmill.sources.sales_bills import SALES_ORDER, read_sales_bills
    from billmill.workspace import stored

    raw = stored(read_sales_bills(spark, small), "raw")
    eager = []

    def noted(df, name):
        eager.append(plan_of(df))
        return stored(df, name)

    monkeypatch.setattr(staging, "stored", noted)
    final = plan_of(staging.build_staging(raw, SALES_ORDER))
    assert len(eager) == 1 and eager[0].count("FileScan") == 1 and eager[0].count("row_number(), 1, Final") == 1
    assert "row_number" not in final and "/raw-" not in final
    # the median reads one column of what was stored
    assert re.search(r"ReadSchema: struct<Consumption \(KWH\):double>", final)


def test_counts_of_a_numbering_read_one_column(spark, small):
    from billmill.operators.keys import number_rows

    plan = plan_of(number_rows(spark.read.parquet(f"{small}/orders.parquet"), ["o_orderkey"], "key"))
    assert "ReadSchema: struct<_range:bigint>" in plan and "ExistingRDD" not in plan


def test_generated_code_of_marks_is_small_enough(spark, small, capsys):
    from billmill.operators.clean import mark_bills
    from billmill.plans.staging import clean_bills, first_bills
    from billmill.sources.sales_bills import SALES_ORDER, read_sales_bills
    from billmill.workspace import stored

    marked = mark_bills(stored(read_sales_bills(spark, small), "raw"))
    kept = first_bills(clean_bills(stored(marked, "marked"), SALES_ORDER), SALES_ORDER)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.codegen.hugeMethodLimit")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        marked.explain("codegen")
        kept.explain("codegen")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000, sizes
