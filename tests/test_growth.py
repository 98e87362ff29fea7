"""What decides how the steps grow with the bills."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from billmill import queries
from billmill.functions import numbers
from billmill.operators import keys
from billmill.operators.keys import n_ranges, number_rows
from billmill.sources.bill_files import _file_order
from billmill.sources.quoted_lines import _Walk
from billmill.sources.sales_bills import read_sales_bills


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def stored_columns(monkeypatch):
    """The columns of what a query stores, by the names of the steps."""
    found = {}

    def stored(df, name, f=queries.stored):
        found[name] = df.columns
        return f(df, name)

    monkeypatch.setattr(queries, "stored", stored)
    return found


def test_rows_make_ranges_where_bytes_do_not():
    assert [n_ranges(1, rows=rows) for rows in (0, 1, 1 << 20, (1 << 20) + 1)] == [1, 1, 1, 2]
    assert n_ranges(256 << 20, rows=216_000_000) == 206  # 216 million rows in 256 MB: not one task
    assert n_ranges(100 << 40, rows=1 << 42) == 409_600


def test_equal_rows_in_few_bytes_are_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(keys, "RANGE_ROWS", 500)
    placed = []
    monkeypatch.setattr(keys, "stored_at", lambda df, name, f=keys.stored_at: placed.append(f(df, name)) or placed[-1])
    df = spark.range(0, 4000, 1, 4).select((F.col("id") % 2).alias("of"), F.lit("member").alias("named"))
    got = [(r.key, r.of) for r in number_rows(df, ["of"], "key").orderBy("key").collect()]
    assert got == [(i + 1, int(i >= 2000)) for i in range(4000)]
    sizes = [r["count"] for r in placed[-1][0].groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1500


@pytest.mark.parametrize("name, sorts", [("scan_csv_bills", False), ("land_raw", False), ("dedup_in_file_order", True)])
def test_files_are_sorted_only_where_their_order_decides(spark, small, monkeypatch, name, sorts):
    written = []
    monkeypatch.setattr(queries, "write_bills_csv", lambda df, path, f=queries.write_bills_csv: written.append(df) or f(df, path))
    queries.registered()[name](spark, small)
    plan = plan_of(written[0])
    assert ("Sort [" in plan) == sorts
    # The cells are made behind the sort, so that neither its sample nor its shuffle knows them.
    assert "date_format" in plan and "date_format" not in plan[plan.index("Sort [") if sorts else len(plan):]


def test_parts_come_before_orders_and_suppliers(spark, small):
    plan = plan_of(read_sales_bills(spark, small))
    places = [plan.index(f"= {key}#") for key in ("s_suppkey", "o_orderkey", "p_partkey")]
    assert places == sorted(places)  # the deeper a join, the earlier it runs


def test_ordered_bills_come_in_their_order(spark, small):
    lines = read_sales_bills(spark, small, ["UMIS BILL ID"], ordered=True).select("_source_order", "_source_line", "_source_part").collect()
    assert lines == sorted(lines) and len(lines) == read_sales_bills(spark, small, ["UMIS BILL ID"]).count()


def test_texts_that_are_no_numbers_do_not_reach_the_cast(spark):
    texts = ["n/a", "1,234", "#N/A", "1/2", "x", "1e5", " 7 ", "-0.5", "inf", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    stopped = [r[0] for r in df.select(F.col("v").rlike(numbers._NO_NUMBER)).collect()]
    assert stopped == [True] * 5 + [False] * 4 + [None]
    read = [r[0] for r in numbers.parse_numbers(df, ["v"]).collect()]
    assert read == [None] * 5 + [1e5, 7.0, -0.5, float("inf"), None]


def test_file_order_does_not_search_the_path(spark):
    paths = ["file:///a-7/part-00012-x.csv", "file:///a-7/part-100000-x.csv", "bills 3.csv", "/a9/none.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "path string").select(_file_order(F.col("path")).alias("place"))
    places = [r.place for r in df.collect()]
    assert places == [n.rjust(20, "0") + " " + p for n, p in zip(["00012", "100000", "3", ""], paths)]
    assert "[^/]" not in plan_of(spark.range(1).select(_file_order(F.col("id").cast("string"))))


def walked(texts, cuts, opened=None, nth=None):
    import pyarrow as pa

    walk = _Walk("file:///bills.csv", 7, opened, nth)
    parts = [walk.lines_of(pa.array(texts[low:high], pa.string())) for low, high in zip([0, *cuts], [*cuts, len(texts)])]
    return [tuple(row.values()) for part in parts for row in part.select(["line", "opened", "nth", "text"]).to_pylist()]


def test_rows_within_a_batch_need_no_shuffle():
    texts = ["a,b", 'c,"d', "", 'e"', "f,g", '"h', 'i",j', "k", '"l', "m"]
    rows = [(0, -1, -1, "a,b"), (1, -1, -1, 'c,"d\n\ne"'), (4, -1, -1, "f,g"), (5, -1, -1, '"h\ni",j'), (7, -1, -1, "k")]
    assert walked(texts, []) == [*rows, (8, 7, 9, '"l'), (9, 7, 9, "m")]
    cut = [(1, 7, 2, 'c,"d'), (2, 7, 2, ""), (3, 7, 2, 'e"')]
    assert walked(texts, [2, 9]) == [rows[0], *cut, *rows[2:], (8, 7, 9, '"l'), (9, 7, 9, "m")]
    assert walked(["x", 'y"', "z"], [], 3, 5) == [(0, 3, 5, "x"), (1, 3, 5, 'y"'), (2, -1, -1, "z")]


def test_counted_staging_holds_what_decides_on_bills(spark, small, stored_columns):
    queries.registered()["stage_row_counts"](spark, small)
    assert "Location" in stored_columns["raw"] and "Location" not in stored_columns["staging"]


@pytest.mark.parametrize("name", ["sink_replace_table", "join_development"])
def test_stored_staging_holds_what_is_read(spark, small, stored_columns, name):
    queries.registered()[name](spark, small)
    assert "Development Name" in stored_columns["staging"] and "# days" not in stored_columns["staging"]
