"""What the steps of a query leave on disk while it runs."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from billmill import queries, workspace
from billmill.operators import dedup
from billmill.operators.dedup import PLACE, place_rows, rows_at
from billmill.plans import staging
from billmill.sources import bill_files
from billmill.sources.bill_files import FILE_ORDER, land_raw, read_bills_csv, write_bills_csv
from billmill.sources.sales_bills import SALES_ORDER, read_sales_bills
from billmill.workspace import shared_folder, stored


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def names_below(folder, end):
    return [name for _, _, names in os.walk(folder) for name in names if name.endswith(end)]


def steps(spark, name):
    return {entry for entry in os.listdir(shared_folder(spark).removeprefix("file:")) if entry.startswith(f"{name}-")}


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def left_by(spark, write):
    """The shuffle files that ``write`` has left a while after it."""
    before = shuffle_files(spark)
    write()
    for _ in range(100):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_written_steps_leave_no_shuffle_files(spark, tmp_path):
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("of")).count().repartition(3, "count")
    assert left_by(spark, lambda: stored(counts, "counts")) == set()
    assert left_by(spark, lambda: write_bills_csv(counts, str(tmp_path / "csv"))) == set()
    assert left_by(spark, lambda: land_raw(counts, str(tmp_path / "raw"))) == set()
    assert spark.conf.get(workspace._CLEANUP, "false") == "false"


def test_csv_files_are_packed_and_raw_copies_small(spark, small, monkeypatch):
    written = []
    monkeypatch.setattr(queries, "write_bills_csv", lambda df, path, f=queries.write_bills_csv: written.append(path) or f(df, path))
    monkeypatch.setattr(queries, "land_raw", lambda df, path, f=queries.land_raw: written.append(path) or f(df, path))
    landed = queries.registered()["land_raw"](spark, small)
    csv, raw = (path.removeprefix("file:") for path in written)
    assert names_below(csv, ".csv.gz") and not names_below(csv, ".csv")
    assert names_below(raw, ".zstd.parquet")
    assert landed.where("has_source").count() == landed.count() > 0


def test_packed_files_are_bounded_and_keep_their_order(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(bill_files._PACKED, "maxRecordsPerFile", 300)
    df = spark.range(0, 5000, 1, 3).select(F.col("id").cast("string"), F.lit('say "a", b').alias("text"))
    write_bills_csv(df, str(tmp_path / "csv.gz"))
    assert len(names_below(tmp_path / "csv.gz", ".csv.gz")) == 18
    rows = read_bills_csv(spark, str(tmp_path / "csv.gz")).orderBy(*FILE_ORDER).collect()
    assert [(int(r.id), r.text) for r in rows] == [(i, 'say "a", b') for i in range(5000)]


def test_bills_are_sorted_from_a_step_that_goes(spark, small, monkeypatch):
    before, written = steps(spark, "line-items"), []
    monkeypatch.setattr(queries, "write_bills_csv", lambda df, path, f=queries.write_bills_csv: written.append(df) or f(df, path))
    queries.registered()["dedup_in_file_order"](spark, small)
    plan = plan_of(written[0])
    assert "Sort [" in plan and "Join" not in plan  # the shuffles of the joins are gone when the sort begins
    assert steps(spark, "line-items") == before


@pytest.mark.parametrize("sent", [1 << 17, 0])
def test_rows_at_places(spark, monkeypatch, sent):
    monkeypatch.setattr(dedup, "MOST_SENT", sent)
    wide = stored(place_rows(spark.range(0, 30_000, 1, 3).select("id", F.lit(None).cast("string").alias("none"))), "wide")
    places = wide.where("id % 7 = 3 or id between 12000 and 13000 or id in (0, 29999)").select(PLACE)
    for asked in (places, places.unionAll(places), wide.select(PLACE), wide.select(PLACE).limit(0)):
        got = rows_at(wide, asked)
        assert got.columns == ["id", "none"]
        want = wide.join(asked.distinct(), PLACE, "left_semi")
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect())


def test_wide_bills_stay_in_their_tasks(spark, small, monkeypatch):
    noted = []
    monkeypatch.setattr(staging, "stored", lambda df, name: noted.append(df) or stored(df, name))
    raw = read_sales_bills(spark, small)
    moved = staging.build_staging(stored(raw, "raw"), SALES_ORDER)
    placed = staging.build_staging(stored(place_rows(raw), "raw"), SALES_ORDER)
    old, new = (df._jdf.queryExecution().executedPlan().toString() for df in noted)
    assert "Exchange hashpartitioning" in old and "Exchange hashpartitioning" not in new
    assert placed.schema == moved.schema
    assert sorted(map(str, placed.collect())) == sorted(map(str, moved.collect()))


def test_placed_bills_that_are_marked_or_lack_columns(spark, small):
    from billmill.operators.clean import mark_bills

    bills = read_sales_bills(spark, small)
    for raw in (mark_bills(bills), bills.drop("Meter Number", "Development Name"), bills.drop(*queries.MEASURES)):
        moved = staging.build_staging(stored(raw, "raw"), SALES_ORDER)
        placed = staging.build_staging(stored(place_rows(raw), "raw"), SALES_ORDER)
        assert placed.schema == moved.schema
        assert sorted(map(str, placed.collect())) == sorted(map(str, moved.collect()))


def test_queries_stage_placed_bills(spark, small, monkeypatch):
    found = []
    monkeypatch.setattr(queries, "build_staging", lambda raw, order, f=queries.build_staging: found.append(raw.columns) or f(raw, order))
    before = steps(spark, "raw")
    queries.registered()["sink_csv_roundtrip"](spark, small)
    assert steps(spark, "raw") == before  # gone before the export is written
    queries.registered()["build_staging"](spark, small)
    assert len(found) == 2 and all(PLACE in columns for columns in found)
