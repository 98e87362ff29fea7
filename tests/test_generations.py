from __future__ import annotations

import os

import pytest

from billmill.plans.warehouse import Load, run
from billmill.sources import tables
from billmill.sources.bill_files import OrderedExport, read_bills_csv
from billmill.sources.tables import (
    create_namespace,
    generation,
    named_place,
    publish,
    publish_together,
    read_generation,
    settle,
    write_version,
)

NAMES = [f"together.t{i}" for i in range(5)]


@pytest.fixture
def folder(spark, tmp_path):
    spark.sql("DROP DATABASE IF EXISTS together CASCADE")
    create_namespace(spark, "together", str(tmp_path / "ns"))
    return str(tmp_path / "tables")


def versions(spark, folder, n, names=NAMES):
    """Tables of n rows; the third has other columns in every version, the fourth a folder per value."""
    shapes = {"together.t2": f"id as c{n}", "together.t3": "id, id % 2 as part"}
    return [
        write_version(spark.range(n).selectExpr(*shapes.get(name, "id").split(", ")), name, folder, ["part"] if name.endswith("t3") else [])
        for name in names
    ]


def counts(spark, names=NAMES):
    spark.catalog.clearCache()
    return [spark.table(name).count() if spark.catalog.tableExists(name) else None for name in names]


def test_a_failure_at_the_third_name_leaves_all_five_as_they_were(spark, folder, monkeypatch):
    publish_together(spark, versions(spark, folder, 3), folder)
    assert counts(spark) == [3] * 5
    move = tables.publish

    def third_fails(version):
        if version.table == NAMES[2]:
            raise OSError("catalog is away")
        return move(version)

    monkeypatch.setattr(tables, "publish", third_fails)
    with pytest.raises(OSError):
        publish_together(spark, versions(spark, folder, 7), folder)
    assert counts(spark) == [3] * 5
    assert {t: df.count() for t, df in read_generation(spark, folder).items()} == dict.fromkeys(NAMES, 3)
    monkeypatch.setattr(tables, "publish", move)
    publish_together(spark, versions(spark, folder, 7), folder)
    assert counts(spark) == [7] * 5
    assert spark.table(NAMES[2]).columns == ["c7"]


def test_a_failed_record_takes_the_names_back(spark, folder, monkeypatch):
    publish_together(spark, versions(spark, folder, 2, NAMES[:2]), folder)
    monkeypatch.setattr(tables.Files, "write", lambda *_: (_ for _ in ()).throw(OSError("disk is full")))
    with pytest.raises(OSError):
        publish_together(spark, versions(spark, folder, 4), folder)
    assert counts(spark) == [2, 2, None, None, None]


def test_a_lost_driver_is_settled(spark, folder):
    publish_together(spark, versions(spark, folder, 2), folder)
    for version in versions(spark, folder, 9)[:3]:  # and then the driver is gone
        publish(version)
    assert counts(spark) == [9, 9, 9, 2, 2]
    assert {df.count() for df in read_generation(spark, folder).values()} == {2}
    assert settle(spark, folder) == NAMES[:3]
    assert counts(spark) == [2] * 5 and settle(spark, folder) == []


def test_tables_left_out_of_a_load_stay_in_the_generation(spark, folder):
    publish_together(spark, versions(spark, folder, 2), folder)
    publish_together(spark, versions(spark, folder, 3, NAMES[:1]), folder)
    assert [len(generation(spark, folder)), read_generation(spark, folder)[NAMES[4]].count()] == [5, 2]
    assert counts(spark) == [3, 2, 2, 2, 2]


def test_layout_prunes_folders_and_moves_in_one_step(spark, folder):
    def rows(n):
        return spark.range(n).selectExpr("id", "CAST(2000 + id % 4 AS INT) AS year", "id * 2 AS twice")

    publish(write_version(rows(40), "together.by_year", folder, ["year"], ["twice"]))
    table = spark.table("together.by_year")
    plan = table.where("year = 2001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters: []" in plan
    assert sorted(r.id for r in table.where("year = 2001").collect()) == list(range(1, 40, 4))
    publish(write_version(rows(80), "together.by_year", folder, ["year"], ["twice"]))
    assert spark.table("together.by_year").where("year = 2003").count() == 20
    assert named_place(spark, "together.by_year").partition_by == ("year",)
    publish(write_version(rows(8), "together.by_year", folder))  # another layout
    assert spark.table("together.by_year").columns == ["id", "year", "twice"]
    assert spark.table("together.by_year").count() == 8


def test_staging_lies_in_a_folder_per_year_and_usage_in_order(spark, tmp_path):
    lines = [f"0{1 + i % 9}/05/{2010 + i % 5},B{i % 3},{i},{i},5" for i in range(60)]
    place = tmp_path / "in"
    place.mkdir()
    (place / "a.csv").write_text("Service End Date,Borough,Meter Number,Consumption (KWH),Current Charges\n" + "\n".join(lines) + "\n")
    run(spark, Load(str(place), str(tmp_path / "tables"), "layout_load", multi_line=False))
    staging = spark.table("layout_load.electric_staging")
    plan = staging.where("Bill_Year = 2012")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Bill_Year" in plan
    assert staging.where("Bill_Year = 2012").count() == 12
    usage = named_place(spark, "layout_load.fact_borough_year_usage").path.removeprefix("file:")
    files = sorted(name for name in os.listdir(usage) if name.endswith(".parquet"))
    held = [(r.bill_year, r.borough) for name in files for r in spark.read.parquet(f"{usage}/{name}").collect()]
    assert held == sorted(held) and len(held) == 15


# --- The export ----------------------------------------------------------------------------------------


def bills(path, meters, kwh="10"):
    path.mkdir(exist_ok=True)
    header = "Service End Date,Borough,Meter Number,Rate Class,Consumption (KWH),Current Charges\n"
    (path / "a.csv").write_text(header + "".join(f"01/05/2020,Q,{m},{kwh[:400] if len(kwh) > 50 else 'R'},{i},5\n" for i, m in enumerate(meters)))
    return str(path)


def exported(load):
    files = sorted(name for name in os.listdir(load.export) if name.endswith(".csv"))
    return [line.split(",")[2] for name in files for line in open(f"{load.export}/{name}").read().splitlines()[1:]]


def test_the_export_keeps_the_order_of_the_bills_and_appears_at_once(spark, tmp_path, monkeypatch):
    meters = [f"M{(i * 37) % 100}" for i in range(100)]
    load = Load(bills(tmp_path / "in", meters), str(tmp_path / "tables"), "export_load", export=str(tmp_path / "out" / "staging"))
    run(spark, load)
    assert exported(load) == meters
    assert os.listdir(tmp_path / "out") == ["staging"]

    bills(tmp_path / "in", ["new"], kwh="x" * 400)  # a rate class that does not fit
    with pytest.raises(ValueError, match="do not fit"):
        run(spark, load)
    assert exported(load) == meters and os.listdir(tmp_path / "out") == ["staging"]

    bills(tmp_path / "in", ["N1", "N2"])
    monkeypatch.setattr("billmill.plans.warehouse.publish_together", lambda *_: (_ for _ in ()).throw(OSError("away")))
    with pytest.raises(OSError):
        run(spark, load)
    assert exported(load) == meters and os.listdir(tmp_path / "out") == ["staging"]
    monkeypatch.undo()
    run(spark, load)
    assert exported(load) == ["N1", "N2"] and os.listdir(tmp_path / "out") == ["staging"]


def test_a_failed_rename_leaves_the_old_export(spark, tmp_path, monkeypatch):
    place = str(tmp_path / "out")

    def export(n):
        new = OrderedExport(spark, place)
        new.write(spark.range(n).selectExpr("id AS a", "-id AS at"), ["at"])
        return new

    first = export(3)
    first.swap()
    second = export(5)
    move = second.files.rename

    def fails(what, to):
        if what == second.aside:
            raise OSError("no rename")
        move(what, to)

    monkeypatch.setattr(second.files, "rename", fails)
    with pytest.raises(OSError):
        second.swap()
    assert read_bills_csv(spark, place).count() == 3
    monkeypatch.undo()
    second.swap()
    second.undo()
    assert read_bills_csv(spark, place).count() == 3
    second.discard()
    assert os.listdir(tmp_path) == ["out"]
