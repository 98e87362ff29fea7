from __future__ import annotations

import math
import os

import pytest
from pyspark.sql import functions as F

from billmill.plans.staging import build_staging, clean_bills, first_bills
from billmill.sources.bill_files import FILE_ORDER, land_raw, read_bills_csv, read_typed_csv, write_bills_csv
from billmill.sources.tables import create_namespace, replace_table, use_namespace
from billmill.workspace import new_folder, shared_folder, stored

HEADER = "Service End Date,Development Name,Meter Number,Current Charges,Remark\n"


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_quoting_blanks_and_codes(spark, tmp_path):
    path = write(
        tmp_path / "in",
        "a.csv",
        HEADER + '01/26/2010,"Baker, ""North""",007,"1,234.5",\\x\n\n01/27/2010,,"",5, y \n',
    )
    rows = read_bills_csv(spark, path).orderBy("_source_row").drop(*FILE_ORDER).collect()
    assert [tuple(r) for r in rows][0] == ("01/26/2010", 'Baker, "North"', "007", "1,234.5", "\\x")
    second = tuple(rows[1])
    assert second[0] == "01/27/2010" and second[1] is None and second[2] in (None, "") and second[4] == " y "
    assert len(rows) == 2


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", HEADER + '01/26/2010,"two\nlines",1,5,z\n')
    rows = read_bills_csv(spark, path, multi_line=True).collect()
    assert [row["Development Name"] for row in rows] == ["two\nlines"]
    with pytest.raises(Exception):
        read_bills_csv(spark, path).collect()


def test_files_with_other_headers_fail(spark, tmp_path):
    write(tmp_path / "in", "a.csv", HEADER + "01/26/2010,A,1,5,z\n")
    path = write(tmp_path / "in", "b.csv", "Service End Date,Meter Number,Development Name,Current Charges,Remark\n1/1/2010,1,A,5,z\n")
    with pytest.raises(Exception):
        read_bills_csv(spark, path).collect()


def test_first_in_file_order_wins(spark, tmp_path):
    lines = [f"01/{1 + i % 28:02d}/2010,D{i % 7},{i % 3},{i},r{i}" for i in range(4000)]
    write(tmp_path / "in", "part-1.csv", HEADER + "\n".join(lines[:2500]) + "\n")
    path = write(tmp_path / "in", "part-2.csv", HEADER + "\n".join(lines[2500:]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")  # several blocks per file
    try:
        raw = read_bills_csv(spark, path)
        assert raw.rdd.getNumPartitions() > 8
        landed = land_raw(raw, str(tmp_path / "raw"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {}
    for line in lines:
        day, name, meter, charges, remark = line.split(",")
        want.setdefault((day, name, meter), remark)
    for partitions in (1, 13):
        kept = first_bills(clean_bills(landed.repartition(partitions))).collect()
        got = {(r["Service End Date"].strftime("%m/%d/%Y"), r["Development Name"], r["Meter Number"]): r["Remark"] for r in kept}
        assert got == want and len(kept) == len(want)


def test_export_and_read_back(spark, tmp_path):
    schema = "day DATE, text STRING, number DOUBLE, flag BIGINT"
    rows = [
        ("2010-01-26", 'say "a", b', math.inf, 1),
        ("2010-01-27", "back\\slash", -math.inf, 0),
        (None, None, None, None),
        ("2010-01-28", " padded ", 1.5e-7, -3),
    ]
    df = spark.createDataFrame(rows, "day STRING, text STRING, number DOUBLE, flag BIGINT")
    df = df.select(F.col("day").cast("date"), "text", "number", "flag").coalesce(1)
    folder = str(tmp_path / "out")
    write_bills_csv(df, folder)
    files = [f for f in os.listdir(folder) if f.endswith(".csv")]
    text = (tmp_path / "out" / files[0]).read_text()
    assert text.splitlines()[0] == "day,text,number,flag"
    assert ",inf," in text and ",-inf," in text and "2010-01-26" in text
    back = read_typed_csv(spark, folder, df.schema)
    assert back.schema.simpleString() == f"struct<{schema.lower().replace(' ', ':').replace(',:', ',')}>"
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_the_last_writer_wins(spark, tmp_path):
    create_namespace(spark, "sink_test", str(tmp_path / "ns"))
    first = replace_table(spark.range(5), "sink_test.t", str(tmp_path / "t"))
    assert first.count() == 5
    # A table may be replaced by a query over itself, also with other columns.
    replace_table(spark.table("sink_test.t").selectExpr("id * 2 AS twice").where("id > 2"), "sink_test.t", str(tmp_path / "t"))
    assert sorted(r.twice for r in spark.table("sink_test.t").collect()) == [6, 8]
    use_namespace(spark, "sink_test")
    try:
        assert spark.table("t").columns == ["twice"]
    finally:
        use_namespace(spark, "default")


def test_a_failed_write_keeps_the_old_table(spark, tmp_path):
    create_namespace(spark, "sink_test", str(tmp_path / "ns"))
    replace_table(spark.range(3), "sink_test.kept", str(tmp_path / "kept"))
    broken = spark.range(3).selectExpr("raise_error('broken') AS id")
    with pytest.raises(Exception, match="broken"):
        replace_table(broken, "sink_test.kept", str(tmp_path / "kept"))
    assert spark.table("sink_test.kept").count() == 3


def test_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    names = spark.createDataFrame([(1, "a b")], "`# days` INT, `Consumption (KWH)` STRING")
    assert stored(names, "odd-names").collect() == names.collect()


def test_short_rows_are_filled_and_long_rows_fail(spark, tmp_path):
    short = write(tmp_path / "short", "a.csv", HEADER + '01/26/2010,A,1\n01/27/2010,"B, C",2,5,z\n')
    rows = read_bills_csv(spark, short).orderBy("_source_row").drop(*FILE_ORDER).collect()
    assert [tuple(r) for r in rows] == [("01/26/2010", "A", "1", None, None), ("01/27/2010", "B, C", "2", "5", "z")]
    for line in ("01/26/2010,A,1,5,z,more\n", "01/26/2010,A,1,5,z,\n"):
        path = write(tmp_path / "long", "a.csv", HEADER + line)
        with pytest.raises(Exception, match="more cells than the header"):
            read_bills_csv(spark, path).collect()


def test_files_come_in_the_order_of_their_numbers(spark, tmp_path):
    write(tmp_path / "in", "part-100000.csv", HEADER + "01/26/2010,A,1,5,late\n")
    path = write(tmp_path / "in", "part-99999.csv", HEADER + "01/26/2010,A,1,5,early\n")
    kept = first_bills(clean_bills(read_bills_csv(spark, path))).collect()
    assert [row["Remark"] for row in kept] == ["early"]


def test_a_replacement_never_hides_the_name(spark, tmp_path):
    from billmill.sources.tables import old_versions, publish, write_version

    create_namespace(spark, "swap_test", str(tmp_path / "ns"))
    old = replace_table(spark.range(3), "swap_test.t", str(tmp_path / "tables"))
    assert old.count() == 3
    waiting = write_version(spark.range(5), "swap_test.t", str(tmp_path / "tables"))
    assert spark.table("swap_test.t").count() == 3  # written, not yet named
    assert publish(waiting).count() == spark.table("swap_test.t").count() == 5
    assert len(old_versions(spark, ["swap_test.t"], str(tmp_path / "tables"))) == 1
    wider = replace_table(spark.range(2).selectExpr("id", "id AS other"), "swap_test.t", str(tmp_path / "tables"))
    assert wider.columns == spark.table("swap_test.t").columns == ["id", "other"]


def test_raw_copies_are_versions(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", HEADER + "01/26/2010,A,1,5,z\n")
    first = land_raw(read_bills_csv(spark, path), str(tmp_path / "raw"))
    write(tmp_path / "in", "a.csv", HEADER + "01/27/2010,A,1,6,y\n01/28/2010,A,1,6,y\n")
    second = land_raw(read_bills_csv(spark, path), str(tmp_path / "raw"))
    assert (first.count(), second.count()) == (1, 2)


def test_staging_of_a_file(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", HEADER + "01/26/2010,A,,5,z\n01/26/2010,A,N/A,6,late\n02/30/2010,B,1,5,\n")
    rows = build_staging(land_raw(read_bills_csv(spark, path), str(tmp_path / "raw"))).collect()
    assert [(r["Meter Number"], r["Current Charges"], r["Remark"]) for r in rows] == [("Unknown", 5.0, "z")]
