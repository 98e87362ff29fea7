from __future__ import annotations

import datetime as dt
import math

import pytest

from billmill.functions.dates import date_key, is_weekend
from billmill.functions.text import col
from billmill.operators import clean
from billmill.plans.staging import build_staging, clean_bills, first_bills, stage_counts
from billmill.schema import NA_TOKENS

ORDER = ("_place_in_file",)


def column(df, name):
    return [row[name] for row in df.collect()]


def texts(spark, name, values):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"_place_in_file INT, `{name}` STRING").coalesce(1)


NUMBERS = [
    ("1,234", None),
    ("$3", None),
    ("x", None),
    ("", None),
    (None, None),
    ("n/a", None),
    ("5d", None),
    ("5f", None),
    ("5D", None),
    ("0x1p3", None),
    ("1e400", None),
    ("-1e400", None),
    ("nan", None),
    ("NaN", None),
    ("1_000", None),
    ("12", 12.0),
    (" 12 ", 12.0),
    ("-12.50", -12.5),
    ("+3", 3.0),
    (".5", 0.5),
    ("1e3", 1000.0),
    ("0", 0.0),
    ("inf", math.inf),
    ("-inf", -math.inf),
    ("Infinity", math.inf),
]


def test_numbers(spark):
    bills = texts(spark, "Current Charges", [text for text, _ in NUMBERS])
    assert column(clean.coerce_measures(bills), "Current Charges") == [number for _, number in NUMBERS]


def test_na_tokens_are_exact_spellings(spark):
    kept = ["-", "none", "na", "Unknown", "NONE", " "]
    result = column(clean.null_na_tokens(texts(spark, "Vendor Name", [*NA_TOKENS, *kept])), "Vendor Name")
    assert result == [None] * len(NA_TOKENS) + kept


DAYS = [
    ("01/26/2010", dt.date(2010, 1, 26)),
    ("1/6/2010", dt.date(2010, 1, 6)),
    ("02/29/2012", dt.date(2012, 2, 29)),
    ("04/11/2262", dt.date(2262, 4, 11)),
    ("09/22/1677", dt.date(1677, 9, 22)),
    ("04/12/2262", None),
    ("12/31/9999", None),
    ("09/20/1677", None),
    ("1/6/10", None),
    ("02/30/2010", None),
    ("02/29/2011", None),
    ("13/01/2010", None),
    ("2010-01-26", None),
    ("Mar 5 2010", None),
    ("", None),
    (None, None),
]


def test_dates(spark):
    parsed = clean.parse_bill_date(texts(spark, "Service End Date", [text for text, _ in DAYS]))
    assert column(parsed, "BillDate_Std") == [day for _, day in DAYS]
    assert column(parsed, "Service End Date") == [day for _, day in DAYS]
    first = parsed.first()
    assert (first.Bill_Year, first.Bill_Quarter, first.Bill_Month, first.Bill_Day) == (2010, 1, 1, 26)
    assert clean.drop_undated(parsed).count() == 5


def test_another_date_format(spark):
    parsed = clean.parse_bill_date(texts(spark, "Service End Date", ["2010-01-26", "01/26/2010"]), "yyyy-MM-dd")
    assert column(parsed, "BillDate_Std") == [dt.date(2010, 1, 26), None]


def test_the_date_is_required(spark):
    with pytest.raises(ValueError, match="Service End Date"):
        clean.parse_bill_date(texts(spark, "Borough", ["Q"]))


def test_date_key_and_weekend(spark):
    days = spark.createDataFrame([(dt.date(2025, 1, 15),), (dt.date(2025, 1, 18),), (dt.date(2025, 1, 19),)], "d DATE")
    rows = days.select(date_key(col("d")).alias("k"), is_weekend(col("d")).alias("w")).collect()
    assert [(row.k, row.w) for row in rows] == [(20250115, False), (20250118, True), (20250119, True)]


def test_unknown_members_also_for_numbers(spark):
    bills = spark.createDataFrame([(73, None), (None, "Q")], "`TDS #` INT, Borough STRING")
    rows = clean.fill_unknown(bills).collect()
    assert [tuple(row) for row in rows] == [("73", "Unknown"), ("Unknown", "Q")]


def test_rows_without_measures(spark):
    schema = "`# days` DOUBLE, `Current Charges` DOUBLE, note STRING"
    bills = spark.createDataFrame([(None, None, "gone"), (None, 0.0, "kept"), (1.0, None, "kept")], schema)
    assert column(clean.drop_empty_measures(bills), "note") == ["kept", "kept"]
    no_measures = bills.select("note")
    assert clean.drop_empty_measures(no_measures).count() == 3


def test_ratios(spark):
    schema = "`# days` DOUBLE, `Consumption (KWH)` DOUBLE, `Current Charges` DOUBLE"
    rows = [
        (30.0, 300.0, 60.0),
        (0.0, 5.0, -5.0),
        (0.0, 0.0, 0.0),
        (None, 5.0, 5.0),
        (2.0, 0.0, 5.0),
        (2.0, None, 5.0),
        (math.inf, math.inf, math.inf),
    ]
    bills = spark.createDataFrame(rows, schema).coalesce(1)
    result = bills.transform(clean.add_daily_ratios).transform(clean.add_unit_cost)
    assert column(result, "Avg_Daily_kWh") == [10.0, math.inf, None, None, 0.0, None, None]
    assert column(result, "Avg_Daily_Current_Charges") == [2.0, -math.inf, None, None, 2.5, 2.5, None]
    assert column(result, "Cost_per_kWh") == [0.2, -1.0, None, 1.0, None, None, None]


BILLS = [
    # place, date, development, meter, charges, kwh, days
    (1, "01/26/2010", "A", "1", "n/a", "", None),  # no measure: must not win over its copy
    (2, "01/26/2010", "A", "1", "10", "100", "10"),
    (3, "01/26/2010", "A", "1", "11", "110", "10"),  # later copy
    (4, "1/26/2010", "A", "1", "12", "120", "10"),  # the same day, other spelling
    (5, "01/26/2010", None, "N/A", "5", "50", "0"),  # unknown development and meter
    (6, "01/26/2010", "NULL", "", "6", "60", "5"),  # the same unknown key
    (7, "02/30/2010", "A", "1", "7", "70", "7"),  # no such day
    (8, "02/28/2010", "A", "1", "8", "1,234", "8"),  # usage is no number
    (9, "03/28/2010", "A", "1", "x", "", ""),  # no measure at all
    (10, "04/28/2010", "B", "2", "9", "200", "2"),
]
COLUMNS = (
    "_place_in_file INT, `Service End Date` STRING, `Development Name` STRING, `Meter Number` STRING, "
    "`Current Charges` STRING, `Consumption (KWH)` STRING, `# days` STRING"
)


@pytest.fixture(scope="module")
def bills(spark):
    return spark.createDataFrame(BILLS, COLUMNS)


def test_whole_cleaning(bills):
    staging = build_staging(bills, ORDER)
    assert staging.columns == [
        "Service End Date",
        "Development Name",
        "Meter Number",
        "Current Charges",
        "Consumption (KWH)",
        "# days",
        "BillDate_Std",
        "Bill_Year",
        "Bill_Quarter",
        "Bill_Month",
        "Bill_Day",
        "Avg_Daily_kWh",
        "Avg_Daily_Current_Charges",
        "Cost_per_kWh",
        "HighUsageFlag",
    ]
    rows = staging.select(
        "BillDate_Std", "`Development Name`", "`Meter Number`", "`Current Charges`", "Avg_Daily_kWh", "HighUsageFlag"
    ).orderBy("`Current Charges`")
    # Usage left: 50, 100, 200 and one missing; the median is 100.
    assert [tuple(row) for row in rows.collect()] == [
        (dt.date(2010, 1, 26), "Unknown", "Unknown", 5.0, math.inf, 0),
        (dt.date(2010, 2, 28), "A", "1", 8.0, None, 0),
        (dt.date(2010, 4, 28), "B", "2", 9.0, 100.0, 1),
        (dt.date(2010, 1, 26), "A", "1", 10.0, 10.0, 0),
    ]


def test_dropping_empty_bills_first_gives_the_same(bills):
    cleaned = clean_bills(bills, ORDER)
    late = first_bills(cleaned, ORDER).collect()
    early = first_bills(clean.drop_empty_measures(cleaned), ORDER).collect()
    assert sorted(late, key=str) == sorted(early, key=str)


def test_counts_per_stage(bills):
    staging = build_staging(bills, ORDER)
    rows = stage_counts(bills, staging, ORDER).orderBy("place").collect()
    assert [(r.stage, r.row_count, r.column_count) for r in rows] == [
        ("raw", 10, 6),
        ("dated", 9, 11),
        ("measured", 7, 11),
        ("staged", 4, 15),
    ]
    assert (staging.count(), len(staging.columns)) == (4, 15)


def test_columns_that_are_absent_and_columns_nobody_lists(bills):
    extra = bills.withColumnRenamed("Meter Number", "Remark").drop("# days", "Consumption (KWH)")
    staging = build_staging(extra, ORDER)
    assert "Remark" in staging.columns and "Cost_per_kWh" not in staging.columns
    assert "HighUsageFlag" not in staging.columns
    # Without meters, date and development alone make the key.
    assert sorted(row["Current Charges"] for row in staging.collect()) == [5.0, 8.0, 9.0, 10.0]


def test_only_dates(bills):
    staging = build_staging(bills.select("_place_in_file", "Service End Date"), ORDER)
    assert staging.count() == 4
