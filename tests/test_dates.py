from __future__ import annotations

import pandas as pd
import pytest

from billmill.functions.dates import DATE_FORMATS, matching_format, parse_date
from billmill.plans.staging import infer_date_format
from billmill.plans.warehouse import Load, run

TEXTS = [
    "2010-01-26", "2010-1-6", "01/26/2010", "1/6/2010", "13/01/2010", "2010/01/26", "26-Jan-2010", "26 Jan 2010", "Jan 26, 2010",
    "January 26, 2010", "May 6, 2010", "20100126", "01/26/10", "2010-01-26 00:00:00", "2010-01-26T10:11:12", "01/26/2010 14:30",
    "01/26/2010 12:00:00 AM", "2010-01-26T00:00:00.000", "26.01.2010", "01.06.2010", "01-26-2010", "26-01-2010", "02/30/2010", "abc",
]


@pytest.mark.filterwarnings("ignore")
def test_single_dates_are_read_as_pandas_reads_them(spark):
    for text in TEXTS:
        found = matching_format(spark, text)
        row = spark.createDataFrame([(text,)], "text string").select(parse_date("text", found or DATE_FORMATS).alias("day")).first()
        want = pd.to_datetime(pd.Series([text]), errors="coerce")[0]
        assert row.day == (None if pd.isna(want) else want.date()), text


@pytest.mark.filterwarnings("ignore")
@pytest.mark.parametrize(
    "texts",
    [
        ["2010-01-26", "01/27/2010", "2010-1-6", None, "2010-02-30"],
        ["01/26/2010", "2010-01-27", "13/01/2010", "1/6/2010"],
        ["13/01/2010", "01/02/2010", "01/13/2010"],
        [None, "N/A", "20100126", "20100230", "2010-01-26"],
        ["26-Jan-2010", "27-FEB-2010", "x"],
        ["2010-01-26 10:00:00", "2010-01-27"],
        ["02/30/2010", "2010-01-27", "01/28/2010"],
        ["no date", None, "13/01/2010", "Jan 5, 2011"],
    ],
)
def test_the_first_date_decides_for_all(spark, texts):
    rows = [(i, text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "at long, `Service End Date` string").repartition(3)
    shape = infer_date_format(df, ["at"])
    days = df.select("at", parse_date("Service End Date", shape).alias("day")).orderBy("at").collect()
    want = pd.to_datetime(pd.Series([None if t == "N/A" else t for t in texts]), errors="coerce")
    assert [r.day for r in days] == [None if pd.isna(w) else w.date() for w in want]


def write(folder, text, name="a.csv"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("Service End Date,Borough,Meter Number,Consumption (KWH),Current Charges\n" + text)
    return str(folder)


def test_iso_dates_load_without_a_word(spark, tmp_path):
    bills = write(tmp_path / "in", ",Q,0,1,1\n2020-01-05,Q,1,10,5\n2020-01-06,Q,2,20,6\n")
    tables = run(spark, Load(bills, str(tmp_path / "tables"), "iso_load"))
    assert sorted(str(r.BillDate_Std) for r in tables["electric_staging"].collect()) == ["2020-01-05", "2020-01-06"]
    assert tables["fact_borough_year_usage"].first().total_kwh == 30.0
    counts = {r.stage: r.row_count for r in spark.table("iso_load.stage_row_counts").collect()}
    assert counts == {"raw": 3, "dated": 2, "measured": 2, "staged": 2}


def test_a_load_that_loses_its_bills_is_refused(spark, tmp_path):
    place = str(tmp_path / "tables")
    run(spark, Load(write(tmp_path / "in", "01/05/2020,Q,1,10,5\n"), place, "lost_load"))

    def refused(message, text, **options):
        with pytest.raises(ValueError, match=message):
            run(spark, Load(write(tmp_path / "in", text), place, "lost_load", **options))
        assert [r.total_kwh for r in spark.table("lost_load.fact_borough_year_usage").collect()] == [10.0]

    refused("no bill has a date", "2020-01-05,Q,1,99,5\n2020-01-06,Q,1,99,5\n", date_format="M/d/yyyy")
    refused("no bill has a date .every known format", "soon,Q,1,99,5\n")
    refused("less than 60%", "01/05/2020,Q,1,99,5\nlater,Q,1,99,5\n", least_dated=0.6)
    refused("no bill is left", "01/05/2020,Q,1,,\n")
