from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from billmill.plans.staging import build_staging
from billmill.plans.warehouse import Load, run
from billmill.queries import _csv_folder, registered
from billmill.sources.sales_bills import SALES_ORDER, read_sales_bills


@pytest.fixture(scope="module")
def loaded(spark, small, tmp_path_factory):
    folder = tmp_path_factory.mktemp("load")
    load = Load(_csv_folder(spark, small), str(folder / "tables"), "load_test", export=str(folder / "export"))
    return load, run(spark, load)


def test_tables_hold_what_the_queries_give(spark, small, loaded):
    load, tables = loaded
    assert set(tables["electric_staging"].columns) == set(registered()["build_staging"](spark, small).columns)
    for name in ("dim_date", "dim_development", "dim_meter", "dim_vendor", "fact_borough_year_usage", "stage_row_counts"):
        stored = spark.table(f"{load.namespace}.{name}")
        want = registered()[name](spark, small).select(stored.columns)
        assert sorted(map(str, stored.collect())) == sorted(map(str, want.collect())), name


def test_export_keeps_the_names_of_the_bills(spark, small, loaded):
    load, tables = loaded
    export = spark.read.option("header", True).option("escape", '"').csv(load.export)
    assert export.columns == build_staging(read_sales_bills(spark, small), SALES_ORDER).columns
    assert export.count() == tables["electric_staging"].count()


def test_contract_tables(spark, loaded):
    load, tables = loaded
    assert tables["contract.dim_time"].count() == 1440
    assert spark.table(f"{load.namespace}_contract.dim_date").columns[1] == "calendar_date"
    facts = tables["contract.fact_electric_consumption"]
    assert facts.count() == tables["electric_staging"].count() == 5681
    assert facts.agg(F.max("fact_key"), F.count_distinct("ingestion_timestamp")).first()[:] == (5681, 1)
    usage = tables["fact_borough_year_usage"].agg(F.sum("total_kwh")).first()[0]
    assert float(facts.agg(F.sum("kwh_consumed")).first()[0]) == usage == 5031371.0


def test_nothing_violates_the_contract(loaded):
    checks = {line.constraint: line.violations for line in loaded[1]["load_checks"].collect()}
    assert not any(checks.values())
    assert {"primary key of dim_date", "foreign key location_key"} <= set(checks)
    assert sum(name.startswith("not null") for name in checks) == 8
    assert [line.violations for line in loaded[1]["load_notes"].collect()] == [10]


def test_running_again_replaces_everything(spark, loaded):
    load, tables = loaded
    again = run(spark, load)
    for name, table in again.items():
        columns = [c for c in table.columns if c != "ingestion_timestamp"]
        old = tables[name].select(*[f"`{c}`" for c in columns])
        new = table.select(*[f"`{c}`" for c in columns])
        assert sorted(map(str, old.collect())) == sorted(map(str, new.collect())), name


def test_values_that_do_not_fit_stop_the_load(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(
        "Service End Date,Development Name,Borough,Meter Number,Meter AMR,Rate Class,Account Name,"
        "Consumption (KWH),Current Charges\n01/26/2010,A,Q,1,AMR,R,acc,1e30,5\n"
    )
    load = Load(str(tmp_path / "in"), str(tmp_path / "tables"), "misfit_test")
    with pytest.raises(ValueError, match="kwh_consumed: 1"):
        run(spark, load)


@pytest.mark.parametrize("name", ["Borough", "Meter AMR", "Rate Class", "Account Name"])
def test_long_text_stops_the_load_before_any_table_moves(spark, tmp_path, name):
    columns = ["Service End Date", "Development Name", "Borough", "Meter Number", "Meter AMR", "Rate Class", "Account Name"]
    columns += ["Consumption (KWH)", "Current Charges"]
    good = dict(zip(columns, ["01/26/2010", "A", "Q", "1", "AMR", "R", "acc", "10", "5"]))
    namespace = "long_" + name.replace(" ", "_").lower()

    def load(**other):
        (tmp_path / "in").mkdir(exist_ok=True)
        lines = [good, good | {"Meter Number": "2"} | other]
        text = "\n".join([",".join(columns), *[",".join(line.values()) for line in lines]]) + "\n"
        (tmp_path / "in" / "a.csv").write_text(text)
        return run(spark, Load(str(tmp_path / "in"), str(tmp_path / "tables"), namespace))

    load()
    before = {t: sorted(map(str, spark.table(f"{namespace}.{t}").collect())) for t in ("electric_staging", "dim_date")}
    with pytest.raises(ValueError, match="values that do not fit the contract.*: 1"):
        load(**{name: "x" * 60, "Service End Date": "02/26/2010"})
    after = {t: sorted(map(str, spark.table(f"{namespace}.{t}").collect())) for t in before}
    assert after == before
    customers = spark.table(f"{namespace}_contract.dim_customer")
    assert customers.count() == customers.select("customer_id").distinct().count() == 1


def test_few_columns_still_load(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(
        "Service End Date,Borough,Consumption (KWH),Current Charges\n01/26/2010,Q,10,5\n01/27/2010,,1,2\n"
    )
    tables = run(spark, Load(str(tmp_path / "in"), str(tmp_path / "tables"), "few_test"))
    assert "dim_meter" not in tables and tables["contract.dim_meter_type"].count() == 0
    facts = tables["contract.fact_electric_consumption"].orderBy("fact_key").collect()
    assert [(f.fact_key, f.date_key, f.location_key, f.meter_type_key) for f in facts] == [(1, 1, 1, None), (2, 2, 2, None)]
    assert all(line.violations == 0 for line in tables["load_checks"].collect())
    assert {line.constraint.split()[1] for line in tables["load_notes"].collect()} == {"dim_development", "dim_meter", "dim_vendor"}
