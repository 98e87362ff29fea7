"""The whole load: bill files in, stored warehouse tables out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billmill.operators.checks import duplicate_keys, foreign_key_report, null_report, primary_key_report
from billmill.operators.clean import mark_bills
from billmill.plans import contract, star
from billmill.plans.staging import add_metrics, date_format_of, stage_counts, staged_bills, staging_names
from billmill.schema import (
    BILL_DATE,
    CONTRACT,
    CONTRACT_FOREIGN_KEYS,
    DIM_DEVELOPMENT,
    DIM_METER,
    DIM_VENDOR,
    DUPLICATE_KEYS,
    STAGING_RENAMES,
    STD_DATE,
)
from billmill.session import Sizing, sized, tune
from billmill.sources.bill_files import FILE_ORDER, OrderedExport, first_text, land_raw, read_bills_csv
from billmill.sources.files import Files
from billmill.sources.quoted_lines import QuotedLines
from billmill.sources.tables import Version, create_namespace, publish_together, settle, write_version
from billmill.workspace import recorded_steps, remove_steps


@dataclass
class Load:
    """Where bills come from and where tables go. All paths are URIs that every executor can reach.

    ``date_format`` None means the format of the first date in file order. ``multi_line`` None looks for line breaks
    in quotes, which costs one more scan of the text; False says that there are none. A load whose share of dated bills
    is below ``least_dated``, or that keeps no bill at all, is refused. ``input_bytes`` 0 is measured.
    """

    bills: str
    folder: str
    namespace: str = "billing"
    date_format: str | None = None
    multi_line: bool | None = None
    record_source: str = "monthly_bills"
    export: str | None = None
    input_bytes: int = 0
    least_dated: float = 0.0


def _refuse(found: DataFrame, said: str) -> None:
    """Stop before anything is published; ``found`` has one short line per column or constraint."""
    bad = found.where(f"{found.columns[-1]} > 0").collect()
    if bad:
        raise ValueError(f"{said}: " + ", ".join(": ".join(map(str, line)) for line in bad))


def _refuse_lost_bills(counts: DataFrame, load: Load, date_format: str | Sequence[str]) -> None:
    """Stop if the bills are lost on the way: an unknown date format leaves none, and would replace good tables."""
    rows = {line.stage: line.row_count for line in counts.collect()}
    said = ", ".join(f"{stage} {n}" for stage, n in rows.items())
    tried = date_format if isinstance(date_format, str) else "every known format"
    if rows["raw"] and not rows["dated"]:
        raise ValueError(f"no bill has a date ({tried}): {said}")
    if rows["dated"] < load.least_dated * rows["raw"]:
        raise ValueError(f"less than {load.least_dated:.0%} of the bills have a date ({tried}): {said}")
    if rows["raw"] and not rows["staged"]:
        raise ValueError(f"no bill is left: {said}")


class _Store:
    """Writes versions and publishes their names together, after all checks."""

    def __init__(self, folder: str) -> None:
        self.folder = folder
        self.versions: list[Version] = []

    def __call__(self, df: DataFrame, table: str, folder: str, **layout: Sequence[str]) -> DataFrame:
        self.versions.append(write_version(df, table, folder, **layout))
        return self.versions[-1].rows

    def publish(self, spark: SparkSession) -> None:
        publish_together(spark, self.versions, self.folder)


def sizing(spark: SparkSession, load: Load) -> Sizing:
    return Sizing(load.input_bytes or sum(size for _, size in Files(spark).inputs(load.bills)))


def date_format(spark: SparkSession, load: Load, multi_line: bool) -> str | Sequence[str]:
    if load.date_format:
        return load.date_format
    return date_format_of(spark, first_text(spark, load.bills, BILL_DATE, multi_line))


def load_staging(spark: SparkSession, load: Load, store: _Store) -> tuple[DataFrame, OrderedExport | None]:
    """Staging as it is stored, by year of the bill and sorted by its date, and the export that waits beside its place.

    The bills are parsed once, on their way into the raw copy; all else reads what is written there.
    """
    breaks = load.multi_line
    if breaks is None:
        breaks = QuotedLines(spark, load.bills).has_breaks()
    shape = date_format(spark, load, breaks)
    bills = read_bills_csv(spark, load.bills, breaks)
    export = None
    with sized(spark, sizing(spark, load)):
        raw = land_raw(mark_bills(bills, shape), f"{load.folder}/raw")
        placed = staged_bills(raw)
        staging = staging_names(add_metrics(placed.drop(*FILE_ORDER)))
        stored = store(
            staging,
            f"{load.namespace}.electric_staging",
            load.folder,
            partition_by=["Bill_Year"],
            sort_by=[STD_DATE],
        )
        counts = store(stage_counts(raw, stored), f"{load.namespace}.stage_row_counts", load.folder)
        _refuse_lost_bills(counts, load, shape)
        if load.export:
            # The rows of the file keep the order and names of the bills; only tables need other names.
            export = OrderedExport(spark, load.export)
            try:
                export.write(add_metrics(placed), FILE_ORDER)
            except BaseException:
                export.discard()
                raise
    return stored, export


_DIMENSIONS = {
    "dim_development": (DIM_DEVELOPMENT, "development_key"),
    "dim_meter": (DIM_METER, "meter_key"),
    "dim_vendor": (DIM_VENDOR, "vendor_key"),
}


def load_star(staging: DataFrame, load: Load, store: _Store) -> dict[str, DataFrame]:
    """The four dimensions and the usage fact; a dimension whose columns are absent is left out."""

    def keep(name: str, table: DataFrame) -> DataFrame:
        return store(table, f"{load.namespace}.{name}", load.folder)

    tables = {"dim_date": keep("dim_date", star.build_dim_date(staging))}
    for name, (columns, key) in _DIMENSIONS.items():
        if set(columns) <= set(staging.columns):
            tables[name] = keep(name, star.build_dimension(staging, columns, key))
    name = "fact_borough_year_usage"
    usage = star.usage_by_year(staging)
    tables[name] = store(usage, f"{load.namespace}.{name}", load.folder, order_by=["bill_year", "borough"])
    return tables


def left_out(staging: DataFrame) -> DataFrame:
    """One line per star dimension that the bills lack columns for, with the number of these columns."""
    lines = [
        (f"dimension {name} left out, columns missing", len(missing))
        for name, (columns, _) in _DIMENSIONS.items()
        if (missing := set(columns) - set(staging.columns))
    ]
    return staging.sparkSession.createDataFrame(lines, "constraint string, violations long")


def load_contract(staging: DataFrame, load: Load, store: _Store) -> dict[str, DataFrame]:
    """The contract tables in a namespace of their own: its date dimension has other columns."""
    namespace, folder = f"{load.namespace}_contract", f"{load.folder}/contract"
    create_namespace(staging.sparkSession, namespace, f"{folder}/namespace")
    tables = {
        "dim_date": contract.dim_calendar(staging),
        "dim_time": contract.dim_time(contract.minutes_of_day(staging.sparkSession), "at"),
        "dim_location": contract.dim_location(staging),
        "dim_meter_type": contract.dim_meter_type(staging),
        "dim_service_class": contract.dim_service_class(staging),
        "dim_customer": contract.dim_customer(staging),
    }
    tables = {name: store(table, f"{namespace}.{name}", folder) for name, table in tables.items()}
    # The keys of deduplication tell staged bills apart, so they order the facts.
    order = [name for name in DUPLICATE_KEYS if name in staging.columns]
    # The facts move every bill, so these steps are sized by the input as well.
    with sized(staging.sparkSession, sizing(staging.sparkSession, load)):
        rows = contract.fact_rows(
            staging,
            tables["dim_date"],
            tables["dim_location"],
            tables["dim_meter_type"],
            tables["dim_service_class"],
            load.record_source,
            keep=order,
        )
        facts = contract.load_fact(rows, order)
        name = "fact_electric_consumption"
        tables[name] = store(facts, f"{namespace}.{name}", folder)
    return tables


def shared_keys(tables: dict[str, DataFrame]) -> DataFrame | None:
    """The natural keys of developments that stand for several members (with other amps, funding or codes).

    A note, no violation: the join reduces members to their keys, so no bill counts twice.
    """
    if "dim_development" not in tables:
        return None
    twice = duplicate_keys(tables["dim_development"], list(star.DEVELOPMENT_KEY.values()))
    return twice.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("join keys of dim_development with several members").alias("constraint"), "violations"
    )


def check_required(tables: dict[str, DataFrame]) -> DataFrame:
    """One line per required contract column with its NULLs."""
    lines = None
    for name, table in tables.items():
        required = {f.name: True for f in CONTRACT[name] if not f.nullable and f.name in table.columns}
        report = null_report(table, required).select(
            F.concat(F.lit(f"not null {name}."), "column_name").alias("constraint"),
            F.col("null_count").alias("violations"),
        )
        lines = report if lines is None else lines.unionByName(report)
    return lines


def check_contract(tables: dict[str, DataFrame]) -> DataFrame:
    """One line per declared key with its number of violating rows."""
    primary = primary_key_report({n: (t, [t.columns[0]]) for n, t in tables.items()}).select(
        F.concat(F.lit("primary key of "), "table_name").alias("constraint"),
        (F.col("null_keys") + F.col("duplicate_keys")).alias("violations"),
    )
    foreign = foreign_key_report(
        tables["fact_electric_consumption"],
        {key: (tables[name], key) for key, name in CONTRACT_FOREIGN_KEYS.items()},
    ).select(
        F.concat(F.lit("foreign key "), "key_column").alias("constraint"),
        (
            F.col("orphan_rows") + F.when(F.col("key_column") == "date_key", F.col("null_keys")).otherwise(0)
        ).alias("violations"),
    )
    return primary.unionByName(foreign)


def run(spark: SparkSession, load: Load) -> dict[str, DataFrame]:
    """Load everything and return the stored tables by name.

    Names and export move only after every table is written and every check has passed, and they move together: a
    refused or failed load leaves all earlier tables and the earlier export as they were. Names that a lost driver
    left half moved are brought back first.
    """
    tune(spark)
    create_namespace(spark, load.namespace, f"{load.folder}/namespace")
    settle(spark, load.folder)
    store, export = _Store(load.folder), None
    with recorded_steps() as steps:
        try:
            staging, export = load_staging(spark, load, store)
            tables = load_tables(staging, load, store)
            _publish(spark, store, export)
        except BaseException:
            if export is not None:
                export.discard()
            raise
        finally:
            # All tables are versions of their own; no step is read any more.
            remove_steps(spark, steps)
    return tables


def load_tables(staging: DataFrame, load: Load, store: _Store) -> dict[str, DataFrame]:
    """All tables from the stored staging, checked but not published."""
    _refuse(contract.misfits(staging), "values that do not fit the contract")
    tables = {"electric_staging": staging, **load_star(staging, load, store)}
    declared = load_contract(staging, load, store)
    checks = check_contract(declared).unionByName(check_required(declared))
    checks = store(checks, f"{load.namespace}.load_checks", load.folder)
    _refuse(checks, "constraints violated")
    notes = left_out(staging)
    if (keys := shared_keys(tables)) is not None:
        notes = notes.unionByName(keys)
    notes = store(notes, f"{load.namespace}.load_notes", load.folder)
    declared = {f"contract.{name}": table for name, table in declared.items()}
    return tables | declared | {"load_checks": checks, "load_notes": notes}


def _publish(spark: SparkSession, store: _Store, export: OrderedExport | None) -> None:
    """Export and names, or neither."""
    if export is None:
        return store.publish(spark)
    export.swap()
    try:
        store.publish(spark)
    except BaseException:
        export.undo()
        raise
    export.finish()
