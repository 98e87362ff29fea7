"""The registered queries: each takes (spark, folder of the sales tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billmill.functions.dates import date_key
from billmill.functions.text import col
from billmill.operators import checks, clean
from billmill.operators.dedup import place_rows
from billmill.operators.joins import join_bill_date, join_members
from billmill.operators.keys import number_rows
from billmill.operators.median import exact_median
from billmill.plans import contract, star
from billmill.plans.staging import (
    add_metrics,
    build_staging,
    clean_bills,
    first_bills,
    infer_date_format,
    stage_counts,
    staged_bills,
    staging_names,
)
from billmill.schema import (
    BILL_DATE,
    CALENDAR_PARTS,
    CHARGES,
    CONTRACT,
    DAYS,
    DIM_DEVELOPMENT,
    DIM_METER,
    DIM_VENDOR,
    DIMENSIONS,
    KWH,
    MEASURES,
    NA_TOKENS,
    STAGED_KWH,
    STD_DATE,
)
from billmill.session import tune
from billmill.sources.bill_files import (
    FILE_ORDER,
    OrderedExport,
    land_raw,
    read_bills_csv,
    read_typed_csv,
    write_bills_csv,
)
from billmill.sources.sales_bills import SALES_ORDER, read_sales_bills
from billmill.sources.tables import create_namespace, replace_table, use_namespace, write_version
from billmill.workspace import new_folder, recorded_steps, remove_steps, stored, unread_steps

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

_BILL_ID = "UMIS BILL ID"
_RECORD_SOURCE = "monthly_bills"


def _named(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(tune(spark), folder)

        _REGISTRY[name] = run
        return build

    return register


def _query(build: Query) -> Query:
    return _named(build.__name__)(build)


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def _bills(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return read_sales_bills(spark, folder, columns or None)


def _keyed_bills(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """The bills with just what deduplication needs, and ``extra`` columns."""
    return _bills(spark, folder, BILL_DATE, "Development Name", "Meter Number", *MEASURES, *extra)


def _kept(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """Clean, deduplicated bills with their source order."""
    bills = clean_bills(_keyed_bills(spark, folder, *extra), SALES_ORDER)
    return first_bills(bills, SALES_ORDER)


def _staging(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """The part of staging that dimensions and facts read: no ratios, no flag."""
    return staging_names(_plain(_kept(spark, folder, *extra)))


def _star_columns(staging: DataFrame) -> DataFrame:
    """What the totals by borough and year and their dimensions read of staging."""
    return staging.select(STD_DATE, *CALENDAR_PARTS, *[col(c) for c in DIM_DEVELOPMENT], col(STAGED_KWH), col(CHARGES))


def _plain(df: DataFrame) -> DataFrame:
    return df.drop(*SALES_ORDER)


# --- Sources and sinks ---------------------------------------------------------------------------


def _csv_folder(spark: SparkSession, folder: str, ordered: bool = False) -> str:
    """All bills as CSV files, ``ordered`` by ``SALES_ORDER`` where the places of the rows decide on something."""
    path = new_folder(spark, "bills-csv") + ".gz"
    with recorded_steps() as steps:
        write_bills_csv(_plain(read_sales_bills(spark, folder, ordered=ordered)), path)
    remove_steps(spark, steps)
    return path


@_query
def scan_csv_bills(spark, folder):
    bills = read_bills_csv(spark, _csv_folder(spark, folder))
    return bills.select(*[col(name) for name in [BILL_DATE, *DIMENSIONS, *MEASURES]])


@_named("land_raw")
def land_raw_bills(spark, folder):
    landed = land_raw(read_bills_csv(spark, _csv_folder(spark, folder)), new_folder(spark, "raw"))
    has_source = F.col("_source_file").endswith(".csv.gz") & (F.col("_source_row") >= 0)
    return landed.select(
        *[col(name) for name in [BILL_DATE, *DIMENSIONS, *MEASURES]], has_source.alias("has_source")
    )


@_query
def dedup_in_file_order(spark, folder):
    landed = land_raw(read_bills_csv(spark, _csv_folder(spark, folder, ordered=True)), new_folder(spark, "raw"))
    kept = first_bills(clean_bills(landed))
    return kept.select(STD_DATE, col("Development Name"), col("Meter Number"), col(_BILL_ID), col(CHARGES))


@_query
def sink_csv_roundtrip(spark, folder):
    with recorded_steps() as steps:
        raw = stored(place_rows(_bills(spark, folder)), "raw")
        staging = build_staging(raw, SALES_ORDER)
    remove_steps(spark, unread_steps(staging, steps))
    path = new_folder(spark, "staging-csv") + ".gz"
    write_bills_csv(staging, path)
    return read_typed_csv(spark, path, staging.schema)


@_query
def sink_replace_table(spark, folder):
    staging = stored(_star_columns(_staging(spark, folder, *DIM_DEVELOPMENT)), "staging")
    create_namespace(spark, "billmill_sink", new_folder(spark, "namespace"))
    table, path = "billmill_sink.fact_borough_year_usage", new_folder(spark, "tables")
    star_form = star.usage_by_year_star(
        staging, star.build_dim_date(staging), star.build_dim_development(staging)
    )
    replace_table(star_form, table, path)
    replace_table(star.usage_by_year(staging), table, path)
    before = spark.catalog.currentDatabase()
    use_namespace(spark, "billmill_sink")
    try:
        return spark.table("fact_borough_year_usage")
    finally:
        use_namespace(spark, before)


@_query
def scan_csv_quoted_breaks(spark, folder):
    """Files in which the cells of two columns hold line breaks and quotes."""
    bills = _bills(spark, folder, _BILL_ID, "Location", "Borough")
    broken = bills.select(
        col(_BILL_ID),
        F.concat(F.lit('first "line"\n\n'), col("Location"), F.lit("\n")).alias("Location"),
        F.when(F.col("_source_part") % 3 == 0, F.concat(F.lit("a,\n"), col("Borough"))).otherwise(col("Borough")).alias("Borough"),
    )
    path = new_folder(spark, "bills-with-breaks")
    write_bills_csv(broken, path)
    return read_bills_csv(spark, path, multi_line=None).drop(*FILE_ORDER)


@_query
def staging_of_year(spark, folder):
    """One year of a staging table that lies in a folder per year."""
    create_namespace(spark, "billmill_sink", new_folder(spark, "namespace"))
    staging = _staging(spark, folder, _BILL_ID, "Borough")
    table = replace_table(
        staging, "billmill_sink.staging_by_year", new_folder(spark, "tables"), partition_by=["Bill_Year"], sort_by=[STD_DATE]
    )
    return table.where("Bill_Year = 1995").select(col(_BILL_ID), STD_DATE, "Borough", "Bill_Year", col(STAGED_KWH))


@_query
def usage_in_stored_order(spark, folder):
    """The usage fact as its files hold it: the place of each row is its place in the table's layout."""
    usage = star.usage_by_year(_staging(spark, folder, "Borough"))
    version = write_version(usage, "usage", new_folder(spark, "tables"), order_by=["bill_year", "borough"])
    held = spark.read.schema(usage.schema).parquet(version.path)
    held = held.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    return number_rows(held, ["file", "at"], "place").drop("file", "at")


@_query
def export_in_order(spark, folder):
    """The export of staging, read back: the place of a bill in its files is its place among the staged bills."""
    bills = staged_bills(_bills(spark, folder, BILL_DATE, "Development Name", "Meter Number", _BILL_ID, KWH, CHARGES), SALES_ORDER)
    export = OrderedExport(spark, new_folder(spark, "export"))
    export.write(add_metrics(bills), SALES_ORDER)
    export.swap()
    export.finish()
    back = read_bills_csv(spark, export.folder).select(col(_BILL_ID), col("HighUsageFlag").cast("bigint").alias("HighUsageFlag"), *FILE_ORDER)
    return number_rows(back, FILE_ORDER, "place").drop(*FILE_ORDER)


@_named("build_staging")
def build_staging_table(spark, folder):
    raw = stored(place_rows(_bills(spark, folder)), "raw")
    return staging_names(build_staging(raw, SALES_ORDER))


# --- Row-level steps -----------------------------------------------------------------------------


@_query
def parse_bill_date(spark, folder):
    bills = _bills(spark, folder, BILL_DATE, _BILL_ID)
    parsed = bills.withColumn("service_end_text", col(BILL_DATE)).transform(clean.parse_bill_date)
    return parsed.select(col(_BILL_ID), "service_end_text", col(BILL_DATE))


@_query
def parse_iso_dates(spark, folder):
    """Bills whose dates are written as ISO dates, but for some: the format of the first one holds for all."""
    bills = _bills(spark, folder, BILL_DATE, _BILL_ID)
    iso = F.regexp_replace(BILL_DATE, r"(\d+)/(\d+)/(\d+)", "$3-$1-$2")
    bills = bills.withColumn(BILL_DATE, F.when(F.col("_source_line") < 7, iso).otherwise(col(BILL_DATE)))
    parsed = clean.parse_bill_date(bills, infer_date_format(bills, SALES_ORDER))
    return parsed.select(col(_BILL_ID), STD_DATE)


@_query
def infer_date_formats(spark, folder):
    """The bills' dates in several formats: the format that is found in each, and the bills it dates."""
    days = _bills(spark, folder, BILL_DATE).transform(clean.parse_bill_date).transform(clean.drop_undated)
    days = stored(days.select(STD_DATE, *SALES_ORDER), "days")
    lines = None
    for shape in ("yyyy-MM-dd", "d-MMM-yyyy", "yyyyMMdd", "MMMM d, yyyy", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy h:mm:ss a"):
        texts = days.select(F.date_format(STD_DATE, shape).alias(BILL_DATE), F.col(STD_DATE).alias("day"), *SALES_ORDER)
        found = infer_date_format(texts, SALES_ORDER)
        same = F.count_if(col(STD_DATE).eqNullSafe(F.col("day")))
        line = clean.parse_bill_date(texts, found).agg(same.alias("dated"))
        line = line.select(F.lit(shape).alias("written"), F.lit(found if isinstance(found, str) else "any").alias("found"), "dated")
        lines = line if lines is None else lines.unionByName(line)
    return lines


@_query
def calendar_parts(spark, folder):
    bills = _bills(spark, folder, BILL_DATE, _BILL_ID).transform(clean.parse_bill_date)
    return bills.select(col(_BILL_ID), STD_DATE, *CALENDAR_PARTS)


@_query
def na_tokens(spark, folder):
    return _plain(_bills(spark, folder, _BILL_ID, "Meter AMR", "Funding Source", DAYS, KWH).transform(clean.null_na_tokens))


@_query
def na_tokens_all(spark, folder):
    """Every spelling of no value, and two that are values."""
    spellings = F.array(*[F.lit(token) for token in [*NA_TOKENS, "n/A", " NA"]])
    spelled = F.get(spellings, F.col("_source_part") % (len(NA_TOKENS) + 2)).alias("Funding Source")
    bills = _bills(spark, folder, _BILL_ID).select(col(_BILL_ID), spelled)
    return clean.null_na_tokens(bills)


@_query
def scan_csv_short_rows(spark, folder):
    """Files in which a third of the rows ends after the first cell and a third after the second."""
    cells = [col(_BILL_ID), col(BILL_DATE), F.coalesce(col("Borough"), F.lit(""))]
    lines = F.concat_ws(",", F.slice(F.array(*cells), 1, (F.col("_source_part") % 3 + 1).cast("int")))
    path = new_folder(spark, "short-rows")
    bills = _bills(spark, folder, _BILL_ID, BILL_DATE, "Borough").select(lines.alias(f"{_BILL_ID},{BILL_DATE},Borough"))
    bills.write.options(header=True, sep="\u0001").csv(path)
    return read_bills_csv(spark, path).select(col(_BILL_ID), col(BILL_DATE), col("Borough"))


@_query
def check_contract_misfits(spark, folder):
    return contract.misfits(_staging(spark, folder, "Borough", "Meter AMR", "Rate Class", "Account Name"))


@_query
def drop_undated(spark, folder):
    bills = _bills(spark, folder, BILL_DATE, _BILL_ID)
    kept = bills.transform(clean.parse_bill_date).transform(clean.drop_undated)
    return kept.select(col(_BILL_ID), STD_DATE)


@_query
def fill_unknown_members(spark, folder):
    bills = _bills(spark, folder, *DIMENSIONS)
    return _plain(bills.transform(clean.null_na_tokens).transform(clean.fill_unknown))


@_query
def coerce_measures(spark, folder):
    return _plain(_bills(spark, folder, _BILL_ID, *MEASURES).transform(clean.coerce_measures))


@_query
def drop_empty_measures(spark, folder):
    bills = _bills(spark, folder, _BILL_ID, *MEASURES)
    return _plain(bills.transform(clean.coerce_measures).transform(clean.drop_empty_measures))


@_query
def avg_daily_ratios(spark, folder):
    bills = _bills(spark, folder, _BILL_ID, DAYS, KWH, CHARGES).transform(clean.coerce_measures)
    return _plain(bills.transform(clean.add_daily_ratios))


@_query
def cost_per_kwh(spark, folder):
    bills = _bills(spark, folder, _BILL_ID, KWH, CHARGES).transform(clean.coerce_measures)
    return _plain(bills.transform(clean.add_unit_cost))


@_named("date_key")
def smart_date_key(spark, folder):
    bills = _bills(spark, folder, BILL_DATE, _BILL_ID).transform(clean.parse_bill_date)
    return bills.select(col(_BILL_ID), date_key(col(STD_DATE)).alias("date_key"))


@_query
def filter_not_null(spark, folder):
    names = ["Development Name", "Meter Number", "Vendor Name"]
    bills = _bills(spark, folder, _BILL_ID, *names).transform(clean.null_na_tokens)
    for name in names:
        bills = bills.where(col(name).isNotNull())
    return _plain(bills)


@_query
def optional_columns(spark, folder):
    """Bills without days, meter, vendor and four of the measures."""
    names = [BILL_DATE, "Development Name", "Borough", _BILL_ID, CHARGES, KWH]
    return build_staging(_bills(spark, folder, *names), SALES_ORDER)


@_query
def contract_cast(spark, folder):
    facts = _bills(spark, folder, _BILL_ID, KWH, CHARGES, "Borough").transform(clean.coerce_measures)
    # An uneven surcharge per kWh, so that rounding to the contract's scale shows.
    priced = (col(CHARGES) + col(KWH) / 9001).alias("total_cost_usd")
    typed = facts.select(col(_BILL_ID).alias("record_source"), col(KWH).alias("kwh_consumed"), priced)
    return checks.fit_contract(typed, CONTRACT["fact_electric_consumption"])


# --- Deduplication, distinct rows, keys ------------------------------------------------------------


@_query
def dedup_first_bill(spark, folder):
    kept = _kept(spark, folder, _BILL_ID)
    return kept.select(STD_DATE, col("Development Name"), col("Meter Number"), col(_BILL_ID), col(CHARGES))


@_query
def distinct_dates(spark, folder):
    return _staging(spark, folder).select(STD_DATE).distinct()


@_query
def dim_date(spark, folder):
    return star.dates_of(clean_bills(_bills(spark, folder, BILL_DATE, *MEASURES), SALES_ORDER))


@_query
def dim_development(spark, folder):
    return star.build_dim_development(_staging(spark, folder, *DIM_DEVELOPMENT))


@_query
def dim_meter(spark, folder):
    return star.build_dim_meter(_staging(spark, folder, *DIM_METER))


@_query
def dim_vendor(spark, folder):
    return star.build_dim_vendor(_staging(spark, folder, *DIM_VENDOR))


def _rowgrain(spark, folder, columns, key, rank_by):
    bills = _kept(spark, folder, *columns)
    return star.build_rowgrain_dimension(bills, columns, key, rank_by, SALES_ORDER)


@_query
def dim_development_rowgrain(spark, folder):
    rank_by = ["development_name", "Borough", "tds_number"]
    return _rowgrain(spark, folder, DIM_DEVELOPMENT, "development_key", rank_by)


@_query
def dim_meter_rowgrain(spark, folder):
    return _rowgrain(spark, folder, DIM_METER, "meter_key", list(DIM_METER.values()))


@_query
def dim_vendor_rowgrain(spark, folder):
    return _rowgrain(spark, folder, DIM_VENDOR, "vendor_key", ["vendor_name"])


@_query
def assign_fact_keys(spark, folder):
    narrow = _kept(spark, folder, _BILL_ID).select(col(_BILL_ID), col(KWH), *SALES_ORDER)
    return number_rows(narrow, SALES_ORDER, "fact_key").select("fact_key", col(_BILL_ID), col(KWH))


# --- Joins -----------------------------------------------------------------------------------------


@_named("join_bill_date")
def join_bill_dates(spark, folder):
    staging = stored(_staging(spark, folder, _BILL_ID).select(col(_BILL_ID), STD_DATE, *CALENDAR_PARTS), "staging")
    dates = stored(star.build_dim_date(staging), "dim-date")
    return join_bill_date(staging.select(col(_BILL_ID), STD_DATE), dates)


@_query
def join_development(spark, folder):
    """Bills with the amps of the developments that have one; other developments stay unmatched."""
    read = [col(name) for name in (_BILL_ID, "Development Name", "Borough", "TDS #", "AMP #")]
    staging = stored(_staging(spark, folder, _BILL_ID, *DIM_DEVELOPMENT).select(*read), "staging")
    members = staging.where(col("AMP #") != "Unknown").groupBy(
        *[col(ours).alias(theirs) for ours, theirs in star.DEVELOPMENT_KEY.items()]
    ).agg(F.max("AMP #").alias("last_amp"))
    members = stored(members.where(F.col("development_name") != "Unknown"), "members")
    bills = staging.select(col(_BILL_ID), col("Development Name"), col("TDS #"), col("Borough").alias("bill_borough"))
    on = {"Development Name": "development_name", "bill_borough": "Borough", "TDS #": "tds_number"}
    return join_members(bills, members, on, {"Borough": "borough", "last_amp": "last_amp"})


@_query
def check_join_key_unique(spark, folder):
    members = star.build_dim_development(_staging(spark, folder, *DIM_DEVELOPMENT))
    return checks.duplicate_keys(members, list(star.DEVELOPMENT_KEY.values()))


# --- Aggregates --------------------------------------------------------------------------------------


@_query
def fact_borough_year_usage(spark, folder):
    return star.usage_by_year(_staging(spark, folder, "Borough"))


@_query
def fact_borough_year_star(spark, folder):
    staging = stored(_star_columns(_staging(spark, folder, *DIM_DEVELOPMENT)), "staging")
    dates = stored(star.build_dim_date(staging), "dim-date")
    developments = stored(star.build_dim_development(staging), "dim-development")
    return star.usage_by_year_star(staging, dates, developments)


@_query
def fact_borough_year_rowgrain(spark, folder):
    staging = stored(
        _staging(spark, folder, "Borough", "TDS #").select(
            STD_DATE, *CALENDAR_PARTS, *[col(c) for c in star.DEVELOPMENT_KEY], col(STAGED_KWH), col(CHARGES)
        ),
        "staging",
    )
    return star.usage_by_year_rowgrain(staging, stored(star.build_dim_date(staging), "dim-date"))


@_query
def fact_sorted(spark, folder):
    return fact_borough_year_usage(spark, folder).orderBy("bill_year", "borough")


@_query
def median_kwh(spark, folder):
    return exact_median(_kept(spark, folder), KWH)


@_query
def high_usage_flag(spark, folder):
    staging = staging_names(build_staging(_keyed_bills(spark, folder, _BILL_ID), SALES_ORDER))
    return staging.select(col(_BILL_ID), col(STAGED_KWH), "HighUsageFlag")


@_query
def stage_row_counts(spark, folder):
    raw = stored(clean.mark_bills(_bills(spark, folder)), "raw")
    # Staged rows are counted: the columns that decide which bills stay are enough.
    read = [BILL_DATE, "Development Name", "Meter Number", *MEASURES, *clean.marks(raw), *SALES_ORDER]
    staged = build_staging(raw.select(*[col(name) for name in read]), SALES_ORDER)
    return stage_counts(raw, stored(staged, "staging"), SALES_ORDER)


# --- Previews ----------------------------------------------------------------------------------------


@_query
def preview_dim_date(spark, folder):
    return star.preview(dim_date(spark, folder), "bill_date")


@_query
def preview_dim_development(spark, folder):
    return star.preview(dim_development(spark, folder), "development_key")


@_query
def preview_dim_meter(spark, folder):
    return star.preview(dim_meter(spark, folder), "meter_key")


@_query
def preview_dim_vendor(spark, folder):
    return star.preview(dim_vendor(spark, folder), "vendor_key")


@_query
def preview_raw_bills(spark, folder):
    """The first five bills in source order."""
    return _plain(_bills(spark, folder).orderBy(*SALES_ORDER).limit(5))


# --- Contract tables -----------------------------------------------------------------------------------


@_query
def dim_calendar(spark, folder):
    return contract.dim_calendar(_staging(spark, folder))


@_query
def dim_time(spark, folder):
    """The minutes of the day in which events happened."""
    return contract.dim_time(spark.read.parquet(f"{folder}/events.parquet"), "ts")


@_query
def dim_location(spark, folder):
    return contract.dim_location(_staging(spark, folder, "Borough"))


@_query
def dim_meter_type(spark, folder):
    return contract.dim_meter_type(_staging(spark, folder, "Meter AMR"))


@_query
def dim_service_class(spark, folder):
    return contract.dim_service_class(_staging(spark, folder, "Rate Class"))


@_query
def dim_customer(spark, folder):
    return contract.dim_customer(_staging(spark, folder, "Account Name", "Borough"))


def _contract_tables(spark, folder, numbered: bool = True) -> dict[str, DataFrame]:
    """Dimensions and facts, each dimension stored before the facts read it."""
    bills = _kept(spark, folder, "Borough", "Meter AMR", "Rate Class")
    staging = stored(
        staging_names(bills).select(
            STD_DATE,
            *[col(c) for c in ("Borough", "Meter AMR", "Rate Class", STAGED_KWH, CHARGES)],
            *SALES_ORDER,
        ),
        "staging",
    )
    tables = {
        "dim_date": contract.dim_calendar(staging),
        "dim_location": contract.dim_location(staging),
        "dim_meter_type": contract.dim_meter_type(staging),
        "dim_service_class": contract.dim_service_class(staging),
    }
    tables = {name: stored(table, name) for name, table in tables.items()}
    rows = contract.fact_rows(staging, *tables.values(), _RECORD_SOURCE, keep=SALES_ORDER)
    tables["fact_electric_consumption"] = contract.load_fact(rows, SALES_ORDER) if numbered else rows
    return tables


@_query
def load_contract_fact(spark, folder):
    return _contract_tables(spark, folder)["fact_electric_consumption"].drop("ingestion_timestamp")


@_query
def check_foreign_keys(spark, folder):
    tables = _contract_tables(spark, folder, numbered=False)
    facts = tables.pop("fact_electric_consumption")
    # One location is taken away, so that its facts are orphans.
    tables["dim_location"] = tables["dim_location"].where(F.col("location_key") != 1)
    keys = ["date_key", "location_key", "meter_type_key", "service_key"]
    return checks.foreign_key_report(
        facts, {key: (table, key) for key, table in zip(keys, tables.values())}
    )


@_query
def check_primary_keys(spark, folder):
    tables = _contract_tables(spark, folder)
    keys = {name: (table, [table.columns[0]]) for name, table in tables.items()}
    # The raw bills have no such key: the same meter is billed for a day more than once.
    raw = _bills(spark, folder, BILL_DATE, "Meter Number")
    return checks.primary_key_report(keys | {"raw_bills": (raw, [BILL_DATE, "Meter Number"])})


@_query
def check_not_null(spark, folder):
    facts = _contract_tables(spark, folder)["fact_electric_consumption"]
    required = {f.name: not f.nullable for f in CONTRACT["fact_electric_consumption"]}
    return checks.null_report(facts, required)


@_query
def check_contract_fit(spark, folder):
    """Raw texts against widths that some of them exceed."""
    bills = _bills(spark, folder, "Account Name", "Rate Class", CHARGES).transform(clean.coerce_measures)
    described = bills.select(
        col("Account Name").alias("zip_code"),
        F.concat_ws(" ", col("Rate Class"), col("Rate Class")).alias("borough"),
        (col(CHARGES) / 100).alias("latitude"),
    )
    return checks.misfit_report(described, CONTRACT["dim_location"])
