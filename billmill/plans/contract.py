"""The tables of the declared warehouse contract, loaded from staging.

The contract declares columns, not contents. Attributes that bills do not carry (coordinates, zip code,
time of day, customer type and status, rate code, description) are NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billmill.functions.dates import is_weekend
from billmill.functions.text import col
from billmill.operators.checks import fit_contract, misfit_report
from billmill.operators.joins import lookup_key
from billmill.operators.keys import number_rows, number_stored
from billmill.schema import CHARGES, CONTRACT, STAGED_KWH, STD_DATE
from billmill.workspace import stored_at

# Contract attribute -> staging column; None where bills have no such value.
LOCATION = {"latitude": None, "longitude": None, "borough": "Borough", "zip_code": None}
METER_TYPE = {"meter_type_name": "Meter AMR"}
CUSTOMER = {"customer_id": "Account Name", "borough": "Borough"}
MEASURES = {"kwh_consumed": STAGED_KWH, "total_cost_usd": CHARGES}
SERVICE_CLASS = {"service_class": "Rate Class", "rate_code": None, "description": None}


def _available(df: DataFrame, sources: Mapping[str, str | None]) -> dict[str, str | None]:
    """The mapping without the columns that this input lacks."""
    return {name: source if source in df.columns else None for name, source in sources.items()}


def dim_calendar(staging: DataFrame) -> DataFrame:
    """Every day from the first to the last bill date, keyed 1, 2, 3, ... by distance from the first.

    The days between two dates are few whatever the number of bills.
    """
    ends = staging.agg(F.min(STD_DATE).alias("first"), F.max(STD_DATE).alias("last"))
    days = ends.where(F.col("first").isNotNull()).select(
        "first", F.explode(F.sequence("first", "last")).alias("calendar_date")
    )
    day = F.col("calendar_date")
    full = days.select(
        (F.datediff(day, "first") + 1).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("weekday"),
        is_weekend(day).alias("is_weekend"),
    )
    return fit_contract(full, CONTRACT["dim_date"], strict=True)


def minutes_of_day(spark: SparkSession) -> DataFrame:
    return spark.range(24 * 60).select(F.timestamp_seconds(F.col("id") * 60).alias("at"))


def dim_time(moments: DataFrame, at: str) -> DataFrame:
    """The minutes of the day that occur in ``at``, keyed by their place in the day (1 to 1440)."""
    hour, minute = F.hour(col(at)), F.minute(col(at))
    seen = moments.where(col(at).isNotNull()).select(hour.alias("hour"), minute.alias("minute")).distinct()
    clock = F.format_string("%02d:%02d", "hour", "minute")
    keyed = seen.select(
        (F.col("hour") * 60 + F.col("minute") + 1).alias("time_key"), "hour", "minute", clock.alias("clock_time")
    )
    return fit_contract(keyed, CONTRACT["dim_time"], strict=True)


def misfits(staging: DataFrame) -> DataFrame:
    """One row per contract table and attribute that bills carry: the staged values that do not fit it.

    One pass over staging, before anything is stored from it.
    """
    tables = {
        "dim_location": LOCATION,
        "dim_meter_type": METER_TYPE,
        "dim_service_class": SERVICE_CLASS,
        "dim_customer": CUSTOMER,
        "fact_electric_consumption": MEASURES,
    }
    sources = {
        f"{table}.{name}": (CONTRACT[table][name].dataType, source)
        for table, attributes in tables.items()
        for name, source in _available(staging, attributes).items()
        if source is not None
    }
    renamed = staging.select(*[col(source).alias(name) for name, (_, source) in sources.items()])
    declared = T.StructType([T.StructField(name, kind) for name, (kind, _) in sources.items()])
    report = misfit_report(renamed, declared)
    place = F.split("column_name", r"\.")
    return report.select(F.get(place, 0).alias("table_name"), F.get(place, 1).alias("column_name"), "misfits")


def _entity(staging: DataFrame, table: str, sources: dict[str, str | None]) -> DataFrame:
    """The distinct members of one dimension; none if the bills carry no attribute of it."""
    contract = CONTRACT[table]
    key = contract.fieldNames()[0]
    sources = _available(staging, sources)
    if not any(sources.values()):
        staging = staging.limit(0)
    attributes = staging.select(
        *[
            (F.lit(None).cast("string") if source is None else col(source)).alias(name)
            for name, source in sources.items()
        ]
    )
    members = fit_contract(attributes, contract, strict=True).distinct()
    return number_rows(members, list(sources), key, "int").select(*contract.fieldNames())


def dim_location(staging: DataFrame) -> DataFrame:
    return _entity(staging, "dim_location", LOCATION)


def dim_meter_type(staging: DataFrame) -> DataFrame:
    return _entity(staging, "dim_meter_type", METER_TYPE)


def dim_service_class(staging: DataFrame) -> DataFrame:
    return _entity(staging, "dim_service_class", SERVICE_CLASS)


def dim_customer(staging: DataFrame) -> DataFrame:
    """One row per account. Its borough is given only where all its bills agree on one."""
    contract = CONTRACT["dim_customer"]
    if "Account Name" not in staging.columns:
        staging = staging.withColumn("Account Name", F.lit(None).cast("string")).limit(0)
    first = last = F.lit(None).cast("string")
    if "Borough" in staging.columns:
        first, last = F.min("Borough"), F.max("Borough")
    accounts = staging.groupBy(col("Account Name").alias("customer_id")).agg(
        F.when(first == last, first).alias("borough")
    )
    blank = F.lit(None).cast("string")
    members = fit_contract(
        accounts.withColumns({"customer_type": blank, "zip_code": blank, "account_status": blank}), contract, strict=True
    )
    return number_rows(members, ["customer_id"], "customer_key", "int").select(*contract.fieldNames())


def fact_rows(
    staging: DataFrame,
    calendar: DataFrame,
    location: DataFrame,
    meter_type: DataFrame,
    service_class: DataFrame,
    record_source: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One fact per bill with the keys of its dimensions, before the fact's own key."""
    facts = staging
    for key, dimension, sources in (
        ("date_key", calendar, {"calendar_date": STD_DATE}),
        ("location_key", location, LOCATION),
        ("meter_type_key", meter_type, METER_TYPE),
        ("service_key", service_class, SERVICE_CLASS),
    ):
        sources = _available(staging, sources)
        if any(sources.values()):
            facts = lookup_key(facts, dimension, key, sources)
        else:
            facts = facts.withColumn(key, F.lit(None).cast("int"))
    return facts.select(
        "date_key",
        F.lit(None).cast("int").alias("time_key"),
        "location_key",
        "meter_type_key",
        "service_key",
        col(STAGED_KWH).alias("kwh_consumed"),
        col(CHARGES).alias("total_cost_usd"),
        F.lit(record_source).alias("record_source"),
        F.current_timestamp().alias("ingestion_timestamp"),
        *[col(name) for name in keep],
    )


def load_fact(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Fit the facts to the contract and number them in ``order``.

    They are stored first: numbering reads its input twice, and the joins should run once.
    """
    contract = CONTRACT["fact_electric_consumption"]
    kept = T.StructType([*contract.fields[1:], *[rows.schema[name] for name in order]])
    joined, folder = stored_at(fit_contract(rows, kept, strict=True), "fact-rows")
    return number_stored(joined, folder, order, "fact_key").select(*contract.fieldNames())
