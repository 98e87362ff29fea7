"""Column lists and table contracts of the billing warehouse."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names, tokens and sizes the data and its consumers prescribe ----------------

BILL_DATE = "Service End Date"

DIMENSIONS = [
    "Development Name",
    "Borough",
    "Account Name",
    "Location",
    "Meter AMR",
    "Meter Scope",
    "TDS #",
    "EDP",
    "RC Code",
    "Funding Source",
    "AMP #",
    "Vendor Name",
    "UMIS BILL ID",
    "Revenue Month",
    "Rate Class",
    "Estimated",
    "Bill Analyzed",
    "Meter Number",
]

DAYS = "# days"
CHARGES = "Current Charges"
KWH = "Consumption (KWH)"

MEASURES = [
    "# days",
    "Current Charges",
    "Consumption (KWH)",
    "KWH Charges",
    "Consumption (KW)",
    "KW Charges",
    "Other charges",
]

STD_DATE = "BillDate_Std"
CALENDAR_PARTS = ["Bill_Year", "Bill_Quarter", "Bill_Month", "Bill_Day"]

DUPLICATE_KEYS = ["BillDate_Std", "Development Name", "Meter Number"]

UNKNOWN = "Unknown"

# Text that a CSV cell uses for "no value" (exact, case-sensitive spellings).
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

STAGING_RENAMES = {
    "Consumption (KWH)": "Consumption _KWH_",
    "Consumption (KW)": "Consumption _KW_",
}
STAGED_KWH = "Consumption _KWH_"

DIM_DEVELOPMENT = {
    "Development Name": "development_name",
    "Borough": "Borough",
    "TDS #": "tds_number",
    "AMP #": "amp_number",
    "Funding Source": "funding_source",
    "RC Code": "rc_code",
}
DIM_METER = {
    "Meter Number": "meter_number",
    "Meter AMR": "meter_amr_type",
    "Meter Scope": "meter_scope",
    "Location": "Location",
}
DIM_VENDOR = {"Vendor Name": "vendor_name"}


def _table(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_INT, _LONG, _DATE, _BOOL = T.IntegerType(), T.LongType(), T.DateType(), T.BooleanType()
_GEO, _MONEY = T.DecimalType(9, 6), T.DecimalType(18, 2)

CONTRACT = {
    "dim_date": _table(
        ("date_key", _INT, False),
        ("calendar_date", _DATE, True),
        ("year", _INT, True),
        ("quarter", _INT, True),
        ("month", _INT, True),
        ("month_name", T.VarcharType(15), True),
        ("day", _INT, True),
        ("weekday", T.VarcharType(10), True),
        ("is_weekend", _BOOL, True),
    ),
    "dim_time": _table(
        ("time_key", _INT, False),
        ("hour", _INT, True),
        ("minute", _INT, True),
        ("clock_time", T.VarcharType(10), True),
    ),
    "dim_location": _table(
        ("location_key", _INT, False),
        ("latitude", _GEO, True),
        ("longitude", _GEO, True),
        ("borough", T.VarcharType(50), True),
        ("zip_code", T.VarcharType(10), True),
    ),
    "dim_meter_type": _table(
        ("meter_type_key", _INT, False),
        ("meter_type_name", T.VarcharType(50), True),
    ),
    "dim_service_class": _table(
        ("service_key", _INT, False),
        ("service_class", T.VarcharType(50), True),
        ("rate_code", T.VarcharType(20), True),
        ("description", T.VarcharType(200), True),
    ),
    "dim_customer": _table(
        ("customer_key", _INT, False),
        ("customer_id", T.VarcharType(50), True),
        ("customer_type", T.VarcharType(50), True),
        ("borough", T.VarcharType(50), True),
        ("zip_code", T.VarcharType(10), True),
        ("account_status", T.VarcharType(20), True),
    ),
    "fact_electric_consumption": _table(
        ("fact_key", _LONG, False),
        ("date_key", _INT, False),
        ("time_key", _INT, True),
        ("location_key", _INT, True),
        ("meter_type_key", _INT, True),
        ("service_key", _INT, True),
        ("kwh_consumed", _MONEY, True),
        ("total_cost_usd", _MONEY, True),
        ("record_source", T.VarcharType(50), True),
        ("ingestion_timestamp", T.TimestampType(), True),
    ),
}

CONTRACT_FOREIGN_KEYS = {
    "date_key": "dim_date",
    "time_key": "dim_time",
    "location_key": "dim_location",
    "meter_type_key": "dim_meter_type",
    "service_key": "dim_service_class",
}

# --- End of fixed values -----------------------------------------------------------------------
