"""The registered queries as plain SQL over the same tables, for comparing results.

This module lists columns and texts on its own: a mistake in the library's lists must not hide here as well.
"""

from __future__ import annotations

_DATE = "Service End Date"
# Fixed values, listed here on their own: the texts that stand for no value.
_NO_VALUES = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>"]
_NO_VALUES += ["N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
_NA_LIST = ", ".join(f"'{token}'" for token in _NO_VALUES)

_EMPTY = "l_orderkey % 53 = 0"
_CELLS = {
    "Service End Date": "CASE WHEN l_partkey % 97 = 0 THEN '02/30/2010' ELSE strftime(l_shipdate, '%m/%d/%Y') END",
    "Development Name": "CASE WHEN l_suppkey % 10 = 9 THEN NULL ELSE s_name END",
    "Borough": "CASE WHEN l_suppkey % 7 = 6 THEN NULL ELSE r_name END",
    "Account Name": "c_name",
    "Location": "p_brand",
    "Meter AMR": "CASE l_returnflag WHEN 'A' THEN 'AMR' WHEN 'N' THEN 'NONE' END",
    "Meter Scope": "l_linestatus",
    "TDS #": "CAST(l_suppkey AS VARCHAR)",
    "EDP": "CAST(n_nationkey AS VARCHAR)",
    "RC Code": "'K' || CAST(n_nationkey AS VARCHAR)",
    "Funding Source": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'N/A' ELSE o_orderpriority END",
    "AMP #": "n_name",
    "Vendor Name": "CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_mktsegment END",
    "UMIS BILL ID": "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)",
    "Revenue Month": "strftime(l_shipdate, '%Y-%m')",
    "Rate Class": "p_type",
    "Estimated": "CASE WHEN l_tax = 0 THEN 'Y' ELSE 'N' END",
    "Bill Analyzed": "'Yes'",
    "Meter Number": "CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE 'M' || CAST(l_partkey % 5 AS VARCHAR) END",
    "# days": "CAST(CAST(l_quantity - 1 AS BIGINT) AS VARCHAR)",
    "Current Charges": "CASE WHEN l_partkey % 101 = 0 THEN 'x' ELSE CAST(l_extendedprice AS VARCHAR) END",
    "Consumption (KWH)": "CASE WHEN l_partkey % 89 = 0 THEN '1,234' WHEN l_discount = 0 THEN '0' "
    "ELSE CAST(CAST(l_quantity * 37 AS BIGINT) AS VARCHAR) END",
    "KWH Charges": "CAST(l_tax AS VARCHAR)",
    "Consumption (KW)": "CAST(l_linenumber AS VARCHAR)",
    "KW Charges": "CAST(l_discount AS VARCHAR)",
    "Other charges": "'0'",
}

# The cells above in their order: the date, the dimensions, the seven measures.
DIMENSIONS, MEASURES = list(_CELLS)[1:-7], list(_CELLS)[-7:]
DIM_DEVELOPMENT = {
    "Development Name": "development_name",
    "Borough": "Borough",
    "TDS #": "tds_number",
    "AMP #": "amp_number",
    "Funding Source": "funding_source",
    "RC Code": "rc_code",
}
DIM_METER = {"Meter Number": "meter_number", "Meter AMR": "meter_amr_type", "Meter Scope": "meter_scope", "Location": "Location"}
DIM_VENDOR = {"Vendor Name": "vendor_name"}
FACT_COLUMNS = "fact_key date_key time_key location_key meter_type_key service_key kwh_consumed total_cost_usd"
FACT_COLUMNS = [*FACT_COLUMNS.split(), "record_source", "ingestion_timestamp"]
REQUIRED = {"fact_key", "date_key"}


def _q(name: str) -> str:
    return f'"{name}"'


def _list(names) -> str:
    return ", ".join(_q(name) for name in names)


def _cell(name: str) -> str:
    if name in MEASURES:
        return f"CASE WHEN {_EMPTY} THEN 'n/a' ELSE {_CELLS[name]} END"
    return _CELLS[name]


def _na(name: str) -> str:
    return f"CASE WHEN {_q(name)} NOT IN ({_NA_LIST}) THEN {_q(name)} END"


def _number(name: str) -> str:
    return f"TRY_CAST({_q(name)} AS DOUBLE)"


_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
_RAW_COLUMNS = [_DATE, *DIMENSIONS, *MEASURES]

_BILLS = f"""bills AS (
  SELECT {", ".join(f"{_cell(name)} AS {_q(name)}" for name in _RAW_COLUMNS)}, {_ORDER}
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
)"""

_PARSED = f"""parsed AS (
  SELECT *, TRY_STRPTIME({_q(_DATE)}, '%m/%d/%Y')::DATE AS "BillDate_Std"
  FROM bills
)"""

_PARTS = """CAST(year("BillDate_Std") AS INTEGER) AS "Bill_Year",
    CAST(quarter("BillDate_Std") AS INTEGER) AS "Bill_Quarter",
    CAST(month("BillDate_Std") AS INTEGER) AS "Bill_Month",
    CAST(day("BillDate_Std") AS INTEGER) AS "Bill_Day\""""


def _per_day(amount: str) -> str:
    return f"""CASE WHEN "# days" = 0 THEN
      CASE WHEN {amount} > 0 THEN 'inf'::DOUBLE WHEN {amount} < 0 THEN '-inf'::DOUBLE END
    ELSE {amount} / "# days" END"""


_KWH, _CHARGES = '"Consumption (KWH)"', '"Current Charges"'
_COST = f"CASE WHEN {_KWH} <> 0 THEN {_CHARGES} / {_KWH} END"


def _staged(dimensions=DIMENSIONS, measures=MEASURES, keys=("BillDate_Std", "Development Name", "Meter Number")) -> str:
    """CTEs up to ``staged``: clean, deduplicated, with calendar parts and the raw measures' numbers."""
    return f"""{_BILLS}, {_PARSED}, clean AS (
  SELECT "BillDate_Std" AS {_q(_DATE)}, "BillDate_Std", {_PARTS},
    {", ".join(f"COALESCE({_na(name)}, 'Unknown') AS {_q(name)}" for name in dimensions)},
    {", ".join(f"{_number(name)} AS {_q(name)}" for name in measures)}, {_ORDER}
  FROM parsed
  WHERE "BillDate_Std" IS NOT NULL
), measured AS (
  SELECT * FROM clean WHERE COALESCE({_list(measures)}) IS NOT NULL
), staged AS (
  SELECT * FROM measured
  QUALIFY ROW_NUMBER() OVER (PARTITION BY {_list(keys)} ORDER BY {_ORDER}) = 1
)"""


_STAGED = _staged()
_FLAG = f"""CAST(CASE WHEN {_KWH} > (SELECT median({_KWH}) FROM staged) THEN 1 ELSE 0 END AS BIGINT)
    AS "HighUsageFlag\""""

_RATIOS = f"""{_per_day(_KWH)} AS "Avg_Daily_kWh",
    {_per_day(_CHARGES)} AS "Avg_Daily_Current_Charges", {_COST} AS "Cost_per_kWh\""""

_FULL_STAGING = f"""{_list([_DATE, *DIMENSIONS, *MEASURES])},
    "BillDate_Std", "Bill_Year", "Bill_Quarter", "Bill_Month", "Bill_Day", {_RATIOS}, {_FLAG}"""

_DIM_DATE = """SELECT DISTINCT CAST(strftime("BillDate_Std", '%Y%m%d') AS INTEGER) AS date_key,
  "BillDate_Std" AS bill_date, "Bill_Year", "Bill_Quarter", "Bill_Month", "Bill_Day" FROM staged"""


def _sum(value: str) -> str:
    return f"CAST(SUM(CAST({value} AS DECIMAL(18, 2))) AS DOUBLE)"


_USAGE = f"""SELECT CAST("Bill_Year" AS BIGINT) AS bill_year, "Borough" AS borough,
  {_sum(_KWH)} AS total_kwh, {_sum(_CHARGES)} AS total_current_charges
FROM staged GROUP BY 1, 2"""


def _numbered(select: str, names, key: str, key_type: str = "BIGINT") -> str:
    order = ", ".join(f"{_q(name)} NULLS FIRST" for name in names)
    return f"""SELECT CAST(ROW_NUMBER() OVER (ORDER BY {order}) AS {key_type}) AS {key}, *
FROM (SELECT DISTINCT {select} FROM staged) AS members"""


def _dimension(columns: dict[str, str], key: str) -> str:
    select = ", ".join(f"{_q(source)} AS {_q(name)}" for source, name in columns.items())
    return _numbered(select, columns.values(), key)


def _rowgrain(columns: dict[str, str], key: str, rank_by: list[str]) -> str:
    select = ", ".join(f"{_q(source)} AS {_q(name)}" for source, name in columns.items())
    return f"""SELECT DISTINCT CAST(ROW_NUMBER() OVER (ORDER BY {_list(rank_by)}, {_ORDER}) AS BIGINT) AS {key},
  {select} FROM staged"""


_DEVELOPMENT = _dimension(DIM_DEVELOPMENT, "development_key")

_LOCATION = _numbered(
    "CAST(NULL AS DECIMAL(9, 6)) AS latitude, CAST(NULL AS DECIMAL(9, 6)) AS longitude, "
    '"Borough" AS borough, CAST(NULL AS VARCHAR) AS zip_code',
    ["borough"],
    "location_key",
    "INTEGER",
)
_METER_TYPE = _numbered('"Meter AMR" AS meter_type_name', ["meter_type_name"], "meter_type_key", "INTEGER")
_SERVICE = _numbered(
    '"Rate Class" AS service_class, CAST(NULL AS VARCHAR) AS rate_code, CAST(NULL AS VARCHAR) AS description',
    ["service_class"],
    "service_key",
    "INTEGER",
)
_CALENDAR = """SELECT CAST(day_number AS INTEGER) AS date_key, calendar_date,
  CAST(year(calendar_date) AS INTEGER) AS year, CAST(quarter(calendar_date) AS INTEGER) AS quarter,
  CAST(month(calendar_date) AS INTEGER) AS month, monthname(calendar_date) AS month_name,
  CAST(day(calendar_date) AS INTEGER) AS day, dayname(calendar_date) AS weekday,
  dayofweek(calendar_date) IN (0, 6) AS is_weekend
FROM (
  SELECT ROW_NUMBER() OVER (ORDER BY moment) AS day_number, moment::DATE AS calendar_date
  FROM (SELECT UNNEST(generate_series(MIN("BillDate_Std")::TIMESTAMP, MAX("BillDate_Std")::TIMESTAMP,
    INTERVAL 1 DAY)) AS moment FROM staged) AS moments
) AS days"""

_FACTS = f"""{_STAGED}, calendar AS ({_CALENDAR}), location AS ({_LOCATION}), meter_type AS ({_METER_TYPE}),
service_class AS ({_SERVICE}), facts AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY {_ORDER}) AS BIGINT) AS fact_key, date_key,
    CAST(NULL AS INTEGER) AS time_key, location_key, meter_type_key, service_key,
    CAST({_KWH} AS DECIMAL(18, 2)) AS kwh_consumed, CAST({_CHARGES} AS DECIMAL(18, 2)) AS total_cost_usd,
    'monthly_bills' AS record_source
  FROM staged
  LEFT JOIN calendar ON calendar_date = "BillDate_Std"
  LEFT JOIN location ON location.borough = staged."Borough"
  LEFT JOIN meter_type ON meter_type_name = "Meter AMR"
  LEFT JOIN service_class ON service_class.service_class = "Rate Class"
)"""

_USED_KEYS = ["date_key", "location_key", "meter_type_key", "service_key"]


def _foreign_key_line(key: str) -> str:
    orphans = "COUNT(*) FILTER (WHERE location_key = 1)" if key == "location_key" else "0"
    return f"""SELECT '{key}' AS key_column, COUNT(*) AS row_count,
  CAST(COUNT(*) - COUNT({key}) AS BIGINT) AS null_keys, CAST({orphans} AS BIGINT) AS orphan_rows FROM facts"""


def _primary_key_line(name: str, table: str, keys: str) -> str:
    """NULL in any key column makes a null key; a duplicate is a key that occurs more than once."""
    missing = " OR ".join(f"{k} IS NULL" for k in keys.split(", "))
    return f"""SELECT '{name}' AS table_name, CAST(SUM(n) AS BIGINT) AS row_count,
  CAST(COALESCE(SUM(n) FILTER (WHERE {missing}), 0) AS BIGINT) AS null_keys,
  COUNT(*) FILTER (WHERE n > 1 AND NOT ({missing})) AS duplicate_keys
FROM (SELECT {keys}, COUNT(*) AS n FROM {table} GROUP BY {keys}) AS per_key"""


def _null_line(name: str, required: bool) -> str:
    count = "COUNT(*)" if name == "time_key" else f"COUNT(*) - COUNT({name})"
    if name == "ingestion_timestamp":
        count = "0"
    return f"""SELECT '{name}' AS column_name, {str(required).upper()} AS required, COUNT(*) AS row_count,
  CAST({count} AS BIGINT) AS null_count FROM facts"""


def _union(lines) -> str:
    return "\nUNION ALL\n".join(lines)


_RAW = f"WITH {_BILLS} SELECT {_list(_RAW_COLUMNS)} FROM bills"
_FIRST = f"""WITH {_STAGED}
SELECT "BillDate_Std", "Development Name", "Meter Number", "UMIS BILL ID", {_CHARGES} FROM staged"""


def _measures(names=MEASURES) -> str:
    return ", ".join(f"{_number(name)} AS {_q(name)}" for name in names)


_RENAMED = _FULL_STAGING.replace(
    _list(MEASURES),
    ", ".join(
        f"{_q(name)} AS " + _q({"Consumption (KWH)": "Consumption _KWH_", "Consumption (KW)": "Consumption _KW_"}.get(name, name))
        for name in MEASURES
    ),
)

_OPTIONAL = _staged(
    ["Development Name", "Borough", "UMIS BILL ID"],
    ["Current Charges", "Consumption (KWH)"],
    ("BillDate_Std", "Development Name"),
)


def oracle_sql() -> dict[str, str]:
    usage = f"WITH {_STAGED} {_USAGE}"
    dim_date = f"WITH {_STAGED} {_DIM_DATE}"
    dim_development = f"WITH {_STAGED} {_DEVELOPMENT}"
    dim_meter = f"WITH {_STAGED} {_dimension(DIM_METER, 'meter_key')}"
    dim_vendor = f"WITH {_STAGED} {_dimension(DIM_VENDOR, 'vendor_key')}"
    return {
        "scan_csv_bills": _RAW,
        "land_raw": f"WITH {_BILLS} SELECT {_list(_RAW_COLUMNS)}, TRUE AS has_source FROM bills",
        "dedup_in_file_order": _FIRST,
        "sink_csv_roundtrip": f"WITH {_STAGED} SELECT {_FULL_STAGING} FROM staged",
        "sink_replace_table": usage,
        "build_staging": f"WITH {_STAGED} SELECT {_RENAMED} FROM staged",
        "parse_bill_date": f"""WITH {_BILLS}, {_PARSED}
SELECT "UMIS BILL ID", {_q(_DATE)} AS service_end_text, "BillDate_Std" AS {_q(_DATE)} FROM parsed""",
        "parse_iso_dates": f"""WITH {_BILLS}
SELECT "UMIS BILL ID", CASE WHEN l_partkey % 97 <> 0 AND l_linenumber < 7 THEN CAST(l_shipdate AS DATE) END AS "BillDate_Std"
FROM bills JOIN (SELECT DISTINCT {_ORDER}, l_shipdate FROM lineitem) AS lines USING ({_ORDER})""",
        "infer_date_formats": """SELECT written, found, COUNT(*) FILTER (WHERE l_partkey % 97 <> 0) AS dated FROM lineitem, (VALUES
  ('yyyy-MM-dd', 'yyyy-M-d'), ('d-MMM-yyyy', 'd-MMM-yyyy'), ('yyyyMMdd', 'yyyyMMdd'), ('MMMM d, yyyy', 'MMMM d, yyyy'),
  ('yyyy-MM-dd HH:mm:ss', 'yyyy-M-d H:mm:ss'), ('M/d/yyyy h:mm:ss a', 'M/d/yyyy h:mm:ss a')) AS formats(written, found)
GROUP BY written, found""",
        "scan_csv_quoted_breaks": f"""WITH {_BILLS}
SELECT "UMIS BILL ID", 'first "line"' || chr(10) || chr(10) || "Location" || chr(10) AS "Location",
  CASE WHEN l_partkey % 3 = 0 THEN 'a,' || chr(10) || "Borough" ELSE "Borough" END AS "Borough" FROM bills""",
        "staging_of_year": f"""WITH {_STAGED}
SELECT "UMIS BILL ID", "BillDate_Std", "Borough", "Bill_Year", {_KWH} AS "Consumption _KWH_" FROM staged WHERE "Bill_Year" = 1995""",
        "usage_in_stored_order": f"""WITH {_STAGED}
SELECT ROW_NUMBER() OVER (ORDER BY bill_year, borough) AS place, * FROM ({_USAGE}) AS usage""",
        "export_in_order": f"""WITH {_staged(
            ["Development Name", "UMIS BILL ID", "Meter Number"], ["Current Charges", "Consumption (KWH)"])}
SELECT ROW_NUMBER() OVER (ORDER BY {_ORDER}) AS place, "UMIS BILL ID", {_FLAG} FROM staged""",
        "calendar_parts": f"""WITH {_BILLS}, {_PARSED}
SELECT "UMIS BILL ID", "BillDate_Std", {_PARTS} FROM parsed""",
        "na_tokens": f"""WITH {_BILLS}
SELECT {", ".join(f"{_na(n)} AS {_q(n)}" for n in ["UMIS BILL ID", "Meter AMR", "Funding Source", "# days", "Consumption (KWH)"])}
FROM bills""",
        "na_tokens_all": f"""WITH {_BILLS}
SELECT "UMIS BILL ID", CASE WHEN l_partkey % 21 >= 19 THEN ['n/A', ' NA'][l_partkey % 21 - 18] END AS "Funding Source"
FROM bills""",
        "scan_csv_short_rows": f"""WITH {_BILLS}
SELECT "UMIS BILL ID", CASE WHEN l_partkey % 3 > 0 THEN {_q(_DATE)} END AS {_q(_DATE)},
  CASE WHEN l_partkey % 3 > 1 THEN "Borough" END AS "Borough" FROM bills""",
        "check_contract_misfits": f"""WITH {_STAGED}
SELECT 'dim_location' AS table_name, 'borough' AS column_name,
  COUNT(*) FILTER (WHERE length("Borough") > 50) AS misfits FROM staged
UNION ALL SELECT 'dim_meter_type', 'meter_type_name', COUNT(*) FILTER (WHERE length("Meter AMR") > 50) FROM staged
UNION ALL SELECT 'dim_service_class', 'service_class', COUNT(*) FILTER (WHERE length("Rate Class") > 50) FROM staged
UNION ALL SELECT 'dim_customer', 'customer_id', COUNT(*) FILTER (WHERE length("Account Name") > 50) FROM staged
UNION ALL SELECT 'dim_customer', 'borough', COUNT(*) FILTER (WHERE length("Borough") > 50) FROM staged
UNION ALL SELECT 'fact_electric_consumption', 'kwh_consumed',
  COUNT(*) FILTER (WHERE {_KWH} IS NOT NULL AND TRY_CAST({_KWH} AS DECIMAL(18, 2)) IS NULL) FROM staged
UNION ALL SELECT 'fact_electric_consumption', 'total_cost_usd',
  COUNT(*) FILTER (WHERE {_CHARGES} IS NOT NULL AND TRY_CAST({_CHARGES} AS DECIMAL(18, 2)) IS NULL) FROM staged""",
        "drop_undated": f"""WITH {_BILLS}, {_PARSED}
SELECT "UMIS BILL ID", "BillDate_Std" FROM parsed WHERE "BillDate_Std" IS NOT NULL""",
        "fill_unknown_members": f"""WITH {_BILLS}
SELECT {", ".join(f"COALESCE({_na(n)}, 'Unknown') AS {_q(n)}" for n in DIMENSIONS)} FROM bills""",
        "coerce_measures": f'WITH {_BILLS} SELECT "UMIS BILL ID", {_measures()} FROM bills',
        "drop_empty_measures": f"""WITH {_BILLS}, numbers AS (SELECT "UMIS BILL ID", {_measures()} FROM bills)
SELECT * FROM numbers WHERE COALESCE({_list(MEASURES)}) IS NOT NULL""",
        "avg_daily_ratios": f"""WITH {_BILLS}, numbers AS (
  SELECT "UMIS BILL ID", {_measures(["# days", "Current Charges", "Consumption (KWH)"])} FROM bills)
SELECT *, {_per_day(_KWH)} AS "Avg_Daily_kWh", {_per_day(_CHARGES)} AS "Avg_Daily_Current_Charges" FROM numbers""",
        "cost_per_kwh": f"""WITH {_BILLS}, numbers AS (
  SELECT "UMIS BILL ID", {_measures(["Current Charges", "Consumption (KWH)"])} FROM bills)
SELECT *, {_COST} AS "Cost_per_kWh" FROM numbers""",
        "date_key": f"""WITH {_BILLS}, {_PARSED}
SELECT "UMIS BILL ID", CAST(strftime("BillDate_Std", '%Y%m%d') AS INTEGER) AS date_key FROM parsed""",
        "filter_not_null": f"""WITH {_BILLS}
SELECT {_list(["UMIS BILL ID", "Development Name", "Meter Number", "Vendor Name"])} FROM bills
WHERE "Development Name" IS NOT NULL AND "Meter Number" IS NOT NULL AND "Vendor Name" IS NOT NULL""",
        "optional_columns": f"""WITH {_OPTIONAL}
SELECT {_list([_DATE, "Development Name", "Borough", "UMIS BILL ID", "Current Charges", "Consumption (KWH)"])},
  "BillDate_Std", "Bill_Year", "Bill_Quarter", "Bill_Month", "Bill_Day", {_COST} AS "Cost_per_kWh", {_FLAG}
FROM staged""",
        "contract_cast": f"""WITH {_BILLS}, numbers AS (
  SELECT "UMIS BILL ID", {_measures(["Current Charges", "Consumption (KWH)"])} FROM bills)
SELECT CAST({_KWH} AS DECIMAL(18, 2)) AS kwh_consumed,
  CAST({_CHARGES} + {_KWH} / 9001 AS DECIMAL(18, 2)) AS total_cost_usd, "UMIS BILL ID" AS record_source
FROM numbers""",
        "dedup_first_bill": _FIRST,
        "distinct_dates": f'WITH {_STAGED} SELECT DISTINCT "BillDate_Std" FROM staged',
        "dim_date": dim_date,
        "dim_development": dim_development,
        "dim_meter": dim_meter,
        "dim_vendor": dim_vendor,
        "dim_development_rowgrain": f"""WITH {_STAGED}
{_rowgrain(DIM_DEVELOPMENT, "development_key", ["Development Name", "Borough", "TDS #"])}""",
        "dim_meter_rowgrain": f'WITH {_STAGED} {_rowgrain(DIM_METER, "meter_key", list(DIM_METER))}',
        "dim_vendor_rowgrain": f'WITH {_STAGED} {_rowgrain(DIM_VENDOR, "vendor_key", list(DIM_VENDOR))}',
        "assign_fact_keys": f"""WITH {_STAGED}
SELECT CAST(ROW_NUMBER() OVER (ORDER BY {_ORDER}) AS BIGINT) AS fact_key, "UMIS BILL ID", {_KWH} FROM staged""",
        "join_bill_date": f"""WITH {_STAGED}, dates AS ({_DIM_DATE})
SELECT s."UMIS BILL ID", s."BillDate_Std", d.date_key, d."Bill_Year" AS bill_year
FROM staged AS s LEFT JOIN dates AS d ON d.bill_date = s."BillDate_Std" WHERE d."Bill_Year" IS NOT NULL""",
        "join_development": f"""WITH {_STAGED}, members AS (
  SELECT "Development Name" AS development_name, "Borough", "TDS #" AS tds_number, MAX("AMP #") AS last_amp
  FROM staged WHERE "AMP #" <> 'Unknown' AND "Development Name" <> 'Unknown' GROUP BY 1, 2, 3
)
SELECT s."UMIS BILL ID", s."Development Name", s."TDS #", s."Borough" AS bill_borough,
  m."Borough" AS borough, m.last_amp
FROM staged AS s LEFT JOIN members AS m
  ON m.development_name = s."Development Name" AND m."Borough" = s."Borough" AND m.tds_number = s."TDS #\"""",
        "check_join_key_unique": f"""WITH {_STAGED}, members AS ({_DEVELOPMENT})
SELECT development_name, "Borough", tds_number, COUNT(*) AS row_count FROM members
GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""",
        "fact_borough_year_usage": usage,
        "fact_borough_year_star": f"""WITH {_STAGED}, dates AS ({_DIM_DATE}), members AS (
  SELECT DISTINCT development_name, "Borough", tds_number FROM ({_DEVELOPMENT}) AS developments
)
SELECT CAST(d."Bill_Year" AS BIGINT) AS bill_year, m."Borough" AS borough,
  {_sum("s." + _KWH)} AS total_kwh, {_sum("s." + _CHARGES)} AS total_current_charges
FROM staged AS s LEFT JOIN dates AS d ON d.bill_date = s."BillDate_Std"
LEFT JOIN members AS m
  ON m.development_name = s."Development Name" AND m."Borough" = s."Borough" AND m.tds_number = s."TDS #"
WHERE d."Bill_Year" IS NOT NULL GROUP BY 1, 2""",
        "fact_borough_year_rowgrain": f"""WITH {_STAGED}, dates AS ({_DIM_DATE}), members AS (
  {_rowgrain(DIM_DEVELOPMENT, "development_key", ["Development Name", "Borough", "TDS #"])}
)
SELECT CAST(d."Bill_Year" AS BIGINT) AS bill_year, m."Borough" AS borough,
  {_sum("s." + _KWH)} AS total_kwh, {_sum("s." + _CHARGES)} AS total_current_charges
FROM staged AS s LEFT JOIN dates AS d ON d.bill_date = s."BillDate_Std"
LEFT JOIN members AS m
  ON m.development_name = s."Development Name" AND m."Borough" = s."Borough" AND m.tds_number = s."TDS #"
WHERE d."Bill_Year" IS NOT NULL GROUP BY 1, 2""",
        "fact_sorted": f"{usage} ORDER BY 1, 2",
        "median_kwh": f"WITH {_STAGED} SELECT median({_KWH}) AS median FROM staged",
        "high_usage_flag": f"""WITH {_STAGED}
SELECT "UMIS BILL ID", {_KWH} AS "Consumption _KWH_", {_FLAG} FROM staged""",
        "stage_row_counts": f"""WITH {_STAGED}
SELECT 1 AS place, 'raw' AS stage, COUNT(*) AS row_count, CAST(26 AS BIGINT) AS column_count FROM bills
UNION ALL SELECT 2, 'dated', COUNT(*), 31 FROM clean
UNION ALL SELECT 3, 'measured', COUNT(*), 31 FROM measured
UNION ALL SELECT 4, 'staged', COUNT(*), 35 FROM staged""",
        "preview_dim_date": f"{dim_date} ORDER BY bill_date LIMIT 20",
        "preview_dim_development": f"{dim_development} ORDER BY development_key LIMIT 20",
        "preview_dim_meter": f"{dim_meter} ORDER BY meter_key LIMIT 20",
        "preview_dim_vendor": f"{dim_vendor} ORDER BY vendor_key LIMIT 20",
        "preview_raw_bills": f"{_RAW} ORDER BY {_ORDER} LIMIT 5",
        "dim_calendar": f"WITH {_STAGED} {_CALENDAR}",
        "dim_time": """SELECT DISTINCT CAST(hour(ts) * 60 + minute(ts) + 1 AS INTEGER) AS time_key,
  CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute, strftime(ts, '%H:%M') AS clock_time
FROM events""",
        "dim_location": f"WITH {_STAGED} {_LOCATION}",
        "dim_meter_type": f"WITH {_STAGED} {_METER_TYPE}",
        "dim_service_class": f"WITH {_STAGED} {_SERVICE}",
        "dim_customer": f"""WITH {_STAGED}
SELECT CAST(ROW_NUMBER() OVER (ORDER BY customer_id) AS INTEGER) AS customer_key, customer_id,
  CAST(NULL AS VARCHAR) AS customer_type, borough, CAST(NULL AS VARCHAR) AS zip_code,
  CAST(NULL AS VARCHAR) AS account_status
FROM (SELECT "Account Name" AS customer_id,
  CASE WHEN MIN("Borough") = MAX("Borough") THEN MIN("Borough") END AS borough
  FROM staged GROUP BY 1) AS accounts""",
        "load_contract_fact": f"WITH {_FACTS} SELECT * FROM facts",
        "check_foreign_keys": f"WITH {_FACTS}\n" + _union(_foreign_key_line(key) for key in _USED_KEYS),
        "check_primary_keys": f"WITH {_FACTS}\n"
        + _union(
            [
                _primary_key_line("dim_date", "calendar", "date_key"),
                _primary_key_line("dim_location", "location", "location_key"),
                _primary_key_line("dim_meter_type", "meter_type", "meter_type_key"),
                _primary_key_line("dim_service_class", "service_class", "service_key"),
                _primary_key_line("fact_electric_consumption", "facts", "fact_key"),
                _primary_key_line("raw_bills", "bills", '"Service End Date", "Meter Number"'),
            ]
        ),
        "check_not_null": f"WITH {_FACTS}\n"
        + _union(_null_line(name, name in REQUIRED) for name in FACT_COLUMNS),
        "check_contract_fit": f"""WITH {_BILLS}
SELECT 'latitude' AS column_name,
  COUNT(*) FILTER (WHERE TRY_CAST({_CHARGES} AS DOUBLE) / 100 IS NOT NULL
    AND TRY_CAST(TRY_CAST({_CHARGES} AS DOUBLE) / 100 AS DECIMAL(9, 6)) IS NULL) AS misfits FROM bills
UNION ALL SELECT 'borough', COUNT(*) FILTER (WHERE length("Rate Class" || ' ' || "Rate Class") > 50) FROM bills
UNION ALL SELECT 'zip_code', COUNT(*) FILTER (WHERE length("Account Name") > 10) FROM bills""",
    }
