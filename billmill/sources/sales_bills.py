"""Raw bills derived from sales tables: one text row per line item, with the blemishes of real files.

The sales tables hold no blanks and no bad values, so fixed rules put them in: impossible dates, blank
members, no-value tokens, numbers with thousands separators, bills without any measure, repeated keys.
"""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billmill.schema import BILL_DATE, DIMENSIONS, MEASURES
from billmill.workspace import stored

# A total order of the line items: it takes the place of the order of rows in a file.
SALES_ORDER = (
    "_source_order",
    "_source_line",
    "_source_part",
    "_source_supplier",
    "_source_quantity",
    "_source_price",
)
_ORDER_COLUMNS = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
)


_CELLS = {
    BILL_DATE: "IF(l_partkey % 97 = 0, '02/30/2010', date_format(l_shipdate, 'MM/dd/yyyy'))",
    "Development Name": "IF(l_suppkey % 10 = 9, NULL, s_name)",
    "Borough": "IF(l_suppkey % 7 = 6, NULL, r_name)",
    "Account Name": "c_name",
    "Location": "p_brand",
    "Meter AMR": "decode(l_returnflag, 'A', 'AMR', 'N', 'NONE')",
    "Meter Scope": "l_linestatus",
    "TDS #": "STRING(l_suppkey)",
    "EDP": "STRING(n_nationkey)",
    "RC Code": "concat('K', n_nationkey)",
    "Funding Source": "IF(o_orderpriority = '4-NOT SPECIFIED', 'N/A', o_orderpriority)",
    "AMP #": "n_name",
    "Vendor Name": "IF(c_mktsegment = 'FURNITURE', NULL, c_mktsegment)",
    "UMIS BILL ID": "concat(l_orderkey, '-', l_linenumber)",
    "Revenue Month": "date_format(l_shipdate, 'yyyy-MM')",
    "Rate Class": "p_type",
    "Estimated": "IF(l_tax = 0, 'Y', 'N')",
    "Bill Analyzed": "'Yes'",
    "Meter Number": "IF(l_partkey % 10 = 0, NULL, concat('M', l_partkey % 5))",
    "# days": "STRING(BIGINT(l_quantity - 1))",
    "Current Charges": "IF(l_partkey % 101 = 0, 'x', STRING(l_extendedprice))",
    "Consumption (KWH)": "CASE WHEN l_partkey % 89 = 0 THEN '1,234' WHEN l_discount = 0 THEN '0' "
    "ELSE STRING(BIGINT(l_quantity * 37)) END",
    "KWH Charges": "STRING(l_tax)",
    "Consumption (KW)": "STRING(l_linenumber)",
    "KW Charges": "STRING(l_discount)",
    "Other charges": "'0'",
}


def _cell(name: str) -> Column:
    rule = _CELLS[name]
    if name in MEASURES:
        rule = f"IF(l_orderkey % 53 = 0, 'n/a', {rule})"
    return F.expr(rule).alias(name)


def _read_by(names: Collection[str]) -> list[str]:
    """The columns of the sales tables that the cells and the order of bills are made of."""
    found = {column for name in names for column in re.findall(r"\b[a-z]_[a-z]+\b", _CELLS[name])}
    return sorted(found | set(_ORDER_COLUMNS))


_FROM_PART = {"Location", "Rate Class"}
_FROM_CUSTOMER = {"Account Name", "Vendor Name"}
_FROM_ORDERS = _FROM_CUSTOMER | {"Funding Source"}
_FROM_SUPPLIER = {"Development Name", "Borough", "EDP", "RC Code", "AMP #"}


def read_sales_bills(
    spark: SparkSession, folder: str, columns: Collection[str] | None = None, ordered: bool = False
) -> DataFrame:
    """The bills with ``columns`` (all by default) and ``SALES_ORDER``; ``ordered`` sorts them by it.

    Every line item has exactly one order, customer, part and supplier, so a table is joined only if a
    wanted column comes from it. The small tables join one by one: Spark knows the size of each file and
    broadcasts it only if it is small, while it cannot tell the size of a join. Orders come first, while
    the line items are narrow, and customers meet the orders, which are fewer than the line items. Orders
    grow with the line items, so that join shuffles both sides at every size: small tables show the plan
    that large ones run. Parts come before them, as they grow too: the names of suppliers and customers do not
    move with the line items to meet the parts. Sorting comes before the cells are made, so that the texts are made
    once and do not move, and behind a step, so that the shuffles of the joins are gone before the sort adds its own
    and its ranges are sampled from the step.
    """
    wanted = [BILL_DATE, *DIMENSIONS, *MEASURES]
    if columns is not None:
        wanted = [name for name in wanted if name in set(columns)]
    need = set(wanted)

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    lines = table("lineitem")
    if need & _FROM_PART:
        lines = lines.join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
    if need & _FROM_ORDERS:
        orders = table("orders")
        if need & _FROM_CUSTOMER:
            orders = orders.join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        lines = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    if need & _FROM_SUPPLIER:
        lines = lines.join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        lines = lines.join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        if "Borough" in need:
            lines = lines.join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    if ordered:
        lines = stored(lines.select(*_read_by(wanted)), "line-items").orderBy(*_ORDER_COLUMNS)
    return lines.select(
        *[_cell(name) for name in wanted],
        *[F.col(source).alias(name) for source, name in zip(_ORDER_COLUMNS, SALES_ORDER)],
    )
