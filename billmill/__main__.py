"""spark-submit / python -m billmill: load bill files into warehouse tables."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from billmill.plans.warehouse import Load, run


def main() -> None:
    parser = argparse.ArgumentParser(prog="billmill", description=__doc__)
    parser.add_argument("--bills", required=True, help="CSV files or folder")
    parser.add_argument("--folder", required=True, help="folder for raw zone and tables")
    parser.add_argument("--namespace", default="billing")
    parser.add_argument("--date-format", help="such as M/d/yyyy; that of the first date by default")
    lines = parser.add_mutually_exclusive_group()
    lines.add_argument("--multi-line", action="store_true", default=None, help="quoted cells hold line breaks; looked for by default")
    lines.add_argument("--single-line", dest="multi_line", action="store_false", help="no cell holds a line break")
    parser.add_argument("--least-dated", type=float, default=0.0, help="least share of bills with a date")
    parser.add_argument("--record-source", default="monthly_bills")
    parser.add_argument("--export", help="folder for the staged bills as CSV")
    parser.add_argument("--input-gb", type=int, default=0, help="input size, to size the shuffles; measured by default")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("billmill").getOrCreate()
    load = Load(
        bills=args.bills,
        folder=args.folder.rstrip("/"),
        namespace=args.namespace,
        date_format=args.date_format,
        multi_line=args.multi_line,
        least_dated=args.least_dated,
        record_source=args.record_source,
        export=args.export,
        input_bytes=args.input_gb << 30,
    )
    tables = run(spark, load)
    tables["load_checks"].orderBy("constraint").show(50, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
