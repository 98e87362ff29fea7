"""Bill files: CSV in, CSV out, and the raw zone between file and staging."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billmill.functions.numbers import parse_numbers
from billmill.functions.text import col, null_if_na
from billmill.sources.files import Files
from billmill.sources.quoted_lines import QuotedLines
from billmill.workspace import shuffles_released

# Where a row stands in its input: read once at the scan, kept with the row from then on.
FILE_ORDER = ("_source_file", "_source_block", "_source_row")
_MALFORMED = "_malformed_row"
_MARK = "\u0002"


def _options(multi_line: bool) -> dict:
    return {"header": True, "escape": '"', "columnNameOfCorruptRecord": _MALFORMED, "multiLine": multi_line}


def _file_order(path: Column) -> Column:
    """Sorts files by the first number in their names (part-99999 before part-100000), then by their paths."""
    # Not by a pattern such as [^/]*$, which is tried from every character of the path, for every row.
    number = F.regexp_extract(F.substring_index(path, "/", -1), r"^\D*(\d+)", 1)
    return F.concat(F.lpad(number, 20, "0"), F.lit(" "), path)


def _cells(text: Column, header: Sequence[str]) -> tuple[list[Column], Column]:
    """The cells of a row, NULL where it has too few, and whether it has too many or an open quote.

    The row is read with a mark behind it: the mark takes the place after the last cell, and no place if the row is
    longer than the header or a quote in it stays open.
    """
    wide = ", ".join(f"c{i} STRING" for i in range(len(header) + 1))
    read = F.from_csv(F.concat(text, F.lit(f",{_MARK}")), wide, {"escape": '"', "multiLine": "true"})
    cells = [read[f"c{i}"] for i in range(len(header) + 1)]
    bad = ~F.coalesce(F.array_contains(F.array(*cells), _MARK), F.lit(False))
    return [F.nullif(cell, F.lit(_MARK)) for cell in cells[:-1]], bad


def read_bills_csv(spark: SparkSession, path: str, multi_line: bool | None = False) -> DataFrame:
    """Bills as text, every column of the header, plus ``FILE_ORDER``.

    No type inference: that would read the input twice and turn codes such as 073 into numbers. Only
    the header is read to learn the columns; a file with another header fails instead of shifting
    columns. A row with fewer cells than the header gets NULL for the rest, one with more cells fails.
    ``multi_line`` allows line breaks inside quotes (see ``sources.quoted_lines``), also in files of many tasks;
    None looks for them first, at the price of one more scan of the text.

    Files come in the order of the first number in their names (part-99999 before part-100000), then of
    their paths. Row ids grow inside a block, and (file, block, id) orders blocks as the file does, so the order is
    the same however Spark packs blocks into tasks.
    """
    header = spark.read.options(**_options(False), inferSchema=False).csv(path).columns
    if multi_line is not False:
        quotes = QuotedLines(spark, path)
        if multi_line or quotes.has_breaks():
            return _from_rows(quotes.rows(), header)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*header, _MALFORMED]])
    bills = spark.read.options(**_options(False), enforceSchema=False).schema(schema).csv(path)
    # A row that is not as long as the header is read once more.
    bad = F.col(_MALFORMED).isNotNull() & _cells(F.col(_MALFORMED), header)[1]
    first = F.when(bad, F.raise_error(_said(F.col(_MALFORMED))).cast("string")).otherwise(col(header[0])).alias(header[0])
    return bills.select(
        first,
        *[col(name) for name in header[1:]],
        _file_order(F.col("_metadata.file_path")).alias("_source_file"),
        F.col("_metadata.file_block_start").alias("_source_block"),
        F.monotonically_increasing_id().alias("_source_row"),
    )


def _said(row: Column) -> Column:
    return F.concat(F.lit("more cells than the header, or an open quote: "), row)


def _from_rows(rows: DataFrame, header: Sequence[str]) -> DataFrame:
    """The bills of whole rows (file, block, line, is_header, text)."""
    cells, bad = _cells(F.col("text"), header)
    parsed = rows.select("*", F.array(*cells).alias("cells"), bad.alias("bad"))
    other = F.col("is_header") & (F.col("bad") | ~F.col("cells").eqNullSafe(F.array(*[F.lit(name) for name in header])))
    checked = (
        F.when(other, F.raise_error(F.concat(F.lit("another header than the first file: "), F.col("text"))).cast("array<string>"))
        .when(F.col("bad"), F.raise_error(_said(F.col("text"))).cast("array<string>"))
        .otherwise(F.col("cells"))
    )
    checked_rows = parsed.withColumn("cells", checked).where(~F.col("is_header") | F.col("cells").isNull())
    return checked_rows.select(
        *[F.col("cells")[i].alias(name) for i, name in enumerate(header)],
        _file_order(F.col("file")).alias("_source_file"),
        F.col("block").alias("_source_block"),
        F.col("line").alias("_source_row"),
    )


def first_text(spark: SparkSession, path: str, name: str, multi_line: bool | None = False) -> str | None:
    """The first value of a column in file order, without the no-value spellings.

    Looks into one file after the other and stops in the first one that has a value. A file read alone is split from
    front to back, and a limit runs its parts in this order, so little more than the rows before the value is read;
    with line breaks in quotes the whole file is.
    """

    def order(place: str) -> tuple[str, str]:
        number = re.match(r"\D*(\d*)", place.rsplit("/", 1)[-1])[1]
        return number.rjust(20, "0")[:20], place

    for place in sorted((place for place, _ in Files(spark).inputs(path)), key=order):
        bills = read_bills_csv(spark, place, multi_line)
        if name not in bills.columns:
            return None
        found = bills.withColumn("_text", null_if_na(name)).where("_text is not null")
        if multi_line is not False:
            found = found.orderBy(*FILE_ORDER)
        if rows := found.select("_text").limit(1).collect():
            return rows[0][0]
    return None


def land_raw(bills: DataFrame, folder: str) -> DataFrame:
    """Keep an unmodified copy in columnar form; later steps read only the columns they need.

    Each copy is a new version below ``folder``: an earlier one stays until it is removed on purpose.
    """
    version = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
    with shuffles_released(bills.sparkSession):
        bills.write.option("compression", "zstd").parquet(version)
    return bills.sparkSession.read.schema(bills.schema).parquet(version)


def _csv_cells(df: DataFrame) -> DataFrame:
    infinity = float("inf")

    def cell(field: T.StructField):
        value = col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            text = (
                F.when(value == infinity, "inf")
                .when(value == -infinity, "-inf")
                .otherwise(value.cast("string"))
            )
            return text.alias(field.name)
        return value

    return df.select(*[cell(f) for f in df.schema])


_CSV_OUT = {
    "header": True,
    "escape": '"',
    "dateFormat": "yyyy-MM-dd",
    # Spark trims cells on writing unless told otherwise.
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


# A compressed file is read by one task, so none holds more rows than a task reads within seconds.
_PACKED = {"compression": "gzip", "maxRecordsPerFile": 1 << 20}


def write_bills_csv(df: DataFrame, folder: str) -> None:
    """Export with a header. NULL is an empty cell, infinite numbers are ``inf`` and ``-inf``.

    Files in a folder named ``….gz`` are compressed, to about a fifth of the text; rows and their order stay the same.
    """
    options = _CSV_OUT | (_PACKED if folder.rstrip("/").endswith(".gz") else {})
    with shuffles_released(df.sparkSession):
        _csv_cells(df).write.mode("overwrite").options(**options).csv(folder)


class OrderedExport:
    """An export whose rows come in a given order over its files, and that replaces an earlier one at once.

    The files are written beside the export; ``swap`` puts them in its place by two renames and ``undo`` takes that
    back; ``finish`` removes what they replaced. A failed rename leaves the earlier export where it was.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.files, self.folder = Files(spark), folder.rstrip("/")
        self.mark = uuid.uuid4().hex
        self.aside, self.former = f"{self.folder}.{self.mark}.new", f"{self.folder}.{self.mark}.old"
        self.had = False

    def write(self, df: DataFrame, order: Sequence[str]) -> None:
        """Sort by ``order`` (whose columns are not exported) in ranges, one file per range."""
        ordered = df.orderBy(*[col(name).asc_nulls_first() for name in order])
        _csv_cells(ordered.drop(*order)).write.options(**_CSV_OUT).csv(self.aside)

    def swap(self) -> None:
        self.had = self.files.exists(self.folder)
        if self.had:
            self.files.rename(self.folder, self.former)
        try:
            self.files.rename(self.aside, self.folder)
        except BaseException:
            if self.had:
                self.files.rename(self.former, self.folder)
            raise

    def undo(self) -> None:
        self.files.rename(self.folder, self.aside)
        if self.had:
            self.files.rename(self.former, self.folder)

    def finish(self) -> None:
        if self.had:
            self.files.delete(self.former)

    def discard(self) -> None:
        """Remove what was written aside and never took its place."""
        if self.files.exists(self.aside):
            self.files.delete(self.aside)


def read_typed_csv(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Read an export back into the given types."""

    def typed(field: T.StructField):
        if isinstance(field.dataType, T.DoubleType):
            return col(field.name)
        return null_if_na(field.name).try_cast(field.dataType).alias(field.name)

    numbers = [field.name for field in schema if isinstance(field.dataType, T.DoubleType)]
    bills = parse_numbers(read_bills_csv(spark, folder), numbers)
    return bills.select(*[typed(field) for field in schema])
