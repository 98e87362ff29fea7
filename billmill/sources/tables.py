"""Named tables: a namespace, full replacement, layout, and publication of many names as one generation."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from billmill.functions.text import col, quoted
from billmill.sources.files import Files


def _quoted(name: str) -> str:
    return ".".join(quoted(part) for part in name.split("."))


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}{where}")


def use_namespace(spark: SparkSession, name: str) -> None:
    """Names without a namespace mean this one from now on."""
    spark.catalog.setCurrentDatabase(name)


@dataclass(frozen=True)
class Place:
    """Where the rows of a table lie and how they are laid out."""

    table: str
    path: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()

    def rows(self, spark: SparkSession) -> DataFrame:
        # Spark puts partition columns last; the order of the written columns holds.
        return spark.read.schema(self.schema).parquet(self.path).select(*[col(f.name) for f in self.schema])

    def as_json(self) -> dict:
        return {"path": self.path, "schema": self.schema.jsonValue(), "partition_by": list(self.partition_by)}

    @staticmethod
    def from_json(table: str, held: dict) -> Place:
        return Place(table, held["path"], T.StructType.fromJson(held["schema"]), tuple(held["partition_by"]))


@dataclass(frozen=True)
class Version:
    """A written table that no name points to yet."""

    place: Place
    rows: DataFrame

    @property
    def table(self) -> str:
        return self.place.table

    @property
    def path(self) -> str:
        return self.place.path


def write_version(
    df: DataFrame,
    table: str,
    folder: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    order_by: Sequence[str] = (),
) -> Version:
    """Write the rows to a new folder below ``folder``. Readers of ``table`` notice nothing.

    ``partition_by`` makes a folder per value, so that filters on these columns open only the folders they need, and
    ``sort_by`` sorts the rows of each file, so that Parquet's row groups cover narrow ranges: both cost no shuffle.
    ``order_by`` sorts the whole table over its files, in the order of their names.
    """
    path = f"{folder.rstrip('/')}/{table.split('.')[-1]}/{uuid.uuid4().hex}"
    if order_by:
        df = df.orderBy(*[col(name).asc_nulls_first() for name in order_by])
    elif partition_by or sort_by:
        df = df.sortWithinPartitions(*[col(name) for name in (*partition_by, *sort_by)])
    df.write.partitionBy(*partition_by).parquet(path)
    place = Place(table, path, df.schema, tuple(partition_by))
    return Version(place, place.rows(df.sparkSession))


@contextmanager
def _partitions_from_folders(spark: SparkSession) -> Iterator[None]:
    """Tables created meanwhile find their partitions in their folder, so that one change of place moves them all."""
    name = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _point(spark: SparkSession, place: Place) -> None:
    """Let the name point to the place: in one step of the catalog if the table keeps its columns and layout."""
    name = _quoted(place.table)
    now = named_place(spark, place.table)
    if now is not None:
        if now.path == place.path:
            return
        kept = (now.partition_by, _by_name(now.schema)) == (place.partition_by, _by_name(place.schema))
        if kept and (place.partition_by or now.schema.simpleString() == place.schema.simpleString()):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{place.path}'")
            spark.catalog.refreshTable(place.table)
            return
        spark.sql(f"DROP TABLE {name}")
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in place.schema)
    layout = f" PARTITIONED BY ({', '.join(quoted(c) for c in place.partition_by)})" if place.partition_by else ""
    with _partitions_from_folders(spark):
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{layout} LOCATION '{place.path}'")


def _by_name(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema}


def named_place(spark: SparkSession, table: str) -> Place | None:
    """Where the name points to now."""
    if not spark.catalog.tableExists(table):
        return None
    lines = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").where("col_name = 'Location'").collect()
    parts = tuple(c.name for c in spark.catalog.listColumns(table) if c.isPartition)
    return Place(table, lines[0].data_type, spark.table(table).schema, parts)


def publish(version: Version) -> DataFrame:
    """Let the name point to the version and return the table.

    A table with the same columns and layout only changes its place, in one step of the catalog: the name is never
    missing. Otherwise it is dropped and created. The last writer wins.
    """
    spark = version.rows.sparkSession
    _point(spark, version.place)
    return spark.table(version.table)


def replace_table(df: DataFrame, table: str, folder: str, **layout: Sequence[str]) -> DataFrame:
    """Make ``table`` hold exactly the rows of ``df`` and return the stored table.

    A failed job leaves the old table as it was, and ``df`` may read the table it replaces.
    """
    return publish(write_version(df, table, folder, **layout))


# --- Generations -------------------------------------------------------------------------------------


def _records(folder: str) -> str:
    return f"{folder.rstrip('/')}/generations"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    names = Files(spark).names(_records(folder))
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def generation(spark: SparkSession, folder: str) -> dict[str, Place]:
    """The places of all tables as of the last published generation; empty before the first."""
    numbers = _numbers(spark, folder)
    if not numbers:
        return {}
    held = json.loads(Files(spark).read(f"{_records(folder)}/{numbers[-1]:012d}.json"))
    return {table: Place.from_json(table, place) for table, place in held.items()}


def read_generation(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All tables of the last published generation. They belong together, also while another one is published."""
    return {table: place.rows(spark) for table, place in generation(spark, folder).items()}


def publish_together(spark: SparkSession, versions: Iterable[Version], folder: str) -> None:
    """Publish all versions or none.

    The names move one by one. If one cannot move, those before it go back to where they were (new ones are dropped).
    When all have moved, the record of the new generation appears below ``folder`` in one step: from then on it is the
    published one, for ``read_generation`` and for ``settle``.
    """
    versions = list(versions)
    held = generation(spark, folder) | {v.table: v.place for v in versions}
    before = {v.table: named_place(spark, v.table) for v in versions}
    moved: list[str] = []
    try:
        for version in versions:
            moved.append(version.table)
            publish(version)
        number = max(_numbers(spark, folder), default=0) + 1
        text = json.dumps({table: place.as_json() for table, place in held.items()})
        Files(spark).write(f"{_records(folder)}/{number:012d}.json", text)
    except BaseException:
        for table in reversed(moved):
            _restore(spark, table, before[table])
        raise


def _restore(spark: SparkSession, table: str, place: Place | None) -> None:
    if place is not None:
        _point(spark, place)
    elif spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE {_quoted(table)}")


def settle(spark: SparkSession, folder: str) -> list[str]:
    """Bring the names back to the published generation and return those that had strayed.

    They stray only if the driver is lost in the middle of a publication. Every load begins with this step.
    """
    strayed = []
    for table, place in generation(spark, folder).items():
        now = named_place(spark, table)
        if now is None or now.path.rsplit("/", 1)[-1] != place.path.rsplit("/", 1)[-1]:
            _point(spark, place)
            strayed.append(table)
    return strayed


def old_versions(spark: SparkSession, tables: Sequence[str], folder: str) -> list[str]:
    """The version folders below ``folder`` that none of ``tables`` points to, for removal by an operator.

    Readers that began before a replacement may still read one of them.
    """
    found = []
    for table in tables:
        place = f"{folder.rstrip('/')}/{table.split('.')[-1]}"
        now = named_place(spark, table)
        used = now.path.rstrip("/").rsplit("/", 1)[-1] if now else ""
        found += [f"{place}/{name}" for name in Files(spark).names(place) if name != used]
    return sorted(found)
