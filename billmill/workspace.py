"""Where a run keeps what it must write down between two steps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from billmill.sources.files import Files


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a machine-local folder
    would be lost together with its machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not named and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="billmill-"))
    return named or context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files behind: they go as soon as the written files are complete."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


_recordings: list[list[str]] = []


@contextmanager
def recorded_steps() -> Iterator[list[str]]:
    """The folders of all steps that are stored meanwhile."""
    folders: list[str] = []
    _recordings.append(folders)
    try:
        yield folders
    finally:
        _recordings[:] = [other for other in _recordings if other is not folders]


def remove_steps(spark: SparkSession, folders: Iterable[str]) -> None:
    """Delete the folders of steps that nothing reads any more."""
    files = Files(spark)
    for folder in folders:
        files.delete(folder)


def unread_steps(df: DataFrame, folders: Iterable[str]) -> list[str]:
    """Those folders that ``df`` does not read. For plans without subqueries: their files are not listed."""
    read = {place.rstrip("/").rsplit("/", 2)[-2] for place in df.inputFiles()}
    return [folder for folder in folders if folder.rstrip("/").rsplit("/", 1)[-1] not in read]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Like ``stored``, and the folder that holds the rows."""
    folder = new_folder(df.sparkSession, name)
    for recording in _recordings:
        recording.append(folder)
    with shuffles_released(df.sparkSession):
        df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage for good, and Spark then knows the real size of the result when it chooses a join.
    """
    return stored_at(df, name)[0]
