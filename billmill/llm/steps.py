"""Finished steps of a long job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from billmill import workspace

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; its shuffle files go as soon as it is written.

    A lost executor after that loses nothing: the next step reads the written table.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return workspace.stored(df, name)
    finally:
        conf.set(_CLEANUP, before)


def settled(build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` returns, without the steps that it has stored on its way and that the result does not read."""
    with workspace.recorded_steps() as steps:
        result = build()
    workspace.remove_steps(result.sparkSession, workspace.unread_steps(result, steps))
    return result
