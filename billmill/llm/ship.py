"""Makes this package importable in Python workers, wherever they run."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable
from functools import cache, wraps

import billmill
from billmill.workspace import recorded_steps, remove_steps, unread_steps


@cache
def _archive() -> str:
    """The package as an archive beside the driver, which serves it to the executors itself."""
    folder = os.path.dirname(os.path.dirname(os.path.abspath(billmill.__file__)))
    place = os.path.join(tempfile.mkdtemp(prefix="billmill-code-"), "billmill")
    return shutil.make_archive(place, "zip", folder, "billmill")


_DONE: set[str] = set()
# Texts differ by orders of magnitude in length, so batches for Python are bounded by bytes, not rows.
_BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def ship(spark) -> None:
    """Send the package to the workers of this application, once, and bound the batches that they get."""
    for name, value in _BATCH.items():
        spark.conf.set(name, value)
    application = spark.sparkContext.applicationId
    if application not in _DONE:
        spark.sparkContext.addPyFile(_archive())
        _DONE.add(application)


def shipped(function: Callable) -> Callable:
    """``function(spark, ...)`` with the package sent first; of its steps, those that the result reads stay."""

    @wraps(function)
    def run(spark, *rest):
        ship(spark)
        with recorded_steps() as steps:
            result = function(spark, *rest)
        remove_steps(spark, unread_steps(result, steps))
        return result

    return run
