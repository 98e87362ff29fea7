from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Session settings that the jobs are tuned for. Sizes that depend on the cluster (executors, memory,
# spark.sql.shuffle.partitions) stay with whoever submits the job.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Java compiles no method above 8000 bytes; a wide projection beyond that would be interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@dataclass(frozen=True)
class Sizing:
    """Split and shuffle sizes for the steps that move the whole input.

    Map tasks times reduce tasks is the number of shuffle blocks, so both grow with the share of the input
    that one task takes: 1 GB, which a task sorts with a little spilling.
    """

    input_bytes: int
    task_bytes: int = 1 << 30

    @property
    def tasks(self) -> int:
        return -(-self.input_bytes // self.task_bytes)

    @property
    def shuffle_blocks(self) -> int:
        return self.tasks * self.tasks

    @property
    def index_bytes(self) -> int:
        """Size of the index files of one shuffle."""
        return 8 * (self.tasks + 1) * self.tasks

    def settings(self, partitions: int) -> dict[str, str]:
        """What to change for such a step, given the session's own number of partitions."""
        if self.tasks <= partitions:
            return {}
        return {
            "spark.sql.shuffle.partitions": str(self.tasks),
            "spark.sql.files.maxPartitionBytes": str(self.task_bytes),
        }


@contextmanager
def sized(spark: SparkSession, sizing: Sizing):
    """Hold the settings while raw bills or staging are written; small shuffles keep the session's own."""
    settings = sizing.settings(int(spark.conf.get("spark.sql.shuffle.partitions")))
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
