"""Training rows dealt the same way on any cluster."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

ROWS_PER_TASK = 1 << 16
# For fits of hundreds of passes, each of whose tasks answers the driver: so many tasks are not merged.
MANY_PASSES_TASKS, MANY_PASSES_ROWS = 48, 1 << 20


def task_count(rows: int, rows_per_task: int = ROWS_PER_TASK, many_passes: bool = False) -> int:
    """Tasks for so many rows; with ``many_passes`` tasks beyond MANY_PASSES_TASKS take up to MANY_PASSES_ROWS."""
    tasks = max(1, -(-rows // rows_per_task))
    return min(tasks, max(MANY_PASSES_TASKS, -(-rows // MANY_PASSES_ROWS))) if many_passes else tasks


def dealt(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK, many_passes: bool = False) -> DataFrame:
    """``df`` in tasks of about ``rows_per_task`` rows, dealt by a hash of ``key`` and sorted by it,
    kept in memory and on disk for the many passes of a fit.

    Learners that sample rows or sum in the order of their partitions give the same model whatever
    the files, cores or executors, also when lost partitions are computed again. ``many_passes`` deals
    large tables into larger tasks (``task_count``), as every pass sends the driver one answer a task.
    """
    tasks = task_count(df.count(), rows_per_task, many_passes)
    return df.repartition(tasks, key).sortWithinPartitions(key).persist(StorageLevel.MEMORY_AND_DISK)
