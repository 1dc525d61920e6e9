"""Dense surrogate keys without a single-task sort."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assign_keys(
    members: DataFrame, order: list[str], surrogate: str, last_key: int, path: str
) -> DataFrame | None:
    """Number distinct members from ``last_key + 1`` in the order of their natural key.

    The members are range-partitioned and sorted, then written with the partition and
    place each one got, so that a lost executor cannot change the order. Only the size of
    each partition goes through the driver. Returns None if there are no members. The
    result reads what is written to ``path``, which the caller removes afterwards.
    """
    spark = members.sparkSession
    ordering = [F.col(name).asc_nulls_last() for name in order]
    (
        members.repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()})
        .write.parquet(path)
    )
    placed = spark.read.parquet(path)
    sizes = placed.groupBy("_part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("_place").alias("first")
    )
    parts = sorted(sizes.collect())
    if not parts:
        return None
    before = accumulate((part.rows for part in parts), initial=last_key + 1)
    starts = [(part._part, key - part.first) for part, key in zip(parts, before)]
    starts = spark.createDataFrame(starts, "_part int, _start bigint")
    return placed.join(F.broadcast(starts), "_part").select(
        (F.col("_place") + F.col("_start")).cast("int").alias(surrogate), *members.columns
    )


# A row number taken at a write has the task in the bits from here on, and a place below.
TASK_BITS = 33


def _task_and_place(number: str) -> tuple[Column, Column]:
    from_0 = F.col(number) - F.lit(1)
    task = F.shiftright(from_0, TASK_BITS)
    return task, from_0 - F.shiftleft(task, TASK_BITS)


def task_starts(stored: DataFrame, number: str, first: int) -> DataFrame:
    """Where the dense numbers of each task begin, after ``first``: a row for each task that
    wrote the ``stored`` rows, which goes through the driver.

    The numbers of a task follow those of the tasks before it. They are taken from what is stored,
    so they are the same whenever that is read.
    """
    task, place = _task_and_place(number)
    lengths = stored.groupBy(task.alias("task")).agg((F.max(place) + 1).alias("rows")).collect()
    lengths.sort()
    starts = accumulate((length.rows for length in lengths), initial=first + 1)
    starts = [(length.task, start) for length, start in zip(lengths, starts)]
    return stored.sparkSession.createDataFrame(starts, "_task bigint, _start bigint")


def with_dense_number(rows: DataFrame, number: str, name: str, starts: DataFrame) -> DataFrame:
    """``rows`` with ``name``: their row number (task and place) without the gaps between tasks."""
    task, place = _task_and_place(number)
    placed = rows.withColumns({"_task": task, "_place": place}).join(F.broadcast(starts), "_task")
    return placed.withColumn(name, F.col("_start") + F.col("_place")).drop("_task", "_start", "_place")
