"""Session helpers: shared scratch folder and scoped settings."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# While it is "true", what a job has shuffled is deleted at its end, and not when the driver
# happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one in spark.checkpoint.dir, else the warehouse's."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return folder.rstrip("/")


def new_shared_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/quitanda/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, wherever it is stored."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set one session option for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def spread(frame: DataFrame) -> DataFrame:
    """Deal out an input that comes in fewer splits than there are cores.

    A feed in one file, or a parquet file with a single row group, is otherwise read and
    handed on by one task. A large input has splits enough and is left as it is. Meant for
    plain scans: counting the partitions of a plan with a shuffle would run the shuffle.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if frame.rdd.getNumPartitions() < cores else frame
