"""Raw landing store: parquet files in one folder per collection."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.settings import spread

COLLECTION = "collection"


def _folder(path: str, collection: str) -> str:
    """Folder of one collection, whose name is one of letters, digits and underscores."""
    if not re.fullmatch(r"[A-Za-z0-9_]+", collection):
        raise ValueError(f"not a collection name: {collection!r}")
    return f"{path}/{COLLECTION}={collection}"


def land_raw(batch: DataFrame, path: str, collection: str, plain_scan: bool = False) -> bool:
    """Replace the landed records of a collection; an empty batch leaves them alone.

    The new files take the place of the old ones when the job commits, so a batch that
    fails half-way (a feed that turns out malformed, say) leaves the old records readable.
    ``plain_scan`` says that the batch is read from files without a shuffle: if these give
    fewer splits than there are cores, its rows are dealt out before they are written.
    """
    _folder(path, collection)
    if batch.isEmpty():
        return False
    (
        (spread(batch) if plain_scan else batch)
        .withColumn(COLLECTION, F.lit(collection))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(COLLECTION)
        .parquet(path, compression="zstd")
    )
    return True


def scan_raw(
    spark: SparkSession,
    path: str,
    collection: str,
    where: Column | str | None = None,
    columns: Sequence[Column | str] | None = None,
    sort: Sequence[Column | str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Landed records of a collection: filtered, then sorted, then limited, then projected.

    A limit of zero or less means no limit. A sort key need not be among the columns.
    """
    landed = spark.read.parquet(_folder(path, collection))
    if where is not None:
        landed = landed.where(where)
    if sort:
        landed = landed.orderBy(*sort)
    if limit is not None and limit > 0:
        landed = landed.limit(limit)
    if columns is not None:
        landed = landed.select(*columns)
    return landed


def landed_or_none(spark: SparkSession, path: str, collection: str) -> DataFrame | None:
    """Landed records, or None if nothing has been landed there yet."""
    try:
        landed = scan_raw(spark, path, collection)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return None if landed.isEmpty() else landed
