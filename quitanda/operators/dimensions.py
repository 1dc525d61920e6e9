"""Insert-only dimensions: find members that are new, number them, append them."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.functions.dates import calendar
from quitanda.operators.keys import assign_keys
from quitanda.schema import DEFAULT_TEXTS, DIM_LOCAL, DIM_TEMPO, Dimension, TABLES_BY_NAME
from quitanda.settings import remove_path
from quitanda.sources.tables import Warehouse, append_rows


def is_member(dimension: Dimension) -> Column:
    """Whether a staged row names a member: key present, and no default text in it."""
    present = [
        F.col(source).isNotNull()
        for column, source in dimension.natural_key.items()
        if column not in dimension.null_safe
    ]
    named = [F.col(source) != F.lit(DEFAULT_TEXTS[source]) for source in dimension.markers]
    return reduce(and_, present + named)


def staged_members(staged: DataFrame, dimension: Dimension) -> DataFrame:
    """Distinct members of the staged batch, under the column names of the dimension.

    Only the columns the dimension needs are read, and duplicates go before the shuffle.
    """
    rows = staged.where(is_member(dimension))
    keys = [F.col(source).alias(name) for name, source in dimension.natural_key.items()]
    if dimension is DIM_LOCAL:
        return rows.groupBy(*keys).agg(
            F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude")
        )
    members = rows.select(*keys).distinct()
    if dimension is DIM_TEMPO:
        members = members.withColumns(calendar(F.col("data_completa")))
    return members


def new_members(staged: DataFrame, current: DataFrame, dimension: Dimension) -> DataFrame:
    """Staged members the dimension does not hold yet; the first value seen stays."""
    members = staged_members(staged, dimension)
    conditions = [
        members[name].eqNullSafe(current[name])
        if name in dimension.null_safe
        else members[name] == current[name]
        for name in dimension.natural_key
    ]
    return members.join(current, reduce(and_, conditions), "left_anti")


def load_dimension(
    warehouse: Warehouse,
    staged: DataFrame,
    dimension: Dimension,
    loaded_at: datetime | None = None,
) -> None:
    """Append the new members of the staged batch, numbered on from the highest key."""
    current = warehouse.dimension(dimension)
    last_key = current.agg(F.max(dimension.surrogate)).first()[0] or 0
    scratch = f"{warehouse.location}/_scratch/{dimension.table}-{uuid.uuid4().hex}"
    try:
        numbered = assign_keys(
            new_members(staged, current, dimension),
            list(dimension.natural_key),
            dimension.surrogate,
            last_key,
            scratch,
        )
        if numbered is None:
            return
        loaded_at = loaded_at or datetime.now(timezone.utc)
        stamp = F.lit(loaded_at.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f"))
        stamps = {
            name: stamp.cast("timestamp_ntz")
            for name in ("data_inclusao", "data_atualizacao")
            if name in TABLES_BY_NAME[dimension.table].column_names
        }
        append_rows(warehouse, dimension.table, numbered.withColumns(stamps))
    finally:
        remove_path(warehouse.spark, scratch)
