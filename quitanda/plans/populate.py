"""Fill the star schema from the staged batch: dimensions first, the fact last."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.operators.dimensions import load_dimension
from quitanda.operators.fact import load_fact
from quitanda.operators.quality import unmatched_sales
from quitanda.schema import DIMENSIONS
from quitanda.sources.tables import Lot, Warehouse


class OrphanKeys(RuntimeError):
    """Sales without a member in some dimension, where the load was told to refuse them."""


def load_dimensions(
    warehouse: Warehouse, staged: DataFrame, loaded_at: datetime | None = None
) -> None:
    """Load the five dimensions; they do not depend on each other, so their jobs overlap."""
    loaded_at = loaded_at or datetime.now(timezone.utc)
    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
        loads = [
            pool.submit(load_dimension, warehouse, staged, dimension, loaded_at)
            for dimension in DIMENSIONS
        ]
        for load in loads:
            load.result()


def populate(
    warehouse: Warehouse,
    collection: str,
    mode: str = "append",
    strict_keys: bool = False,
    batch: str | None = None,
) -> Lot:
    """Load the dimensions and then the fact from the staged batch of a collection.

    ``strict_keys`` raises before the fact is touched if a sale would get an unknown key.
    A load that fails can be run again: members already added are found by the anti-join,
    and the batch replaces whatever an earlier attempt left of it in the fact.
    """
    staged = warehouse.staging(collection)
    load_dimensions(warehouse, staged)
    if strict_keys:
        refuse_unknown_keys(warehouse, staged)
    return load_fact(warehouse, staged, collection, mode, batch)


def refuse_unknown_keys(warehouse: Warehouse, staged: DataFrame) -> None:
    orphans = unmatched_sales(staged, warehouse.dimensions())
    found = orphans.where(F.col("orphan_rows") > 0).collect()
    if found:
        counts = ", ".join(f"{row.fact_key}: {row.orphan_rows}" for row in found)
        raise OrphanKeys(f"sales without a dimension member: {counts}")
