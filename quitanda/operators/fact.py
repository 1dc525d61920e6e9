"""The sales fact: staged rows with a date, their dimension keys and measures."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.operators.keys import task_starts, with_dense_number
from quitanda.operators.lookups import BROADCAST_BYTES, join_keyed
from quitanda.schema import DIMENSIONS, FACT_COLUMNS, FACT_TABLE, UNKNOWN_KEY
from quitanda.sources.tables import Lot, Warehouse, aligned_rows, drop_lots, write_lot

# Small dimensions first: the texts they replace by a number are not shuffled later on.
LOOKUP_ORDER = ("dim_tempo", "dim_local", "dim_pagamento", "dim_vendedor", "dim_produto")


def fact_rows(
    staged: DataFrame,
    dimensions: dict[str, DataFrame],
    first_sale: int = 0,
    byte_limit: int = BROADCAST_BYTES,
    hot_share: int | None = None,
) -> DataFrame:
    """One fact row per staged row with a date; an unmatched key becomes -1.

    ``sk_venda`` follows ``first_sale``. It is the staging id without the gaps between the
    tasks that staged the rows, so it is the same if a task runs again, and a staged batch, whose
    rows with a date come first in each task, is numbered without a gap.
    """
    dated = staged.where(F.col("purchase_date").isNotNull())
    count_dated = cache(dated.count)
    by_table = {dimension.table: dimension for dimension in DIMENSIONS}
    sources = {source for d in DIMENSIONS for source in d.natural_key.values()}
    rows = dated.select(
        "staging_id",
        *sorted(sources),
        "price_cents",
        "shipping_cost_cents",
        "purchase_rating",
        "etl_load_timestamp",
    )
    starts = task_starts(dated, "staging_id", first_sale)
    for table in LOOKUP_ORDER:
        dimension = by_table[table]
        keyed = dimensions[table].select(dimension.surrogate, *dimension.natural_key)
        rows = join_keyed(
            rows,
            keyed,
            dimension.natural_key,
            row_number="staging_id",
            null_safe=dimension.null_safe,
            keys_from=dated,
            byte_limit=byte_limit,
            hot_share=hot_share,
            count_rows=count_dated,
        ).drop(*dimension.natural_key.values())
    surrogates = {
        d.surrogate: F.coalesce(F.col(d.surrogate), F.lit(UNKNOWN_KEY)) for d in DIMENSIONS
    }
    return (
        with_dense_number(rows.withColumns(surrogates), "staging_id", "sk_venda", starts)
        .withColumnRenamed("price_cents", "preco_cents")
        .select(*FACT_COLUMNS)
    )


def batch_name(staged: DataFrame) -> str:
    """Name of a staged batch: the time it was cleaned, which every run has of its own."""
    loaded_at = staged.agg(F.max("etl_load_timestamp")).first()[0]
    return loaded_at.strftime("%Y%m%dT%H%M%S%f") if loaded_at else "empty"


def _first_sale(warehouse: Warehouse, lots: list[Lot]) -> int:
    """The number after which a new lot begins; only the last lot is read for it."""
    if not lots:
        return 0
    last = max(lots, key=lambda lot: lot.first_sale)
    return warehouse.fact_lot(last).agg(F.max("sk_venda")).first()[0] or last.first_sale


def load_fact(
    warehouse: Warehouse,
    staged: DataFrame,
    collection: str,
    mode: str = "append",
    batch: str | None = None,
) -> Lot:
    """Add the staged sales to the fact, or put them in place of the collection's sales.

    A batch is a partition of the fact, a lot. Loaded again under its name (by default the
    time it was cleaned) it replaces itself, so a load that broke off can be repeated. With
    ``overwrite`` the collection's other lots go once the new one is complete.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    batch = batch or batch_name(staged)
    lots = warehouse.fact_lots()
    own = [lot for lot in lots if lot.collection == collection]
    lot = next((lot for lot in own if lot.batch == batch), None)
    if lot is None:
        lot = Lot(collection, _first_sale(warehouse, lots), batch)
    rows = fact_rows(staged, warehouse.dimensions(), lot.first_sale)
    write_lot(warehouse, lot, aligned_rows(FACT_TABLE, rows))
    if mode == "overwrite":
        drop_lots(warehouse, [other for other in own if other != lot])
    return lot
