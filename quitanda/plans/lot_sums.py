"""Reports from stored sums: each lot of the fact is summed up once.

A lot never changes once it is loaded, so the sums of its sales per key are kept beside it, one
partition per lot and grain. A report adds up the sums of all lots; only lots without sums are
read from the fact. A lot loaded again loses its sums before it is written, and the sums of a
lot that is gone are taken out before the next report. A sale whose price and freight exceed an INT
stops the refresh, as it stops every report of totals.
"""

from __future__ import annotations

from functools import reduce
from itertools import groupby
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.plans.marts import MARTS, sums_of_sales
from quitanda.schema import FACT_TABLE, GRAINS, LOT_SUMS, SUMS_TABLE, TABLES_BY_NAME
from quitanda.sources.tables import Lot, Warehouse, drop_sums

KEYS = ("sk_produto", "sk_vendedor", "sk_local", "sk_tempo", "sk_pagamento", "purchase_rating")
LOT_KEYS = ("collection", "lote")

# The grain each report is made from.
GRAIN_OF_MART = {
    "mart_01_sales_by_category": "produto",
    "mart_02_monthly_sales": "tempo",
    "mart_03_top_sellers": "vendedor",
    "mart_04_sales_by_location": "local",
    "mart_05_payments": "pagamento",
    "mart_06_quarterly_sales": "tempo",
    "mart_07_rating_by_category": "produto",
    "mart_08_freight_by_location": "local",
    "mart_09_weekend_vs_weekday": "tempo",
    "mart_10_top_products": "produto",
    "mart_11_seller_monthly": "vendedor",
}


def sums_by_lot(sales: DataFrame) -> DataFrame:
    """Sums per lot, grain and key, in one pass over sales that carry their lot.

    A sale is counted in every grain; sums are built in the tasks that read it, so what is
    shuffled are keys, and a key that holds a third of the sales costs no more than another.
    """
    columns = [*LOT_KEYS, *KEYS]
    sets = [[*LOT_KEYS, *keys] for keys in GRAINS.values()]
    # One bit per column that a set leaves out, the last column lowest.
    masks = {
        grain: sum(1 << (len(columns) - 1 - i) for i, name in enumerate(columns)
                   if name in KEYS and name not in keys)
        for grain, keys in GRAINS.items()
    }
    sums = [column.alias(name) for name, column in sums_of_sales().items()]
    summed = sales.groupingSets(sets, *columns).agg(F.grouping_id().alias("grouping"), *sums)
    grain = F.coalesce(
        *[F.when(F.col("grouping") == mask, F.lit(name)) for name, mask in masks.items()]
    )
    return summed.withColumn("grao", grain).select(*TABLES_BY_NAME[SUMS_TABLE].column_names)


def _summed_lots(warehouse: Warehouse) -> dict[Lot, set[str]]:
    """Lots that have sums, with the grains that are there, from the catalog alone."""
    found: dict[Lot, set[str]] = {}
    for folder in warehouse.partitions(SUMS_TABLE):
        lot, _, grain = folder.rpartition("/")
        found.setdefault(Lot.read(lot), set()).add(grain.partition("=")[2])
    return found


def _sales_of(warehouse: Warehouse, lots: list[Lot]) -> DataFrame:
    """Sales of some lots with the columns that tell lots apart; only their folders are read."""
    by_collection = sorted(lots, key=lambda lot: lot.collection)
    wanted = [
        (F.col("collection") == name) & F.col("lote").isin([lot.name for lot in group])
        for name, group in groupby(by_collection, key=lambda lot: lot.collection)
    ]
    return warehouse.read(FACT_TABLE).where(reduce(or_, wanted))


def refresh_sums(warehouse: Warehouse) -> list[Lot]:
    """Make the stored sums those of the fact's present lots; gives the lots that were read.

    A lot counts as summed up when all grains are there, so one whose job broke off is read
    again. A lot without sales has no sums and is looked at each time.
    """
    lots = set(warehouse.fact_lots())
    summed = _summed_lots(warehouse)
    missing = sorted(
        (lot for lot in lots if summed.get(lot) != set(GRAINS)),
        key=lambda lot: (lot.collection, lot.first_sale, lot.batch),
    )
    # Files that a broken-off job left of the missing ones go too, so its rows can be appended.
    drop_sums(warehouse, [*(summed.keys() - lots), *missing])
    if missing:
        sums = sums_by_lot(_sales_of(warehouse, missing))
        sums.write.insertInto(warehouse.name(SUMS_TABLE))
    return missing


def stored_sums(warehouse: Warehouse, grain: str) -> DataFrame:
    """Sums of all lots in one grain, a row per lot and key."""
    sums = warehouse.read(SUMS_TABLE).where(F.col("grao") == grain)
    return sums.select(*GRAINS[grain], *LOT_SUMS)


def mart_from_sums(warehouse: Warehouse, name: str) -> DataFrame:
    """A report over all lots that reads only those loaded since the last one."""
    refresh_sums(warehouse)
    return MARTS[name](stored_sums(warehouse, GRAIN_OF_MART[name]), warehouse.dimensions())
