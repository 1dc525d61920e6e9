"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.adapter import ROW_KEYS
from fixtures.warehouse import COLLECTION, SalesFixture, sales_fixture
from quitanda.operators import cleaning, quality
from quitanda.plans.lot_sums import mart_from_sums
from quitanda.plans.marts import MARTS
from quitanda.schema import (
    DEFAULT_TEXTS,
    DIMENSIONS,
    FACT_TABLE,
    FIELD_MAP,
    STAGING_COLUMNS,
    STAGING_TABLE,
    TABLES_BY_NAME,
    TEXT_FIELDS,
    Dimension,
)
from quitanda.sources.landing import scan_raw
from quitanda.sources.tables import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

STAGED = [name for name in STAGING_COLUMNS if name != "etl_load_timestamp"]

# Dimension columns that do not depend on the time of the load.
MEMBER_COLUMNS = {
    "dim_tempo": [
        "sk_tempo",
        "data_completa",
        "ano",
        "mes",
        "dia",
        "nome_dia_semana",
        "nome_mes",
        "trimestre",
        "semestre",
    ],
    "dim_local": ["sk_local", "uf", "regiao", "latitude", "longitude"],
    "dim_vendedor": ["sk_vendedor", "nome_vendedor"],
    "dim_produto": ["sk_produto", "nome_produto", "categoria", "brand"],
    "dim_pagamento": ["sk_pagamento", "tipo_pagamento", "qtd_parcelas"],
}
FACT_MEASURES = [
    "sk_produto",
    "sk_vendedor",
    "sk_local",
    "sk_tempo",
    "sk_pagamento",
    "preco_cents",
    "shipping_cost_cents",
    "purchase_rating",
]


def _picked(fixture: SalesFixture) -> DataFrame:
    return cleaning.select_fields(fixture.raw, carry=ROW_KEYS)


def _converted(*names: str) -> Callable[[SalesFixture], DataFrame]:
    def query(fixture: SalesFixture) -> DataFrame:
        return cleaning.convert(_picked(fixture), *names).select(*ROW_KEYS, *names)

    return query


def _geo(fixture: SalesFixture) -> DataFrame:
    coordinates = cleaning.convert(_picked(fixture), "latitude", "longitude")
    return coordinates.select(
        *ROW_KEYS,
        F.col("latitude").cast("decimal(10,7)").alias("latitude"),
        F.col("longitude").cast("decimal(10,7)").alias("longitude"),
    )


def _defaults(fixture: SalesFixture) -> DataFrame:
    filled = cleaning.apply_defaults(cleaning.normalize_text(_picked(fixture)))
    return filled.select(*ROW_KEYS, *DEFAULT_TEXTS, "price_cents", "purchase_date")


def _load_timestamp(fixture: SalesFixture) -> DataFrame:
    stamped = cleaning.add_load_timestamp(_picked(fixture))
    stamp = F.col("etl_load_timestamp")
    return stamped.agg(
        F.count(F.lit(1)).alias("stamped_rows"),
        F.count_if(stamp.isNull()).alias("unstamped_rows"),
        (F.min(stamp) == F.max(stamp)).alias("one_timestamp"),
    )


def _json_records(records: DataFrame) -> DataFrame:
    picked = cleaning.select_fields(records)
    return picked.select(
        "product_id",
        *[
            F.try_variant_get(name, "$", "string").alias(name)
            for name in FIELD_MAP.values()
            if name != "product_id"
        ],
    )


def _raw_scan(fixture: SalesFixture) -> DataFrame:
    return scan_raw(
        fixture.spark,
        fixture.raw_path,
        COLLECTION,
        where="`Tipo de pagamento` = '1-URGENT' and `Quantidade de parcelas` = '1'",
        sort=[F.col(name).desc() for name in ROW_KEYS],
        limit=100,
        columns=[
            *ROW_KEYS,
            F.col("Produto").alias("produto"),
            F.col("`Preço`").alias("preco"),
            F.col("Vendedor").alias("vendedor"),
        ],
    )


def _members(warehouse: Warehouse, dimension: Dimension) -> DataFrame:
    return warehouse.dimension(dimension).select(*MEMBER_COLUMNS[dimension.table])


def _stage_counts(fixture: SalesFixture) -> DataFrame:
    warehouse = fixture.loaded
    stages = {"raw": fixture.raw, "staging": warehouse.staging(COLLECTION)}
    return quality.stage_counts(stages | warehouse.dimensions() | {"fato": warehouse.fact()})


def _duplicated(fixture: SalesFixture) -> dict[str, DataFrame]:
    """The dimensions with every third member twice."""
    tables = fixture.loaded.dimensions()
    again = {d.table: tables[d.table].where(F.col(d.surrogate) % 3 == 0) for d in DIMENSIONS}
    return {name: table.unionByName(again[name]) for name, table in tables.items()}


def _with_nulls(name: str, table: DataFrame) -> DataFrame:
    """Required columns emptied: in sales by their rating, in members by their key."""
    required = [c.name for c in TABLES_BY_NAME[name].columns if c.required and c.name in table.columns]
    keys = {d.table: d.surrogate for d in DIMENSIONS}
    emptied = {}
    for i, column in enumerate(required):
        if name in keys:
            test = F.col(keys[name]) % (i + 2) == 0
        else:
            test = F.coalesce(F.col("purchase_rating") == 1 + i % 5, F.lit(False))
        emptied[column] = F.when(~test, F.col(column))
    return table.withColumns(emptied)


def _null_violations(fixture: SalesFixture) -> DataFrame:
    warehouse = fixture.loaded
    tables = {
        STAGING_TABLE: warehouse.staging(COLLECTION),
        **warehouse.dimensions(),
        FACT_TABLE: warehouse.fact(),
    }
    return quality.null_violations(
        {name: _with_nulls(name, table) for name, table in tables.items()}
    )


# Raw field, remainder of the order number, and a value its column can't hold.
BEYOND = {
    "Preço": (401, "50000000"),
    "Frete": (409, "R$ 99999999.99"),
    "Avaliação da compra": (419, "99999999999"),
    "Quantidade de parcelas": (421, "-99999999999"),
    "Categoria do Produto": (431, "c" * 300),
    "Tipo de pagamento": (433, "p" * 51),
    "Local da compra": (439, "long place"),
    "lat": (443, "1234.5"),
    "lon": (449, "-1e9"),
}


def _out_of_range(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            name: F.when(F.col("l_orderkey") % divisor == 0, F.lit(value)).otherwise(F.col(f"`{name}`"))
            for name, (divisor, value) in BEYOND.items()
        }
    )


def _by_dimension(prefix: str, read: Callable[[SalesFixture], Warehouse]):
    return {
        f"{prefix}{dimension.table.removeprefix('dim_')}": (
            lambda fixture, d=dimension: _members(read(fixture), d)
        )
        for dimension in DIMENSIONS
    }


def _mart(name: str) -> Callable[[SalesFixture], DataFrame]:
    def query(fixture: SalesFixture) -> DataFrame:
        warehouse = fixture.loaded
        return MARTS[name](warehouse.fact(), warehouse.dimensions())

    return query


def _stored_mart(name: str) -> Callable[[SalesFixture], DataFrame]:
    return lambda fixture: mart_from_sums(fixture.summed_by_lot, name)


ON_FIXTURE: dict[str, Callable[[SalesFixture], DataFrame]] = {
    **{name: _mart(name) for name in MARTS},
    **{f"stored_{name}": _stored_mart(name) for name in MARTS},
    "src_json_records": lambda fixture: _json_records(fixture.feed),
    "src_json_list": lambda fixture: _json_records(fixture.lists),
    "raw_scan_filter_project_sort_limit": _raw_scan,
    "t_select_rename": _picked,
    "t_product_id": lambda fixture: _picked(fixture).select(*ROW_KEYS, "product_id"),
    "t_normalize_text": lambda fixture: cleaning.normalize_text(_picked(fixture)).select(
        *ROW_KEYS, *TEXT_FIELDS
    ),
    "t_price_cents": _converted("price_cents"),
    "t_shipping_cents": _converted("shipping_cost_cents"),
    "t_rating_int": _converted("purchase_rating"),
    "t_installments_int": _converted("installments_quantity"),
    "t_geo_decimal": _geo,
    "t_parse_date": _converted("purchase_date"),
    "t_defaults": _defaults,
    "t_load_timestamp": _load_timestamp,
    "staging_full": lambda fixture: cleaning.to_staging_types(
        cleaning.clean_records(fixture.raw)
    ).select(*STAGED),
    "staging_load": lambda fixture: fixture.staged.staging(COLLECTION).select(*STAGED),
    "staging_from_json": lambda fixture: fixture.run_from_feed.staging(COLLECTION).select(*STAGED),
    **_by_dimension("dim_", lambda fixture: fixture.loaded),
    **_by_dimension("dim_incremental_", lambda fixture: fixture.loaded_in_two),
    "fato_vendas": lambda fixture: fixture.loaded.fact().select(*FACT_MEASURES),
    "fato_vendas_from_json": lambda fixture: fixture.run_from_feed.fact().select(*FACT_MEASURES),
    "fato_vendas_append_twice": lambda fixture: fixture.appended_twice.fact().select(
        *FACT_MEASURES
    ),
    "fato_vendas_two_collections": lambda fixture: fixture.two_collections.fact().select(
        *FACT_MEASURES
    ),
    "dq_rejects": lambda fixture: quality.reject_counts(fixture.raw),
    "dq_rejected_values": lambda fixture: quality.rejected_values(fixture.raw),
    "dq_stage_counts": _stage_counts,
    "dq_duplicate_members": lambda fixture: quality.duplicate_members(_duplicated(fixture)),
    "dq_null_violations": _null_violations,
    "dq_fk_orphans": lambda fixture: quality.orphan_keys(
        fixture.loaded.fact(), fixture.loaded.dimensions()
    ),
    "dq_unmatched_sales": lambda fixture: quality.unmatched_sales(
        fixture.loaded.staging(COLLECTION), fixture.loaded.dimensions()
    ),
    "dq_domain_violations": lambda fixture: quality.domain_violations(
        cleaning.clean_records(_out_of_range(fixture.raw))
    ),
}


def queries() -> dict[str, Query]:
    def on_tables(run: Callable[[SalesFixture], DataFrame]) -> Query:
        return lambda spark, sf_dir: run(sales_fixture(spark, sf_dir))

    return {name: on_tables(run) for name, run in ON_FIXTURE.items()}
