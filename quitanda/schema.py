"""Names, types and defaults of the raw records, the staging table and the star schema."""

from __future__ import annotations

from dataclasses import dataclass

# Raw record keys and the staging column each one feeds.
FIELD_MAP = {
    "id": "product_id",
    "Produto": "product_name",
    "Categoria do Produto": "category_name",
    "Preço": "price_raw",
    "Frete": "shipping_raw",
    "Data da Compra": "date_raw",
    "Vendedor": "seller_name",
    "Local da compra": "purchase_location_code",
    "Avaliação da compra": "rating_raw",
    "Tipo de pagamento": "payment_type",
    "Quantidade de parcelas": "installments_raw",
    "lat": "latitude_raw",
    "lon": "longitude_raw",
}

TEXT_FIELDS = (
    "product_name",
    "category_name",
    "seller_name",
    "purchase_location_code",
    "payment_type",
)

# Texts that stand for a missing value.
DEFAULT_TEXTS = {
    "product_name": "nome indisponível",
    "category_name": "outros",
    "seller_name": "vendedor desconhecido",
    "purchase_location_code": "n/a",
    "payment_type": "não especificado",
}

# The 14 staging columns in load order. Whole numbers stay BIGINT until
# the table insert narrows them, so that a value out of range stops the load.
STAGING_TYPES = {
    "product_id": "string",
    "product_name": "string",
    "category_name": "string",
    "price_cents": "int",
    "shipping_cost_cents": "int",
    "purchase_date": "date",
    "seller_name": "string",
    "purchase_location_code": "string",
    "purchase_rating": "int",
    "payment_type": "string",
    "installments_quantity": "int",
    "latitude": "decimal(10,7)",
    "longitude": "decimal(10,7)",
    "etl_load_timestamp": "timestamp_ntz",
}
STAGING_COLUMNS = tuple(STAGING_TYPES)

UNKNOWN_KEY = -1


@dataclass(frozen=True)
class Dimension:
    """One insert-only dimension.

    ``natural_key`` maps a dimension column to the staging column it is matched with.
    ``null_safe`` names the natural-key columns in which NULL equals NULL.
    ``markers`` maps a staging column to the default text that never becomes a member.
    """

    table: str
    surrogate: str
    natural_key: dict[str, str]
    null_safe: frozenset[str] = frozenset()
    markers: tuple[str, ...] = ()


DIM_TEMPO = Dimension("dim_tempo", "sk_tempo", {"data_completa": "purchase_date"})
DIM_LOCAL = Dimension(
    "dim_local", "sk_local", {"uf": "purchase_location_code"}, markers=("purchase_location_code",)
)
DIM_VENDEDOR = Dimension(
    "dim_vendedor", "sk_vendedor", {"nome_vendedor": "seller_name"}, markers=("seller_name",)
)
DIM_PRODUTO = Dimension(
    "dim_produto",
    "sk_produto",
    {"nome_produto": "product_name", "categoria": "category_name"},
    markers=("product_name", "category_name"),
)
DIM_PAGAMENTO = Dimension(
    "dim_pagamento",
    "sk_pagamento",
    {"tipo_pagamento": "payment_type", "qtd_parcelas": "installments_quantity"},
    null_safe=frozenset({"qtd_parcelas"}),
    markers=("payment_type",),
)
DIMENSIONS = (DIM_TEMPO, DIM_LOCAL, DIM_VENDEDOR, DIM_PRODUTO, DIM_PAGAMENTO)

STAGING_TABLE = "staging_produtos_ecommerce"
FACT_TABLE = "fato_vendas"
FACT_COLUMNS = (
    "sk_produto",
    "sk_vendedor",
    "sk_local",
    "sk_tempo",
    "sk_pagamento",
    "preco_cents",
    "shipping_cost_cents",
    "purchase_rating",
    "etl_load_timestamp",
    "sk_venda",
)

SUMS_TABLE = "soma_vendas"
# What is kept of the sales of a key: see plans/marts.py for the sums of sales.
LOT_SUMS = (
    "sales",
    "price",
    "total",
    "totals",
    "rating",
    "ratings",
    "freight",
    "freights",
    "lowest",
    "highest",
)
# Keys of each grain. A seller's sales are kept by day, for the report by seller and month.
GRAINS = {
    "produto": ("sk_produto", "purchase_rating"),
    "vendedor": ("sk_vendedor", "sk_tempo"),
    "tempo": ("sk_tempo",),
    "local": ("sk_local",),
    "pagamento": ("sk_pagamento",),
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    required: bool = False
    comment: str = ""


@dataclass(frozen=True)
class TableSpec:
    name: str
    comment: str
    columns: tuple[ColumnSpec, ...]
    partitioned_by: tuple[str, ...] = ()

    @property
    def column_names(self) -> list[str]:
        return [column.name for column in self.columns]


_C = ColumnSpec

# Tables in creation order: staging, dimensions, fact, sums of its lots.
TABLES = (
    TableSpec(
        STAGING_TABLE,
        "Cleaned sale records of the latest batch, before they enter the star schema.",
        (
            _C("staging_id", "bigint", True, "Unique row number of the batch; not dense."),
            _C("product_id", "string", comment="Product id of the feed, if it sends one."),
            _C("product_name", "string"),
            _C("category_name", "varchar(255)"),
            _C("price_cents", "int"),
            _C("shipping_cost_cents", "int"),
            _C("purchase_date", "date"),
            _C("seller_name", "string"),
            _C("purchase_location_code", "varchar(10)"),
            _C("purchase_rating", "int"),
            _C("payment_type", "varchar(50)"),
            _C("installments_quantity", "int"),
            _C("latitude", "decimal(10,7)"),
            _C("longitude", "decimal(10,7)"),
            _C("etl_load_timestamp", "timestamp_ntz", True, "UTC time of the batch."),
            _C("collection", "string", True, "Landing collection the batch was read from."),
        ),
        partitioned_by=("collection",),
    ),
    TableSpec(
        "dim_tempo",
        "Calendar days on which something was bought.",
        (
            _C("sk_tempo", "int", True),
            _C("data_completa", "date", True),
            _C("ano", "int", True),
            _C("mes", "int", True),
            _C("dia", "int", True),
            _C("nome_dia_semana", "varchar(20)"),
            _C("nome_mes", "varchar(20)"),
            _C("trimestre", "int"),
            _C("semestre", "int"),
            _C("data_inclusao", "timestamp_ntz"),
        ),
    ),
    TableSpec(
        "dim_local",
        "Purchase locations by state code.",
        (
            _C("sk_local", "int", True),
            _C("uf", "varchar(2)", True),
            _C("regiao", "varchar(50)", comment="Not filled by the load."),
            _C("latitude", "decimal(10,7)"),
            _C("longitude", "decimal(10,7)"),
            _C("data_inclusao", "timestamp_ntz"),
            _C("data_atualizacao", "timestamp_ntz"),
        ),
    ),
    TableSpec(
        "dim_vendedor",
        "Sellers.",
        (
            _C("sk_vendedor", "int", True),
            _C("nome_vendedor", "string", True),
            _C("data_inclusao", "timestamp_ntz"),
            _C("data_atualizacao", "timestamp_ntz"),
        ),
    ),
    TableSpec(
        "dim_produto",
        "Products by name and category.",
        (
            _C("sk_produto", "int", True),
            _C("nome_produto", "string", True),
            _C("categoria", "varchar(255)", True),
            _C("brand", "varchar(255)", comment="Not filled by the load."),
            _C("data_inclusao", "timestamp_ntz"),
            _C("data_atualizacao", "timestamp_ntz"),
        ),
    ),
    TableSpec(
        "dim_pagamento",
        "Payment types with their number of instalments.",
        (
            _C("sk_pagamento", "int", True),
            _C("tipo_pagamento", "varchar(50)", True),
            _C("qtd_parcelas", "int", comment="NULL where the payment has no instalments."),
            _C("data_inclusao", "timestamp_ntz"),
            _C("data_atualizacao", "timestamp_ntz"),
        ),
    ),
    TableSpec(
        FACT_TABLE,
        "One row per sale, with its dimension keys and measures.",
        (
            _C("sk_produto", "int", True),
            _C("sk_vendedor", "int", True),
            _C("sk_local", "int", True),
            _C("sk_tempo", "int", True),
            _C("sk_pagamento", "int", True),
            _C("preco_cents", "int"),
            _C("shipping_cost_cents", "int"),
            _C("purchase_rating", "int"),
            _C("etl_load_timestamp", "timestamp_ntz", True),
            _C("sk_venda", "bigint", True, "Unique sale number; without gaps within a lot."),
            _C("collection", "string", True, "Landing collection the batch was read from."),
            _C("lote", "string", True, "Number before the batch's first sale, and its name."),
        ),
        partitioned_by=("collection", "lote"),
    ),
    TableSpec(
        SUMS_TABLE,
        "Sums of the sales of each lot per key, in one grain per report family.",
        (
            _C("sk_produto", "int"),
            _C("sk_vendedor", "int"),
            _C("sk_local", "int"),
            _C("sk_tempo", "int"),
            _C("sk_pagamento", "int"),
            _C("purchase_rating", "int"),
            *[_C(name, "bigint") for name in LOT_SUMS],
            _C("collection", "string", True, "Collection of the lot."),
            _C("lote", "string", True, "Name of the lot."),
            _C("grao", "string", True, "Grain: which of the keys are filled."),
        ),
        partitioned_by=("collection", "lote", "grao"),
    ),
)
TABLES_BY_NAME = {table.name: table for table in TABLES}
