"""The eleven sales reports.

Each one sums the fact per dimension key before it joins the dimension, so the join sees
one row per key however many sales a key has, and a key that holds a third of the sales is
summed up in the tasks that read it. After the join the sums are added up once more under
the report's own columns. Reports by category join a product table that can be broadcast
first, as there are far more products than categories: one row per product and task would
come close to a shuffle of the fact.

In place of the fact a report takes the stored sums of its lots (``plans/lot_sums.py``): these
have the sums below as columns, and the first step adds them up instead of the sales.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.functions.dates import day_kind
from quitanda.functions.money import (
    currency_mean,
    currency_sum,
    mean,
    total_cents,
)
from quitanda.operators.lookups import fits_broadcast
from quitanda.schema import LOT_SUMS, UNKNOWN_KEY

Dimensions = dict[str, DataFrame]


def sales() -> Column:
    """Number of sales, from the counts per dimension key."""
    return F.sum("sales")


def sums_of_sales() -> dict[str, Column]:
    """All sums of the sales of a key that reports are made of."""
    return {
        "sales": F.count(F.lit(1)),
        "price": F.sum("preco_cents"),
        "total": F.sum(total_cents()),
        "totals": F.count(total_cents()),
        "rating": F.sum("purchase_rating"),
        "ratings": F.count("purchase_rating"),
        "freight": F.sum("shipping_cost_cents"),
        "freights": F.count("shipping_cost_cents"),
        "lowest": F.min("shipping_cost_cents"),
        "highest": F.max("shipping_cost_cents"),
    }


def sums_of_sums() -> dict[str, Column]:
    """The same from rows that hold such sums already."""
    special = {"lowest": F.min("lowest"), "highest": F.max("highest")}
    return {name: special.get(name, F.sum(name)) for name in LOT_SUMS}


# Sums per dimension key that most reports need.
TOTALS = ("sales", "total", "totals")


def per_key(fact: DataFrame, keys: list[str], names: tuple[str, ...]) -> DataFrame:
    sums = sums_of_sums() if set(LOT_SUMS) <= set(fact.columns) else sums_of_sales()
    return fact.groupBy(*keys).agg(*[sums[name].alias(name) for name in names])


def known(fact: DataFrame, key: str) -> DataFrame:
    return fact.where(F.col(key) != F.lit(UNKNOWN_KEY))


def per_category(
    fact: DataFrame, dims: Dimensions, by: list[str], names: tuple[str, ...]
) -> DataFrame:
    """Sums per category and ``by``, to be added up once more.

    There are many products and few categories, so a product table that can be broadcast is
    joined first and what is shuffled are categories. A larger one meets one row per product.
    """
    products = dims["dim_produto"].select("sk_produto", "categoria")
    if fits_broadcast(products):
        return per_key(fact.join(F.broadcast(products), "sk_produto"), ["categoria", *by], names)
    return per_key(fact, ["sk_produto", *by], names).join(products, "sk_produto")


def sales_by_category(fact: DataFrame, dims: Dimensions) -> DataFrame:
    return (
        per_category(fact, dims, [], (*TOTALS, "price"))
        .groupBy("categoria")
        .agg(
            sales().alias("total_transacoes_venda"),
            currency_sum("price").alias("valor_produtos_vendidos"),
            currency_sum("total").alias("valor_total_com_frete"),
            currency_mean("total", "totals").alias("ticket_medio_por_transacao"),
        )
        .orderBy(F.col("valor_total_com_frete").desc_nulls_first(), "categoria")
    )


def _sales_by_calendar(fact: DataFrame, dims: Dimensions, columns: list[str]) -> DataFrame:
    return (
        per_key(fact, ["sk_tempo"], TOTALS)
        .join(dims["dim_tempo"], "sk_tempo")
        .groupBy(*columns)
        .agg(
            sales().alias("total_transacoes_venda"),
            currency_sum("total").alias("valor_total_vendas"),
        )
    )


def monthly_sales(fact: DataFrame, dims: Dimensions) -> DataFrame:
    months = _sales_by_calendar(fact, dims, ["ano", "mes", "nome_mes"])
    return months.orderBy(F.col("ano").asc_nulls_last(), F.col("mes").asc_nulls_last())


def top_sellers(fact: DataFrame, dims: Dimensions, k: int = 10) -> DataFrame:
    """The sellers with the highest totals; equal totals are ordered by name."""
    return (
        per_key(known(fact, "sk_vendedor"), ["sk_vendedor"], TOTALS)
        .join(dims["dim_vendedor"], "sk_vendedor")
        .groupBy("nome_vendedor")
        .agg(
            sales().alias("total_transacoes_venda"),
            currency_sum("total").alias("valor_total_vendas"),
        )
        .orderBy(F.col("valor_total_vendas").desc_nulls_first(), "nome_vendedor")
        .limit(k)
    )


def sales_by_location(fact: DataFrame, dims: Dimensions) -> DataFrame:
    return (
        per_key(known(fact, "sk_local"), ["sk_local"], (*TOTALS, "rating", "ratings"))
        .join(dims["dim_local"], "sk_local")
        .groupBy("uf")
        .agg(
            sales().alias("total_transacoes_venda"),
            currency_sum("total").alias("valor_total_vendas"),
            mean("rating", "ratings").alias("avaliacao_media_compra"),
        )
        .orderBy(F.col("valor_total_vendas").desc_nulls_first(), "uf")
    )


def payment_distribution(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """No instalments and zero instalments are one group."""
    return (
        per_key(known(fact, "sk_pagamento"), ["sk_pagamento"], TOTALS)
        .join(dims["dim_pagamento"], "sk_pagamento")
        .groupBy(
            "tipo_pagamento",
            F.coalesce("qtd_parcelas", F.lit(0)).alias("quantidade_parcelas"),
        )
        .agg(
            sales().alias("total_transacoes_venda"),
            currency_sum("total").alias("valor_total_vendas"),
            currency_mean("total", "totals").alias("valor_medio_por_transacao"),
        )
        .orderBy(
            F.col("tipo_pagamento").asc_nulls_last(),
            F.col("quantidade_parcelas").asc_nulls_last(),
        )
    )


def quarterly_sales(fact: DataFrame, dims: Dimensions) -> DataFrame:
    quarters = _sales_by_calendar(fact, dims, ["ano", "trimestre"])
    return quarters.orderBy(F.col("ano").asc_nulls_last(), F.col("trimestre").asc_nulls_last())


def rating_by_category(fact: DataFrame, dims: Dimensions) -> DataFrame:
    rated = known(fact, "sk_produto").where(F.col("purchase_rating").isNotNull())
    return (
        per_category(rated, dims, ["purchase_rating"], ("sales",))
        .groupBy("categoria", F.col("purchase_rating").alias("avaliacao_da_compra"))
        .agg(sales().alias("total_transacoes_com_esta_avaliacao"))
        .orderBy(
            F.col("categoria").asc_nulls_last(), F.col("avaliacao_da_compra").asc_nulls_last()
        )
    )


def freight_by_location(fact: DataFrame, dims: Dimensions) -> DataFrame:
    names = ("freight", "freights", "lowest", "highest")
    return (
        per_key(known(fact, "sk_local"), ["sk_local"], names)
        .where(F.col("freights") > 0)
        .join(dims["dim_local"], "sk_local")
        .groupBy("uf")
        .agg(
            currency_mean("freight", "freights").alias("frete_medio"),
            (F.min("lowest").cast("double") / F.lit(100.0)).alias("frete_minimo"),
            (F.max("highest").cast("double") / F.lit(100.0)).alias("frete_maximo"),
            currency_sum("freight").alias("frete_total_uf"),
        )
        .orderBy(F.col("frete_medio").desc_nulls_first(), "uf")
    )


def weekend_vs_weekday(fact: DataFrame, dims: Dimensions) -> DataFrame:
    return (
        per_key(fact, ["sk_tempo"], TOTALS)
        .join(dims["dim_tempo"], "sk_tempo")
        .groupBy(day_kind(F.col("data_completa")).alias("tipo_dia"))
        .agg(
            sales().alias("total_transacoes_venda"),
            currency_sum("total").alias("valor_total_vendas"),
            currency_mean("total", "totals").alias("ticket_medio_por_transacao"),
        )
        .orderBy(F.col("tipo_dia").asc_nulls_last())
    )


def top_products(fact: DataFrame, dims: Dimensions, k: int = 5) -> DataFrame:
    """The products with the highest totals; equal totals are ordered by product."""
    return (
        per_key(known(fact, "sk_produto"), ["sk_produto"], TOTALS)
        .join(dims["dim_produto"], "sk_produto")
        .groupBy("nome_produto", "categoria")
        .agg(
            sales().alias("total_transacoes_ou_unidades_vendidas"),
            currency_sum("total").alias("valor_total_vendas"),
        )
        .orderBy(F.col("valor_total_vendas").desc_nulls_first(), "nome_produto", "categoria")
        .limit(k)
    )


def seller_monthly(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Months are put in before the first sum where the calendar is small enough to
    broadcast, which leaves one row per month and seller instead of one per day."""
    months = dims["dim_tempo"].select("sk_tempo", "ano", "mes", "nome_mes")
    month_columns = ["ano", "mes", "nome_mes"]
    sold = known(fact, "sk_vendedor")
    if fits_broadcast(months):
        dated = sold.join(F.broadcast(months), "sk_tempo")
        sums = per_key(dated, [*month_columns, "sk_vendedor"], TOTALS)
    else:
        sums = per_key(sold, ["sk_tempo", "sk_vendedor"], TOTALS).join(months, "sk_tempo")
    return (
        sums.join(dims["dim_vendedor"], "sk_vendedor")
        .groupBy(*month_columns, "nome_vendedor")
        .agg(
            sales().alias("total_transacoes_venda"),
            currency_sum("total").alias("valor_total_vendas"),
        )
        .orderBy(
            F.col("ano").asc_nulls_last(),
            F.col("mes").asc_nulls_last(),
            F.col("nome_vendedor").asc_nulls_last(),
            F.col("valor_total_vendas").desc_nulls_first(),
        )
    )


MARTS: dict[str, Callable[[DataFrame, Dimensions], DataFrame]] = {
    "mart_01_sales_by_category": sales_by_category,
    "mart_02_monthly_sales": monthly_sales,
    "mart_03_top_sellers": top_sellers,
    "mart_04_sales_by_location": sales_by_location,
    "mart_05_payments": payment_distribution,
    "mart_06_quarterly_sales": quarterly_sales,
    "mart_07_rating_by_category": rating_by_category,
    "mart_08_freight_by_location": freight_by_location,
    "mart_09_weekend_vs_weekday": weekend_vs_weekday,
    "mart_10_top_products": top_products,
    "mart_11_seller_monthly": seller_monthly,
}
