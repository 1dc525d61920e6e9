from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quitanda.operators import quality
from quitanda.operators.cleaning import clean_records
from quitanda.operators.fact import fact_rows
from quitanda.plans.populate import load_dimensions
from quitanda.schema import FACT_TABLE
from tests.helpers import staged_rows, string_records, variant_records

BAD = {
    "id": "7",
    "Preço": "x",
    "Frete": "gratis",
    "Data da Compra": "31/02/2020",
    "Avaliação da compra": "4.5",
    "Quantidade de parcelas": "many",
    "lat": "n/d",
    "lon": "nan",
}
FINE = {"Produto": "tv", "Preço": "1", "Data da Compra": "  ", "lat": None}


@pytest.mark.parametrize("form", [string_records, variant_records])
def test_rejects(spark, form):
    raw = form(spark, [BAD, BAD, FINE, {}])
    assert {r.field: r.rejects for r in quality.reject_counts(raw).collect()} == {
        "price_cents": 2,
        "shipping_cost_cents": 2,
        "purchase_rating": 2,
        "installments_quantity": 2,
        "latitude": 2,
        "longitude": 2,
        "purchase_date": 2,
    }
    listed = {tuple(r) for r in quality.rejected_values(raw).collect()}
    assert ("price_cents", "x", "7") in listed and len(listed) == 7


def test_json_date_that_is_no_text_is_no_reject(spark):
    raw = variant_records(spark, [{"Data da Compra": 5}, {"Data da Compra": "5"}])
    counts = {r.field: r.rejects for r in quality.reject_counts(raw).collect()}
    assert counts["purchase_date"] == 1


def test_infinity_is_rejected(spark):
    raw = string_records(spark, [{"Preço": "inf"}, {"Preço": "1e999"}, {"Avaliação da compra": "inf"}])
    counts = {r.field: r.rejects for r in quality.reject_counts(raw).collect()}
    assert (counts["price_cents"], counts["purchase_rating"]) == (2, 1)


def test_stage_counts(spark):
    counts = quality.stage_counts({"raw": spark.range(3), "none": spark.range(0)})
    assert sorted(map(tuple, counts.collect())) == [("none", 0), ("raw", 3)]


def test_orphans_and_duplicates(spark, warehouse):
    batch = staged_rows(spark, {}, {"category_name": "outros"}, {"installments_quantity": None})
    load_dimensions(warehouse, batch)
    dims = warehouse.dimensions()
    fact = fact_rows(batch, dims).cache()
    orphans = {r.fact_key: r.orphan_rows for r in quality.orphan_keys(fact, dims).collect()}
    assert orphans == {
        "sk_produto": 1, "sk_vendedor": 0, "sk_local": 0, "sk_tempo": 0, "sk_pagamento": 0
    }
    duplicates = {r.dimension: r.duplicated_keys for r in quality.duplicate_members(dims).collect()}
    assert set(duplicates.values()) == {0} and len(duplicates) == 5
    doubled = dims | {"dim_pagamento": dims["dim_pagamento"].unionAll(dims["dim_pagamento"])}
    duplicates = {r.dimension: r.duplicated_keys for r in quality.duplicate_members(doubled).collect()}
    assert duplicates["dim_pagamento"] == 2 and duplicates["dim_produto"] == 0


def test_null_violations(spark, warehouse):
    batch = staged_rows(spark, {}, {})
    load_dimensions(warehouse, batch)
    fact = fact_rows(batch, warehouse.dimensions())
    broken = fact.withColumn("sk_local", F.when(F.col("sk_venda") > 1, F.col("sk_local")))
    report = quality.null_violations({FACT_TABLE: broken, **warehouse.dimensions()})
    found = {(r.table_name, r.column_name): r.null_rows for r in report.collect()}
    assert found.pop((FACT_TABLE, "sk_local")) == 1
    assert set(found.values()) == {0} and ("dim_tempo", "ano") in found


def test_domain_violations(spark):
    raw = string_records(
        spark,
        [
            {"Preço": "99999999999", "lat": "1000", "lon": "999.99999996"},
            {"Categoria do Produto": "x" * 256, "Local da compra": "abc"},
            {"Tipo de pagamento": "y" * 51, "Quantidade de parcelas": "-3000000000"},
            {},
        ],
    )
    report = quality.domain_violations(clean_records(raw)).collect()
    assert {(r.column_name, r.rule): r.violations for r in report} == {
        ("price_cents", "fits int"): 1,
        ("shipping_cost_cents", "fits int"): 0,
        ("purchase_rating", "fits int"): 0,
        ("installments_quantity", "fits int"): 1,
        ("latitude", "fits decimal(10,7)"): 1,
        ("longitude", "fits decimal(10,7)"): 1,
        ("category_name", "length <= 255"): 1,
        ("purchase_location_code", "length <= 10"): 0,
        ("purchase_location_code", "length <= 2"): 1,
        ("payment_type", "length <= 50"): 1,
    }
