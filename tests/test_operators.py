from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from quitanda.operators.dimensions import load_dimension, staged_members
from quitanda.operators.fact import fact_rows, load_fact
from quitanda.operators.keys import assign_keys
from quitanda.operators.lookups import fits_broadcast, hot_keys, join_keyed
from quitanda.plans.populate import load_dimensions
from quitanda.schema import (
    DIM_LOCAL,
    DIM_PAGAMENTO,
    DIM_PRODUTO,
    DIM_TEMPO,
    DIM_VENDEDOR,
    DIMENSIONS,
    FACT_TABLE,
)
from quitanda.settings import remove_path
from tests.helpers import staged_rows


def test_keys_are_dense_and_in_order_over_many_partitions(spark, tmp_path):
    names = [f"n{i:05d}" for i in range(5000)]
    shuffled = random.Random(1).sample(names, len(names))
    members = spark.createDataFrame([(n,) for n in shuffled], "name string").repartition(7)
    keyed = assign_keys(members, ["name"], "sk", 40, str(tmp_path / "m"))
    assert keyed.rdd.getNumPartitions() >= 1
    assert [tuple(r) for r in keyed.orderBy("sk").collect()] == [
        (41 + i, name) for i, name in enumerate(names)
    ]


def test_keys_put_null_last(spark, tmp_path):
    members = spark.createDataFrame([("a", None), ("a", 2), ("b", 1)], "t string, q int")
    keyed = assign_keys(members, ["t", "q"], "sk", 0, str(tmp_path / "m"))
    assert [tuple(r) for r in keyed.orderBy("sk").collect()] == [
        (1, "a", 2), (2, "a", None), (3, "b", 1)
    ]


def test_no_members_no_keys(spark, tmp_path):
    nobody = spark.createDataFrame([], "name string")
    assert assign_keys(nobody, ["name"], "sk", 0, str(tmp_path / "m")) is None


def test_hot_keys_are_few(spark):
    rows = [("hot", None)] * 500 + [(f"k{i}", i) for i in range(1000)]
    frame = spark.createDataFrame(rows, "t string, q int")

    def found(frame, **options):
        return [tuple(r) for r in hot_keys(frame, ["t", "q"], rows=frame.count(), **options).collect()]

    assert found(frame, hot_share=10) == [("hot", None, 7)]
    assert [key[:2] for key in found(frame, hot_share=10, sampled_rows=300)] == [("hot", None)]
    assert found(frame, hot_share=1) == []
    assert found(frame.limit(0), hot_share=10) == []


def test_broadcast_is_decided_by_measured_size(spark):
    frame = spark.createDataFrame([(i, "x" * 1000) for i in range(100)], "k int, t string")
    assert fits_broadcast(frame, 200_000)
    assert not fits_broadcast(frame, 100_000)
    assert not fits_broadcast(spark.range(1_000_001))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("byte_limit", [0, 10**6])
def test_join_gives_the_same_on_every_path(spark, how, byte_limit):
    """A third of the rows share one key, others have no match, and NULL matches NULL."""
    rows = [(i, "hot", None) for i in range(400)]
    rows += [(400 + i, f"k{i % 90}", i % 3) for i in range(700)]
    rows += [(1100 + i, "nowhere", 1) for i in range(100)]
    large = spark.createDataFrame(rows, "n bigint, t string, q int").repartition(3)
    members = [("hot", None, 1)] + [(f"k{i}", i % 3, 10 + i) for i in range(0, 90, 2)]
    keyed = spark.createDataFrame(members, "kt string, kq int, sk int")
    joined = join_keyed(
        large, keyed, {"kt": "t", "kq": "q"}, "n", how, frozenset({"kq"}),
        byte_limit=byte_limit, hot_share=20,
    )
    assert joined.columns == ["n", "t", "q", "sk"]
    found = {(t, q): sk for t, q, sk in members}
    expected = [(n, t, q, found.get((t, q))) for n, t, q in rows]
    if how == "inner":
        expected = [row for row in expected if row[3] is not None]
    assert sorted(map(tuple, joined.collect())) == sorted(expected)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert ("_salt" in plan) == (byte_limit == 0)


def test_largest_task_is_bounded_at_many_partitions(spark):
    """A key with 30 % of the rows and one with 0.2 %, neither of which may fill a task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "1000",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        n = 300_000
        key = F.when(F.col("id") % 10 < 3, -1).when(F.col("id") % 500 == 7, -2)
        large = spark.range(n).select(F.col("id").alias("n"), key.otherwise(F.col("id")).alias("k"))
        keyed = spark.range(-2, n).select(F.col("id").alias("key"), F.col("id").alias("sk"))
        joined = join_keyed(large, keyed, {"key": "k"}, "n", byte_limit=0)
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count"), F.sum("count"))
        largest, total = sizes.first()
        assert total == n and largest <= 5 * n / 1000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_salting_splits_a_hot_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        large = spark.range(9000).select(
            F.col("id").alias("n"),
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        )
        keyed = spark.range(9000).select(F.col("id").alias("key"), F.col("id").alias("sk"))
        joined = join_keyed(large, keyed, {"key": "k"}, "n", byte_limit=0)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(row["count"] for row in sizes) < 2000
        assert joined.where("sk = k").count() == 9000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def keys_of(warehouse, dimension):
    columns = [dimension.surrogate, *dimension.natural_key]
    return [tuple(r) for r in warehouse.dimension(dimension).select(*columns).orderBy(columns[0]).collect()]


def test_members_are_appended_in_order_and_stay(spark, warehouse):
    first = staged_rows(spark, {"seller_name": "bia"}, {"seller_name": "ana"}, {"seller_name": "bia"})
    load_dimension(warehouse, first, DIM_VENDEDOR)
    assert keys_of(warehouse, DIM_VENDEDOR) == [(1, "ana"), (2, "bia")]
    second = staged_rows(spark, {"seller_name": "zoe"}, {"seller_name": "ana"}, {"seller_name": "abel"})
    load_dimension(warehouse, second, DIM_VENDEDOR)
    expected = [(1, "ana"), (2, "bia"), (3, "abel"), (4, "zoe")]
    assert keys_of(warehouse, DIM_VENDEDOR) == expected
    load_dimension(warehouse, second, DIM_VENDEDOR)
    assert keys_of(warehouse, DIM_VENDEDOR) == expected


def test_payment_without_instalments_is_one_member(spark, warehouse):
    batch = staged_rows(
        spark,
        {"payment_type": "pix", "installments_quantity": None},
        {"payment_type": "pix", "installments_quantity": None},
        {"payment_type": "pix", "installments_quantity": 0},
    )
    for _ in range(2):
        load_dimension(warehouse, batch, DIM_PAGAMENTO)
        assert keys_of(warehouse, DIM_PAGAMENTO) == [(1, "pix", 0), (2, "pix", None)]


def test_default_texts_are_no_members(spark):
    batch = staged_rows(
        spark,
        {"category_name": "outros"},
        {"product_name": "nome indisponível"},
        {"seller_name": "vendedor desconhecido", "product_name": "", "category_name": ""},
        {"purchase_location_code": "n/a", "payment_type": "não especificado"},
        {"purchase_date": None},
    )
    members = {d.table: sorted(map(tuple, staged_members(batch, d).collect())) for d in DIMENSIONS}
    assert members["dim_produto"] == [("", ""), ("celular", "eletronicos")]
    assert members["dim_vendedor"] == [("ana",)]
    assert members["dim_local"] == [("sp", None, None)]
    assert members["dim_pagamento"] == [("boleto", 1)]
    assert [row[0] for row in members["dim_tempo"]] == [date(2024, 5, 3)]


def test_location_takes_separate_minima_and_keeps_the_first(spark, warehouse):
    batch = staged_rows(
        spark, {"latitude": -1, "longitude": 5}, {"latitude": 2, "longitude": -7}, {"latitude": None}
    )
    load_dimension(warehouse, batch, DIM_LOCAL)
    load_dimension(warehouse, staged_rows(spark, {"latitude": -50, "longitude": -50}), DIM_LOCAL)
    row = warehouse.dimension(DIM_LOCAL).collect()
    assert [(r.uf, r.latitude, r.longitude, r.regiao) for r in row] == [("sp", -1, -7, None)]
    assert row[0].data_inclusao is not None and row[0].data_atualizacao == row[0].data_inclusao


def test_members_are_read_with_pruned_columns(spark, warehouse):
    from quitanda.operators.cleaning import staging_columns
    from quitanda.sources.tables import load_staging

    load_staging(warehouse, staging_columns(staged_rows(spark, {})), "vendas")
    plan = staged_members(warehouse.staging("vendas"), DIM_VENDEDOR)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<seller_name:string>" in text
    assert "Not(EqualTo(seller_name,vendedor desconhecido))" in text


BATCH = [
    {},
    {"category_name": "outros"},
    {"purchase_date": None},
    {"installments_quantity": None, "price_cents": None},
    {"seller_name": "vendedor desconhecido", "purchase_rating": None},
]


@pytest.mark.parametrize("byte_limit", [0, 10**6])
def test_fact_rows(spark, warehouse, byte_limit):
    batch = staged_rows(spark, *BATCH)
    load_dimensions(warehouse, batch)
    rows = fact_rows(batch, warehouse.dimensions(), 100, byte_limit, hot_share=3)
    got = {r.sk_venda: r for r in rows.collect()}
    assert sorted(got) == [101, 102, 104, 105]
    assert (got[101].sk_produto, got[102].sk_produto) == (1, -1)
    assert got[105].sk_vendedor == -1 and got[105].purchase_rating is None
    assert got[104].sk_pagamento == 2 and got[104].preco_cents is None
    for row in got.values():
        for dimension in DIMENSIONS:
            members = {key[0] for key in keys_of(warehouse, dimension)}
            assert row[dimension.surrogate] in members | {-1}


def test_a_new_run_appends_and_a_repeated_one_replaces_itself(spark, warehouse):
    batch = staged_rows(spark, *BATCH)
    load_dimensions(warehouse, batch)
    first = load_fact(warehouse, batch, "vendas")
    assert load_fact(warehouse, batch, "vendas") == first
    assert warehouse.fact().count() == 4
    for name in ("second", "third"):
        load_fact(warehouse, batch, "vendas", batch=name)
    fact = warehouse.fact()
    assert fact.count() == 12 and fact.select("sk_venda").distinct().count() == 12
    load_fact(warehouse, batch, "vendas", "overwrite", "fourth")
    assert warehouse.read(FACT_TABLE).count() == 4
    with pytest.raises(ValueError):
        load_fact(warehouse, batch, "vendas", "merge")
    with pytest.raises(ValueError):
        load_fact(warehouse, batch, "vendas", batch="../x")


def test_sales_are_numbered_without_gaps(spark, warehouse):
    from quitanda.operators.cleaning import staging_columns
    from quitanda.sources.tables import load_staging

    changes = [{"purchase_date": None} if i % 3 == 0 else {"price_cents": i} for i in range(50)]
    batch = staging_columns(staged_rows(spark, *changes).repartition(7))
    load_staging(warehouse, batch, "vendas")
    staged = warehouse.staging("vendas")
    load_dimensions(warehouse, staged)
    assert staged.agg(F.max("staging_id")).first()[0] > 2**33
    numbers = []
    for name in ("one", "two"):
        lot = load_fact(warehouse, staged, "vendas", batch=name)
        assert load_fact(warehouse, staged, "vendas", batch=name) == lot
        numbers.append({r.sk_venda: r.preco_cents for r in warehouse.fact_lot(lot).collect()})
    assert sorted(numbers[0]) == list(range(1, 34))
    assert sorted(numbers[1]) == list(range(34, 67))
    assert {n + 33: price for n, price in numbers[0].items()} == numbers[1]


def test_numbers_of_any_task_and_place_stay_apart(spark, warehouse):
    from quitanda.operators.keys import task_starts, with_dense_number

    numbers = [1, 5, 2**33 + 1, 2**33 + 2, 3 * 2**33 + 4, 2**62 + 1]
    rows = spark.createDataFrame([(n,) for n in numbers], "n bigint").repartition(3)
    dense = with_dense_number(rows, "n", "dense", task_starts(rows, "n", 10))
    assert {r.n: r.dense for r in dense.collect()} == dict(zip(numbers, [11, 15, 16, 17, 21, 22]))


def test_a_failing_overwrite_leaves_the_old_fact(spark, warehouse):
    batch = staged_rows(spark, *BATCH)
    load_dimensions(warehouse, batch)
    load_fact(warehouse, batch, "vendas")
    before = sorted(map(tuple, warehouse.fact().collect()))
    fails = F.when(F.col("staging_id") > 1, F.raise_error(F.lit("lost")).cast("int"))
    broken = batch.withColumn("purchase_rating", fails)
    for name in (None, "another"):
        with pytest.raises(Exception, match="lost"):
            load_fact(warehouse, broken, "vendas", "overwrite", name or "new")
        assert sorted(map(tuple, warehouse.fact().collect())) == before
    load_fact(warehouse, batch, "vendas", "overwrite", "new")
    assert warehouse.fact().count() == 4


def test_overwriting_one_collection_leaves_the_others(spark, warehouse):
    batch = staged_rows(spark, *BATCH)
    load_dimensions(warehouse, batch)
    for _ in range(2):
        load_fact(warehouse, batch, "a", "overwrite")
        load_fact(warehouse, batch.limit(1), "b", "overwrite")
    assert warehouse.fact().count() == 5
    assert warehouse.fact().select("sk_venda").distinct().count() == 5
    undated = batch.withColumn("purchase_date", F.lit(None).cast("date"))
    load_fact(warehouse, undated, "a", "overwrite", "empty_one")
    assert warehouse.fact().count() == 1


def test_a_load_reads_no_more_of_the_fact_than_the_last_lot(spark, warehouse):
    batch = staged_rows(spark, *BATCH)
    load_dimensions(warehouse, batch)
    for i in range(3):
        load_fact(warehouse, batch, "vendas", batch=f"b{i}")
    lots = warehouse.fact_lots()
    assert len({lot.first_sale for lot in lots}) == 3
    last = max(lots, key=lambda lot: lot.first_sale)
    assert len(warehouse.fact_lot(last).inputFiles()) >= 1
    plan = warehouse.fact_lot(last)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(collection" in plan
    for lot in lots:
        folder = f"{warehouse.location}/{FACT_TABLE}/collection=vendas/lote={lot.name}"
        if lot != last:
            remove_path(spark, folder)
    assert load_fact(warehouse, batch, "vendas", batch="b3").first_sale > last.first_sale


def test_no_scratch_files_stay(spark, warehouse):
    from pathlib import Path

    load_dimensions(warehouse, staged_rows(spark, *BATCH))
    assert list(Path(warehouse.location, "_scratch").rglob("*")) == []


def test_unmatched_date_becomes_unknown(spark, warehouse):
    load_dimension(warehouse, staged_rows(spark, {}), DIM_TEMPO)
    load_dimension(warehouse, staged_rows(spark, {}), DIM_PRODUTO)
    later = staged_rows(spark, {"purchase_date": date(2030, 1, 1)})
    row = fact_rows(later, warehouse.dimensions()).first()
    assert (row.sk_tempo, row.sk_produto, row.sk_local) == (-1, 1, -1)
