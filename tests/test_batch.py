from __future__ import annotations

import json
from dataclasses import replace
from types import SimpleNamespace

import pytest

from quitanda.plans.batch import BatchConfig, run_batch
from quitanda.plans.marts import monthly_sales, sales_by_category
from quitanda.plans.populate import OrphanKeys
from quitanda.settings import new_shared_path, shared_folder
from quitanda.sources.tables import Warehouse

SALE = {
    "Produto": "Celular",
    "Categoria do Produto": "Eletronicos",
    "Preço": 10.0,
    "Frete": 1,
    "Data da Compra": "03/05/2024",
    "Vendedor": "Ana",
    "Local da compra": "SP",
    "Avaliação da compra": 5,
    "Tipo de pagamento": "boleto",
    "Quantidade de parcelas": 1,
    "lat": -22.19,
    "lon": -48.79,
}


@pytest.fixture
def config(tmp_path):
    return BatchConfig(
        raw_path=str(tmp_path / "raw"),
        warehouse_path=str(tmp_path / "dw"),
        database=f"batch_{abs(hash(str(tmp_path))):x}",
        feed_path=str(tmp_path / "feed.json"),
        multi_line=True,
    )


def put_feed(config, payload):
    with open(config.feed_path, "w", encoding="utf-8") as file:
        file.write(payload if isinstance(payload, str) else json.dumps(payload, indent=1))


def counts(spark, config):
    warehouse = Warehouse(spark, config.database, config.warehouse_path)
    return warehouse.staging(config.collection).count(), warehouse.fact().count()


def test_full_run(spark, config):
    put_feed(config, [SALE, SALE | {"Vendedor": "Bia"}, SALE | {"Data da Compra": "?"}])
    result = run_batch(spark, config)
    assert result.landed and result.staged and result.populated
    assert result.rows == {"raw": 3, "staging": 3, "fact": 2}
    assert counts(spark, config) == (3, 2)
    warehouse = Warehouse(spark, config.database, config.warehouse_path)
    mart = sales_by_category(warehouse.fact(), warehouse.dimensions())
    assert [tuple(r) for r in mart.collect()] == [("eletronicos", 2, 20.0, 22.0, 11.0)]


@pytest.mark.parametrize("second", ["[]", "{broken", "5", None])
def test_without_new_records_the_last_batch_is_loaded_again(spark, config, second):
    put_feed(config, [SALE])
    run_batch(spark, config)
    if second is None:
        config = replace(config, feed_path=config.feed_path + ".gone")
    else:
        put_feed(config, second)
    result = run_batch(spark, config)
    assert not result.landed and result.populated
    assert counts(spark, config) == (1, 2)


def test_overwrite_mode_does_not_count_twice(spark, config):
    config = replace(config, fact_mode="overwrite")
    put_feed(config, [SALE, SALE])
    for _ in range(2):
        run_batch(spark, config)
    assert counts(spark, config) == (2, 2)


def test_nothing_ever_landed_leaves_the_warehouse_alone(spark, config):
    put_feed(config, [])
    result = run_batch(spark, config)
    assert not (result.landed or result.staged or result.populated)
    assert counts(spark, config) == (0, 0)


def test_list_element_that_is_no_record_stops_the_run(spark, config):
    put_feed(config, [SALE])
    run_batch(spark, config)
    put_feed(config, [SALE, "x"])
    with pytest.raises(Exception, match="NOT_A_RECORD"):
        run_batch(spark, config)
    assert counts(spark, config) == (1, 1)


def test_strict_keys_refuse_unknown_members(spark, config):
    config = replace(config, strict_keys=True)
    put_feed(config, [SALE, SALE | {"Categoria do Produto": "Outros"}])
    with pytest.raises(OrphanKeys, match="sk_produto: 1"):
        run_batch(spark, config)
    assert counts(spark, config) == (2, 0)
    put_feed(config, [SALE])
    run_batch(spark, config)
    assert counts(spark, config) == (1, 1)


def test_second_batch_adds_members_and_sales(spark, config):
    put_feed(config, [SALE])
    run_batch(spark, config)
    put_feed(config, SALE | {"Vendedor": "Zoe"})
    run_batch(spark, config)
    warehouse = Warehouse(spark, config.database, config.warehouse_path)
    members = warehouse.read("dim_vendedor").orderBy("sk_vendedor").collect()
    assert [(r.sk_vendedor, r.nome_vendedor) for r in members] == [(1, "ana"), (2, "zoe")]
    assert warehouse.read("dim_produto").count() == 1
    assert counts(spark, config) == (1, 2)


def test_reports_can_be_written_in_sql(spark, config):
    put_feed(config, [SALE, SALE | {"Data da Compra": "09/06/2024"}, SALE | {"Preço": 0.5}])
    run_batch(spark, config)
    by_seller = spark.sql(
        f"""
        WITH amounts AS (
          SELECT sk_vendedor, sum(preco_cents) AS goods, max(preco_cents) AS dearest
          FROM {config.database}.fato_vendas GROUP BY ALL
        )
        SELECT seller.nome_vendedor, goods, dearest
        FROM {config.database}.dim_vendedor AS seller JOIN amounts USING (sk_vendedor)
        """
    )
    assert [tuple(r) for r in by_seller.collect()] == [("ana", 2050, 1000)]
    warehouse = Warehouse(spark, config.database, config.warehouse_path)
    mart = monthly_sales(warehouse.fact(), warehouse.dimensions()).drop("nome_mes")
    assert [tuple(r) for r in mart.collect()] == [(2024, 5, 2, 12.5), (2024, 6, 1, 11.0)]


def test_a_run_reports_its_rejects_without_another_scan(spark, config):
    put_feed(config, [SALE, SALE | {"Preço": "x", "lat": "?"}, SALE | {"Preço": "y", "Frete": None}])
    assert run_batch(spark, config).rejects == {"price_cents": 2, "latitude": 1}
    put_feed(config, [SALE])
    assert run_batch(spark, config).rejects == {}


def test_repeated_keys_keep_the_last_value(spark, config):
    text = json.dumps([SALE])
    put_feed(config, text.replace('"Vendedor": "Ana"', '"Vendedor": "Ana", "Vendedor": "Zoe"'))
    for multi_line in (True, False):
        result = run_batch(spark, replace(config, multi_line=multi_line, collection=f"m{multi_line:d}"))
        assert result.landed and result.rows["fact"] == 1
    warehouse = Warehouse(spark, config.database, config.warehouse_path)
    assert [r.nome_vendedor for r in warehouse.read("dim_vendedor").collect()] == ["zoe"]


def test_a_resource_limit_is_no_malformed_feed(spark, config):
    from quitanda.sources.records import PARSE_BYTES

    put_feed(config, [SALE])
    run_batch(spark, config)
    put_feed(config, "[" + json.dumps({"Produto": "x" * PARSE_BYTES}) + ", 5")
    with pytest.raises(Exception, match="UNREADABLE_FEED"):
        run_batch(spark, config)
    assert counts(spark, config) == (1, 1)


class Session:
    """As much of a session as the folder helpers look at."""

    def __init__(self, master, **settings):
        self.conf = settings
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{id(self)}")


def test_shared_folder_is_the_one_the_cluster_names():
    named = Session("spark://host", **{"spark.checkpoint.dir": "hdfs://x/shared/"})
    assert shared_folder(named) == "hdfs://x/shared"
    path = new_shared_path(named, "x")
    assert path.startswith("hdfs://x/shared/quitanda/x-") and path != new_shared_path(named, "x")


def test_without_a_checkpoint_folder_the_warehouse_is_shared():
    unnamed = Session("spark://host", **{"spark.sql.warehouse.dir": "hdfs://x/warehouse"})
    assert shared_folder(unnamed) == "hdfs://x/warehouse"
