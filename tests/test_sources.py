from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quitanda.operators.cleaning import clean_records, select_fields
from quitanda.schema import STAGING_TABLE, TABLES
from quitanda.sources.landing import land_raw, landed_or_none, scan_raw
from quitanda.sources.records import CachedFeed, is_malformed_feed, read_records, record_field
from quitanda.sources.tables import (
    comment_on_column,
    comment_on_table,
    load_staging,
    set_up_tables,
)
from tests.helpers import string_records, variant_records


def price():
    return F.try_variant_get("record", "$['Preço']", "string").alias("p")


def feed(spark, tmp_path, text, multi_line=False):
    path = tmp_path / "feed.json"
    path.write_text(text, encoding="utf-8")
    return read_records(spark, str(path), multi_line)


@pytest.mark.parametrize(
    "payload, prices",
    [
        ([{"Preço": 1.5}, {"Preço": "2"}], ["1.5", "2"]),
        ({"Preço": 3}, ["3"]),
        ([], []),
        ([{}], [None]),
        ("text", []),
        (5, []),
        (None, []),
    ],
)
@pytest.mark.parametrize("multi_line", [False, True])
def test_payload_shapes(spark, tmp_path, payload, prices, multi_line):
    text = json.dumps(payload, indent=1 if multi_line else None)
    rows = feed(spark, tmp_path, text, multi_line).select(price()).collect()
    assert [row.p for row in rows] == prices


def test_newline_delimited_feed(spark, tmp_path):
    records = feed(spark, tmp_path, '{"Preço":1}\n{"Preço":2}\n\n[{"Preço":3}]\n')
    assert sorted(row.p for row in records.select(price()).collect()) == ["1", "2", "3"]


def test_malformed_feed_fails_the_read(spark, tmp_path):
    with pytest.raises(Exception) as failure:
        feed(spark, tmp_path, '{"Preço":1}\n{"Preço":\n').collect()
    assert is_malformed_feed(failure.value)


def test_list_element_that_is_no_object_fails_the_read(spark, tmp_path):
    with pytest.raises(Exception) as failure:
        feed(spark, tmp_path, '[{"Preço":1}, 5]').collect()
    assert "NOT_A_RECORD" in str(failure.value)
    assert not is_malformed_feed(failure.value)


def test_cached_feed(spark, tmp_path):
    path = tmp_path / "feed.json"
    path.write_text("[]")
    reads = []

    def read():
        reads.append(1)
        return read_records(spark, str(path))

    cached = CachedFeed(read)
    assert cached.get().count() == 0
    path.write_text('[{"Preço":1}]')
    assert cached.get().count() == 1
    path.write_text('[{"Preço":1},{"Preço":2}]')
    assert cached.get().count() == 1
    assert cached.get(force_refresh=True).count() == 2
    assert len(reads) == 3
    cached.release()


def test_landing_replaces_unless_empty(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert landed_or_none(spark, path, "vendas") is None
    assert land_raw(string_records(spark, [{"Preço": "1"}, {"Preço": "2"}]), path, "vendas")
    assert land_raw(string_records(spark, [{"Preço": "3"}]), path, "vendas")
    assert not land_raw(string_records(spark, []), path, "vendas")
    assert [row["Preço"] for row in landed_or_none(spark, path, "vendas").collect()] == ["3"]
    assert land_raw(variant_records(spark, [{"Preço": 9}]), path, "outra")
    assert scan_raw(spark, path, "vendas").columns != scan_raw(spark, path, "outra").columns
    assert scan_raw(spark, path, "vendas").count() == 1
    with pytest.raises(ValueError):
        land_raw(string_records(spark, [{"Preço": "9"}]), path, "../outra")
    assert landed_or_none(spark, path, "nenhuma") is None


def test_landed_files_are_compressed_by_zstd(spark, tmp_path):
    land_raw(string_records(spark, [{"Preço": "1"}]), str(tmp_path / "raw"), "vendas")
    files = [path.name for path in (tmp_path / "raw").rglob("part-*")]
    assert files and all(name.endswith(".zstd.parquet") for name in files)


def test_failed_landing_keeps_the_old_records(spark, tmp_path):
    path = str(tmp_path / "raw")
    land_raw(variant_records(spark, [{"Preço": 1}]), path, "vendas")
    lines = "\n".join(['{"Preço":2}'] * 1000) + '\n{"Preço":'
    with pytest.raises(Exception):
        land_raw(feed(spark, tmp_path, lines), path, "vendas")
    assert [r.p for r in scan_raw(spark, path, "vendas").select(price()).collect()] == ["1"]


def test_scan_filters_sorts_limits_then_projects(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [{"Produto": name, "Preço": str(i)} for i, name in enumerate("dacb")]
    land_raw(string_records(spark, rows), path, "vendas")

    def products(**options):
        columns = ["Produto"]
        return [r.Produto for r in scan_raw(spark, path, "vendas", columns=columns, **options).collect()]

    assert products(sort=[F.col("`Preço`").desc()], limit=2) == ["b", "c"]
    assert products(where="Produto <> 'a'", sort=["Produto"]) == ["b", "c", "d"]
    assert sorted(products(where=F.col("`Preço`") >= "2", limit=0)) == ["b", "c"]
    assert sorted(products(limit=-1)) == ["a", "b", "c", "d"]
    plan = scan_raw(spark, path, "vendas", where="Produto = 'a'", columns=["`Preço`"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(Produto,a)" in text and "ReadSchema: struct<Produto:string,Preço:string>" in text


def test_scan_of_json_records(spark, tmp_path):
    path = str(tmp_path / "raw")
    land_raw(variant_records(spark, [{"Vendedor": s} for s in ("bia", "ana", 7)]), path, "vendas")
    seller = F.try_variant_get("record", "$.Vendedor", "string")
    found = scan_raw(spark, path, "vendas", where=seller != "ana", sort=[seller], limit=5)
    assert [r.s for r in found.select(seller.alias("s")).collect()] == ["7", "bia"]
    plan = scan_raw(spark, path, "vendas", columns=[seller.alias("s")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<record:struct<0:string>>" in text


def test_table_set_up_is_repeatable_and_finds_old_data(spark, tmp_path):
    location = str(tmp_path / "dw")
    first = set_up_tables(spark, "setup_one", location)
    load_staging(first, clean_records(string_records(spark, [{"Produto": "a"}])), "vendas")
    again = set_up_tables(spark, "setup_one", location)
    other_session = set_up_tables(spark, "setup_two", location)
    for warehouse in (again, other_session):
        assert warehouse.staging("vendas").count() == 1
        names = {row.tableName for row in spark.sql(f"SHOW TABLES IN {warehouse.database}").collect()}
        assert names == {table.name for table in TABLES}


def test_comments(spark, warehouse):
    def describe(table):
        rows = spark.sql(f"DESCRIBE EXTENDED {warehouse.name(table)}").collect()
        return {row.col_name: row.comment or row.data_type for row in rows}

    assert describe(STAGING_TABLE)["staging_id"].startswith("Unique row number")
    comment_on_table(warehouse, "fato_vendas", "it's one row per sale")
    assert describe("fato_vendas")["Comment"] == "it's one row per sale"
    comment_on_column(warehouse, "dim_local", "uf", "state")
    assert describe("dim_local")["uf"] == "state"


def test_staging_load_replaces_and_fills_missing_columns(spark, warehouse):
    for count in (3, 2):
        rows = clean_records(string_records(spark, [{"Produto": "a"}] * count)).drop("latitude")
        load_staging(warehouse, rows, "vendas")
    staged = warehouse.staging("vendas").collect()
    assert len(staged) == 2
    assert len({row.staging_id for row in staged}) == 2
    assert staged[0].latitude is None and staged[0].product_name == "a"


@pytest.mark.parametrize(
    "record",
    [
        {"Preço": "99999999999"},
        {"Categoria do Produto": "x" * 256},
        {"Local da compra": "x" * 11},
        {"lat": "1000"},
    ],
)
def test_staging_load_refuses_values_out_of_range_and_keeps_the_batch(spark, warehouse, record):
    load_staging(warehouse, clean_records(string_records(spark, [{"Produto": "old"}])), "vendas")
    bad = clean_records(string_records(spark, [record]))
    with pytest.raises(Exception):
        load_staging(warehouse, bad, "vendas")
    assert [row.product_name for row in warehouse.staging("vendas").collect()] == ["old"]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "STATIC"


def test_fields_must_be_text_or_variant(spark):
    with pytest.raises(TypeError, match="Preço"):
        select_fields(spark.createDataFrame([(1.5,)], "`Preço` double"))


def test_cleaning_on_both_raw_forms(spark):
    record = {
        "id": "7",
        "Produto": "  Celular ",
        "Preço": "19.99",
        "Frete": "R$ 3,50",
        "Data da Compra": "05/05/2024",
        "Avaliação da compra": "4",
        "lat": "-22.19",
        "ignored": "x",
    }
    stamp = datetime(2024, 6, 1)
    for raw in (string_records(spark, [record, {}]), variant_records(spark, [record, {}])):
        cleaned = clean_records(raw, stamp)
        assert raw.count() == cleaned.count() == 2
        full, empty = cleaned.orderBy(F.col("product_id").asc_nulls_last()).collect()
        assert (full.product_id, full.product_name, full.price_cents) == ("7", "celular", 1998)
        assert (full.shipping_cost_cents, full.purchase_rating) == (300, 4)
        assert str(full.purchase_date) == "2024-05-05" and full.etl_load_timestamp == stamp
        assert empty.asDict() == {
            "product_id": None,
            "product_name": "nome indisponível",
            "category_name": "outros",
            "price_cents": None,
            "shipping_cost_cents": None,
            "purchase_date": None,
            "seller_name": "vendedor desconhecido",
            "purchase_location_code": "n/a",
            "purchase_rating": None,
            "payment_type": "não especificado",
            "installments_quantity": None,
            "latitude": None,
            "longitude": None,
            "etl_load_timestamp": stamp,
        }
    assert clean_records(string_records(spark, [])).count() == 0


def test_a_list_beyond_the_size_of_one_value_lands_whole(spark, tmp_path):
    """A VARIANT holds 128 MiB at most; the list is larger than that."""
    path, record = tmp_path / "large.json", json.dumps({"Preço": 1, "extra": "x" * 100_000})
    with open(path, "w", encoding="utf-8") as file:
        file.write("[\n" + ",\n".join([record] * 1400) + "\n]")
    records = read_records(spark, str(path), multi_line=True)
    extra = F.length(F.try_variant_get("record", "$.extra", "string"))
    assert records.agg(F.count(price()), F.sum(extra)).first() == (1400, 140_000_000)


def test_unknown_keys_land_and_repeated_ones_keep_the_last(spark, tmp_path):
    for multi_line in (False, True):
        records = feed(spark, tmp_path, '[{"Preço":1,"cor":"azul"},{"Preço":2}]', multi_line)
        color = F.try_variant_get("record", "$.cor", "string").alias("cor")
        assert sorted(map(tuple, records.select(price(), color).collect())) == [("1", "azul"), ("2", None)]
        records = feed(spark, tmp_path, '[{"Preço":1,"Preço":2},{"Preço":3}]', multi_line)
        assert sorted(r.p for r in records.select(price()).collect()) == ["2", "3"]


def test_a_repeated_key_leaves_all_other_keys_in_place(spark, tmp_path):
    records = [
        '{"id":"1","id":"2","Preço":5,"extra":"keep me","deep":{"a":1,"a":{"b":2,"b":3}}}',
        '{"id":"3","Extra":7}',
    ]
    for multi_line, text in (
        (False, "\n".join(records)),
        (False, f"[{','.join(records)}]"),
        (True, f"[{','.join(records)}]"),
    ):
        rows = feed(spark, tmp_path, text, multi_line)
        names = ["id", "extra", "Extra", "deep"]
        found = rows.select(*[record_field(name, "string").alias(f"f{i}") for i, name in enumerate(names)])
        assert sorted(map(tuple, found.collect())) == [
            ("2", "keep me", None, '{"a":{"b":3}}'),
            ("3", None, "7", None),
        ]


@pytest.mark.parametrize("multi_line", [False, True])
def test_a_record_beyond_the_size_of_one_value_keeps_its_keys(spark, tmp_path, multi_line):
    """A VARIANT holds 128 MiB at most; the record is larger than that, each of its keys smaller."""
    path = tmp_path / "large.json"
    long = "x" * 14_000_000
    with open(path, "w", encoding="utf-8") as file:
        file.write('[{"Preço":1,"cor":"azul"},' if multi_line else '{"Preço":1,"cor":"azul"}\n')
        file.write('{"Preço":2,"Preço":3,"extra":"a","extra":"b"')
        for i in range(10):
            file.write(f',"k{i}":"{long}"')
        file.write("}]" if multi_line else "}\n")
    records = read_records(spark, str(path), multi_line)
    columns = [record_field(name, "string") for name in ("Preço", "extra", "cor")]
    columns += [F.length(record_field(f"k{i}", "string")) for i in (0, 9)]
    raw = str(tmp_path / "raw")
    assert land_raw(records, raw, "vendas")
    landed = scan_raw(spark, raw, "vendas", columns=[c.alias(f"c{i}") for i, c in enumerate(columns)])
    assert sorted(map(tuple, landed.collect())) == [
        ("1", None, "azul", None, None),
        ("3", "b", None, 14_000_000, 14_000_000),
    ]
    prices = clean_records(scan_raw(spark, raw, "vendas")).select("price_cents").collect()
    assert sorted(r.price_cents for r in prices) == [100, 300]
