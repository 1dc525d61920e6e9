from __future__ import annotations

import gzip
import json
import re

import pytest
from pyspark.sql import functions as F

from fixtures import adapter
from fixtures.warehouse import SalesFixture
from quitanda.operators import lookups
from quitanda.settings import session_setting
from quitanda.sources.records import read_records, record_field


def test_lists_are_bounded_and_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(adapter, "RECORDS_PER_LIST", 50)
    names = [F.lit("x").alias(name) for name in adapter.RAW_FIELDS if name != "id"]
    raw = spark.range(1000).select(
        F.col("id").alias("l_orderkey"), F.col("id").cast("string").alias("id"), *names
    )
    adapter.write_lists(raw, str(tmp_path / "lists"))
    lists = [json.loads(p.read_text()) for p in (tmp_path / "lists").glob("part-*")]
    assert len(lists) == 20
    assert sorted(int(r["id"]) for records in lists for r in records) == list(range(1000))


def sales(spark, rows):
    """Raw records whose ids are 0, 1 and so on, the other fields always the same."""
    names = [F.lit("a text of some length").alias(name) for name in adapter.RAW_FIELDS if name != "id"]
    numbers = spark.range(rows, numPartitions=4)
    return numbers.select(
        F.col("id").alias("l_orderkey"), F.col("id").cast("string").alias("id"), *names
    )


def ids(records):
    return sorted(int(row.id) for row in records.select(record_field("id", "string").alias("id")).collect())


def test_the_feed_is_compressed_bounded_and_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(adapter, "RECORDS_PER_LIST", 500)
    raw = sales(spark, 4000)
    adapter.write_feed(raw, str(tmp_path / "feed"))
    files = list((tmp_path / "feed").glob("part-*"))
    lines = [gzip.decompress(p.read_bytes()).splitlines() for p in files]
    assert sorted(len(found) for found in lines) == [500] * 8
    assert 5 * sum(p.stat().st_size for p in files) < sum(len(x) for found in lines for x in found)
    assert ids(read_records(spark, str(tmp_path / "feed"))) == list(range(4000))


def test_lists_beyond_a_fixed_number_of_records_are_compressed_and_not_shuffled(
    spark, tmp_path, monkeypatch
):
    monkeypatch.setattr(adapter, "RECORDS_PER_LIST", 300)
    monkeypatch.setattr(adapter, "PLAIN_RECORDS", 500)
    adapter.write_lists(sales(spark, 4000), str(tmp_path / "lists"))
    plain = [json.loads(p.read_text()) for p in (tmp_path / "lists").glob("part-*.txt")]
    files = list((tmp_path / "lists").glob("part-*.txt.gz"))
    compressed = [json.loads(gzip.decompress(p.read_bytes())) for p in files]
    assert len(plain) == 4 and 300 < sum(map(len, plain)) < 700
    # Each of the four tasks has less than 1000 records left, so four lists at most.
    assert all(0 < len(records) <= 300 for records in compressed) and 12 <= len(files) <= 16
    assert ids(read_records(spark, str(tmp_path / "lists"), multi_line=True)) == list(range(4000))


def test_a_full_list_is_followed_by_no_empty_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(adapter, "RECORDS_PER_LIST", 50)
    records = spark.range(600, numPartitions=4).selectExpr("concat('{\"id\":\"', id, '\"}') AS value")
    adapter._write_documents(records, str(tmp_path / "lists"), "gzip")
    files = list((tmp_path / "lists").glob("part-*.txt.gz"))
    assert [len(json.loads(gzip.decompress(p.read_bytes()))) for p in files] == [50] * 12
    adapter._write_documents(records.where("value = ''"), str(tmp_path / "none"), "gzip")
    assert ids(read_records(spark, str(tmp_path / "none"), multi_line=True)) == []


@pytest.fixture
def large_tables(spark, monkeypatch):
    """Every table but the suppliers counts as too large for a broadcast."""
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 100)
    with session_setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        yield "/root/testdata/sf0.001"


def test_sales_are_shuffled_once_at_a_time(spark, large_tables, tmp_path):
    """By order, which is written with its customer, and then by part."""
    scratch = str(tmp_path / "ordered")
    sales = adapter.raw_sales(spark, large_tables, scratch)
    ordered = spark.read.parquet(scratch)
    assert ordered.count() == 6000 and {"c_nationkey", "o_orderpriority"} < set(ordered.columns)
    plan = sales._jdf.queryExecution().executedPlan().toString()
    shuffled = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(shuffled) == ["l_partkey", "p_partkey"]


def test_landing_the_sales_leaves_no_shuffle_files(spark, large_tables):
    def shuffle_files():
        store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        blocks = store.getAllBlocks()
        names = [blocks.apply(i).name() for i in range(blocks.size())]
        return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}

    before = shuffle_files()
    raw = SalesFixture(spark, large_tables).raw
    assert shuffle_files() <= before
    assert raw.count() == 6000
