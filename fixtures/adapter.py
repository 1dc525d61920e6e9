"""Raw sale records out of the test tables: one per lineitem row, with planted defects.

The expressions are those of FIXTURES.md; the oracle states them again in its own SQL.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.operators.lookups import join_keyed
from quitanda.settings import spread

ROW_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

RAW_FIELDS = {
    "id": """case when l_orderkey % 173 = 0 then '' when l_orderkey % 179 = 0 then null
        else cast(l_partkey as string) end""",
    "Produto": """case when l_orderkey % 211 = 0 then null
        else concat('  ', upper(p_name), ' ') end""",
    "Categoria do Produto": "case when l_orderkey % 223 = 0 then null else p_type end",
    "Preço": """case when l_orderkey % 101 = 0 then 'sob consulta'
        when l_orderkey % 103 = 0 then null else cast(l_extendedprice as string) end""",
    "Frete": """case when l_orderkey % 107 = 0 then 'gratis' when l_orderkey % 109 = 0 then null
        when l_orderkey % 113 = 0 then concat(cast(cast(l_quantity as int) as string), ',90')
        else concat('R$ ', cast(l_quantity as string)) end""",
    "Data da Compra": """case when l_orderkey % 127 = 0 then '31/02/2000'
        when l_orderkey % 131 = 0 then null
        when l_orderkey % 137 = 0 then date_format(l_shipdate, 'd/M/yyyy')
        else date_format(l_shipdate, 'dd/MM/yyyy') end""",
    "Vendedor": "case when l_orderkey % 139 = 0 then null else s_name end",
    "Local da compra": """case when l_orderkey % 149 = 0 then null
        else concat(chr(65 + c_nationkey), 'X ') end""",
    "Avaliação da compra": """case when l_orderkey % 151 = 0 then '4.5'
        when l_orderkey % 157 = 0 then null else cast(1 + l_linenumber % 5 as string) end""",
    "Tipo de pagamento": """case when l_orderkey % 163 = 0 then null
        else o_orderpriority end""",
    "Quantidade de parcelas": """case when l_linenumber = 7 then null
        else cast(l_linenumber as string) end""",
    "lat": """case when l_orderkey % 167 = 0 then 'n/d'
        else cast(c_nationkey * -1.25 as string) end""",
    "lon": "cast(-30 - c_nationkey * 0.5 as string)",
}


def raw_sales(spark: SparkSession, sf_dir: str, scratch: str) -> DataFrame:
    """Raw records under their feed names, with the row keys of lineitem in front.

    Sales with their orders are written to ``scratch``, which the caller removes afterwards, so
    what was shuffled for them can go before the next join shuffles them again.
    """

    def table(name: str, *columns: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)

    lineitem = table(
        "lineitem", *ROW_KEYS, "l_quantity", "l_extendedprice", "l_shipdate"
    )
    lineitem = spread(lineitem.withColumn("row_number", F.monotonically_increasing_id()))
    orders = table("orders", "o_orderkey", "o_custkey", "o_orderpriority")
    orders = orders.withColumn("order_row", F.monotonically_increasing_id())
    customer = table("customer", "c_custkey", "c_nationkey")
    # Orders meet their customers before the sales do, and the texts of parts come last, as what
    # is shuffled for the joins is many times the tables themselves.
    placed = join_keyed(orders, customer, {"c_custkey": "o_custkey"}, "order_row", how="inner")
    placed = placed.drop("o_custkey", "order_row")
    ordered = join_keyed(
        lineitem, placed, {"o_orderkey": "l_orderkey"}, "row_number", how="inner", keys_from=lineitem
    )
    ordered.write.parquet(scratch, compression="zstd")
    sales = spread(spark.read.schema(ordered.schema).parquet(scratch))
    for keyed, on in (
        (table("part", "p_partkey", "p_name", "p_type"), {"p_partkey": "l_partkey"}),
        (table("supplier", "s_suppkey", "s_name"), {"s_suppkey": "l_suppkey"}),
    ):
        sales = join_keyed(sales, keyed, on, "row_number", how="inner", keys_from=lineitem)
    return sales.select(
        *ROW_KEYS, *[F.expr(sql).alias(name) for name, sql in RAW_FIELDS.items()]
    )


# Fields of every seventh order are written as JSON numbers where they are numbers.
DECIMAL, WHOLE = r"^-?[1-9]\d*(\.\d*[1-9])?$", r"^[1-9]\d*$"
NUMBER_FIELDS = {
    "Preço": DECIMAL,
    "Avaliação da compra": WHOLE,
    "Quantidade de parcelas": WHOLE,
    "lat": DECIMAL,
}


def _json_field(name: str) -> Column:
    value = F.col(f"`{name}`")
    if name not in NUMBER_FIELDS:
        return value
    is_number = (F.col("l_orderkey") % 7 == 1) & value.rlike(NUMBER_FIELDS[name])
    quoted = F.concat(F.lit('"'), value, F.lit('"'))
    return F.try_parse_json(F.when(is_number, value).otherwise(quoted))


def _json_records(raw: DataFrame) -> DataFrame:
    """Records as JSON, every eleventh order's without its NULL fields, the others' with them.

    Every nineteenth order's have a key that no sale record has, and ``lon`` twice.
    """
    record = F.struct(*[_json_field(name).alias(name) for name in RAW_FIELDS])
    whole = F.to_json(record, {"ignoreNullFields": "false"})
    short = F.col("l_orderkey") % 11 == 0
    text = F.when(short, F.to_json(record)).otherwise(whole)
    more = F.concat(F.lit('{"lon":"0","extra":{"a":1},'), F.substr(text, F.lit(2)))
    text = F.when(F.col("l_orderkey") % 19 == 0, more).otherwise(text)
    return raw.select("l_orderkey", text.alias("value"))


# Records of a list document at most, about, and of a file of the feed: more of them make more files.
RECORDS_PER_LIST = 500_000


def write_feed(raw: DataFrame, path: str) -> None:
    """Write raw records as a newline-delimited JSON feed, with numbers and nulls in it.

    As text a record takes many times the disk of its row in the test tables, so the feed is
    compressed. A task reads a compressed file alone, so files are bounded.
    """
    files = _json_records(raw).select("value").write.option("maxRecordsPerFile", RECORDS_PER_LIST)
    files.text(path, compression="gzip")


# Records in list documents of plain text, about. Further records come in compressed documents,
# so the disk that plain text takes doesn't grow with the tables.
PLAIN_RECORDS = 200_000


def write_lists(raw: DataFrame, path: str, files: int = 4) -> None:
    """Write raw records as JSON documents, each a list over many lines: ``files`` or more.

    A task writes its documents record by record, so none is held as a whole. Plain documents
    are read by ranges, compressed ones as a whole by a task. The first are few and gather their
    records from all tasks; the others, all but these, are written where their records are read.
    """
    rows = raw.count()
    if rows > PLAIN_RECORDS:
        is_plain = F.pmod(F.xxhash64("l_orderkey", "id"), F.lit(rows)) < PLAIN_RECORDS
        _write_documents(_json_records(raw.where(~is_plain)).select("value"), path, "gzip")
        raw, rows = raw.where(is_plain), PLAIN_RECORDS
    files = max(files, -(-rows // RECORDS_PER_LIST))
    dealt = _json_records(raw).withColumn("row", F.xxhash64("value"))
    _write_documents(dealt.repartition(files, "l_orderkey", "row").select("value"), path)


def _write_documents(records: DataFrame, path: str, compression: str | None = None) -> None:
    """One document for each task; compressed ones are bounded, so a task can write several."""
    most = RECORDS_PER_LIST if compression else sys.maxsize

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = 0
        yield pa.RecordBatch.from_pydict({"value": ["["]})
        for batch in batches:
            left = batch.column(0).cast(pa.string())
            while len(left):
                if held == most:
                    held = 0
                    yield pa.RecordBatch.from_pydict({"value": ["]", "["]})
                # The first of a list alone, as all others have a comma before them.
                part = left.slice(0, most - held if held else 1)
                lines = pc.binary_join_element_wise(",", part, "") if held else part
                yield pa.RecordBatch.from_arrays([lines], ["value"])
                left, held = left.slice(len(part)), held + len(part)
        yield pa.RecordBatch.from_pydict({"value": ["]"]})

    files = records.mapInArrow(documents, "value string").write.mode("append")
    if compression:
        # A list of ``most`` records has two lines more, so each file holds one list.
        files = files.option("maxRecordsPerFile", most + 2)
    files.text(path, compression=compression)
