"""Small inputs in both raw forms, and the conversion rules stated in plain Python."""

from __future__ import annotations

import json
import re
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from quitanda.schema import FIELD_MAP, STAGING_TYPES


def variant_records(spark, records: list[dict]):
    """Records as one VARIANT column, the way a JSON feed is read."""
    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "line string")
    return lines.select(F.parse_json("line").alias("record"))


def string_records(spark, records: list[dict]):
    """Records as one string column per field."""
    schema = ", ".join(f"`{key}` string" for key in FIELD_MAP)
    return spark.createDataFrame([tuple(r.get(key) for key in FIELD_MAP) for r in records], schema)


STAGED = {
    "product_id": None,
    "product_name": "celular",
    "category_name": "eletronicos",
    "price_cents": 1000,
    "shipping_cost_cents": 100,
    "purchase_date": date(2024, 5, 3),
    "seller_name": "ana",
    "purchase_location_code": "sp",
    "purchase_rating": 5,
    "payment_type": "boleto",
    "installments_quantity": 1,
    "latitude": None,
    "longitude": None,
    "etl_load_timestamp": datetime(2024, 6, 1, 12, 0),
}


def staged_rows(spark, *changes: dict):
    """Staging rows with a staging id; each dict changes some columns of a standard row."""
    schema = "staging_id bigint, " + ", ".join(f"{n} {t}" for n, t in STAGING_TYPES.items())
    rows = [
        (i + 1, *[Decimal(v) if n in ("latitude", "longitude") and v is not None else v
                  for n, v in (STAGED | change).items()])
        for i, change in enumerate(changes)
    ]
    return spark.createDataFrame(rows, schema)


def python_cents(value):
    try:
        return int(float(value) * 100)
    except (ValueError, TypeError, OverflowError):
        return None


def python_int(value):
    try:
        return int(value)
    except (ValueError, TypeError, OverflowError):
        return None


def python_freight(value):
    found = re.search(r"(\d+\.?\d*|\.\d+)", str(value))
    return python_cents(found.group(1)) if found else None


def python_date(value):
    try:
        return datetime.strptime(value, "%d/%m/%Y").date()
    except (ValueError, TypeError):
        return None
