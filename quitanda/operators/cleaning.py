"""Cleaning steps: each takes a DataFrame and returns one, as a projection and nothing else.

Chained with ``DataFrame.transform`` they collapse into a single projection over the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StringType, VariantType

from quitanda.functions import dates, numbers, values
from quitanda.schema import DEFAULT_TEXTS, FIELD_MAP, STAGING_TYPES, TEXT_FIELDS
from quitanda.sources.records import RECORD
from quitanda.sources.tables import staging_columns

# Cleaned column, the raw column it is read from, and the expression that reads it.
CONVERSIONS = {
    "price_cents": ("price_raw", numbers.price_cents),
    "shipping_cost_cents": ("shipping_raw", numbers.shipping_cents),
    "purchase_rating": ("rating_raw", numbers.whole_number),
    "installments_quantity": ("installments_raw", numbers.whole_number),
    "latitude": ("latitude_raw", numbers.coordinate),
    "longitude": ("longitude_raw", numbers.coordinate),
    "purchase_date": ("date_raw", dates.purchase_date),
}
NUMBER_COLUMNS = tuple(name for name in CONVERSIONS if name != "purchase_date")


def is_variant(frame: DataFrame, column: str) -> bool:
    return isinstance(frame.schema[column].dataType, VariantType)


def select_fields(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Pick and rename the known fields; a missing one is NULL, any other is dropped.

    ``raw`` has either one VARIANT column named ``record`` or one string (or VARIANT)
    column per field. ``carry`` names further columns to keep as they are.
    """
    from_record = RECORD in raw.columns and is_variant(raw, RECORD)
    picked = []
    for key, name in FIELD_MAP.items():
        if from_record:
            value, variant = values.field(F.col(RECORD), key), True
        elif key in raw.columns:
            value, variant = F.col(f"`{key}`"), is_variant(raw, key)
            if not variant and not isinstance(raw.schema[key].dataType, (StringType, NullType)):
                raise TypeError(
                    f"raw field {key!r} must be STRING or VARIANT, "
                    f"not {raw.schema[key].dataType.simpleString()}"
                )
        else:
            value, variant = F.lit(None).cast("string"), False
        if name == "product_id":
            value = values.identifier(value, variant)
        picked.append(value.alias(name))
    return raw.select(*[F.col(name) for name in carry], *picked)


def normalize_text(frame: DataFrame) -> DataFrame:
    """Lower-case and strip the text fields; NULL stays NULL."""
    return frame.withColumns(
        {
            name: values.normalized_text(F.col(name), is_variant(frame, name))
            for name in TEXT_FIELDS
            if name in frame.columns
        }
    )


def convert(frame: DataFrame, *names: str) -> DataFrame:
    """Add the named cleaned columns and drop the raw ones they were read from."""
    converted = {}
    for name in names:
        source, read = CONVERSIONS[name]
        converted[name] = read(F.col(source), is_variant(frame, source))
    return frame.withColumns(converted).drop(*[CONVERSIONS[name][0] for name in names])


def is_given(frame: DataFrame, source: str) -> Column:
    """Whether a raw value is there to be converted; a blank date text is not."""
    variant, value = is_variant(frame, source), F.col(source)
    given = value.isNotNull()
    if variant:
        given = given & ~F.is_variant_null(value)
    if source == CONVERSIONS["purchase_date"][0]:
        given = given & (values.strip(values.text_of(value, variant)) != F.lit(""))
        if variant:
            given = given & (F.schema_of_variant(value) == "STRING")
    return given


def convert_counting(frame: DataFrame, rejects: Observation) -> DataFrame:
    """All conversions. The values that none could read are counted as the rows pass."""
    converted = frame.withColumns(
        {name: read(F.col(raw), is_variant(frame, raw)) for name, (raw, read) in CONVERSIONS.items()}
    )
    counts = [
        F.count_if(is_given(frame, raw) & F.col(name).isNull()).alias(name)
        for name, (raw, _) in CONVERSIONS.items()
    ]
    return converted.observe(rejects, *counts).drop(*[raw for raw, _ in CONVERSIONS.values()])


def convert_numbers(frame: DataFrame) -> DataFrame:
    return convert(frame, *NUMBER_COLUMNS)


def convert_dates(frame: DataFrame) -> DataFrame:
    return convert(frame, "purchase_date")


def apply_defaults(frame: DataFrame) -> DataFrame:
    """Give every staging column, with the default text where a text field is NULL."""
    present = set(frame.columns)
    filled = {}
    for name, type_name in STAGING_TYPES.items():
        default = F.lit(DEFAULT_TEXTS.get(name))
        if name not in present:
            filled[name] = default.cast(type_name)
        elif name in DEFAULT_TEXTS:
            filled[name] = F.coalesce(F.col(name), default)
    return frame.withColumns(filled)


def add_load_timestamp(frame: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """Stamp all rows with one UTC time, fixed now and not when the plan runs."""
    loaded_at = loaded_at or datetime.now(timezone.utc)
    text = loaded_at.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    return frame.withColumn("etl_load_timestamp", F.lit(text).cast("timestamp_ntz"))


def clean_records(
    raw: DataFrame, loaded_at: datetime | None = None, rejects: Observation | None = None
) -> DataFrame:
    """All cleaning steps. No row is dropped; numbers keep their widest type.

    The result fits ``load_staging``, whose insert narrows the numbers and fails on a
    value out of range; ``to_staging_types`` does the same without a table. ``rejects``
    observes, in the same pass, how many raw values each conversion turned into NULL.
    """
    texts = normalize_text(select_fields(raw))
    if rejects is None:
        converted = texts.transform(convert_numbers).transform(convert_dates)
    else:
        converted = convert_counting(texts, rejects)
    return (
        converted.transform(apply_defaults)
        .transform(add_load_timestamp, loaded_at)
        .transform(staging_columns)
    )


def to_staging_types(cleaned: DataFrame) -> DataFrame:
    """Staging columns in their final types; a number out of range raises."""
    return staging_columns(cleaned).select(
        *[F.col(name).cast(type_name).alias(name) for name, type_name in STAGING_TYPES.items()]
    )
