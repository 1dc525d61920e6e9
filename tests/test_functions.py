from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quitanda.functions import dates, numbers, values
from quitanda.functions.values import WHITESPACE
from quitanda.operators.cleaning import clean_records, to_staging_types
from tests.helpers import (
    python_cents,
    python_date,
    python_freight,
    python_int,
    variant_records,
)


def read_strings(spark, expression, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    rows = frame.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
    return [row.r for row in rows]


def read_variants(spark, expression, raw_values):
    frame = variant_records(spark, [{"i": i, "v": v} for i, v in enumerate(raw_values)])
    rows = frame.select(
        F.try_variant_get("record", "$.i", "int").alias("i"),
        expression(values.field(F.col("record"), "v"), True).alias("r"),
    )
    return [row.r for row in rows.orderBy("i").collect()]


TEXT_CASES = {
    "  ABC ": "abc",
    "\tA b\n": "a b",
    "ÇÃO": "ção",
    "   ": "",
    "": "",
    "  x　 ": "x",
    " \t \x1cy\x1f \r\n": "y",
}


def test_text_is_lowered_and_stripped(spark):
    got = read_strings(spark, values.normalized_text, [*TEXT_CASES, None])
    assert got == [*TEXT_CASES.values(), None]
    got = read_variants(spark, values.normalized_text, [*TEXT_CASES, None, 17, True])
    assert got == [*TEXT_CASES.values(), None, "17", "true"]


def test_whitespace_is_what_python_strips():
    assert sorted(WHITESPACE) == sorted(chr(c) for c in range(0x110000) if chr(c).isspace())


def test_identifier(spark):
    assert read_strings(spark, values.identifier, ["", "17", None]) == [None, "17", None]
    got = read_variants(spark, values.identifier, ["", "17", 17, None, True, "true"])
    assert got == [None, "17", "17", None, "True", "true"]


PRICES = ["19.99", "1e3", " 12 ", "1,5", "x", "nan", "inf", "-5", "1.5d", "0x1p3", "", ".5", "5.",
          "+7", "1e400", "\u20033\u00a0", "--1", "1 2", "1_000.5_0", "1__0", "_1", "1_", "1_.5",
          "1._5", "1e1_0", "1e_1", ".", "+", "e5", "1e", "\x004", "9" * 400, "1" * 5000 + "x"]


def test_price_from_text(spark):
    assert read_strings(spark, numbers.price_cents, PRICES) == [python_cents(p) for p in PRICES]


def test_price_from_json(spark):
    given_values = [19.99, "19.99", 4, 10000000.0, 1e16, True, False, None, {"a": 1}, [1], "x", -0.5]
    got = read_variants(spark, numbers.price_cents, given_values)
    assert got == [python_cents(v) for v in given_values]


FREIGHTS = ["R$ 12.50", "12,50", "1.234,56", "-.75", "grátis", "-5.00", "", "12.", "a1b2"]


def test_freight_from_text(spark):
    got = read_strings(spark, numbers.shipping_cents, FREIGHTS)
    assert got == [python_freight(v) for v in FREIGHTS]


def test_freight_from_json(spark):
    given_values = [*FREIGHTS, 10000000.0, 9.24, 7, 1.5e16]
    got = read_variants(spark, numbers.shipping_cents, given_values)
    assert got == [python_freight(v) for v in given_values]


INTS = ["4", "4.9", " 4 ", "x", "-3", "+2", "", "1e3", "4.", "\t5\n", "\u00a06", "1_000", "1__0",
        "_1", "1_", "\x004"]


def test_whole_number_from_text(spark):
    assert read_strings(spark, numbers.whole_number, INTS) == [python_int(v) for v in INTS]


def test_whole_number_from_json(spark):
    given_values = [4, 4.9, -4.9, "4.9", " 4 ", "1_0", True, False, "x", None, [4], 1e2]
    got = read_variants(spark, numbers.whole_number, given_values)
    assert got == [python_int(v) for v in given_values]


def test_coordinate_is_rounded_half_up(spark):
    def stored(value, variant=False):
        return numbers.coordinate(value, variant).cast("decimal(10,7)")

    got = read_strings(spark, stored, ["-22.19", "n/d", "12.34567895", "inf"])
    assert got == [Decimal("-22.1900000"), None, Decimal("12.3456790"), None]
    got = read_variants(spark, stored, [-22.19, "n/d", 12.34567895])
    assert got == [Decimal("-22.1900000"), None, Decimal("12.3456790")]


DATES = ["01/02/2020", "1/2/2020", "31/02/2020", " 01/02/2020", "01/02/2020 ", "01/02/20",
         "01/02/12020", "001/02/2020", "", "abc", "29/02/2024", "29/02/2023", "01/02/0000",
         " 1/02/2020", "01/02/2020\n", "1/13/2020", "32/01/2020", "01-02-2020"]


def test_dates(spark):
    assert read_strings(spark, dates.purchase_date, DATES) == [python_date(d) for d in DATES]
    got = read_variants(spark, dates.purchase_date, [*DATES, 1022020, True])
    assert got == [*[python_date(d) for d in DATES], None, None]


def test_calendar(spark):
    frame = spark.createDataFrame([(date(2024, 5, 5),), (date(2024, 12, 31),)], "d date")
    columns = [column.alias(name) for name, column in dates.calendar(F.col("d")).items()]
    first, last = frame.select(*columns).collect()
    assert first.asDict() == {
        "ano": 2024,
        "mes": 5,
        "dia": 5,
        "nome_dia_semana": "Sunday   ",
        "nome_mes": "May      ",
        "trimestre": 2,
        "semestre": 1,
    }
    assert (last.trimestre, last.semestre, last.nome_mes) == (4, 2, "December ")


@pytest.mark.parametrize(
    "day, kind",
    [
        (date(2024, 5, 5), "Fim de Semana"),
        (date(2024, 5, 4), "Fim de Semana"),
        (date(2024, 5, 3), "Dia Útil"),
    ],
)
def test_day_kind(spark, day, kind):
    frame = spark.createDataFrame([(day,)], "d date")
    assert frame.select(dates.day_kind(F.col("d"))).first()[0] == kind


pieces = st.text(alphabet="0123456789_.,+-eE R$\t x/", max_size=12)
many = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def fits_long(cents):
    """Numbers beyond BIGINT end at its limits."""
    return cents if cents is None else max(-(2**63) + 1, min(2**63 - 1, cents))


@pytest.mark.parametrize(
    "raw", ["1e17", "-1e17", "99999999999999999999", "9" * 400, 1e30, -1e30, 10**20, 2**62]
)
def test_finite_numbers_out_of_range_stay_for_the_insert_to_refuse(spark, raw):
    frame = variant_records(spark, [{"Preço": raw, "Avaliação da compra": raw}])
    row = clean_records(frame).first()
    expected = 1 if not str(raw).startswith("-") else -1
    whole = isinstance(raw, str) and "e" in raw
    assert row.purchase_rating is None if whole else expected * row.purchase_rating > 2**31
    if raw == "9" * 400:
        assert row.price_cents is None  # an infinite double
    else:
        assert expected * row.price_cents > 2**31
        with pytest.raises(Exception, match="CAST_OVERFLOW"):
            to_staging_types(clean_records(frame)).collect()


@pytest.mark.parametrize("raw", ["1e400", "inf", "-Infinity", "nan"])
def test_what_is_no_finite_number_is_null(spark, raw):
    row = clean_records(variant_records(spark, [{"Preço": raw, "Frete": raw}])).first()
    assert row.price_cents is None


@many
@given(st.lists(pieces, min_size=200, max_size=300))
def test_any_text_converts_as_in_python(spark, texts):
    expected = [fits_long(python_cents(t)) for t in texts]
    assert read_strings(spark, numbers.price_cents, texts) == expected
    expected = [fits_long(python_freight(t)) for t in texts]
    assert read_strings(spark, numbers.shipping_cents, texts) == expected
    expected = [fits_long(python_int(t)) for t in texts]
    assert read_strings(spark, numbers.whole_number, texts) == expected
    assert read_strings(spark, values.normalized_text, texts) == [t.lower().strip() for t in texts]


day_texts = st.tuples(
    st.integers(0, 33), st.integers(0, 14), st.sampled_from([0, 1, 99, 1999, 2024, 12020])
).map(lambda d: f"{d[0]}/{d[1]:02d}/{d[2]:04d}")


@many
@given(st.lists(day_texts | pieces, min_size=200, max_size=300))
def test_any_date_text_parses_as_in_python(spark, texts):
    assert read_strings(spark, dates.purchase_date, texts) == [python_date(t) for t in texts]
