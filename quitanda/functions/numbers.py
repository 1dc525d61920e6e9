"""Tolerant number parsing: what cannot be read becomes NULL, nothing raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quitanda.functions.values import WHITESPACE, boolean_number, text_of

# Number literals: digits, which single underscores may group. Spark's own cast also takes
# suffixes, hex floats, NaN and Infinity, and no underscores.
DIGITS = r"\d(?:_?\d)*+"
INTEGER_LITERAL = rf"[+-]?{DIGITS}"
DECIMAL_LITERAL = rf"[+-]?(?:{DIGITS}(?:\.(?:{DIGITS})?)?|\.{DIGITS})(?:[eE][+-]?{DIGITS})?"

BIGINT_LIMIT = 2**63 - 1

# Fixed value: the first number inside a freight text.
FIRST_NUMBER = r"(\d+\.?\d*|\.\d+)"


def _literal(text: Column, pattern: str) -> Column:
    """The number literal that makes up the text, without digit grouping; else empty."""
    around = f"[{WHITESPACE}]*+"
    found = F.regexp_extract(text, rf"^{around}({pattern}){around}\z", 1)
    return F.replace(found, F.lit("_"), F.lit(""))


def to_double(value: Column, variant: bool = False) -> Column:
    """Floating point value of a number or a numeric text."""
    number = _literal(text_of(value, variant), DECIMAL_LITERAL).try_cast("double")
    return F.coalesce(number, boolean_number(value)) if variant else number


def _bounded(number: Column) -> Column:
    """A double cut towards zero. Finite ones beyond the range end at its limits, so that
    they are still there for the staging insert to refuse; infinity is no number."""
    finite = F.when(F.abs(number) < F.lit(float("inf")), number)
    within = F.abs(finite) < F.lit(float(BIGINT_LIMIT))
    limit = F.when(finite > 0, F.lit(BIGINT_LIMIT)).when(finite < 0, F.lit(-BIGINT_LIMIT))
    return F.when(within, finite.try_cast("bigint")).otherwise(limit)


def cents(amount: Column) -> Column:
    """Whole cents: the double product cut towards zero (19.99 gives 1998)."""
    return _bounded(amount * F.lit(100.0))


def price_cents(value: Column, variant: bool = False) -> Column:
    return cents(to_double(value, variant))


def shipping_cents(value: Column, variant: bool = False) -> Column:
    """Cents of the first number in the text; sign and currency mark are ignored."""
    number = F.regexp_extract(text_of(value, variant), FIRST_NUMBER, 1)
    return cents(number.try_cast("double"))


def whole_number(value: Column, variant: bool = False) -> Column:
    """Integer: a number is cut to its whole part, a text must be an integer literal."""
    literal = _literal(text_of(value, variant), INTEGER_LITERAL)
    beyond = F.when(literal.startswith("-"), F.lit(-BIGINT_LIMIT)).otherwise(F.lit(BIGINT_LIMIT))
    parsed = F.coalesce(literal.try_cast("bigint"), F.when(literal != F.lit(""), beyond))
    if variant:
        is_text = F.schema_of_variant(value) == F.lit("STRING")
        number = F.when(~is_text, _bounded(F.try_variant_get(value, "$", "double")))
        return F.coalesce(F.try_variant_get(value, "$", "bigint"), parsed, number)
    return parsed


def coordinate(value: Column, variant: bool = False) -> Column:
    """Latitude or longitude as a double; the staging type rounds it to seven digits."""
    return to_double(value, variant)
