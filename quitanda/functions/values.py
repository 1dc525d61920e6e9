"""Raw field values: one reading for VARIANT fields and for plain string columns.

A raw field is either a VARIANT (feed read as JSON, so numbers, texts and booleans are
still told apart) or a string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space when a text is stripped.
WHITESPACE = "".join(
    map(
        chr,
        (
            *range(0x09, 0x0E),
            *range(0x1C, 0x21),
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ),
    )
)
OTHER_WHITESPACE = WHITESPACE.replace(" ", "")


def field(record: Column, key: str) -> Column:
    """One field of a VARIANT record: NULL if the key is missing, a VARIANT null if its
    value is null. Both read as NULL in every conversion."""
    return F.try_variant_get(record, f"$['{key}']", "variant")


def text_of(value: Column, variant: bool = False) -> Column:
    """String form of a raw value."""
    return F.try_variant_get(value, "$", "string") if variant else value


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends (plain trim only removes blanks).

    The trim with a character set is several times slower, so it only runs on a text that
    still begins or ends with other white space once its blanks are gone.
    """
    trimmed = F.trim(text)
    edges = [F.substring(trimmed, 1, 1), F.substring(trimmed, -1, 1)]
    other = [edge.isin(*OTHER_WHITESPACE) for edge in edges]
    return F.when(other[0] | other[1], F.trim(trimmed, F.lit(WHITESPACE))).otherwise(trimmed)


def boolean_number(value: Column) -> Column:
    """1 or 0 for a JSON boolean, else NULL; the texts "true" and "false" are no numbers."""
    spelled = text_of(value, True).isin("true", "false")
    return F.when(spelled, F.try_variant_get(value, "$", "double"))


def normalized_text(value: Column, variant: bool = False) -> Column:
    """Lower case without surrounding white space; a blank text becomes the empty text."""
    return strip(F.lower(text_of(value, variant)))


def identifier(value: Column, variant: bool = False) -> Column:
    """String form of an id; the empty text is no id. A JSON boolean reads True or False."""
    text = text_of(value, variant)
    if variant:
        text = F.when(boolean_number(value).isNotNull(), F.initcap(text)).otherwise(text)
    return F.when(text != F.lit(""), text)
