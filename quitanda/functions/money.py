"""Money rule: cents are summed as whole numbers and divided once, at the end.

Sums come in two steps. The first adds 64-bit cents per dimension key, before any join.
The second adds those sums over the members of a report group as DECIMAL(38,0), which no
number of rows can overflow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total_cents() -> Column:
    """Price plus freight of one sale; no price, no total."""
    return F.col("preco_cents") + F.coalesce(F.col("shipping_cost_cents"), F.lit(0))


def regrouped(partial_sum: str) -> Column:
    return F.sum(F.col(partial_sum).cast("decimal(38,0)"))


def currency_sum(partial_sum: str) -> Column:
    """Sum in currency units."""
    return regrouped(partial_sum).cast("double") / F.lit(100.0)


def currency_mean(partial_sum: str, partial_count: str) -> Column:
    """Mean in currency units over the rows that have a value; NULL if none has."""
    return mean(partial_sum, partial_count) / F.lit(100.0)


def mean(partial_sum: str, partial_count: str) -> Column:
    return F.try_divide(regrouped(partial_sum).cast("double"), F.sum(partial_count).cast("double"))
