"""Purchase dates and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quitanda.functions.values import text_of

# Day and month with one or two digits, four-digit year from 0001, nothing around them;
# a one-digit day may be padded with one blank.
DAY_MONTH_YEAR = r"^( ?[1-9]|0[1-9]|[12]\d|3[01])/(0?[1-9]|1[0-2])/(?!0000)\d{4}\z"


def purchase_date(value: Column, variant: bool = False) -> Column:
    """Strict dd/mm/yyyy; anything else, impossible days included, becomes NULL."""
    text = text_of(value, variant)
    return F.when(text.rlike(DAY_MONTH_YEAR), F.try_to_date(F.ltrim(text), "d/M/yyyy"))


def padded_name(day: Column, pattern: str) -> Column:
    """English day or month name, filled with blanks up to nine characters."""
    return F.rpad(F.date_format(day, pattern), 9, " ")


def calendar(day: Column) -> dict[str, Column]:
    """Attributes of a calendar day, by column name."""
    return {
        "ano": F.year(day),
        "mes": F.month(day),
        "dia": F.dayofmonth(day),
        "nome_dia_semana": padded_name(day, "EEEE"),
        "nome_mes": padded_name(day, "MMMM"),
        "trimestre": F.quarter(day),
        "semestre": F.when(F.month(day) <= 6, 1).otherwise(2),
    }


def day_kind(day: Column) -> Column:
    """Weekend or working day; dayofweek counts from Sunday = 1."""
    return F.when(F.dayofweek(day).isin(1, 7), "Fim de Semana").otherwise("Dia Útil")
