"""Quality reports: failed conversions, stage counts and the constraints of the tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.functions.values import text_of
from quitanda.operators.cleaning import CONVERSIONS, is_given, is_variant, select_fields
from quitanda.schema import DEFAULT_TEXTS, DIMENSIONS, STAGING_TABLE, TABLES_BY_NAME


def _count_report(
    frame: DataFrame, tests: dict[tuple[str, ...], Column], names: list[str], count_name: str
) -> DataFrame:
    """Rows of ``frame`` for which each test holds, counted in one pass over it."""
    aliases = {f"c{i}": parts for i, parts in enumerate(tests)}
    counts = frame.agg(
        *[F.count_if(test).alias(alias) for alias, test in zip(aliases, tests.values())]
    )
    entries = F.array(
        *[
            F.struct(
                *[F.lit(part).alias(name) for name, part in zip(names, parts)],
                F.col(alias).alias(count_name),
            )
            for alias, parts in aliases.items()
        ]
    )
    return counts.select(F.explode(entries).alias("entry")).select("entry.*")


def failed_conversions(raw: DataFrame) -> dict[str, tuple[Column, Column]]:
    """Per cleaned column: the raw value, and whether it is there but cannot be read.

    Works on the result of ``select_fields``. A blank date text counts as no date.
    """
    failed = {}
    for name, (source, read) in CONVERSIONS.items():
        variant, value = is_variant(raw, source), F.col(source)
        unread = is_given(raw, source) & read(value, variant).isNull()
        failed[name] = (text_of(value, variant), unread)
    return failed


def reject_counts(raw: DataFrame) -> DataFrame:
    """How many raw values each conversion turned into NULL."""
    picked = select_fields(raw)
    tests = {(name,): test for name, (_, test) in failed_conversions(picked).items()}
    return _count_report(picked, tests, ["field"], "rejects")


def rejected_values(raw: DataFrame) -> DataFrame:
    """One row per raw value that could not be read: field, value and product."""
    picked = select_fields(raw)
    product = F.coalesce(
        F.col("product_id"), text_of(F.col("product_name"), is_variant(picked, "product_name"))
    )
    rejects = F.array_compact(
        F.array(
            *[
                F.when(test, F.struct(F.lit(name).alias("field"), value.alias("value")))
                for name, (value, test) in failed_conversions(picked).items()
            ]
        )
    )
    return picked.select(F.explode(rejects).alias("reject"), product.alias("product")).select(
        "reject.field", "reject.value", "product"
    )


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows per stage."""
    counted = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(stage).alias("stage"), "rows")
        for stage, frame in stages.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def duplicate_members(dimensions: dict[str, DataFrame]) -> DataFrame:
    """Per dimension: natural keys that more than one member has; NULL equals NULL."""
    counted = []
    for dimension in DIMENSIONS:
        members = (
            dimensions[dimension.table]
            .groupBy(*dimension.natural_key)
            .agg(F.count(F.lit(1)).alias("n"))
        )
        counted.append(
            members.agg(F.count_if(F.col("n") > 1).alias("duplicated_keys")).select(
                F.lit(dimension.table).alias("dimension"), "duplicated_keys"
            )
        )
    return reduce(DataFrame.unionByName, counted)


def null_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Per required column: rows in which it is NULL. One pass over each table."""
    reports = []
    for name, frame in tables.items():
        tests = {
            (name, column.name): F.col(column.name).isNull()
            for column in TABLES_BY_NAME[name].columns
            if column.required and column.name in frame.columns
        }
        reports.append(_count_report(frame, tests, ["table_name", "column_name"], "null_rows"))
    return reduce(DataFrame.unionByName, reports)


def orphan_keys(fact: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Per dimension key of the fact: rows whose key is in no dimension row.

    The fact is counted per key first, so only one row per key meets the dimension.
    """
    counted = []
    for dimension in DIMENSIONS:
        key = dimension.surrogate
        used = fact.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
        orphans = used.join(dimensions[dimension.table].select(key), key, "left_anti")
        counted.append(
            orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows")).select(
                F.lit(key).alias("fact_key"), "orphan_rows"
            )
        )
    return reduce(DataFrame.unionByName, counted)


def unmatched_sales(staged: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Per dimension key: dated staged rows that no member matches, before any fact exists.

    As in ``orphan_keys``, only one row per natural key meets the dimension.
    """
    dated = staged.where(F.col("purchase_date").isNotNull())
    counted = []
    for dimension in DIMENSIONS:
        keyed = dimensions[dimension.table].select(*dimension.natural_key)
        sources = list(dimension.natural_key.values())
        used = dated.groupBy(*sources).agg(F.count(F.lit(1)).alias("rows"))
        same = [
            used[source].eqNullSafe(keyed[name])
            if name in dimension.null_safe
            else used[source] == keyed[name]
            for name, source in dimension.natural_key.items()
        ]
        unmatched = used.join(keyed, reduce(and_, same), "left_anti")
        counted.append(
            unmatched.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows")).select(
                F.lit(dimension.surrogate).alias("fact_key"), "orphan_rows"
            )
        )
    return reduce(DataFrame.unionByName, counted)


# Largest absolute value a DECIMAL(10,7) holds, after rounding to seven digits.
COORDINATE_LIMIT = 1000.0
INT_LIMITS = (-(2**31), 2**31 - 1)


def domain_violations(cleaned: DataFrame) -> DataFrame:
    """Per limited column: cleaned values the staging table or its dimension would refuse.

    Takes the result of ``clean_records`` before its numbers are narrowed.
    """
    tests: dict[tuple[str, ...], Column] = {}
    for column in TABLES_BY_NAME[STAGING_TABLE].columns:
        value = F.col(column.name)
        if column.type.startswith("varchar"):
            limit = int(column.type[len("varchar(") : -1])
            tests[column.name, f"length <= {limit}"] = F.char_length(value) > limit
        elif column.type == "int":
            tests[column.name, "fits int"] = ~value.between(*INT_LIMITS)
        elif column.type == "decimal(10,7)":
            rounded = F.round(F.abs(value), 7)
            tests[column.name, "fits decimal(10,7)"] = rounded >= COORDINATE_LIMIT
    tests["purchase_location_code", "length <= 2"] = (
        F.char_length("purchase_location_code") > 2
    ) & (F.col("purchase_location_code") != F.lit(DEFAULT_TEXTS["purchase_location_code"]))
    return _count_report(cleaned, tests, ["column_name", "rule"], "violations")
