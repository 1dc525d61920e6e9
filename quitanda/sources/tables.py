"""Warehouse tables: set-up, comments, reads and loads."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.schema import (
    FACT_COLUMNS,
    FACT_TABLE,
    GRAINS,
    STAGING_COLUMNS,
    STAGING_TABLE,
    STAGING_TYPES,
    SUMS_TABLE,
    TABLES,
    TABLES_BY_NAME,
    Dimension,
    TableSpec,
)
from quitanda.settings import remove_path, session_setting


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Lot:
    """A partition of the fact: a batch of a collection, whose sale numbers follow ``first_sale``."""

    collection: str
    first_sale: int
    batch: str

    @property
    def name(self) -> str:
        return f"{self.first_sale:019d}-{self.batch}"

    @property
    def columns(self) -> str:
        return f"`collection` = {_quoted(self.collection)}, `lote` = {_quoted(self.name)}"

    @property
    def spec(self) -> str:
        return f"PARTITION ({self.columns})"

    @property
    def folder(self) -> str:
        return f"collection={self.collection}/lote={self.name}"

    @classmethod
    def read(cls, folder: str) -> Lot:
        """The lot of a partition named as ``collection=<name>/lote=<name>``."""
        collection, name = (part.partition("=")[2] for part in folder.split("/"))
        first_sale, _, batch = name.partition("-")
        return cls(collection, int(first_sale), batch)


@dataclass(frozen=True)
class Warehouse:
    """A database of external parquet tables below one shared location."""

    spark: SparkSession
    database: str
    location: str

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def staging(self, collection: str) -> DataFrame:
        """The staged batch of one collection; the filter prunes the others' folders."""
        staged = self.read(STAGING_TABLE).where(F.col("collection") == F.lit(collection))
        return staged.drop("collection")

    def dimension(self, dimension: Dimension) -> DataFrame:
        return self.read(dimension.table)

    def fact(self) -> DataFrame:
        """Sales of all lots, without the columns that tell lots apart."""
        return self.read(FACT_TABLE).select(*FACT_COLUMNS)

    def partitions(self, table: str) -> list[str]:
        """Names of a table's partitions, from the catalog alone."""
        return [row[0] for row in self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()]

    def fact_lots(self) -> list[Lot]:
        return [Lot.read(folder) for folder in self.partitions(FACT_TABLE)]

    def fact_lot(self, lot: Lot) -> DataFrame:
        """Sales of one lot; the filter leaves only its folder to read."""
        same = (F.col("collection") == lot.collection) & (F.col("lote") == lot.name)
        return self.read(FACT_TABLE).where(same).select(*FACT_COLUMNS)

    def dimensions(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in TABLES_BY_NAME if name.startswith("dim_")}


def create_table(warehouse: Warehouse, table: TableSpec) -> None:
    """Create one table if it is missing; data files already at its location are picked up."""
    location = f"{warehouse.location}/{table.name}"
    is_new = not warehouse.spark.catalog.tableExists(warehouse.name(table.name))
    if table.partitioned_by and is_new:
        # Partitions can only be looked for in a folder that is there.
        nothing = warehouse.spark.range(0)
        nothing = nothing.withColumns({name: F.lit("") for name in table.partitioned_by})
        nothing.write.mode("append").partitionBy(*table.partitioned_by).parquet(location)
    columns = ", ".join(
        f"`{c.name}` {c.type}"
        + (" NOT NULL" if c.required and c.name not in table.partitioned_by else "")
        + (f" COMMENT {_quoted(c.comment)}" if c.comment else "")
        for c in table.columns
    )
    partitioning = ", ".join(f"`{name}`" for name in table.partitioned_by)
    warehouse.spark.sql(
        f"CREATE TABLE IF NOT EXISTS {warehouse.name(table.name)} ({columns}) USING parquet "
        + (f"PARTITIONED BY ({partitioning}) " if partitioning else "")
        + f"LOCATION {_quoted(f'{warehouse.location}/{table.name}')} "
        f"COMMENT {_quoted(table.comment)}"
    )
    if partitioning and is_new:
        warehouse.spark.sql(f"ALTER TABLE {warehouse.name(table.name)} RECOVER PARTITIONS")


def set_up_tables(spark: SparkSession, database: str, location: str) -> Warehouse:
    """Create whatever is missing of staging, dimensions and fact, in this order."""
    warehouse = Warehouse(spark, database, location.rstrip("/"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION {_quoted(warehouse.location)}")
    for table in TABLES:
        create_table(warehouse, table)
    return warehouse


def comment_on_table(warehouse: Warehouse, table: str, comment: str) -> None:
    warehouse.spark.sql(f"COMMENT ON TABLE {warehouse.name(table)} IS {_quoted(comment)}")


def comment_on_column(warehouse: Warehouse, table: str, column: str, comment: str) -> None:
    warehouse.spark.sql(
        f"ALTER TABLE {warehouse.name(table)} ALTER COLUMN `{column}` COMMENT {_quoted(comment)}"
    )


def staging_columns(cleaned: DataFrame) -> DataFrame:
    """The staging columns in load order; a missing one is NULL."""
    present = set(cleaned.columns)
    return cleaned.select(
        *[
            F.col(name) if name in present else F.lit(None).cast(STAGING_TYPES[name]).alias(name)
            for name in STAGING_COLUMNS
        ]
    )


def load_staging(warehouse: Warehouse, cleaned: DataFrame, collection: str) -> None:
    """Replace the staged batch of a collection.

    Length and range limits are those of the table: a value beyond them fails the insert,
    and the old batch stays, as the new files take its place only when the job commits.
    """
    # Rows with a date come first, so the numbers of those that become sales have no gaps.
    dated_first = staging_columns(cleaned).sortWithinPartitions(F.col("purchase_date").isNull())
    numbered = dated_first.select(
        (F.monotonically_increasing_id() + 1).alias("staging_id"),
        *STAGING_COLUMNS,
        F.lit(collection).alias("collection"),
    )
    overwrite = "spark.sql.sources.partitionOverwriteMode"
    with session_setting(warehouse.spark, overwrite, "dynamic"):
        numbered.write.insertInto(warehouse.name(STAGING_TABLE), overwrite=True)


def append_rows(warehouse: Warehouse, table: str, rows: DataFrame) -> None:
    """Append rows by column name; a column they lack is filled with NULL."""
    aligned = aligned_rows(table, rows)
    aligned.write.insertInto(warehouse.name(table))


def write_lot(warehouse: Warehouse, lot: Lot, rows: DataFrame) -> None:
    """Write one lot of the fact; files of an earlier attempt at it go, other lots stay.

    Stored sums of an earlier attempt go first, so none can outlive the sales they sum up.
    """
    if not re.fullmatch(r"\w+", lot.collection) or not re.fullmatch(r"\w+", lot.batch):
        raise ValueError("collections and batches are named by letters, digits and underscores")
    drop_sums(warehouse, [lot])
    view = f"lot_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        warehouse.spark.sql(
            f"INSERT OVERWRITE TABLE {warehouse.name(FACT_TABLE)} {lot.spec} SELECT * FROM {view}"
        )
    finally:
        warehouse.spark.catalog.dropTempView(view)


def drop_lots(warehouse: Warehouse, lots: Sequence[Lot]) -> None:
    """Take lots and their stored sums out of the warehouse, then remove their files."""
    drop_sums(warehouse, lots)
    for lot in lots:
        _drop_folder(warehouse, FACT_TABLE, lot, [lot.spec])


def drop_sums(warehouse: Warehouse, lots: Sequence[Lot]) -> None:
    """Take the stored sums of lots out, whether or not there are any.

    Each grain is named, as a partition is only dropped by all of its columns.
    """
    for lot in lots:
        specs = [f"PARTITION ({lot.columns}, `grao` = {_quoted(grain)})" for grain in GRAINS]
        _drop_folder(warehouse, SUMS_TABLE, lot, specs)


def _drop_folder(warehouse: Warehouse, table: str, lot: Lot, specs: Sequence[str]) -> None:
    dropped = ", ".join(specs)
    warehouse.spark.sql(f"ALTER TABLE {warehouse.name(table)} DROP IF EXISTS {dropped}")
    remove_path(warehouse.spark, f"{warehouse.location}/{table}/{lot.folder}")


def aligned_rows(table: str, rows: DataFrame) -> DataFrame:
    present = set(rows.columns)
    return rows.select(
        *[
            F.col(name) if name in present else F.lit(None).alias(name)
            for name in TABLES_BY_NAME[table].column_names
            if name not in TABLES_BY_NAME[table].partitioned_by
        ]
    )
