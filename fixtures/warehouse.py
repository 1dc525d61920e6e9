"""The warehouse loaded from the test tables, once per session and data folder.

Every stage is a written table in the shared folder, so what builds on it starts from
files and not from a long lineage.
"""

from __future__ import annotations

import uuid
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.adapter import raw_sales, write_feed, write_lists
from quitanda.operators.cleaning import clean_records
from quitanda.operators.fact import load_fact
from quitanda.plans.batch import BatchConfig, run_batch
from quitanda.plans.lot_sums import refresh_sums
from quitanda.plans.populate import load_dimensions, populate
from quitanda.settings import SHUFFLE_CLEANUP, new_shared_path, remove_path, session_setting
from quitanda.sources.landing import land_raw, scan_raw
from quitanda.sources.records import read_records
from quitanda.sources.tables import Warehouse, load_staging, set_up_tables

COLLECTION = "vendas"

# Last day of the first of two batches is the day before.
SECOND_BATCH_FROM = date(1995, 1, 4)


class SalesFixture:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = new_shared_path(spark, "fixture")

    def _database(self, label: str) -> Warehouse:
        name = f"vendas_{label}_{uuid.uuid4().hex[:12]}"
        return set_up_tables(self.spark, name, f"{self.root}/{label}")

    @cached_property
    def raw_path(self) -> str:
        path = f"{self.root}/raw"
        scratch = new_shared_path(self.spark, "ordered")
        with session_setting(self.spark, SHUFFLE_CLEANUP, "true"):
            land_raw(raw_sales(self.spark, self.sf_dir, scratch), path, COLLECTION)
        remove_path(self.spark, scratch)
        return path

    @property
    def raw(self) -> DataFrame:
        return scan_raw(self.spark, self.raw_path, COLLECTION)

    @cached_property
    def feed_path(self) -> str:
        path = f"{self.root}/feed"
        write_feed(self.raw, path)
        return path

    @property
    def feed(self) -> DataFrame:
        return read_records(self.spark, self.feed_path)

    @property
    def lists(self) -> DataFrame:
        return read_records(self.spark, self.lists_path, multi_line=True)

    @cached_property
    def lists_path(self) -> str:
        path = f"{self.root}/lists"
        write_lists(self.raw, path)
        return path

    @cached_property
    def staged(self) -> Warehouse:
        warehouse = self._database("loaded")
        load_staging(warehouse, clean_records(self.raw), COLLECTION)
        return warehouse

    @cached_property
    def loaded(self) -> Warehouse:
        populate(self.staged, COLLECTION)
        return self.staged

    @cached_property
    def loaded_in_two(self) -> Warehouse:
        """Dimensions loaded from the early sales first and then from the rest."""
        warehouse = self._database("two_batches")
        batch = self.staged.staging(COLLECTION)
        early = F.coalesce(F.col("purchase_date") < F.lit(SECOND_BATCH_FROM), F.lit(False))
        load_dimensions(warehouse, batch.where(early))
        load_dimensions(warehouse, batch.where(~early))
        return warehouse

    def _facts(self, label: str) -> Warehouse:
        warehouse = self._database(label)
        load_dimensions(warehouse, self.staged.staging(COLLECTION))
        return warehouse

    @cached_property
    def appended_twice(self) -> Warehouse:
        """A batch loaded by two runs, the second of which was repeated after a failure."""
        warehouse, batch = self._facts("twice"), self.staged.staging(COLLECTION)
        for run in ("first", "second", "second"):
            load_fact(warehouse, batch, COLLECTION, batch=run)
        return warehouse

    @cached_property
    def two_collections(self) -> Warehouse:
        """Early sales and the others in collections of their own, each overwritten once."""
        warehouse, batch = self._facts("collections"), self.staged.staging(COLLECTION)
        early = F.coalesce(F.col("purchase_date") < F.lit(SECOND_BATCH_FROM), F.lit(False))
        for run in ("first", "second"):
            load_fact(warehouse, batch.where(early), "early", "overwrite", run)
            load_fact(warehouse, batch.where(~early), "late", "overwrite", run)
        return warehouse

    @cached_property
    def summed_by_lot(self) -> Warehouse:
        """Early sales summed up before the others are loaded, and one lot loaded twice."""
        warehouse, batch = self._facts("sums"), self.staged.staging(COLLECTION)
        early = F.coalesce(F.col("purchase_date") < F.lit(SECOND_BATCH_FROM), F.lit(False))
        load_fact(warehouse, batch.where(early), COLLECTION, batch="early")
        load_fact(warehouse, batch, COLLECTION, batch="late")
        refresh_sums(warehouse)
        load_fact(warehouse, batch.where(~early), COLLECTION, batch="late")
        return warehouse

    @cached_property
    def run_from_feed(self) -> Warehouse:
        """A full batch run from the JSON feed."""
        config = BatchConfig(
            raw_path=f"{self.root}/feed_raw",
            warehouse_path=f"{self.root}/feed_warehouse",
            database=f"vendas_feed_{uuid.uuid4().hex[:12]}",
            collection=COLLECTION,
            feed_path=self.feed_path,
        )
        run_batch(self.spark, config)
        return Warehouse(self.spark, config.database, config.warehouse_path)


_fixtures: dict[tuple[str, str], SalesFixture] = {}


def sales_fixture(spark: SparkSession, sf_dir: str) -> SalesFixture:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _fixtures:
        _fixtures[key] = SalesFixture(spark, sf_dir)
    return _fixtures[key]
