"""One full batch: feed, landing, cleaning, staging, star schema."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession

from quitanda.operators.cleaning import clean_records
from quitanda.plans.populate import populate
from quitanda.sources.landing import land_raw, landed_or_none
from quitanda.sources.records import is_malformed_feed, read_records
from quitanda.sources.tables import load_staging, set_up_tables

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class BatchConfig:
    """Where a batch comes from and goes to; all paths are on shared storage."""

    raw_path: str
    warehouse_path: str
    database: str = "vendas_dw"
    collection: str = "vendas"
    feed_path: str | None = None
    multi_line: bool = False
    fact_mode: str = "append"
    strict_keys: bool = False
    loaded_at: datetime | None = None


@dataclass
class BatchResult:
    """What a run did, how many rows of its batch each stage then held (read from file
    footers), and how many values of each field could not be read."""

    landed: bool = False
    staged: bool = False
    populated: bool = False
    rows: dict[str, int] = field(default_factory=dict)
    rejects: dict[str, int] = field(default_factory=dict)


def land_feed(config: BatchConfig, feed: Callable[[], DataFrame], plain_scan: bool) -> bool:
    """Land the feed; one that is missing, empty or not JSON leaves the last batch landed."""
    try:
        return land_raw(feed(), config.raw_path, config.collection, plain_scan)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("feed not found: %s", error)
    except Exception as error:
        if not is_malformed_feed(error):
            raise
        log.warning("feed is not valid JSON; the last landed batch stays")
    return False


def run_batch(
    spark: SparkSession, config: BatchConfig, feed: Callable[[], DataFrame] | None = None
) -> BatchResult:
    """Set up tables, land the feed, clean what is landed, stage it, fill the star schema.

    ``feed`` reads the new records; without it they come from the JSON at ``feed_path``.

    With nothing new in the feed the last landed batch is cleaned and loaded again; in
    ``append`` mode its sales then count twice. With nothing landed at all, staging and
    star schema stay as they are.
    """
    result = BatchResult()
    warehouse = set_up_tables(spark, config.database, config.warehouse_path)
    if feed is not None:
        result.landed = land_feed(config, feed, plain_scan=False)
    elif config.feed_path is not None:
        read = partial(read_records, spark, config.feed_path, config.multi_line)
        result.landed = land_feed(config, read, plain_scan=not config.multi_line)

    raw = landed_or_none(spark, config.raw_path, config.collection)
    if raw is None:
        return result
    result.rows["raw"] = raw.count()
    rejects = Observation()
    cleaned = clean_records(raw, config.loaded_at, rejects)
    load_staging(warehouse, cleaned, config.collection)
    result.rejects = {name: count for name, count in rejects.get.items() if count}
    if result.rejects:
        log.warning("values that could not be read: %s", result.rejects)
    result.staged = True
    result.rows["staging"] = warehouse.staging(config.collection).count()

    lot = populate(warehouse, config.collection, config.fact_mode, config.strict_keys)
    result.populated = True
    result.rows["fact"] = warehouse.fact_lot(lot).count()
    return result
