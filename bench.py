"""Timing of the engine on the test tables: prints one JSON line.

Each figure is the median of several warm runs, in seconds. Raw records are derived from
the test tables and landed before the clock starts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from fixtures.queries import queries
from fixtures.warehouse import COLLECTION, sales_fixture
from quitanda.operators.cleaning import clean_records
from quitanda.operators.fact import load_fact
from quitanda.plans.batch import BatchConfig, run_batch
from quitanda.plans.marts import MARTS
from quitanda.plans.populate import load_dimensions, populate
from quitanda.settings import new_shared_path
from quitanda.sources.tables import load_staging, set_up_tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SCRATCH = os.environ.get("BENCH_SCRATCH", "/tmp/quitanda-bench")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
FEED_RUNS = min(RUNS, 3)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("sales-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", SCRATCH)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_through(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(run: Callable[[], object]) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def median_seconds(run: Callable[[], object], runs: int = RUNS) -> float:
    """Median over the runs after a first one that warms up."""
    return round(statistics.median([timed(run) for _ in range(runs + 1)][1:]), 4)


def load_seconds(spark: SparkSession, raw: DataFrame) -> dict[str, float]:
    """Each step of the load into a new warehouse, and the same batch loaded again."""

    def one_load() -> dict[str, float]:
        name = f"bench_{uuid.uuid4().hex[:12]}"
        warehouse = set_up_tables(spark, name, new_shared_path(spark, "bench"))
        staging = timed(lambda: load_staging(warehouse, clean_records(raw), COLLECTION))
        staged = warehouse.staging(COLLECTION)
        return {
            "clean_to_staging": staging,
            "load_dimensions": timed(lambda: load_dimensions(warehouse, staged)),
            "load_fact": timed(lambda: load_fact(warehouse, staged, COLLECTION)),
            "load_same_batch_again": timed(lambda: populate(warehouse, COLLECTION, "overwrite")),
        }

    loads = [one_load() for _ in range(RUNS + 1)][1:]
    return {step: round(statistics.median(load[step] for load in loads), 4) for step in loads[0]}


def batch_from_json(spark: SparkSession, feed_path: str) -> None:
    path = new_shared_path(spark, "bench")
    config = BatchConfig(
        raw_path=f"{path}/raw",
        warehouse_path=f"{path}/warehouse",
        database=f"bench_{uuid.uuid4().hex[:12]}",
        feed_path=feed_path,
    )
    run_batch(spark, config)


REPORTS = (
    *MARTS,
    "dq_rejects",
    "dq_domain_violations",
    "dq_unmatched_sales",
    "dq_fk_orphans",
    "src_json_records",
)


def main() -> None:
    spark = session()
    fixture = sales_fixture(spark, SF_DIR)
    seconds = load_seconds(spark, fixture.raw)
    feed_path = fixture.feed_path
    seconds["batch_run_from_json"] = median_seconds(
        lambda: batch_from_json(spark, feed_path), FEED_RUNS
    )
    registered = queries()
    for name in REPORTS:
        seconds[name] = median_seconds(lambda: run_through(registered[name](spark, SF_DIR)))
    print(
        json.dumps(
            {
                "metric": "sum of median seconds over loads, marts and reports",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
