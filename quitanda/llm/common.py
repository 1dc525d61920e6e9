"""Small helpers shared by the operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator, Sequence
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.settings import SHUFFLE_CLEANUP, new_shared_path, remove_path, session_setting

SMALL_BATCH = 256
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_written_to: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def written(frame: DataFrame, label: str) -> DataFrame:
    """The rows of ``frame`` as a table of its own in the shared folder, free of lineage.

    What was shuffled for it is deleted with the last row; a row that is needed again is read.
    """
    path = new_shared_path(frame.sparkSession, label)
    with session_setting(frame.sparkSession, SHUFFLE_CLEANUP, "true"):
        frame.write.parquet(path, compression="zstd")
    table = frame.sparkSession.read.schema(frame.schema).parquet(path)
    _written_to[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` gave, once nothing reads them any more."""
    for table in tables:
        remove_path(table.sparkSession, _written_to.pop(table))


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of results that nothing refers to any more.

    It does so when the driver's objects for them are collected, which a long run would otherwise
    leave to chance while the files stay on the executors' disks.
    """
    gc.collect()
    spark._jvm.System.gc()


# Bits of a key filter at most: beyond a tenth as many keys it lets more others through.
FILTER_BITS = 2**27


def likely_rows(frame: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``frame`` without most rows whose ``key`` is not in ``keys``; no row of a key in it goes.

    The tasks that read ``frame`` know the keys by a Bloom filter, so that a join with them, which
    has to follow, shuffles little else.
    """
    bits = min(FILTER_BITS, 1 << max(16, (10 * keys.count()).bit_length()))
    places = [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(3)]
    bit = keys.select(F.explode(F.array(*places)).alias("bit"))
    one = F.expr("shiftleft(1L, cast(bit % 64 as int))")
    words = bit.groupBy(F.expr("bit div 64").alias("word")).agg(F.bit_or(one).alias("bits")).toPandas()
    table = np.zeros(bits // 64, np.int64)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    shared = frame.sparkSession.sparkContext.broadcast(table)
    names = [f"c{i}" for i in range(len(frame.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = np.ones(batch.num_rows, bool)
            for column in batch.columns[len(names) :]:
                at = np.asarray(column)
                kept &= (shared.value[at >> 6] >> (at & 63)) & 1 == 1
            yield batch.select(names).filter(pa.array(kept))

    kinds = ", ".join(f"{name} {kind}" for name, (_, kind) in zip(names, frame.dtypes))
    columns = [F.col(f"`{column}`").alias(name) for column, name in zip(frame.columns, names)]
    marked = frame.select(*columns, *[place.alias(f"p{i}") for i, place in enumerate(places)])
    return marked.mapInArrow(run, kinds).toDF(*frame.columns)


def map_batches(frame: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """Small batches of rows through Python, by Arrow.

    ``make`` runs once per task, where it may load a model or open a cache, and gives a
    function from lists of column values to the list of result rows (tuples in schema order).
    Results leave in small batches, so a task holds one input batch and a few results.
    A function that gathers over batches has an attribute ``rest``, called at the end.
    """
    arrow = frame.sparkSession.createDataFrame([], schema).schema
    names = arrow.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(arrow)
        step = make()

        def record_batch(rows):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(values, type=target.field(name).type)
                    for name, values in zip(names, zip(*rows))
                ],
                schema=target,
            )

        for batch in batches:
            for start in range(0, batch.num_rows, SMALL_BATCH):
                part = batch.slice(start, SMALL_BATCH)
                rows = step(*[column.to_pylist() for column in part.columns])
                if rows:
                    yield record_batch(rows)
                del part, rows
            pa.default_memory_pool().release_unused()
        if rest := getattr(step, "rest", None):
            if rows := rest():
                yield record_batch(rows)

    return frame.mapInArrow(run, arrow)


def map_rows(frame: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """Like ``map_batches``, with a function from one row's values to its result rows."""

    def make_batch():
        step = make()
        return lambda *columns: [row for values in zip(*columns) for row in step(*values)]

    return map_batches(frame, make_batch, schema)


def map_text(
    frame: DataFrame,
    make: Callable[[], Callable],
    text: str,
    keep: Sequence[str],
    fields: Sequence[tuple[str, str]],
) -> DataFrame:
    """The columns in ``keep`` and, after them, new ``fields`` (name, type) made from a text.

    ``make`` gives a function from a list of texts to a row of new values for each. New columns
    come last, whatever the kept ones are called.
    """
    kinds, kept = dict(frame.dtypes), list(keep)
    read = kept if text in kept else [*kept, text]
    place = read.index(text)

    def start():
        step = make()

        def rows(*columns):
            kept_rows = zip(*columns[: len(kept)]) if kept else iter(lambda: (), None)
            return [(*values, *new) for values, new in zip(kept_rows, step(columns[place]))]

        return rows

    names = [f"k{i} {kinds[name]}" for i, name in enumerate(kept)]
    names += [f"n{i} {kind}" for i, (_, kind) in enumerate(fields)]
    columns = [frame[f"`{name}`"].alias(f"r{i}") for i, name in enumerate(read)]
    mapped = map_batches(frame.select(*columns), start, ", ".join(names))
    return mapped.toDF(*kept, *(name for name, _ in fields))
