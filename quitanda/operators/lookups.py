"""Joins of a large table with a keyed table, by the measured size of the keyed one.

Up to ``BROADCAST_BYTES`` the keyed side is broadcast and the large side does not move.
Beyond it both sides are shuffled, and keys that hold a large share of the rows are split
over several tasks. A key counts as hot from half of what a shuffle partition holds on
average, and gets as many salts as that is in its rows; its single keyed row is repeated once
per salt. So however many rows and partitions there are, no key gives one task more than about
a mean partition. The sample that finds these keys only decides how the work is dealt out:
every row is joined, whatever it says.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 1_000_000
FIXED_WIDTH_BYTES = 16
ROW_OVERHEAD_BYTES = 64

SAMPLED_ROWS = 2_000_000


def fits_broadcast(frame: DataFrame, byte_limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of a stored table are few and small enough to broadcast.

    The row count comes from the file footers; only a table that passes it is measured.
    """
    rows = frame.count()
    if rows > BROADCAST_ROWS:
        return False
    texts = [f.name for f in frame.schema.fields if isinstance(f.dataType, StringType)]
    fixed = len(frame.columns) - len(texts)
    text_bytes = reduce(
        lambda total, name: total + F.coalesce(F.octet_length(F.col(name)), F.lit(0)),
        texts,
        F.lit(0),
    )
    measured = frame.agg(F.sum(text_bytes.cast("bigint"))).first()[0] or 0
    return measured + rows * (fixed * FIXED_WIDTH_BYTES + ROW_OVERHEAD_BYTES) <= byte_limit


def hot_keys(
    frame: DataFrame,
    keys: list[str],
    hot_share: int,
    rows: int,
    sampled_rows: int = SAMPLED_ROWS,
) -> DataFrame:
    """Keys that hold one in ``2 * hot_share`` rows or more, as a small literal table.

    ``salts`` says over how many tasks a key's rows go: one for each half of one in
    ``hot_share`` rows, ``hot_share`` at most. A large frame is judged by a sample, whose
    size does not grow with it: only its keys are shuffled.
    """
    looked_at = frame.select(*keys)
    if rows > sampled_rows:
        looked_at = looked_at.sample(sampled_rows / rows, seed=1)
    enough = max(1.0, min(rows, sampled_rows) / (2 * hot_share))
    counted = looked_at.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    salts = F.least(F.ceil(F.col("rows") / F.lit(enough)), F.lit(hot_share)).cast("int")
    hot = counted.where(F.col("rows") > F.lit(enough)).select(*keys, salts.alias("salts"))
    return frame.sparkSession.createDataFrame(hot.collect(), hot.schema)


def _matches(
    large: DataFrame, keyed: DataFrame, on: dict[str, str], null_safe: frozenset[str]
) -> list[Column]:
    return [
        large[left].eqNullSafe(keyed[right]) if right in null_safe else large[left] == keyed[right]
        for right, left in on.items()
    ]


def join_keyed(
    large: DataFrame,
    keyed: DataFrame,
    on: dict[str, str],
    row_number: str,
    how: str = "left",
    null_safe: frozenset[str] = frozenset(),
    keys_from: DataFrame | None = None,
    byte_limit: int = BROADCAST_BYTES,
    hot_share: int | None = None,
    count_rows: Callable[[], int] | None = None,
) -> DataFrame:
    """Join ``large`` with ``keyed``, whose key columns identify at most one row.

    ``on`` maps key columns of ``keyed`` to columns of ``large``. The result has all
    columns of ``large`` and the non-key ones of ``keyed``. ``row_number`` is a column of
    ``large`` stored or taken at the scan, so that a task run again salts its rows alike.
    Hot keys are counted in ``keys_from``, by default ``large``: name the stored table its
    key columns come from where ``large`` is itself the result of joins, and how to count it
    if that is known. ``hot_share`` is the number of shuffle partitions unless given. Which
    keys count as hot changes the work per task and never the result.
    """
    kept = [c for c in keyed.columns if c not in on]
    if fits_broadcast(keyed, byte_limit):
        conditions = _matches(large, keyed, on, null_safe)
        joined = large.join(F.broadcast(keyed), reduce(and_, conditions), how)
        return joined.select(*[large[c] for c in large.columns], *[keyed[c] for c in kept])

    names = {left: f"_hot_{left}" for left in on.values()}
    counted = large if keys_from is None else keys_from
    rows = (count_rows or counted.count)()
    partitions = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(counted, list(on.values()), hot_share or partitions, rows)
    hot = hot.select(
        *[F.col(c).alias(names[c]) for c in on.values()], F.col("salts").alias("_salts")
    )

    def with_salts(frame: DataFrame, columns: dict[str, str]) -> DataFrame:
        """Number of salts of each row's key: one for a key that is not hot."""
        same = [frame[mine].eqNullSafe(hot[names[theirs]]) for mine, theirs in columns.items()]
        marked = frame.join(F.broadcast(hot), reduce(and_, same), "left")
        salts = F.coalesce("_salts", F.lit(1))
        return marked.select(*[frame[c] for c in frame.columns], salts.alias("_salts"))

    salt = F.pmod(F.col(row_number), F.col("_salts")).cast("int")
    salted_large = with_salts(large, {left: left for left in on.values()})
    salted_large = salted_large.withColumn("_salt", salt).drop("_salts")
    repeated = F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))
    salted_keyed = with_salts(keyed, dict(on)).withColumn("_salt", repeated).drop("_salts")
    conditions = _matches(salted_large, salted_keyed, on, null_safe)
    conditions.append(salted_large["_salt"] == salted_keyed["_salt"])
    joined = salted_large.join(salted_keyed, reduce(and_, conditions), how)
    return joined.select(
        *[salted_large[c] for c in large.columns], *[salted_keyed[c] for c in kept]
    )
