"""Shards of equal bytes as the leaves of a k-d tree over metadata."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quitanda.llm.common import written

SHARDS = 40

# A cut may miss its weighted median by this share of a leaf, if that keeps a group whole.
TOLERANCE = 0.01
BINS = 256

# Rows numbered together by one task.
SLOT_ROWS = 50_000

_TIE = "_tie"


@dataclass
class Node:
    """A node over ``leaves`` shards from ``first`` on. Rows below its cut go left."""

    first: int
    leaves: int
    weight: int
    dimension: str | None = None
    cut: int = 0
    tie: int | None = None


@dataclass
class Search:
    """Where a node's cut may still lie: values of ``column`` from ``low`` to ``high``."""

    node: Node
    column: str
    low: int
    high: int
    target: float
    done: bool = field(default=False)

    @property
    def width(self) -> int:
        return max(1, -(-(self.high - self.low + 1) // BINS))


def _with_nodes(rows: DataFrame, searches: Sequence[tuple], columns: str) -> DataFrame:
    """Rows joined with a few values for their node: at most one row for each shard."""
    table = rows.sparkSession.createDataFrame(list(searches), f"node int, {columns}")
    return rows.join(F.broadcast(table), "node")


def _histograms(rows: DataFrame, searches: Sequence[Search]) -> dict[int, dict[int, int]]:
    """Weight by bin for each open search. A bin is summed in the tasks that read its rows."""
    by_node = [
        (s.node.first, s.column, s.low, s.high, s.width, s.node.dimension, s.node.cut)
        for s in searches
    ]
    joined = _with_nodes(
        rows,
        by_node,
        "searched string, low bigint, high bigint, width bigint, dim string, cut bigint",
    )
    names = sorted({s.column for s in searches} | {s.node.dimension for s in searches})
    value, own = F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
    for name in names:
        value = F.when(F.col("searched") == name, F.col(name)).otherwise(value)
        own = F.when(F.col("dim") == name, F.col(name)).otherwise(own)
    inside = F.col("v").between(F.col("low"), F.col("high"))
    inside = inside & ((F.col("searched") != _TIE) | (F.col("own") == F.col("cut")))
    counted = (
        joined.withColumns({"v": value, "own": own})
        .where(inside)
        .groupBy("node", F.expr("(v - low) div width").alias("bin"))
        .agg(F.sum("weight").alias("weight"))
        .collect()
    )
    found: dict[int, dict[int, int]] = {s.node.first: {} for s in searches}
    for row in counted:
        found[row.node][row.bin] = row.weight
    return found


def _narrow(search: Search, bins: Mapping[int, int], slack: float) -> None:
    """Move a search into the bin that holds the median, or end it at a bin's edge."""
    low, width, below = search.low, search.width, 0.0
    for number in sorted(bins):
        here = bins[number]
        if below + here < search.target:
            below += here
            continue
        start, end = low + number * width, min(low + (number + 1) * width - 1, search.high)
        over, under = below + here - search.target, search.target - below
        edge = end + 1 if over <= under else start
        if min(over, under) <= slack:
            search.done = True
        elif start == end and search.column != _TIE:
            # One value holds more than the slack: a hot group, cut by the tie among its rows.
            search.node.cut, search.column, search.target = start, _TIE, under
            search.low, search.high = 0, (1 << 62) - 1
            return
        elif start == end:
            search.done = True
        else:
            search.low, search.high, search.target = start, end, under
            return
        if search.column == _TIE:
            search.node.tie = edge
        else:
            search.node.cut = edge
        return
    search.done = True
    if search.column == _TIE:
        search.node.tie = search.high + 1
    else:
        search.node.cut = search.high + 1


def _split(rows: DataFrame, nodes: Sequence[Node], dimensions: Sequence[str], slack: float):
    """Choose the dimension and the cut of each node, by rounds of bounded histograms."""
    spans = rows.groupBy("node").agg(
        F.sum("weight").alias("weight"),
        *[f(name).alias(f"{name}_{f.__name__}") for name in dimensions for f in (F.min, F.max)],
    )
    spans = {row.node: row for row in spans.collect()}
    searches = []
    for node in nodes:
        span = spans.get(node.first)
        if span is None:
            continue
        widths = {d: span[f"{d}_max"] - span[f"{d}_min"] for d in dimensions}
        node.dimension = max(dimensions, key=lambda d: widths[d])
        node.weight = span.weight
        target = node.weight * (node.leaves // 2) / node.leaves
        low, high = span[f"{node.dimension}_min"], span[f"{node.dimension}_max"]
        searches.append(Search(node, node.dimension, low, high, target))
    open_searches = searches
    while open_searches:
        found = _histograms(rows, open_searches)
        for search in open_searches:
            _narrow(search, found[search.node.first], slack)
        open_searches = [s for s in open_searches if not s.done]
    return [s.node for s in searches]


def _below(rows: DataFrame, nodes: Sequence[Node]) -> DataFrame:
    """Rows with the child they fall into."""
    table = [(n.first, n.dimension, n.cut, n.tie, n.first + n.leaves // 2) for n in nodes]
    spark = rows.sparkSession
    cuts = spark.createDataFrame(table, "node int, dim string, cut bigint, tie bigint, right int")
    joined = rows.join(F.broadcast(cuts), "node", "left")
    value = F.lit(None).cast("bigint")
    for name in {n.dimension for n in nodes}:
        value = F.when(F.col("dim") == name, F.col(name)).otherwise(value)
    left = (value < F.col("cut")) | ((value == F.col("cut")) & (F.col(_TIE) < F.col("tie")))
    child = F.when(F.coalesce(left, F.lit(False)), F.col("node")).otherwise(
        F.coalesce("right", "node")
    )
    return joined.withColumn("node", child).drop("dim", "cut", "tie", "right")


def kd_shards(
    rows: DataFrame,
    dimensions: Mapping[str, Column],
    weight: Column,
    tie: Column,
    shards: int = SHARDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``rows`` with ``shard``, 0 to ``shards`` - 1, of nearly equal weight, and ``slot``.

    The tree starts with all rows in one node of ``shards`` leaves. A node is cut along the
    dimension that spans most within it, where its weight divides as its leaves do, until a
    node is one leaf; a leaf's weight is then the total by ``shards``. ``dimensions`` are
    integers of 0 to 2^62, scaled by the caller so that their spans compare.

    All cuts of a level are searched together, by histograms of ``BINS`` bins that Spark sums
    by node and narrows round by round, so the driver sees a bounded number of bins only.
    Rows of one value stay together if that costs at most ``tolerance`` of a leaf; a heavier
    value, such as a large group of copies, is cut by ``tie`` (0 to 2^62).

    ``slot`` numbers a shard's rows from 0 without gaps. Repeated rows keep a slot each. An
    empty input gives no rows; with fewer rows than shards some shards stay empty. Input
    columns keep their values; ``shard`` and ``slot`` must not be among them. What is written
    on the way are the given rows, so pass keys and sizes and not texts.
    """
    names = {f"_d_{name}": column for name, column in dimensions.items()}
    placed = rows.withColumns(
        {**names, _TIE: tie, "weight_": weight.cast("bigint"), "node": F.lit(0)}
    ).withColumnRenamed("weight_", "weight")
    placed = written(placed, "shards")
    total = placed.agg(F.sum("weight")).first()[0] or 0
    slack = tolerance * total / shards
    nodes = [Node(0, shards, total)]
    while any(node.leaves > 1 for node in nodes):
        cut = _split(placed, [n for n in nodes if n.leaves > 1], list(names), slack)
        if not cut:
            break
        placed = written(_below(placed, cut), "shards")
        nodes = [
            child
            for n in nodes
            for child in (
                [n]
                if n.leaves == 1
                else [
                    Node(n.first, n.leaves // 2, 0),
                    Node(n.first + n.leaves // 2, n.leaves - n.leaves // 2, 0),
                ]
            )
        ]
    placed = placed.withColumnRenamed("node", "shard").drop("weight", *names)
    return number_slots(placed.sparkSession, placed).drop(_TIE)


def number_slots(spark: SparkSession, placed: DataFrame) -> DataFrame:
    """Rows numbered within their shard, in parts of a bounded size instead of shard by shard."""
    total = placed.count()
    parts = max(1, math.ceil(total / SHARDS / SLOT_ROWS))
    placed = placed.withColumn("_part", F.col(_TIE) % parts)
    counts = sorted(placed.groupBy("shard", "_part").count().collect())
    starts, before, last = [], 0, None
    for shard, part, count in counts:
        before = 0 if shard != last else before
        starts.append((shard, part, before))
        before, last = before + count, shard
    starts = spark.createDataFrame(starts, "shard int, _part bigint, _start bigint")
    order = Window.partitionBy("shard", "_part").orderBy(_TIE)
    return (
        placed.withColumn("_row", F.row_number().over(order))
        .join(F.broadcast(starts), ["shard", "_part"])
        .withColumn("slot", F.col("_start") + F.col("_row") - 1)
        .drop("_part", "_row", "_start")
    )


def document_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document.

    Size is the text's UTF-8 bytes plus 16, a null text has none. The dimensions are size,
    characters and a hash of the text, each a function of the text alone: equal texts are one
    point and stay in one shard, unless a group of copies is heavier than the tolerance.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    crc = F.crc32(text.cast("binary"))
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        crc.alias("text_crc32"),
        F.char_length(text).cast("bigint").alias("_chars"),
        F.xxhash64(text).alias("_hash"),
    )
    # Upper bits give the value, lower bits tell texts of one length apart.
    below = F.shiftrightunsigned("_hash", 34)
    scaled = {
        "size": (F.log2("size") * (1 << 26)).cast("bigint") * (1 << 30) + below,
        "chars": (F.log2(F.col("_chars") + 16) * (1 << 26)).cast("bigint") * (1 << 30) + below,
        "hash": F.shiftrightunsigned("_hash", 2),
    }
    tie = F.shiftrightunsigned(F.xxhash64("doc_id", "_hash"), 2)
    return kd_shards(rows, scaled, F.col("size"), tie, shards).drop("_chars", "_hash")
