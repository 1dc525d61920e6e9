"""Mixing of sources to target weights, by repetition rates and hash-seeded copies.

Sizes are added up per source. Each source has a target, which divided by its size is the rate
at which its documents are repeated: as often as the rate's whole part says, and once more
with the probability of its fraction, decided by a hash of the document.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.llm.common import WORD, written
from quitanda.operators.keys import assign_keys
from quitanda.operators.lookups import join_keyed
from quitanda.settings import new_shared_path, remove_path

WEIGHTS = (5, 2, 1)
MAX_RATE = 3

# Part of what is hashed; another value gives another mix.
SEED = "mix-1"

_WIDE = "decimal(38,0)"


def n_words(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0))


def chance(key: Column, text: Column, seed: str = SEED) -> Column:
    """A number from 0 to 1 (exclusive) that depends on a row's key and whole text alone."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), key.cast("string"), text))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_rate: int = MAX_RATE
) -> DataFrame:
    """Targets of sources, from one row (source, source_size) each.

    Sources in code point order, null last, have the weights in turn and share the sum of all
    sizes by them. A share above ``max_rate`` times its source's size is cut to that; what is
    cut off is shared again by weight among the others, until none is above. Each round is
    one sum over the sources, kept where they are; only sums come to the driver. Whole numbers
    decide what is cut, so a rerun cuts the same.
    """
    spark = sizes.sparkSession
    path = new_shared_path(spark, "mixing-order")
    numbered = assign_keys(sizes, ["source"], "place", -1, path)
    if numbered is None:
        return sizes.withColumn("target", F.lit(0.0))
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")
    )
    ranked = written(
        numbered.select("source", "source_size", weight.cast("bigint").alias("weight")),
        "mixing-sources",
    )
    remove_path(spark, path)
    size, weight = F.col("source_size").cast(_WIDE), F.col("weight").cast(_WIDE)
    cap = size * max_rate

    total, all_weights = ranked.agg(F.sum(size), F.sum(weight)).first()
    budget, left = int(total), int(all_weights)
    while True:
        # cap / weight <= budget / left, in whole numbers.
        above = cap * F.lit(Decimal(left)) <= F.lit(Decimal(budget)) * weight
        cut, cut_weight = ranked.where(above).agg(F.sum(cap), F.sum(weight)).first()
        rest = int(total) - int(cut or 0), int(all_weights) - int(cut_weight or 0)
        if rest == (budget, left) or not rest[1]:
            break
        budget, left = rest
    share = F.lit(float(budget)) * F.col("weight") / F.lit(float(max(left, 1)))
    return ranked.select(
        "source",
        "source_size",
        F.when(above, (F.col("source_size") * max_rate).cast("double"))
        .otherwise(share)
        .alias("target"),
    )


def mixing_plan(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    weights: Sequence[int] = WEIGHTS,
    max_rate: int = MAX_RATE,
    seed: str = SEED,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """How often the mix takes each document: the columns in ``keep`` and, after them, size
    (words), source_size, target (of the source, in words) and copies (0 to ``max_rate``).

    A null text, or one without words, has size 0; a text of any length is counted whole. A null
    source is a source of its own. A source without words has target 0 and its documents
    no copies. Rows with equal key and text are taken equally often; other columns play no
    part, whatever they are called. An empty table gives no rows. The sizes are added up before
    they are shuffled, so a source may hold any share of the rows.
    """
    inner = docs.select(
        F.xxhash64(key, text).alias("_row"),
        n_words(F.col(text)).alias("_size"),
        F.col(source).alias("_source"),
        chance(F.col(key), F.col(text), seed).alias("_chance"),
        *[F.col(f"`{name}`").alias(f"_keep{i}") for i, name in enumerate(keep)],
    )
    sums = docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(n_words(F.col(text))).alias("source_size")
    )
    targets = source_targets(sums, weights, max_rate)
    rated = join_keyed(
        inner, targets, {"source": "_source"}, "_row", null_safe=frozenset(["source"])
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    rate = F.coalesce(rate, F.lit(0.0))
    copies = F.floor(rate) + (F.col("_chance") < rate - F.floor(rate)).cast("bigint")
    return rated.select(
        *[f"_keep{i}" for i in range(len(keep))], "_size", "source_size", "target", copies
    ).toDF(*keep, "size", "source_size", "target", "copies")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as many times as ``mixing_plan`` says, with all its columns.

    Options are those of ``mixing_plan``.
    """
    plan = mixing_plan(docs, keep=docs.columns, **options)
    n = len(docs.columns)
    plan = plan.toDF(*[f"c{i}" for i in range(n)], "size", "source_size", "target", "copies")
    repeated = plan.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies")))
    return repeated.select(*[f"c{i}" for i in range(n)]).toDF(*docs.columns)
