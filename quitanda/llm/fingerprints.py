"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in SQL functions.

A sketch has three subtables of cells. A paragraph's digest is added to one cell of each: a
cell holds how many digests it has and their exclusive or. Sketches subtract cell by cell; a
cell left with one digest gives it up, which frees others, until all differing digests are
found. A sketch too small for the difference is tried again larger.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TABLES = 3

# Cells of a subtable: of the fingerprint, and of the larger tries after it.
CELLS = 8
LARGER = (8, 32, 128, 1024)
ROUNDS = 12

# Digests of one side that a block of the larger tries has on average, at most.
BLOCK_DIGESTS = 4
BLOCK_BITS = 14

# Documents that one window numbers together, and the largest number of windows.
BUCKET_ROWS = 500
MOST_BUCKETS = 1024

# A line's sentences are put together up to this length, and a line end always parts.
_PARAGRAPH = r"[^\n]{80,}?[.!?](?= |\n|\z)|[^\n]+"
_CHECK = (1 << 20) - 1
_CELL = "struct<n:int,x:bigint>"
_STATE = f"struct<cells:array<{_CELL}>,found:int,open:boolean>"


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _check(upper: Column) -> Column:
    return F.xxhash64(upper).bitwiseAND(_CHECK)


def _digest(paragraph: Column) -> Column:
    """44 bits of hash, then 20 bits that tell one digest from a mix of several."""
    upper = F.shiftrightunsigned(F.xxhash64(paragraph), 20)
    return F.shiftleft(upper, 20).bitwiseOR(_check(upper))


def digests(text: Column) -> Column:
    """Distinct digests of a text's paragraphs; none for the empty text."""
    found = F.regexp_extract_all(text, F.lit(_PARAGRAPH), F.lit(0))
    return F.array_distinct(F.transform(found, _digest))


def _position(digest: Column, table: Column, cells: int) -> Column:
    shift = (F.lit(20) + table * 10).cast("int")
    return F.call_function("shiftrightunsigned", digest, shift).bitwiseAND(cells - 1).cast("int")


def _hits(digest: Column, cell: Column, cells: int) -> Column:
    return _position(digest, F.floor(cell / cells), cells) == cell % cells


def _cell(n: Column, x: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), x.alias("x"))


def sketch(keys: Column, cells: int = CELLS) -> Column:
    """The sketch of an array of digests, as an array of cells."""
    empty = F.struct(F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("x"))

    def filled(cell: Column) -> Column:
        return F.aggregate(
            keys,
            empty,
            lambda state, key: F.when(
                _hits(key, cell, cells), _cell(state.n + 1, state.x.bitwiseXOR(key))
            ).otherwise(state),
        )

    return F.transform(F.sequence(F.lit(0), F.lit(TABLES * cells - 1)), filled)


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: _cell(a.n - b.n, a.x.bitwiseXOR(b.x)))


def peeled(difference: Column, cells: int = CELLS) -> Column:
    """How many digests differ, or null if some could not be recovered."""

    def pure_in(state: Column) -> Column:
        single = F.filter(
            state.cells,
            lambda c: (F.abs(c.n) == 1)
            & (c.x.bitwiseAND(_CHECK) == _check(F.shiftrightunsigned(c.x, 20))),
        )
        return F.array_distinct(single)

    def without(state: Column, pure: Column) -> Column:
        def freed(cell: Column, at: Column) -> Column:
            return F.aggregate(
                F.filter(pure, lambda p: _hits(p.x, at, cells)),
                cell,
                lambda c, p: _cell(c.n - p.n, c.x.bitwiseXOR(p.x)),
            )

        found = (state.found + F.size(pure)).cast("int")
        return F.struct(
            F.transform(state.cells, freed).alias("cells"),
            found.alias("found"),
            (F.size(pure) > 0).alias("open"),
        )

    def step(state: Column, _: Column) -> Column:
        after = _bind(pure_in(state), lambda pure: without(state, pure))
        return F.when(state.open, after).otherwise(state)

    start = F.struct(
        difference.alias("cells"), F.lit(0).alias("found"), F.lit(True).alias("open")
    ).cast(_STATE)
    rounds = ROUNDS + cells.bit_length()
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)),
        start,
        step,
        lambda end: F.when(F.forall(end.cells, lambda c: (c.n == 0) & (c.x == 0)), end.found),
    )


def larger_tries(left: Column, right: Column) -> Column:
    """Number of differing digests, by sketches that grow until one can be peeled.

    Should the largest fail as well, the digests themselves are compared.
    """
    tries = [peeled(subtract(sketch(left, n), sketch(right, n)), n) for n in LARGER]
    exact = F.size(F.array_except(left, right)) + F.size(F.array_except(right, left))
    same = F.when(F.size(left) + F.size(right) == 0, F.lit(0))
    return F.coalesce(same, *tries, exact)


def encoded(cells: Column, size: Column) -> Column:
    """A fingerprint as text: number of digests, then count and mix of each cell, in hex."""
    parts = F.transform(
        cells, lambda c: F.concat(F.lpad(F.hex(c.n), 4, "0"), F.lpad(F.hex(c.x), 16, "0"))
    )
    return F.lower(F.concat(F.hex(size), F.lit("-"), F.array_join(parts, "")))


def likeness(left: Column, right: Column, differing: Column) -> Column:
    """Shared digests by all digests, from both numbers and how many differ."""
    total = left + right
    share = (total - differing).cast("double") / (total + differing)
    return F.when(total == 0, F.lit(1.0)).otherwise(share)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and the next document's text, by doc_id; after the last comes the first.

    Rows are dealt by ranges of doc_id, so a row's successor lies in the same bucket but for
    the last row of each, which takes the first text of the next bucket. Null texts count as
    empty and come with ``_bucket`` and ``_row``, which name a row. Rows with one doc_id
    follow each other in the order of a hash of their text, then of the text.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    buckets = min(MOST_BUCKETS, max(1, docs.count() // BUCKET_ROWS))
    cuts = [i / buckets for i in range(1, buckets)]
    found = docs.agg(F.percentile_approx("doc_id", cuts, 20 * buckets)).first()[0] if cuts else []
    bounds = F.array(*[F.lit(b) for b in sorted(set(found or []))]).cast("array<bigint>")
    bucket = F.size(F.filter(bounds, lambda b: b <= F.col("doc_id")))
    docs = docs.withColumn("_bucket", F.coalesce(bucket, F.lit(0)))

    heads = sorted(docs.groupBy("_bucket").agg(F.min("doc_id").alias("doc_id")).collect())
    following = [(row._bucket, heads[i - 1]._bucket) for i, row in enumerate(heads)]
    spark = docs.sparkSession
    first = F.broadcast(spark.createDataFrame(heads, "_bucket int, doc_id bigint"))
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]
    first = docs.join(first.select("doc_id"), "doc_id")
    first = first.groupBy("_bucket").agg(F.min_by("text", F.struct(*order)).alias("_head"))
    first = first.join(
        F.broadcast(spark.createDataFrame(following, "_bucket int, _before int")), "_bucket"
    ).select(F.col("_before").alias("_bucket"), "_head")

    window = Window.partitionBy("_bucket").orderBy(*order)
    rows = docs.select(
        "*", F.row_number().over(window).alias("_row"), F.lead("text").over(window).alias("_lead")
    )
    return rows.join(first.hint("shuffle_hash"), "_bucket", "left").select(
        "_bucket", "_row", "doc_id", "text", F.coalesce("_lead", "_head").alias("next_text")
    )


def fingerprint_versions(rows: DataFrame, texts: Mapping[str, Column]) -> DataFrame:
    """``rows`` with digests, sizes and sketches of each named text as ``_d_``, ``_n_``, ``_s_``."""
    rows = rows.withColumns({f"_d_{name}": digests(text) for name, text in texts.items()})
    rows = rows.withColumns({f"_s_{name}": sketch(F.col(f"_d_{name}")) for name in texts})
    return rows.withColumns({f"_n_{name}": F.size(f"_d_{name}") for name in texts})


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and its edited text, and their likeness.

    The edited text has the last half of the code points replaced by as many, or all, of the
    next document's first ones. Columns: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    A null or empty text has no digests; two such texts are alike (1.0), one and another text
    are not (0.0). A single document is its own successor. Equal texts have equal
    fingerprints; repeated rows stay. One shuffle of the texts, by ranges of doc_id; all that
    follows is grouped within them. No Python runs on the rows.
    """
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.call_function("left", F.col("text"), n - half),
        F.call_function("left", F.col("next_text"), half),
    )
    rows = with_next(docs).withColumn("edited", edited)
    rows = fingerprint_versions(
        rows, {"own": F.col("text"), "edited": F.col("edited"), "next": F.col("next_text")}
    ).select(
        "_bucket",
        "_row",
        F.struct(
            "doc_id",
            n.cast("bigint").alias("n_chars"),
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            encoded(F.col("_s_own"), F.col("_n_own")).alias("fingerprint"),
            encoded(F.col("_s_edited"), F.col("_n_edited")).alias("edited_fingerprint"),
            *[F.col(f"_n_{name}") for name in ("own", "edited", "next")],
            peeled(subtract(F.col("_s_own"), F.col("_s_edited"))).alias("to_edited"),
            peeled(subtract(F.col("_s_own"), F.col("_s_next"))).alias("to_next"),
        ).alias("doc"),
        *[F.col(f"_d_{name}") for name in ("own", "edited", "next")],
    )
    return _summed(_dealt(rows))


def _dealt(rows: DataFrame) -> DataFrame:
    """A row for each block of digests of those documents that need larger sketches.

    A document's first row has the document and no digests.
    """
    failed = F.col("doc.to_edited").isNull() | F.col("doc.to_next").isNull()
    most = F.greatest("doc._n_own", "doc._n_edited", "doc._n_next")
    bits = F.least(F.ceil(F.log2(F.greatest(most / BLOCK_DIGESTS, F.lit(1.0)))), F.lit(BLOCK_BITS))
    mask = F.when(failed, F.pow(F.lit(2), bits).cast("bigint") - 1)

    def items(name: str, kind: int) -> Column:
        return F.transform(
            F.col(f"_d_{name}"),
            lambda k: F.struct(
                F.shiftrightunsigned(k, 50).bitwiseAND(F.col("_mask")).alias("block"),
                F.lit(kind).alias("kind"),
                k.alias("key"),
            ),
        )

    head = F.struct(
        F.lit(-1).cast("bigint").alias("block"),
        F.lit(-1).alias("kind"),
        F.lit(0).cast("bigint").alias("key"),
    )
    keys = F.concat(items("own", 0), items("edited", 1), items("next", 2))
    listed = F.when(F.col("_mask").isNull(), F.array(head)).otherwise(F.concat(F.array(head), keys))
    exploded = rows.withColumn("_mask", mask).select(
        "_bucket", "_row", "doc", F.explode(listed).alias("item")
    )
    exploded = exploded.select(
        "_bucket", "_row", "item.*", F.when(F.col("item.kind") == -1, F.col("doc")).alias("doc")
    )
    return exploded.groupBy("_bucket", "_row", "block").agg(
        F.max("doc").alias("doc"),
        *[
            F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("key")))).alias(name)
            for kind, name in enumerate(("own", "edited", "next"))
        ],
    )


def _summed(blocks: DataFrame) -> DataFrame:
    counted = blocks.select(
        "_bucket",
        "_row",
        "doc",
        larger_tries(F.col("own"), F.col("edited")).alias("to_edited"),
        larger_tries(F.col("own"), F.col("next")).alias("to_next"),
    )
    found = counted.groupBy("_bucket", "_row").agg(
        F.max("doc").alias("doc"),
        F.sum("to_edited").alias("to_edited"),
        F.sum("to_next").alias("to_next"),
    )
    to_edited = F.coalesce("doc.to_edited", "to_edited")
    to_next = F.coalesce("doc.to_next", "to_next")
    own = F.col("doc._n_own")
    return found.select(
        *[
            f"doc.{name}"
            for name in (
                "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"
            )
        ],
        likeness(own, F.col("doc._n_edited"), to_edited).alias("near_edited"),
        likeness(own, F.col("doc._n_next"), to_next).alias("near_next"),
    )
