"""JSON record feeds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.schema import FIELD_MAP
from quitanda.settings import session_setting
from quitanda.sources.json_ranges import (
    MALFORMED,
    NO_OBJECT,
    BrokenDocument,
    document_elements,
)

RECORD = "record"
REST = "rest"

BLANKS = " \t\r\n"

MALFORMED_FEED = "MALFORMED_FEED"
UNREADABLE_FEED = "UNREADABLE_FEED"
NOT_A_RECORD = "NOT_A_RECORD"

# A text above this size may fail to parse for its size alone, so it is not called malformed.
PARSE_BYTES = 16 * 1024 * 1024

_FOUND = f"struct<{RECORD}: variant, {REST}: map<string, variant>>"


def _malformed() -> Column:
    return F.raise_error(F.lit(f"{MALFORMED_FEED}: the feed is not valid JSON"))


def _refusal(text: Column) -> Column:
    """Raises for a text that is no JSON; one too large to tell gets an error of its own."""
    is_small = F.octet_length(text) <= PARSE_BYTES
    return F.when(is_small, _malformed()).otherwise(
        F.raise_error(F.lit(f"{UNREADABLE_FEED}: a large text of the feed can't be parsed"))
    )


def _no_record() -> Column:
    return F.raise_error(F.lit(f"{NOT_A_RECORD}: a list element of the feed is no object"))


def _is_record(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def read_records(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One row per sale record of a JSON feed: ``record``, a VARIANT, and ``rest``.

    A list gives one row per element, an object one row, any other value none. JSON that
    cannot be parsed, or a list element that is no object, makes the read fail, at once or when
    it runs; ``is_malformed_feed`` tells the first kind from other failures. All keys of a record
    are kept, and of a repeated key the last value counts. A record that does not fit one VARIANT
    has the fields of a sale in ``record`` and its other keys in ``rest``, each a VARIANT of
    its own; for other records ``rest`` is null. ``record_field`` reads a key wherever it is.

    Leave ``multi_line`` off for newline-delimited feeds. With it each file is a document of any
    size, whose elements are found by ranges, so many tasks share one file. Both kinds are
    split across tasks.
    """
    # The setting is taken when an expression is made, so it need not stay.
    with session_setting(spark, "spark.sql.variant.allowDuplicateKeys", "true"):
        return _read_document(spark, path) if multi_line else _read_lines(spark, path)


def record_field(key: str, kind: str = "variant") -> Column:
    """A field of what ``read_records`` gives, also of a record that does not fit one VARIANT."""
    quoted = key.replace("\\", "\\\\").replace("'", "\\'")
    kept = F.try_variant_get(RECORD, f"$['{quoted}']", kind)
    return F.coalesce(kept, F.try_variant_get(F.col(REST)[key], "$", kind))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _last_values(entries: Column) -> Column:
    """Entries (key, value) of a record without those whose key comes again after them."""
    return F.transform(
        F.array_distinct(entries["key"]),
        lambda key: F.element_at(F.filter(entries, lambda entry: entry["key"] == key), -1),
    )


def _by_field(entries: Column) -> Column:
    """A record (record, rest) from its entries: the fields of a sale in a VARIANT, the others each
    in one of their own."""

    def value(last: Column, key: str) -> Column:
        same = F.filter(last, lambda entry: entry["key"] == F.lit(key))
        return F.get(same, F.lit(0))["value"].alias(key)

    def record(last: Column) -> Column:
        others = F.filter(last, lambda entry: ~entry["key"].isin(*FIELD_MAP))
        fields = F.to_variant_object(F.struct(*[value(last, key) for key in FIELD_MAP]))
        return F.struct(fields.alias(RECORD), F.map_from_entries(others).alias(REST))

    return _once(entries, lambda found: _once(_last_values(found), record))


def _whole(record: Column) -> Column:
    return F.struct(record.alias(RECORD), F.lit(None).cast("map<string,variant>").alias(REST))


def _object(text: Column, document: Column) -> Column:
    """The record of an object, given its text and what the text parses to, if anything."""

    def again(entries: Column) -> Column:
        refused = _refusal(text).cast(_FOUND)
        return F.when(entries.isNotNull(), _by_field(entries)).otherwise(refused)

    entries = F.map_entries(F.from_json(text, "map<string,variant>"))
    return F.when(document.isNotNull(), _whole(document)).otherwise(_once(entries, again))


def _list(text: Column, document: Column) -> Column:
    """The records of a list, given its text and what the text parses to, if anything."""
    again = F.from_json(text, "array<map<string,variant>>")
    again = F.transform(
        F.coalesce(again, _refusal(text).cast("array<map<string,variant>>")),
        lambda record: F.when(record.isNotNull(), _by_field(F.map_entries(record))).otherwise(
            _no_record().cast(_FOUND)
        ),
    )
    elements = F.transform(
        F.try_variant_get(document, "$", "array<variant>"),
        lambda element: F.when(_is_record(element), _whole(element)).otherwise(
            _no_record().cast(_FOUND)
        ),
    )
    return F.when(document.isNull(), again).otherwise(elements)


def _read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Each line as one value. The first character of a line tells an object from a list."""
    lines = spark.read.text(path)
    # Told here and not by a filter, which Spark could run after what it should keep out.
    first = F.substring(F.ltrim("value", F.lit(BLANKS)), 1, 1)
    parsed = lines.select(
        "value",
        first.alias("first"),
        F.when(first != F.lit(""), F.try_parse_json("value")).alias("document"),
    )
    text, document, first = F.col("value"), F.col("document"), F.col("first")
    listed = F.explode_outer(F.when(first == "[", _list(text, document)))
    found = parsed.select("value", "document", "first", listed.alias("element"))
    alone = F.when(first == "{", _object(text, document)).when(
        (first != "") & (first != "[") & document.isNull(), _refusal(text).cast(_FOUND)
    )
    found = found.select(F.when(first == "[", F.col("element")).otherwise(alone).alias("found"))
    return found.where("found IS NOT NULL").select("found.*")


def _read_document(spark: SparkSession, path: str) -> DataFrame:
    """Documents of any size: each element's text is parsed as a line would be."""
    try:
        elements = document_elements(spark, path)
    except BrokenDocument as error:
        raise ValueError(f"{MALFORMED_FEED}: {error}") from error
    text, fault = F.col("value"), F.col("fault")
    parsed = elements.select(
        "value", "fault", F.when(fault.isNull(), F.try_parse_json("value")).alias("document")
    )
    found = (
        F.when(fault == MALFORMED, _malformed().cast(_FOUND))
        .when(fault == NO_OBJECT, _no_record().cast(_FOUND))
        .otherwise(_object(text, F.col("document")))
    )
    return parsed.select(found.alias("found")).select("found.*")


def is_malformed_feed(error: BaseException) -> bool:
    return MALFORMED_FEED in str(error)


class CachedFeed:
    """A feed that keeps its last non-empty batch until a refresh is forced."""

    def __init__(self, read: Callable[[], DataFrame]):
        self._read = read
        self._batch: DataFrame | None = None

    def get(self, force_refresh: bool = False) -> DataFrame:
        if self._batch is not None and not force_refresh:
            return self._batch
        self.release()
        batch = self._read().persist(StorageLevel.MEMORY_AND_DISK)
        if batch.isEmpty():
            batch.unpersist()
        else:
            self._batch = batch
        return batch

    def release(self) -> None:
        if self._batch is not None:
            self._batch.unpersist()
            self._batch = None
