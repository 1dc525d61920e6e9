"""Small document tables with the cases that every operator must handle."""

from __future__ import annotations

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_table(spark, texts, first=0):
    rows = [(first + i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def clashing(docs):
    """The same rows with columns named like those that operators make or use inside."""
    from pyspark.sql import functions as F

    names = ("kept", "score", "shard", "slot", "weight", "node", "cls", "sig", "n", "k", "t")
    return docs.withColumns({name: F.lit("x") for name in names})


def rows_of(frame, *columns):
    columns = columns or frame.columns
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\n",
    "one",
    "a b c",
    "the same text again and again, to the end of it all.",
    "the same text again and again, to the end of it all.",
    "Unbroken" * 3000,
    "  two  spaces \t tab\r\nline ▁ mark\u3000wide\xa0 <|endoftext|> é日本🙂\x00",
    "A long text of many words. " * 2000,
]
