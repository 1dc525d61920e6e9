"""A corpus pipeline: toxicity, quality rules, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.llm.common import read_table, written
from quitanda.llm.jaccard import jaccard_components
from quitanda.llm.packing import pack
from quitanda.llm.quality import judge_quality
from quitanda.llm.toxicity import THRESHOLD, score, train

# The toxicity model and the tokenizer can't be written in SQL; tests use a brute-force version.
ORACLE_SQL = None


def _free_name(docs: DataFrame, name: str) -> str:
    while name.lower() in map(str.lower, docs.columns):
        name = f"_{name}"
    return name


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by models learnt from these documents.

    A null or empty text has the score of no evidence. Texts are scored whole, repeated rows alike;
    other columns go along, whatever they are called. An empty table stays empty.
    """
    model = train(docs, read_table(spark, sf_dir, "labels"))
    name = _free_name(docs, "score")
    scored = score(docs, model, docs.columns, name=name)
    return scored.where(F.col(name) < THRESHOLD).drop(name)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects.

    A null or empty text has too few words and goes. Texts are judged whole, repeated rows alike;
    other columns go along, whatever they are called. An empty table stays empty.
    """
    name = _free_name(docs, "kept")
    judged = judge_quality(docs, docs.columns, verdict=name)
    return judged.where(F.col(name)).drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: the one with the smallest doc_id, and of these
    the one whose text has the smallest hash.

    Similar is 0.8 or more of shingles of five words. Rows with the same doc_id and different
    texts are documents of their own; of rows that agree in both one stays. Rows without a
    doc_id, which no result can name, all stay, as do texts without words. A text is compared
    whole, however long; other columns go along. An empty table stays empty.
    """
    name = _free_name(docs, "row")
    named = docs.where("doc_id IS NOT NULL")
    named = named.withColumn(name, F.struct("doc_id", F.xxhash64("text").alias("text")))
    found = jaccard_components(named, width=5, num=80, key=name)
    first = found.where(F.col(name) == F.col("component_id")).select(name).distinct()
    kept = named.join(first, name, "left_semi").dropDuplicates([name])
    return kept.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as sequences whose lengths are powers of two.

    A null text is packed like an empty one, as its end alone; a long one whole, in many sequences.
    Repeated rows are packed each. Only doc_id and text are read. An empty table has no sequences.
    """
    return pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    ).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again for the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
