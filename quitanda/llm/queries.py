"""The queries registered for the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.llm.common import WORD, read_table
from quitanda.llm.extraction import extract_text
from quitanda.llm.fingerprints import fingerprints
from quitanda.llm.jaccard import jaccard_components
from quitanda.llm.licenses import scan_licenses
from quitanda.llm.mixing import mixing_plan
from quitanda.llm.packing import pack
from quitanda.llm.periods import periodic_runs
from quitanda.llm.pieces import encode_and_decode
from quitanda.llm.quality import BASE, judge_quality
from quitanda.llm.sharding import document_shards
from quitanda.llm.toxicity import HELD_OUT, THRESHOLD, fold_of, score, train
from quitanda.llm.urls import judge_urls
from quitanda.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
BYTE_PATTERN = public_tokenizers.PATTERN


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(read_table(spark, sf_dir, "documents"), report=BASE)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select(
        "doc_id", *BASE, failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept")
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(read_table(spark, sf_dir, "documents"), BYTE_TOKENIZER, BYTE_PATTERN)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "bucket",
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"), width=3, num=90)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(read_table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, read_table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = document_shards(read_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_and_decode(read_table(spark, sf_dir, "documents"), PIECE_MODEL)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract_text(read_table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


def planted_repeats(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, by a hash of doc_id, repeats some of its words to its end.

    A document without a doc_id or words stays as it is.
    """
    words = docs.select(
        "doc_id",
        "text",
        F.regexp_extract_all("text", F.lit(WORD), 0).alias("w"),
        F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"),
    )
    n = F.size("w").cast("bigint")
    n = words.select("doc_id", "text", "w", "h", F.expr("h div 10").alias("g"), n.alias("n"))
    placed = n.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    placed = placed.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    period = F.slice("w", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    tail = F.flatten(F.array_repeat(period, F.expr("cast((n - a + p - 1) div p as int)")))
    repeated = F.concat(
        F.slice("w", F.lit(1), F.col("a").cast("int")),
        F.slice(tail, F.lit(1), F.expr("cast(n - a as int)")),
    )
    planted = F.when(
        (F.col("h") % 10 == 0) & F.col("a").isNotNull(), F.array_join(repeated, " ")
    ).otherwise(F.col("text"))
    return placed.select("doc_id", planted.alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted_repeats(read_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    best = F.col("most_repeated")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[best[name].alias(name) for name in ("start", "length", "period")],
        F.expr("1000 * most_repeated.length div most_repeated.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing_plan(read_table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return plan.select("doc_id", "size", "source_size", "target", taken)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_packing": op2_packing,
        "op3_license_scan": op3_license_scan,
        "op4_jaccard_join": op4_jaccard_join,
        "op5_url_filter": op5_url_filter,
        "op6_toxicity": op6_toxicity,
        "op7_sharding": op7_sharding,
        "op8_sentencepiece": op8_sentencepiece,
        "op9_fingerprints": op9_fingerprints,
        "op10_html_text": op10_html_text,
        "op11_whitening": op11_whitening,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_mixing": op13_mixing,
        "pipeline": pipeline,
    }
