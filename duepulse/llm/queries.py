"""One query for each operator over its whole table, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    corpus_sql,
    fill_in_middle,
    fingerprints,
    language,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    pii,
    quality,
    tables,
    toxicity,
    vector_codes,
    vector_dedup,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def ship(spark: SparkSession) -> None:
    """Python workers find the package where the driver found it, and get batches of bounded size."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    environment.setdefault("PYTHONPATH", root)
    # Workers stay for later stages: what they free goes back to the system, not into pools of their own.
    environment.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    environment.setdefault("MALLOC_ARENA_MAX", "2")
    environment.setdefault("MALLOC_MMAP_THRESHOLD_", "1048576")
    environment.setdefault("MALLOC_TRIM_THRESHOLD_", "1048576")
    # Documents are long: batches of 10000 rows, twice over in the JVM and in Python, are large.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    # Of very long ones a batch holds few: it is in the JVM, on its way and in Python at once.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return tables.read(spark, sf_dir, "documents")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_documents(spark, sf_dir), tables.read(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), tokenizer_path=public_tokenizers.path("word_bpe_49k.json"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(_documents(spark, sf_dir))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_report(_documents(spark, sf_dir), words_per_edit=line_dedup.WORDS_PER_EDIT)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text_left", 256).alias("text_sha256"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_documents(spark, sf_dir)).drop("source")


def op6_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return vector_dedup.find_near_vectors(tables.read(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_documents(spark, sf_dir), tables.read(spark, sf_dir, "labels"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(_documents(spark, sf_dir))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_ngrams(_documents(spark, sf_dir), width=3, percent=90)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_language(_documents(spark, sf_dir))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return vector_codes.compress(tables.read(spark, sf_dir, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(_documents(spark, sf_dir))
    restored = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return warc.through_archives(tables.read(spark, sf_dir, "pages"))


def queries() -> dict[str, Query]:
    named = [
        op1_quality, op2_best_fit_packing, op3_personal_data, op4_line_dedup, op5_source_mixing,
        op6_vector_dedup, op7_toxicity, op8_fingerprints, op9_ngram_join, op10_language,
        op11_vector_codes, op12_fill_in_middle, op13_warc,
    ]
    return {q.__name__: q for q in named}


def oracle_sql() -> dict[str, str]:
    return corpus_sql.oracle_sql()
