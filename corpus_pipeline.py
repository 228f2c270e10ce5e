"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duepulse.llm import line_dedup, mixing, ngram_join, packing, queries, tables, toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near duplicates: shingles of five words, a similarity of 0.8 or more.
WIDTH, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier toxic than not go. The model learns from labels of docs' ids."""
    queries.ship(spark)
    scored = toxicity.with_severity(docs, docs, tables.read(spark, sf_dir, "labels"))
    return scored.where(~F.col(toxicity.ADDED[2])).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line equals or nearly equals go, and documents left without a word by that."""
    return line_dedup.dedup_lines(docs, drop_emptied=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id stays; rows without an id are last.

    Every row counts by itself. Where ids are missing or repeated, all rows are numbered in a
    written table, and of rows with one id the first in it is the smallest.
    """
    queries.ship(spark)
    node = "row_node"
    while node in map(str.lower, docs.columns):
        node += "_"
    odd = docs.groupBy("doc_id").count().where("doc_id is null or count > 1").limit(1).count()
    rows = tables.stored(docs.withColumn(node, F.monotonically_increasing_id())) if odd else docs.withColumn(node, docs["doc_id"].cast("long"))
    found = ngram_join.join_ngrams(rows.select(F.col(node).alias("doc_id"), "text"), width=WIDTH, percent=PERCENT)
    members = found.select(F.col("doc_id").alias("gone_node"), "component_id")
    if odd:
        rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(node).alias("node"))
        several = members.groupBy("component_id").count().where("count > 1").select("component_id")
        ranked = members.join(several, "component_id").join(rows.select(F.col(node).alias("gone_node"), rank.alias("rank")), "gone_node")
        first = ranked.groupBy("component_id").agg(F.min("rank").alias("first"))
        members = ranked.join(first, "component_id").where("gone_node <> first.node")
    else:
        members = members.where("component_id <> gone_node")
    gone = tables.stored(members.select("gone_node"))
    few = gone.limit(ngram_join.MOST_BROADCAST + 1).count() <= ngram_join.MOST_BROADCAST
    return rows.join(F.broadcast(gone) if few else gone, rows[node] == gone["gone_node"], "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: words taken twice come twice, words not taken are gone."""
    queries.ship(spark)
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences."""
    queries.ship(spark)
    return packing.pack(docs, tokenizer_path=public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: The stages learn, hash and tokenize, which SQL can't express; tests/llm checks them by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of the documents in sf_dir.

    A stage's tables, and the documents it read, go once its own documents are written.
    """
    docs = tables.read(spark, sf_dir, "documents")
    mark = tables.made()
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = tables.stored(docs)
            tables.remove_since(spark, mark, but_last=1)
    return docs
