"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next one.

language ID -> near duplicates (n-gram Jaccard join) -> benchmark decontamination -> mixing to target weights ->
sharding. All stages but the last return the columns of ``documents``; each works on everything its predecessor kept.

Defined results: rows without a text or a letter go in the first stage; rows without an id are never near duplicates or
contaminated, and are mixed and sharded like others; of rows that share an id, all go or stay by their own text, but
near duplicates and contaminated documents go by id; an empty table gives empty stages; further columns are carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import decontaminate, jaccard, langid, mixing, sharding
from stationflow.llm.queries import MIX_SEED, MIX_WEIGHTS
from stationflow.llm.tables import Scratch, read

#: The mixture takes three quarters of the tokens, each document at most once: a second epoch would bring back copies.
MIX_SHARE = (3, 4)
MIX_EPOCHS = 1


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, and those whose best language is little better than a guess: encoded data,
    random letters."""
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    return jaccard.distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    found = decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark"))
    gone = found.select(F.col("doc_id").alias("__gone")).where("doc_id is not null").distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps each leaf's token-prefix of one seeded epoch under the target weights, row by row: with or without an id."""
    return mixing.chosen_rows(docs, MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Assigns a shard and a slot to every document."""
    return sharding.assign(docs, carry=["lang", "source"])


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("sharding", shards),
]

#: The language network cannot be written in SQL; tests/llm checks every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
