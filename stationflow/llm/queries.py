"""The registered queries of the operators, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stationflow.llm import (alignment, capfilters, covertree, decontaminate, jaccard, langid, licenses, mixing, repair,
                             sharding, substrings, tokenstore, toolcalls)
from stationflow.llm.tables import read

Query = Callable[[SparkSession, str], DataFrame]

#: Target weights of the registered mixture: domain d0 holds the hot source.
MIX_WEIGHTS = {"domain": {"d0": 1, "*": 2}, "lang": {"en": 2, "*": 1}, "source": {"*": 1}}
MIX_SHARE = (1, 2)
MIX_EPOCHS = 3
MIX_SEED = 17


#: Every so many ids is a query of the top-k search.
QUERY_EVERY = 50


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.top_k(read(spark, sf_dir, "embeddings"), lambda i: i % QUERY_EVERY == 0)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.parse(read(spark, sf_dir, "documents")).drop("factors")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read(spark, sf_dir, "documents"))


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = toolcalls.from_turns(read(spark, sf_dir, "conversations"))
    return toolcalls.link(calls, results, toolcalls.TURN_TOOLS)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenstore.store(read(spark, sf_dir, "documents"))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capfilters.near_copies(read(spark, sf_dir, "embeddings"))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(read(spark, sf_dir, "conversations"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_top_k": op3_top_k,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_sharding": op5_sharding,
    "op6_tool_calls": op6_tool_calls,
    "op7_decontamination": op7_decontamination,
    "op8_mixing": op8_mixing,
    "op9_language_id": op9_language_id,
    "op10_token_store": op10_token_store,
    "op11_embedding_near_dedup": op11_embedding_near_dedup,
    "op12_structure_repair": op12_structure_repair,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

ORACLE: dict[str, str] = {
    "op2_jaccard_join": jaccard.ORACLE,
    "op3_top_k": covertree.oracle(covertree.K, QUERY_EVERY, covertree.SCALE),
    "op4_substring_dedup": substrings.ORACLE,
    "op6_tool_calls": toolcalls.ORACLE,
    "op7_decontamination": decontaminate.ORACLE,
    "op8_mixing": mixing.oracle(MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED),
}
