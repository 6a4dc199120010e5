"""The registered query of each operator, with production parameters, over whole tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricepanel.llm import (
    content_extraction,
    conversation_repair,
    decontamination,
    exact_dedup,
    importance,
    jaccard_join,
    merkle,
    mixing,
    oracle,
    quality_rules,
    secrets,
    sharding,
    tool_calls,
    warc,
)
from pricepanel.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_round_trip(read_table(spark, sf_dir, "pages"), payload=False)
    return read.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_content_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_extraction.extract(read_table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontamination.mark_hits(
        read_table(spark, sf_dir, "documents").select("doc_id", "text"),
        read_table(spark, sf_dir, "benchmark"),
    )
    hits = F.col("hits")
    return marked.select(
        "doc_id",
        hits["n_words"].alias("n_words"),
        hits["n_hit"].alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hits["items"], ",").cast("binary"), 256).alias("items_sha256"),
        decontamination.contaminated(hits).alias("contaminated"),
    )


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tool_calls.events_of_turns(read_table(spark, sf_dir, "conversations"))
    tools = [("answer", json.dumps(tool_calls.ANSWER_SCHEMA))]
    return tool_calls.format_chats(*events, spark.createDataFrame(tools, tool_calls.SCHEMAS))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("repetitions")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents")).drop("host_rejected")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(read_table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(read_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(read_table(spark, sf_dir, "conversations"))


_QUERIES = (
    op1_importance_resampling, op2_jaccard_join, op3_secret_scan, op4_warc, op5_content_extraction,
    op6_decontamination, op7_tool_calls, op8_mixing, op9_sharding, op10_quality_rules, op11_merkle_manifest,
    op12_exact_dedup, op13_conversation_repair,
)


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return oracle.build()
