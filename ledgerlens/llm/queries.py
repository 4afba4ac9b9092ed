"""The registered query of each operator: the operator over its whole table,
with production parameters, and the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    ann,
    chat,
    conversation_repair,
    license_scan,
    line_dedup,
    mixing,
    near_dedup,
    quality_rules,
    segmentation,
    sharding,
    spelling,
    toxicity,
    url_filter,
)

#: Sources up to which their table of targets is broadcast; beyond, it is joined by shuffle.
BROADCAST_SOURCES = 100_000


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _tool_conversations(rows: DataFrame) -> DataFrame:
    """The conversations as tool traffic: an assistant turn calls ``answer``,
    after the call two turns before, and a user turn is the result of the call
    one turn before (there may be none)."""
    turn = F.col("turn")
    call = F.struct(F.array(F.struct(
        F.concat(F.lit("c"), turn).alias("id"), F.lit("answer").alias("name"),
        F.struct("turn", "text").alias("arguments"),
        F.array(F.concat(F.lit("c"), turn - 2)).alias("after"))).alias("tool_calls"))
    result = F.struct(F.concat(F.lit("c"), turn - 1).alias("tool_call_id"), F.col("text").alias("content"))
    role = F.col("role")
    return rows.select(
        "conv_id", "turn", F.when(role == "user", "tool").otherwise(role).alias("role"),
        F.when(role == "assistant", F.to_json(call)).when(role == "user", F.to_json(result)).otherwise(F.col("text"))
        .alias("text"))


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked, ordered, checked and serialised messages of each conversation."""
    schemas = spark.createDataFrame([("answer", "text", "string", True), ("answer", "turn", "integer", True)],
                                    "name string, field string, type string, required boolean")
    rows = _tool_conversations(_read(spark, sf_dir, "conversations"))
    out = chat.format_chat(spark, rows, schemas)
    return out.select("conv_id", "position", "turn", "role", "kind", "call_id", "linked", "duplicate", "valid", "json")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    pieces, placed, sources = mixing.mix(spark, _read(spark, sf_dir, "documents"), with_text=False)
    taken = (pieces.groupBy(F.col("src").alias("s"), "rank")
             .agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken")))
    shares = sources.select("src", "source_size", "target")
    if sources.count() <= BROADCAST_SOURCES:
        shares = F.broadcast(shares)
    return (placed.join(taken, (F.col("src") == F.col("s")) & (F.col("__rank") == F.col("rank")), "left")
            .join(shares, "src")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of each document."""
    found = near_dedup.near_dedup(spark, _read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of each document."""
    return license_scan.findings(spark, _read(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document."""
    out = sharding.interleave(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated toxicity of each document."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(spark, docs, _read(spark, sf_dir, "labels"))
    return scored.select("doc_id", (toxicity.fold(F.col("doc_id")) == 2).alias("held_out"),
                         F.col("__score").alias("score"), F.col("__toxic").cast("int").alias("predicted"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each document."""
    return segmentation.encode(_read(spark, sf_dir, "documents"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest neighbours of every hundredth vector."""
    return ann.neighbours(spark, _read(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without lines that repeat an earlier window of three."""
    out = line_dedup.line_dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), "text")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of each document."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.quality_rules(docs, with_text=False).select("doc_id", "__verdict.*")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of each damaged conversation."""
    return conversation_repair.repair(spark, conversation_repair.damaged(_read(spark, sf_dir, "conversations")))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of each page's url."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.url_filter(spark, pages, url_filter.default_rules(spark))
    return judged.select("page_id", "__url.*")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words one edit apart, and the frequent form of each."""
    found = spelling.spelling_variants(spark, _read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name to query."""
    return {f.__name__: f for f in (
        op1_chat_formatting, op2_mixing, op3_near_dedup, op4_license_scan, op5_sharding, op6_toxicity,
        op7_sentencepiece, op8_nearest_neighbours, op9_line_dedup, op10_quality_rules, op11_conversation_repair,
        op12_url_filter, op13_spelling_variants)}
