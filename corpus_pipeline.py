"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns a frame that is written as Parquet and read again for the
next: toxic documents go, repeated lines go, one document of each
near-duplicate group stays, sources are mixed to their weights, and the mixed
pieces are segmented.  All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm import line_dedup, mixing, near_dedup, segmentation, toxicity
from ledgerlens.session import ensure_checkpoint_dir


#: Jaccard similarity, in hundredths, from which documents are near copies of each other.
SIMILARITY = 80


def _with_text(docs: DataFrame, rows: DataFrame, value) -> DataFrame:
    """The columns of ``docs`` from ``rows``, with another text and its length."""
    length = F.when(value.isNotNull(), F.length(value)).cast("long")
    new = {"text": value, "n_chars": length}
    return rows.select(*[new[c].alias(c) if c in new else rows[c] for c in docs.columns])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity stays below the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity(spark, docs, labels).where(~F.col("__toxic")).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier window of three."""
    out = line_dedup.line_dedup(docs)
    return _with_text(docs, out, out["text"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest doc_id, of each near-duplicate
    group.  Of rows equal in doc_id and text the one stays whose other columns
    hash least; rows without a doc_id stay."""
    kept = (near_dedup.near_dedup(spark, docs, SIMILARITY)
            .where("doc_id = component_id").select(F.col("doc_id").alias("__id"), F.col("__fp")).distinct())
    keyed = docs.withColumn("__text", F.xxhash64("text"))
    same = (F.col("doc_id").cast("long") == F.col("__id")) & (F.col("__text") == F.col("__fp"))
    # Repeated rows are reduced before the shuffle: row_number up to one is a limit in each group.
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    order = Window.partitionBy("doc_id", "__text").orderBy(F.xxhash64(*others) if others else F.lit(0))
    once = keyed.where("doc_id is not null").withColumn("__nth", F.row_number().over(order)).where("__nth = 1")
    return once.join(kept, same).select(*docs.columns).unionByName(docs.where("doc_id is null"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: one row for each piece of a document in a block of the output,
    as often as the mix takes it, with the piece as its text."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    packed = docs.withColumn("__row", F.struct(*others))
    pieces, _, _ = mixing.mix(spark, packed, keep=("__row",))
    rows = pieces.select("__row.*", "__piece")
    return _with_text(docs, rows, F.col("__piece"))


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each piece."""
    return segmentation.encode(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_repeated_lines),
    ("minhash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("sentencepiece encoding", segment),
]

#: Boosted trees, MinHash and sampling have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written below the
    shared checkpoint folder, so a lost executor never costs a finished stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
