"""Sharding by proportional stratified interleaving.

The rows of each source are put in a seeded pseudorandom order; the row of
rank r among the n of its source has the fractional rank (r + u) / n, with a
fixed offset u of the source, so that small sources do not all meet in the
middle.  Sorting all rows by fractional rank interleaves the sources in
proportion, and cutting that order into equal runs gives every shard the
mixture of the whole, within a row or two for each source.

The law that holds is ``rows``: shard sizes differ by at most one row.  Copies
of a text are ordinary rows: keeping them together would break both the law
and the mixture where one text is a third of all rows.

Both ranks are found in buckets (``ordering.ranked``), so neither a hot source
nor the global order passes one task.  Defined cases: a null source is a source
of its own; null text counts no bytes and has the checksum of the empty text;
equal rows may take each other's places, which changes nothing; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.ordering import BUCKET_ROWS, bucket_count, ranked
from ledgerlens.llm.text import null_safe

SHARDS = 8
#: Sources up to which their counts are broadcast; beyond, they are joined by shuffle.
BROADCAST_SOURCES = 100_000

_OFFSETS = 1 << 20


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = 5, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, source, size, text_crc32, shard, slot) of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    src = null_safe(F.col("source"))
    total = docs.count()
    buckets = bucket_count(total, bucket_rows)
    rows = docs.select("doc_id", "source", src.alias("src"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.xxhash64(F.lit(seed), F.col("doc_id"), src, text).alias("h"))
    rows = rows.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    own = ranked(rows, ["src"], "bucket", ["h", "doc_id", "text_crc32", "size"]).withColumnRenamed("__rank", "r")
    counts = docs.groupBy(src.alias("s")).agg(F.count(F.lit(1)).alias("n"))
    if counts.count() <= BROADCAST_SOURCES:
        counts = F.broadcast(counts)
    offset = (F.pmod(F.xxhash64(F.lit(seed), F.col("src")), F.lit(_OFFSETS)) + 0.5) / _OFFSETS
    spread = own.join(counts, F.col("src") == F.col("s")).select(
        "doc_id", "source", "src", "size", "text_crc32", "r", ((F.col("r") + offset) / F.col("n")).alias("fraction"))
    spread = spread.withColumn("run", F.floor(F.col("fraction") * buckets).cast("long"))
    placed = ranked(spread, [], "run", ["fraction", "src", "r"])
    n = F.lit(total).cast("long")
    shard = F.floor(F.col("__rank") * shards / n).cast("long") if not total else F.expr(
        f"(__rank * {shards}L) div {total}L")
    placed = placed.withColumn("shard", shard)
    begins = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return placed.select("doc_id", "source", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                         (F.col("__rank") - begins).cast("long").alias("slot"))
