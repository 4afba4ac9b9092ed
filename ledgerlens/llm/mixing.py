"""Mixing sources to target weights by blocks of words.

The documents of a source, in a seeded pseudorandom order, are one stream of
words packed into blocks of ``BLOCK`` words (the last may be shorter).  Each
source's quota of blocks follows its target.  The output is ``M`` slots in
shards of ``SHARD_SLOTS``: a pseudorandom permutation of the M quota units
deals sources to slots, so a shard's source counts are a multinomial draw
conditioned on the sources' totals, which therefore meet the targets.  The
n-th slot of a source is mapped through the source's own permutation of its
block numbers, another one for each pass over the source, and the slots are
joined with the blocks on (source, block).

Targets: sources by code point, null last, have the weights 1, 2, 3,
repeating, and share as many words as the input has; none exceeds
``MAX_PASSES`` times its source, and what is cut is shared by weight among
the others.

Defined cases: documents without words (empty, null) are in no block; null
is a source of its own; repeated rows are separate documents; an empty table
gives an empty mix.  One row for each source (not each document) passes one
task, where the targets are computed: good for some millions of sources.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.ordering import bucket_count, ranked
from ledgerlens.llm.shipping import ship
from ledgerlens.llm.tables import Tables
from ledgerlens.llm.text import BLANKS, mixed, null_safe, word_count

BLOCK = 128
SHARD_SLOTS = 4096
MAX_PASSES = 3
#: Quota units that one row of the slot generator expands to.
CHUNK = 8192

_ROUNDS = 4


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of 0..n-1 under ``key``, row by row: a Feistel
    network over the next even power of two, walked until the value is below n."""
    n = n.astype(np.uint64)
    bits = np.ceil(np.log2(np.maximum(n.astype(np.float64), 2))).astype(np.uint64)
    half = (bits + np.uint64(1)) // np.uint64(2)
    mask = (np.uint64(1) << half) - np.uint64(1)
    value, todo = index.astype(np.uint64), np.arange(len(index))
    key = key.astype(np.int64).view(np.uint64)
    while len(todo):
        left, right = value[todo] >> half[todo], value[todo] & mask[todo]
        for r in range(_ROUNDS):
            left, right = right, left ^ (mixed(right + key[todo] + np.uint64(r * 0x51ED270B)) & mask[todo])
        value[todo] = (left << half[todo]) | right
        todo = todo[value[todo] >= n[todo]]
    return value.astype(np.int64)


@F.pandas_udf(T.LongType())
def _permuted(index: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(permute(index.to_numpy(), n.to_numpy(), key.to_numpy()))


def _run(words: Column) -> Column:
    """Regular expression of a run of at most ``words`` words, without backtracking."""
    word = f"[^{BLANKS}]++"
    return F.concat(F.lit(f"{word}(?:[{BLANKS}]++{word}){{0,"), (words - 1).cast("string"), F.lit("}+"))


def cut_text(text: Column, start: Column, block: int) -> Column:
    """The text cut where its source's blocks end: each piece from its first to its last word."""
    first = F.concat(F.lit(f"^([{BLANKS}]*+"), _run(block - F.pmod(start, F.lit(block))), F.lit(")"))
    lead = F.call_function("regexp_extract", text, first, F.lit(1))
    rest = F.substr(text, F.length(lead) + 1)
    return F.concat(F.array(F.regexp_replace(lead, f"^[{BLANKS}]+", "")),
                    F.regexp_extract_all(rest, F.concat(F.lit("("), _run(F.lit(block)), F.lit(")")), F.lit(1)))


def targets(placed: DataFrame, block: int, max_passes: int = MAX_PASSES) -> DataFrame:
    """One row for each source: (src, source_size, target, blocks, quota, before).

    The shared level is found by sorting the sources by the level at which
    they are cut: a source is cut if the level left for it and all later ones
    reaches its own.
    """
    sizes = placed.groupBy("src").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy("src")
    named = sizes.withColumn("w", (F.pmod(F.row_number().over(by_name) - 1, F.lit(3)) + 1).cast("double"))
    named = named.withColumn("cap", (max_passes * F.col("source_size")).cast("double"))
    by_cap = Window.orderBy((F.col("cap") / F.col("w")), "src")
    earlier = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    later = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))) \
        / F.sum("w").over(later)
    cut = named.withColumn("level", level).withColumn("is_cut", F.col("cap") <= F.col("w") * F.col("level"))
    # Past the first source that is not cut the levels only fall.
    shared = F.coalesce(F.max(F.when(~F.col("is_cut"), F.col("level"))).over(whole), F.lit(0.0))
    out = cut.withColumn("target", F.when(F.col("is_cut"), F.col("cap")).otherwise(F.col("w") * shared))
    blocks = F.ceil(F.col("source_size") / F.lit(float(block))).cast("long")
    out = out.withColumn("blocks", blocks)
    quota = F.when(F.col("blocks") == 0, F.lit(0)).otherwise(F.least(
        max_passes * F.col("blocks"), F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long")))
    out = out.withColumn("quota", quota.cast("long"))
    before = by_name.rowsBetween(Window.unboundedPreceding, -1)
    return out.select("src", "source_size", "target", "blocks", "quota",
                      F.coalesce(F.sum("quota").over(before), F.lit(0)).cast("long").alias("before"),
                      F.sum("quota").over(whole).alias("slots"))


def _row_key(seed: int, *columns: str) -> list[Column]:
    """Two hashes, 128 bits in all, that tell rows apart unless they are equal in all ``columns``."""
    return [F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"), F.xxhash64(F.lit(~seed), "doc_id", "text", *columns).alias("k")]


def place(docs: DataFrame, seed: int, tables: Tables, *keep: str) -> DataFrame:
    """Each document with its source, size and place in the source's stream (``__start`` in words, ``__rank`` in
    documents), and the hashes ``h`` and ``k`` that name its row (by its text and ``keep``).  The text is read once and moves nowhere."""
    rows = tables.write(docs.select("doc_id", null_safe(F.col("source")).alias("src"), word_count(F.col("text")).alias("size"),
                                    *_row_key(seed, *keep)))
    rows = rows.withColumn("bucket", F.pmod("h", F.lit(bucket_count(rows.count()))))
    return ranked(rows, ["src"], "bucket", ["h", "doc_id", "k"], "size").drop("bucket")


def deal(sources: DataFrame, seed: int) -> DataFrame:
    """The slots: (shard, slot, src, block, pass), one row for each quota unit."""
    chunks = F.ceil(F.col("quota") / F.lit(CHUNK)).cast("long")
    rows = (sources.where("quota > 0")
            .select("*", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"))
            .repartition("src", "chunk"))
    low = F.col("chunk") * CHUNK
    rows = rows.select("src", "blocks", "before", "slots", F.explode(
        F.sequence(low, F.least(low + CHUNK, F.col("quota")) - 1)).alias("k"))
    turn = F.floor(F.col("k") / F.col("blocks")).cast("long")
    rows = rows.withColumn("pass", turn)
    return rows.select(
        _permuted(F.col("before") + F.col("k"), F.col("slots"), F.lit(seed).cast("long")).alias("place"), "src",
        _permuted(F.pmod("k", "blocks"), F.col("blocks"), F.xxhash64(F.lit(seed), "src", "pass")).alias("block"),
        "pass").select(F.floor(F.col("place") / SHARD_SLOTS).alias("shard"),
                       F.pmod("place", F.lit(SHARD_SLOTS)).alias("slot"), "src", "block", "pass")


def shard_counts(slots: DataFrame) -> DataFrame:
    """How many slots of each output shard each source fills."""
    return slots.groupBy("shard", "src").agg(F.count(F.lit(1)).alias("n"))


def mix(spark: SparkSession, docs: DataFrame, block: int = BLOCK, seed: int = 17, with_text: bool = True,
        keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pieces, placed, sources).

    ``pieces``: what each slot holds, one row for each document in its block:
    shard, slot, src, block, pass, doc_id, rank (the document's place in its
    source), from_word, to_word, the columns ``keep`` and, ``with_text``, the
    piece's text as ``__piece``.
    """
    ship(spark)
    tables = Tables(spark, "mixing")
    placed = tables.write(place(docs, seed, tables, *keep))
    sources = tables.write(targets(placed, block))
    slots = deal(sources, seed)
    start, end = F.col("__start"), F.col("__start") + F.col("size")
    first = F.floor(start / block).cast("long")
    cut = (placed.where("size > 0")
           .select("*", F.explode(F.sequence(first, F.floor((end - 1) / block).cast("long"))).alias("b"))
           .select(F.col("src").alias("s"), "b", "doc_id", F.col("__rank").alias("rank"), "h", "k", "__start",
                   (F.col("b") - first).cast("int").alias("i"),
                   F.greatest(F.col("b") * block - start, F.lit(0)).alias("from_word"),
                   F.least((F.col("b") + 1) * block - start, F.col("size")).alias("to_word")))
    # Both sides are exploded, which Spark's estimate of their size leaves out: unhinted, all slots would be
    # broadcast as soon as the few rows they come from are small.
    pieces = slots.join(cut.hint("merge"), (F.col("src") == F.col("s")) & (F.col("block") == F.col("b"))).drop("s", "b")
    if with_text:
        pieces = _with_pieces(pieces, docs, seed, block, keep)
    return pieces.drop("h", "k", "i", "__start"), placed, sources


def _with_pieces(pieces: DataFrame, docs: DataFrame, seed: int, block: int, keep: tuple[str, ...]) -> DataFrame:
    """``pieces`` with the columns ``keep`` of their row and their text as ``__piece``.

    What the mix takes of a row is gathered first (a row has few pieces, and each is
    taken ``MAX_PASSES`` times at most); then the row's text, which moves once, is cut once.  Equal rows have one text."""
    own = [c for c in pieces.columns if c not in ("src", "doc_id", "rank", "h", "k", "__start")]
    taken = pieces.groupBy("src", "doc_id", "rank", "h", "k", "__start").agg(F.collect_list(F.struct(*own)).alias("taken"))
    first = F.row_number().over(Window.partitionBy("h", "k").orderBy("h"))
    texts = docs.select(*_row_key(seed, *keep), F.col("text").alias("__text"), *keep)
    texts = texts.withColumn("__copy", first).where("__copy = 1").drop("__copy").withColumnsRenamed({"h": "h2", "k": "k2"})
    rows = taken.join(texts, (F.col("h") == F.col("h2")) & (F.col("k") == F.col("k2")))
    # Exploding one struct keeps the cut apart from its uses, which would else repeat it.
    made = F.explode(F.array(F.struct("taken", cut_text(F.col("__text"), F.col("__start"), block).alias("cut")))).alias("m")
    named = rows.select("src", "doc_id", "rank", *keep, made)
    chosen = F.transform("m.taken", lambda t: F.struct(t.alias("t"), F.element_at(F.col("m.cut"), t["i"] + 1).alias("piece")))
    return (named.select("src", "doc_id", "rank", *keep, F.explode(chosen).alias("c"))
            .select("src", "doc_id", "rank", *keep, "c.t.*", F.col("c.piece").alias("__piece")))
