"""Line dedup by overlapping windows of three lines.

Every three consecutive lines of a document are hashed to one window.  A
window found at several places keeps its first place (smallest doc_id, null
last, then the text's hash, then the line); the later places lose their
lines, and covered positions of overlapping windows merge.  A later place
that overlaps its own first one loses only the lines beyond it.

Defined cases: documents of fewer than three lines have no window and stay
as they are; windows without any word are not counted; lines compare exactly
but for blanks at their ends; null text stays null; a document may end empty.
Rows equal in doc_id and text are one document: they keep the same lines.
Windows compare by a 64-bit hash of the lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def _lines(docs: DataFrame) -> DataFrame:
    """Key of each document and the windows of its lines, one row each."""
    text = F.col("text")
    keyed = docs.where(text.isNotNull()).select(
        *_key(docs), F.transform(F.split(text, "\n", -1), lambda x: F.xxhash64(F.trim(x))).alias("__h"))
    blank = F.xxhash64(F.lit(""))
    n = F.size("__h")
    # The outer form, so that no filter on the array's size is pushed below and splits every text twice.
    starts = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW))
    windows = keyed.select("__id", "__fp", "__h", F.explode_outer(starts).alias("__pos")).where("__pos is not null")
    at = [F.col("__h")[F.col("__pos") + i] for i in range(WINDOW)]
    worded = F.lit(False)
    for x in at:
        worded = worded | (x != blank)
    return windows.where(worded).select("__id", "__fp", "__pos", F.xxhash64(*at).alias("__w"))


def _key(docs: DataFrame):
    """Sort key of a document: its id, null after all others, then its text."""
    return (F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("__id"),
            F.xxhash64(F.col("doc_id"), F.col("text")).alias("__fp"))


def covered_lines(docs: DataFrame) -> DataFrame:
    """(__id, __fp, __gone): sorted line numbers that each document loses.

    The windows are counted per hash with partial sums before the shuffle, so
    a window that stands everywhere is one row per task; places join that
    small side, and a hot window's places can be split.
    """
    windows = _lines(docs)
    place = F.struct("__id", "__fp", "__pos")
    first = (windows.groupBy("__w").agg(F.min(place).alias("__first"), F.max(place).alias("__last"))
             .where(F.col("__first") != F.col("__last"))
             .select(F.col("__w").alias("__k"), "__first"))
    later = windows.join(first, F.col("__w") == F.col("__k")).where(place != F.col("__first"))
    own = (F.col("__id") == F.col("__first.__id")) & (F.col("__fp") == F.col("__first.__fp"))
    start = F.when(own, F.greatest(F.col("__pos"), F.col("__first.__pos") + WINDOW)).otherwise(F.col("__pos"))
    end = F.col("__pos") + (WINDOW - 1)
    return (later.select("__id", "__fp", start.alias("__a"), end.alias("__b")).where("__a <= __b").distinct()
            .groupBy("__id", "__fp")
            .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.sequence("__a", "__b"))))).alias("__gone")))


def line_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cleaned, and ``__n_lines`` and ``__n_removed``
    (long; null text has no lines).  All other columns stay."""
    gone = covered_lines(docs).select(F.col("__id").alias("__gid"), F.col("__fp").alias("__gfp"), "__gone")
    keyed = docs.select("*", *_key(docs))
    out = keyed.join(gone, (F.col("__id") == F.col("__gid")) & (F.col("__fp") == F.col("__gfp")), "left")
    flag = F.col("__gone").isNull()
    out = out.withColumn("__lines", F.split(F.col("text"), "\n", -1))
    n = F.size("__lines")
    left = F.array_except(F.sequence(F.lit(0), n - 1), F.col("__gone"))
    kept = F.array_join(F.transform(left, lambda i: F.col("__lines")[i]), "\n")
    out = out.select(
        *[F.when(flag, F.col("text")).otherwise(kept).alias(c) if c == "text" else F.col(c) for c in docs.columns],
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(n).cast("long").alias("__n_lines"),
        F.when(flag, F.lit(0)).otherwise(F.size("__gone")).cast("long").alias("__n_removed"))
    return out
