"""Ranks and running sums inside groups, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one window partition holds on average.
BUCKET_ROWS = 20_000


def bucket_count(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Buckets for ``rows`` rows; grows with the table."""
    return max(1, -(-rows // bucket_rows))


def ranked(df: DataFrame, group: list[str], bucket: str, order: list[str], size: str | None = None) -> DataFrame:
    """Add ``__rank`` (from 0) and, with ``size``, ``__start`` (sum of the
    sizes before the row), both within ``group`` in the order (bucket, order).

    ``bucket`` must not decrease along that order and ``group`` holds no
    nulls.  Two levels keep a hot group divided: a window ranks the rows
    inside one (group, bucket), and the totals of the buckets, one small
    row each, give every bucket its offset.
    """
    value = F.col(size) if size else F.lit(0)
    keys = [*group, bucket]
    totals = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__v"))
    before = Window.orderBy(bucket) if not group else Window.partitionBy(*group).orderBy(bucket)
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(k).alias(f"__o_{i}") for i, k in enumerate(keys)],
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n0"),
                            F.coalesce(F.sum("__v").over(before), F.lit(0)).alias("__v0"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    local = df.withColumn("__rank", (F.row_number().over(inside) - 1).cast("long"))
    if size:
        run = inside.rowsBetween(Window.unboundedPreceding, -1)
        local = local.withColumn("__start", F.coalesce(F.sum(size).over(run), F.lit(0)).cast("long"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & (local[k] == offsets[f"__o_{i}"])
    out = local.join(offsets, same).withColumn("__rank", F.col("__rank") + F.col("__n0"))
    if size:
        out = out.withColumn("__start", F.col("__start") + F.col("__v0"))
    return out.drop("__n0", "__v0", *[f"__o_{i}" for i in range(len(keys))])
