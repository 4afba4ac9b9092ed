"""Approximate nearest neighbours by shifted space-filling curves.

For each of several curves the vectors are projected on a few random
orthonormal directions, laid by the share of vectors below them along each on
a grid with a random shift, and numbered along a Hilbert curve.  So a dense
group takes as much of the grid as it has vectors, and is ordered within itself
however close they are.  Each order is range-partitioned in Spark and ranked; a query
is compared by exact distance with all vectors in the window around its own
rank, and the best of all curves are merged and ranked again.

A window is a share of the order, so recall does not fall as a table of the
same kind grows.  Orders are cut into blocks of ``BLOCK`` vectors and queries
are sent to the blocks that their windows touch, in parts of at most
``QUERIES``, so a task holds one block and one part at a time.  Candidate
pairs exist only inside tasks; each block returns at most k rows for a query.

Defined cases: vectors that are null or zero, hold null or non-finite
components, or have another dimension than most vectors take no part, neither
do null ids; equal vectors are one point with its smallest ids, so a vector that
a third of all rows have is one point too; ties go to the smaller id; an id on
several rows counts once, with its nearest vector, and never as its own
neighbour; with fewer candidates than ``k`` all are returned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.ordering import ranked
from ledgerlens.llm.shipping import ship
from ledgerlens.session import ensure_checkpoint_dir

NEIGHBOURS = 10
CURVES = 24
#: Directions of a projection, and bits of the grid along each.
AXES, BITS = 8, 5
#: Half a window, as a share of all vectors, and at least so many.
WINDOW_SHARE, WINDOW_LEAST = 0.025, 256
#: Vectors from which the shares along an axis are estimated, about, and the steps of the estimate.
SAMPLE, KNOTS = 8192, 256
BLOCK = 1024
QUERIES = 4096


def hilbert(grid: np.ndarray, bits: int) -> np.ndarray:
    """Place of each grid point (rows of unsigned integers below 2^bits) on the
    Hilbert curve, after Skilling's transposition."""
    x = [c.copy() for c in np.asarray(grid, np.uint64).T]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q = np.uint64(1 << level)
        low = q - np.uint64(1)
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        q = np.uint64(1 << level)
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - np.uint64(1)), turn)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for c in x:
            key = (key << np.uint64(1)) | (((c ^ turn) >> np.uint64(level)) & np.uint64(1))
    return key.astype(np.int64)


def _frames(dimension: int, curves: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Directions and shift (in widths of the grid) of each curve."""
    rng = np.random.Generator(np.random.PCG64(seed))
    axes = min(AXES, dimension)
    return [(np.linalg.qr(rng.standard_normal((dimension, axes)))[0], rng.random(axes)) for _ in range(curves)]


def usable(vectors: DataFrame, identity: str, column: str) -> DataFrame:
    """(id, fp, v): the rows that take part; fp is the vector's hash."""
    v = F.col(column)
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.select(F.col(identity).cast("long").alias("id"), v.cast("array<float>").alias("v"), whole.alias("w"))
            .where("id is not null and w").where(F.exists("v", lambda x: x != 0)))
    return rows.select("id", F.xxhash64("v").alias("fp"), "v")


def _distinct(rows: DataFrame, ids: int) -> DataFrame:
    """(fp, v, ids): each vector once with the smallest of its ids, ``ids`` at
    most (each task forwards no more of a vector that many rows have)."""
    order = Window.partitionBy("fp").orderBy("id")
    heads = rows.dropDuplicates(["fp", "id"]).withColumn("n", F.row_number().over(order)).where(F.col("n") <= ids)
    return heads.groupBy("fp").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids"))


def neighbours(spark: SparkSession, vectors: DataFrame, is_query, k: int = NEIGHBOURS, curves: int = CURVES,
               share: float = WINDOW_SHARE, least: int = WINDOW_LEAST, identity: str = "vec_id",
               column: str = "embedding", seed: int = 3) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows for which ``is_query``, a
    function of the id column, holds; all usable rows are candidates."""
    ensure_checkpoint_dir(spark)
    ship(spark)
    every = usable(vectors, identity, column)
    rows = _distinct(every, k + 1).checkpoint()
    dimensions = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "q long, c long, score double"
    if dimensions is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d = dimensions["d"]
    rows = rows.where(F.size("v") == d)
    count = rows.count()
    # fp is a hash: the same sample each time, of rows spread over the table.
    step = max(1, count // SAMPLE)
    sample = rows.where(F.pmod("fp", F.lit(step)) == 0).select("v").collect() or rows.limit(1).select("v").collect()
    sample = np.array([r["v"] for r in sample], np.float64)
    frames = [(axes, shift, np.quantile(sample @ axes, np.linspace(0, 1, KNOTS), axis=0))
              for axes, shift in _frames(d, curves, seed)]
    del sample

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def keys(v: pd.Series) -> pd.Series:
        x = np.array(v.tolist(), np.float64).reshape(len(v), d)
        out = np.empty((len(x), curves), np.int64)
        for c, (axes, shift, knots) in enumerate(frames):
            # The share of the vectors below along each axis takes half the grid; the shift moves it within all of it.
            below = [np.searchsorted(k, a) / KNOTS for k, a in zip(knots.T, (x @ axes).T, strict=True)]
            at = np.stack(below, axis=1) + shift
            out[:, c] = hilbert((at / 2 * (1 << BITS)).clip(0, (1 << BITS) - 1), BITS)
        return pd.Series(list(out))

    orders = (rows.select("fp", F.posexplode(keys("v")).alias("curve", "key"))
              .repartitionByRange("curve", "key", "fp").withColumn("run", F.spark_partition_id()).checkpoint())
    half = max(least, int(np.ceil(share * count)))
    places = ranked(orders, ["curve"], "run", ["key", "fp"]).select("fp", "curve", "__rank")
    placed = places.join(rows.select("fp", "v"), "fp")
    parts = max(1, -(-(2 * half + BLOCK) // (100 * QUERIES)))
    every_part = F.sequence(F.lit(0), F.lit(parts - 1))
    blocks = placed.select("fp", "v", "curve", F.floor(F.col("__rank") / BLOCK).cast("long").alias("block"),
                           F.explode(every_part).alias("part"))
    touched = F.sequence(F.floor(F.greatest(F.col("__rank") - half, F.lit(0)) / BLOCK).cast("long"),
                         F.floor(F.least(F.col("__rank") + half, F.lit(count - 1)) / BLOCK).cast("long"))
    queries = every.where(is_query(F.col("id"))).select(F.col("id").alias("query_id"), F.col("fp").alias("query_fp"))
    queries = queries.distinct().checkpoint()
    asked = placed.join(queries.select(F.col("query_fp").alias("fp")).distinct(), "fp", "left_semi").select(
        F.col("fp").alias("q"), F.col("v").alias("u"), F.col("curve").alias("q_curve"), F.explode(touched).alias("q_block"),
        F.pmod("fp", F.lit(parts)).cast("int").alias("q_part"))

    def nearest(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(queries):
            return pd.DataFrame({"q": [], "c": [], "score": []})
        names = block["fp"].to_numpy()
        points = np.array(block["v"].tolist(), np.float64)
        wanted = min(k + 1, len(names))
        found = []
        for q, u in zip(queries["q"], queries["u"], strict=True):
            far = np.sqrt(np.square(points - np.asarray(u, np.float64)).sum(axis=1))
            # All at the edge are kept: which of equally far ones counts depends on their ids.
            near = np.flatnonzero(far <= np.partition(far, wanted - 1)[wanted - 1])
            found += [(q, names[i], far[i]) for i in near]
        return pd.DataFrame(found, columns=["q", "c", "score"])

    best = (blocks.groupBy("curve", "block", "part").cogroup(asked.groupBy("q_curve", "q_block", "q_part"))
            .applyInPandas(nearest, schema).distinct())
    # From vectors to the rows that have them: of each vector the k + 1 smallest ids are enough.
    named = best.join(rows.select(F.col("fp").alias("c"), F.explode("ids").alias("vec_id")), "c")
    named = named.groupBy("q", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("q").orderBy("score", "vec_id")
    named = named.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    pairs = queries.join(named, F.col("query_fp") == F.col("q")).where(F.col("query_id") != F.col("vec_id"))
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
