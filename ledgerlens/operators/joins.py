"""Broadcast only behind a checked size.

A dimension is broadcast when an upper bound on its rows is known and under
a limit; otherwise the join stays a shuffle join (sort-merge, with AQE free
to convert it after measuring, and to split skewed keys).

The bound comes from the dimension's source table: a Parquet row count is
answered from file footers (no column data is read), and the Silver
filters and unique-key lookups applied on the way only remove rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes above which a dimension is never broadcast: an upper bound on its rows
# times the width of the columns that are joined.  Override with the session
# conf key below.
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
CONF_KEY = "ledgerlens.broadcast.maxBytes"

# What a value is taken to occupy, where its type does not say.
_TEXT_BYTES = 40


def row_bytes(df: DataFrame) -> int:
    """Estimated bytes of a row of ``df`` in memory."""
    wide = {"string": _TEXT_BYTES, "binary": _TEXT_BYTES, "map": 400, "array": 400, "struct": 400}
    return 16 + sum(wide.get(f.dataType.typeName(), 16) for f in df.schema.fields)


def max_broadcast_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get(CONF_KEY, str(DEFAULT_MAX_BROADCAST_BYTES)))


def fits_broadcast(dim: DataFrame, row_bound: int | None, max_bytes: int | None = None) -> bool:
    """Whether ``row_bound`` (an upper bound on the rows) is known and within the limit."""
    limit = max_bytes if max_bytes is not None else max_broadcast_bytes(dim.sparkSession)
    return row_bound is not None and row_bound * row_bytes(dim) <= limit


def source_row_count(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table: footer metadata only, cost grows with the
    number of files, not with their size."""
    return spark.read.parquet(path).select(F.lit(1)).count()


def source_row_counts(spark: SparkSession, paths: dict[str, str]) -> dict[str, int]:
    """Row counts of several Parquet tables in one job (footers only)."""
    from functools import reduce
    parts = [spark.read.parquet(p).select(F.lit(k).alias("_t")) for k, p in paths.items()]
    counts = reduce(lambda a, b: a.unionByName(b), parts).groupBy("_t").count().collect()
    out = {k: 0 for k in paths}
    out.update({r["_t"]: r["count"] for r in counts})
    return out


def checked_broadcast(dim: DataFrame, row_bound: int | None, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(dim)`` when ``row_bound`` (an upper bound on its rows) is
    known and its bytes within the limit; the dimension unchanged otherwise."""
    return F.broadcast(dim) if fits_broadcast(dim, row_bound, max_bytes) else dim


#: Keys salted at most: the list of hot keys is broadcast.
MAX_HOT_KEYS = 1000
#: Parts into which the rows of a hot key are dealt.
SALTS = 16


def hot_keys(fact: DataFrame, key: str, hot_fraction: float = 0.01) -> DataFrame:
    """The keys that hold at least ``hot_fraction`` of ``fact``'s rows, as a
    lazy one-column frame ``_hot`` (there are 1 / hot_fraction of them at most).
    It reads the key column alone, and counts before the shuffle."""
    counts = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.orderBy(F.col("_n").desc(), key).limit(min(MAX_HOT_KEYS, max(1, int(1 / hot_fraction))))
    rows = fact.agg(F.count(F.lit(1))).scalar()
    return top.filter(F.col("_n") >= hot_fraction * rows).select(F.col(key).alias("_hot"))


def hot_key_lists(fact: DataFrame, keys, hot_fraction: float = 0.01) -> dict[str, Column]:
    """For each of ``keys`` the values that hold at least ``hot_fraction`` of
    ``fact``'s rows, as an array: parts of one subquery, so that the fact's key
    columns are read once however many keys and joins ask for them.

    Each task keeps a sketch of frequent values for every key (Misra-Gries) and
    forwards nothing else, so no count of each single value is shuffled.  The
    sketch is off by a fifth of ``hot_fraction`` at most: it misses no hot value, and
    one that is nearly hot may be taken for hot, which changes no result."""
    keys = list(keys)
    tracked = 1 << (math.ceil(20 / hot_fraction) - 1).bit_length()
    top = [F.expr(f"approx_top_k(`{k}`, {math.ceil(2 / hot_fraction)}, {tracked})").alias(f"_k{j}") for j, k in enumerate(keys)]
    counts = fact.agg(F.count(F.lit(1)).alias("_n"), *top)

    def hot(column: str) -> Column:
        often = F.filter(column, lambda e: e["item"].isNotNull() & (e["count"] >= F.lit(hot_fraction) * F.col("_n")))
        return F.transform(often, lambda e: e["item"]).alias(column)

    lists = counts.select(F.struct(*[hot(f"_k{j}") for j in range(len(keys))]).alias("hot")).scalar()
    return {k: lists[f"_k{j}"] for j, k in enumerate(keys)}


def deal(*columns: str, salts: int = SALTS) -> Column:
    """The salt of a row whose key is hot: a hash of its own values, so a task that runs again deals every row as before."""
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def salted_left_join(fact: DataFrame, dim: DataFrame, key: str, row_id: str, salts: int = SALTS,
                     hot: DataFrame | Column | None = None, hot_fraction: float = 0.01,
                     dealt: str | None = None) -> DataFrame:
    """Left join that splits hot keys without relying on AQE: fact rows of a
    hot key get one of ``salts`` salts, a hash of ``row_id``, so a task that
    runs again deals every row as before; only the dimension rows of hot keys
    are replicated ``salts`` times.  Each fact row still meets exactly one
    dimension row, so the result equals the plain left join.  Nothing runs
    before the plan does: ``hot`` (a frame with the column ``_hot``, by default
    :func:`hot_keys` of the fact, or an array of :func:`hot_key_lists`) is part
    of it.  ``dealt`` names a column that holds :func:`deal` already, where
    several joins of one fact would otherwise carry the row id for it."""
    salt = F.col(dealt) if dealt else deal(row_id, salts=salts)
    replicas = lambda is_hot: F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    if isinstance(hot, Column):
        f = fact.withColumn("_salt", F.when(F.array_contains(hot, F.col(key)), salt).otherwise(F.lit(0)))
        d = dim.withColumn("_salt", F.explode(replicas(F.array_contains(hot, F.col(key)))))
    else:
        hot = F.broadcast(hot if hot is not None else hot_keys(fact, key, hot_fraction))
        f = fact.join(hot, fact[key] == hot["_hot"], "left").withColumn(
            "_salt", F.when(F.col("_hot").isNotNull(), salt).otherwise(F.lit(0))).drop("_hot")
        d = dim.join(hot, dim[key] == hot["_hot"], "left")
        d = d.withColumn("_salt", F.explode(replicas(F.col("_hot").isNotNull()))).drop("_hot")
    return f.join(d, [key, "_salt"], "left").drop("_salt")
