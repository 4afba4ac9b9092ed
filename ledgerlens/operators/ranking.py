"""Distributed global ranking: NTILE and quantile bins without a
single-partition window.

``Window.orderBy(...)`` with no partition key moves every row to one task.
Instead, for one or several sort keys at once:

1. The keys are stacked into one narrow frame ``(id, metric, null_rank,
   key)`` (descending keys are negated).
2. A bounded sample, the rows whose hashes are smallest, gives bounds of the
   composite ``(metric, null_rank, key, id)``.  A row's bucket is the number of
   bounds it reaches: a pure function of the row and of the bounds, so every branch of the
   plan, and every task that runs again, puts it into the same bucket, with or
   without exchange reuse.  As bounds hold the id, a value shared by a third
   of all rows is still split.
3. A window ranks the rows inside each (metric, bucket), and the counts of the
   buckets - at most buckets + metrics rows, broadcast back - give each its
   offset.
4. NTILE(k) and exact quantile edges are arithmetic on (rank, count).

The driver sees the sample (``SAMPLE`` rows for each bucket asked for), never the data; the buckets
asked for are the shuffle partitions, however many.
"""

from __future__ import annotations

from decimal import Decimal, localcontext
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import ensure_checkpoint_dir

#: Sampled rows for each bucket: the fullest of many buckets holds about twice its share.
SAMPLE = 32


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    return max(1, int(num_partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def _common_key_type(df: DataFrame, cols) -> T.DataType | None:
    """Exact common numeric type for the stacked sort keys; None if no decimal holds them all."""
    scale, int_digits = 0, 1
    for c in cols:
        t = df.schema[c].dataType
        if isinstance(t, T.DecimalType):
            scale = max(scale, t.scale)
            int_digits = max(int_digits, t.precision - t.scale)
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            int_digits = max(int_digits, 19)
        elif isinstance(t, (T.FloatType, T.DoubleType)):
            return T.DoubleType() if len(cols) == 1 else None
        else:
            raise TypeError(f"rank key {c!r} must be numeric, got {t.simpleString()}")
    return T.DecimalType(int_digits + scale, scale) if int_digits + scale <= 38 else None


_ORDER = ("_m", "_nr", "_key", "_id")


def _bounds(stacked: DataFrame, buckets: int) -> Column:
    """Sorted bounds of the composite order, ``buckets`` - 1 at most, as a one-row subquery."""
    spark = stacked.sparkSession
    h = F.xxhash64("_m", "_id")
    sample = stacked.orderBy(h, "_m", "_id").limit(SAMPLE * buckets).orderBy(*_ORDER).select(*_ORDER).collect()
    step = max(1, -(-len(sample) // buckets))
    kind = T.ArrayType(stacked.select(F.struct(*_ORDER).alias("b")).schema["b"].dataType)
    rows = [[tuple(r) for r in sample[step::step]]]
    return spark.createDataFrame([rows], T.StructType([T.StructField("bounds", kind)])).scalar()


def _bucketed(stacked: DataFrame, bounds: Column, most: int = (1 << 31) - 1) -> DataFrame:
    """``stacked`` with ``_b``: how many bounds (``most`` at most) a row reaches, found by halving.

    It is never null, so that no join filters by it, which would search twice."""
    return stacked.withColumn("_bounds", bounds).withColumn("_b", F.coalesce(_bucket(F.col("_bounds"), most), F.lit(0))).drop("_bounds")


def _bucket(bounds: Column, most: int) -> Column:
    here, n = F.struct(*_ORDER), F.size(bounds)
    steps = [1 << i for i in reversed(range(most.bit_length()))]

    def further(reached: Column, step: Column) -> Column:
        # The bound is looked at only where there is one.
        ahead = F.when(step <= n - reached, F.get(bounds, reached + step - 1) <= here)
        return F.when(ahead, reached + step).otherwise(reached)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further)


def global_ranks(df: DataFrame, id_col: str, specs, num_partitions: int | None = None) -> DataFrame:
    """0-based ranks of every row under each sort spec.

    ``specs``: list of ``(key_col, ascending, nulls_first)``.  ``id_col``
    must be unique in ``df``; it breaks ties (ascending).  Returns a long
    frame ``(_id, _m, _key, _rank, _n)``: one row per input row and spec,
    with the spec index ``_m``, the sign-adjusted key, the rank and the
    spec's row count.  Keys of several types are ranked as one decimal type that holds them
    all; where there is none each has a pass of its own.
    """
    key_type = _common_key_type(df, [s[0] for s in specs])
    if key_type is None:
        alone = [global_ranks(df, id_col, [s], num_partitions).withColumn("_m", F.lit(i)) for i, s in enumerate(specs)]
        return reduce(lambda a, b: a.unionByName(b), [r.withColumn("_key", F.col("_key").cast("double")) for r in alone]) \
            if len(alone) > 1 else alone[0]
    entries = []
    for i, (key, asc, nulls_first) in enumerate(specs):
        k = F.col(key).cast(key_type)
        null_rank = F.when(k.isNull(), F.lit(0 if nulls_first else 2)).otherwise(F.lit(1))
        entries.append(F.struct(F.lit(i).alias("_m"), null_rank.alias("_nr"),
                                (k if asc else -k).alias("_key")))
    # One pass over the input emits one row per spec (no union, so the
    # upstream plan is not repeated per spec).
    stacked = df.select(F.col(id_col).alias("_id"), F.inline(F.array(*entries)))
    buckets = _partitions(df, num_partitions) * len(specs)
    placed = _bucketed(stacked, _bounds(stacked, buckets), buckets)
    inside = Window.partitionBy("_m", "_b").orderBy("_nr", "_key", "_id")
    ranked = placed.withColumn("_pos", F.row_number().over(inside) - 1)
    earlier = Window.partitionBy("_m").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # The counts come from the ranked rows, so that both branches share one
    # exchange and a row's bucket is searched once.
    offsets = ranked.groupBy("_m", "_b").agg((F.max("_pos") + 1).alias("_c")).select(
        "_m", "_b", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_off"),
        F.sum("_c").over(Window.partitionBy("_m")).alias("_n"))
    j = ranked.join(F.broadcast(offsets), ["_m", "_b"], "inner")
    return j.select("_id", "_m", "_key", (F.col("_pos") + F.col("_off")).alias("_rank"), "_n")


def ntile_expr(rank: Column, n: Column, k: int) -> Column:
    """NTILE(k) (1-based) for a 0-based rank among n rows: the first n mod k
    buckets hold one extra row, as in SQL."""
    if k <= 0:
        raise ValueError("k must be positive")
    q = F.floor(n / F.lit(k))
    r = n - q * F.lit(k)
    big = r * (q + 1)
    return (F.when(q == 0, rank + 1)
            .when(rank < big, F.floor(rank / (q + 1)) + 1)
            .otherwise(r + F.floor((rank - big) / q) + 1)).cast("int")


def add_ntiles(df: DataFrame, id_col: str, specs, k: int,
               num_partitions: int | None = None) -> DataFrame:
    """Add ``NTILE(k) OVER (ORDER BY key [DESC], id)`` columns for several
    sort keys in one distributed pass.

    ``specs``: list of ``(out_col, key_col, ascending, nulls_first)``.  The
    scores are pivoted back per id (one shuffle of narrow rows) and joined
    to ``df`` on ``id_col``.
    """
    ranks = global_ranks(df, id_col, [(s[1], s[2], s[3]) for s in specs], num_partitions)
    tiles = ranks.select("_id", "_m", ntile_expr(F.col("_rank"), F.col("_n"), k).alias("_t"))
    wide = tiles.groupBy("_id").agg(*[F.max(F.when(F.col("_m") == i, F.col("_t"))).alias(s[0])
                                      for i, s in enumerate(specs)])
    wide = wide.withColumnRenamed("_id", id_col)
    return df.join(wide, id_col, "left")


def add_ntile(df: DataFrame, id_col: str, out_col: str, key_col: str, k: int,
              ascending: bool = True, nulls_first: bool | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """Single-key form of :func:`add_ntiles` (Spark's default null order:
    first for ascending, last for descending)."""
    nf = ascending if nulls_first is None else nulls_first
    return add_ntiles(df, id_col, [(out_col, key_col, ascending, nf)], k, num_partitions)


# ---- quantile bins (qcut) ---------------------------------------------------------

def _linear_edge(values: dict[int, object], h: Fraction):
    lo = h.numerator // h.denominator
    frac = h - lo
    v_lo = Fraction(values[lo])
    if frac == 0:
        return v_lo
    v_hi = Fraction(values[lo + 1])
    return v_lo + frac * (v_hi - v_lo)


def quantile_edges(df: DataFrame, id_col: str, value_cols, q: int,
                   num_partitions: int | None = None) -> dict[str, list[Fraction]]:
    """Exact linear-interpolated quantile edges at i/q, i = 0..q, for each
    column (the rule of pandas ``qcut``; nulls ignored).  One job: the ranks
    are distributed, and only the <= 2(q+1) rows per column at the needed
    ranks reach the driver."""
    value_cols = list(value_cols)
    # Nulls sort last, so ranks 0..n_nonnull-1 are the non-null values.
    ranks = global_ranks(df, id_col, [(c, True, False) for c in value_cols], num_partitions)
    nn = ranks.groupBy("_m").agg(F.count("_key").alias("_nn"))
    ranks = ranks.filter(F.col("_key").isNotNull()).join(F.broadcast(nn), "_m")
    n1 = F.col("_nn") - 1
    conds = []
    for i in range(q + 1):
        lo = F.floor(n1 * F.lit(i) / F.lit(q))
        conds.append((F.col("_rank") == lo) | (F.col("_rank") == lo + 1))
    picked = ranks.filter(reduce(lambda a, b: a | b, conds)) \
        .select("_m", "_rank", "_key", "_nn").collect()
    out: dict[str, list[Fraction]] = {}
    for m, c in enumerate(value_cols):
        rows = [r for r in picked if r["_m"] == m]
        if not rows:
            out[c] = []
            continue
        n = rows[0]["_nn"]
        values = {r["_rank"]: r["_key"] for r in rows}
        hs = [Fraction(n - 1) * Fraction(i, q) for i in range(q + 1)]
        out[c] = [_linear_edge(values, h) for h in hs]
    return out


def _lit_edge(e: Fraction) -> Column:
    """Decimal literal for an edge: exact when it terminates in base 10
    (always for q = 5 over 4-decimal values), else 30 significant digits."""
    with localcontext() as ctx:
        ctx.prec = 30
        d = Decimal(e.numerator) / Decimal(e.denominator)
    return F.lit(d)


def bin_by_edges(value: Column, edges: list[Fraction], duplicates: str = "raise") -> Column:
    """Right-closed bins 1..len(edges)-1 with the minimum in bin 1."""
    if not edges:
        return F.lit(None).cast("int")
    uniq = sorted(set(edges))
    if len(uniq) != len(edges) and duplicates == "raise":
        raise ValueError(f"Bin edges must be unique: {[float(e) for e in edges]}")
    expr = None
    for i, e in enumerate(uniq[1:-1], start=1):
        cond = value <= _lit_edge(e)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    top = len(uniq) - 1
    expr = F.lit(top) if expr is None else expr.otherwise(F.lit(top))
    return F.when(value.isNotNull(), expr).cast("int")


def qcut(df: DataFrame, id_col: str, specs, q: int, duplicates: str = "raise",
         num_partitions: int | None = None) -> DataFrame:
    """Quantile bins 1..q like pandas ``qcut(x, q, labels=1..q)`` for several
    columns: ``specs`` = list of ``(value_col, out_col)``.  Duplicate edges
    raise (pandas default) or, with ``duplicates='drop'``, are merged."""
    # The edges are a separate job: pin the input once in the shared
    # checkpoint directory so its upstream plan is not computed twice (and
    # its lineage is cut).
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    edges = quantile_edges(df, id_col, [s[0] for s in specs], q, num_partitions)
    return df.withColumns({out: bin_by_edges(F.col(v), edges[v], duplicates) for v, out in specs})
