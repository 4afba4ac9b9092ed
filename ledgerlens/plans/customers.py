"""Customer models: RFM-segmented dimension and the quantile RFM variant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import as_date_lit, as_ts_lit, days_between
from ledgerlens.functions.tiers import lifetime_tier, rfm_segment, score_segment
from ledgerlens.operators.ranking import add_ntiles, qcut
from ledgerlens.session import ensure_checkpoint_dir

# Defaults for a customer without (non-cancelled) sales, and
# the number of RFM buckets.
NO_SALES_DAYS = 9999
NO_SALES_SCORE = 1
NO_SALES_RFM_TOTAL = 3
RFM_BUCKETS = 5


def customer_sales_stats(fct: DataFrame, as_of=None) -> DataFrame:
    """Per-customer order stats over non-cancelled sales (A1, A2).

    Partial aggregation runs map-side, so a customer holding a large share
    of all rows still leaves one small partial row per input partition.
    The distinct product count adds one Expand leg (keyed by customer and
    product, which spreads a hot customer across tasks).
    """
    base = fct.filter(F.col("status") != "cancelled")
    stats = base.groupBy("customer_id").agg(
        F.count("*").alias("total_orders"),
        F.sum("net_revenue").alias("lifetime_value"),
        F.sum("net_revenue").alias("_rev_sum"),
        F.count("net_revenue").alias("_rev_n"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count_distinct("product_id").alias("unique_products_bought"),
        F.sum("gross_profit").alias("total_gross_profit"),
    )
    return stats.select(
        "customer_id", "total_orders", "lifetime_value",
        # mean = sum / count in decimal (14 fractional digits), rounded once.
        F.round(F.col("_rev_sum").cast("decimal(28,4)") / F.col("_rev_n"), 2)
         .cast("decimal(18,2)").alias("avg_order_value"),
        "first_order_date", "last_order_date",
        days_between(F.col("last_order_date"), as_date_lit(as_of)).alias("days_since_last_order"),
        "unique_products_bought", "total_gross_profit",
    )


def rfm_scores(stats: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """NTILE(5) recency (days DESC), frequency (orders) and monetary (value)
    scores, tie-broken by customer_id, all three from one distributed
    ranking pass (no single-partition window)."""
    return add_ntiles(stats, "customer_id", [
        ("recency_score", "days_since_last_order", False, False),
        ("frequency_score", "total_orders", True, True),
        ("monetary_score", "lifetime_value", True, True),
    ], RFM_BUCKETS, num_partitions)


def dim_customers(customers: DataFrame, fct: DataFrame, as_of=None, run_ts=None,
                  num_partitions: int | None = None) -> DataFrame:
    """Customer dimension with RFM segmentation (M6).

    Scores are computed on the stats frame itself, so customers join the
    stats once (one left join instead of two).  Customers without sales get
    the documented defaults: scores 1/1/1, total 3, days 9999, Lost, Bronze.
    """
    # The stats feed both the ranking and the final join, and column pruning
    # would give the two branches different aggregates (no exchange reuse):
    # pin them once in the shared checkpoint directory so the fact plan runs
    # once (customer-sized, and the lineage is cut).
    ensure_checkpoint_dir(fct.sparkSession)
    stats = customer_sales_stats(fct, as_of).checkpoint(eager=True)
    stats = rfm_scores(stats, num_partitions)
    j = customers.join(stats, "customer_id", "left")
    r = F.coalesce(F.col("recency_score"), F.lit(NO_SALES_SCORE))
    f = F.coalesce(F.col("frequency_score"), F.lit(NO_SALES_SCORE))
    m = F.coalesce(F.col("monetary_score"), F.lit(NO_SALES_SCORE))
    zero = F.lit(0)
    return j.select(
        *[F.col(c) for c in customers.columns],
        F.coalesce(F.col("total_orders"), zero).cast("bigint").alias("total_orders"),
        F.coalesce(F.col("lifetime_value"), zero.cast("decimal(28,4)")).alias("lifetime_value"),
        F.coalesce(F.col("avg_order_value"), zero.cast("decimal(18,2)")).alias("avg_order_value"),
        "first_order_date", "last_order_date",
        F.coalesce(F.col("days_since_last_order"), F.lit(NO_SALES_DAYS).cast("bigint")).alias("days_since_last_order"),
        F.coalesce(F.col("unique_products_bought"), zero).cast("bigint").alias("unique_products_bought"),
        F.coalesce(F.col("total_gross_profit"), zero.cast("decimal(32,4)")).alias("total_gross_profit"),
        r.alias("recency_score"), f.alias("frequency_score"), m.alias("monetary_score"),
        F.coalesce(F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score"),
                   F.lit(NO_SALES_RFM_TOTAL)).alias("rfm_total"),
        rfm_segment(r, f, m).alias("customer_segment"),
        lifetime_tier(F.col("lifetime_value")).alias("lifetime_tier"),
        (F.coalesce(F.col("total_orders"), zero) > 0).alias("is_active"),
        as_ts_lit(run_ts).alias("_updated_at"),
    )


def rfm_quantile(fct: DataFrame, as_of=None, duplicates: str = "raise",
                 num_partitions: int | None = None) -> DataFrame:
    """Quantile RFM variant (M12): frequency and monetary quintiles (qcut,
    right-closed, exact edges), score = sum, four right-closed segments."""
    base = fct.filter(F.col("status") != "cancelled")
    stats = base.groupBy("customer_id").agg(
        F.count("sale_id").alias("total_orders"),
        F.sum("net_revenue").alias("lifetime_value"),
        F.max("order_date").alias("last_order"),
    ).withColumn("days_since", days_between(F.col("last_order"), as_date_lit(as_of)))
    s = qcut(stats, "customer_id", [("total_orders", "total_orders_score"),
                                    ("lifetime_value", "lifetime_value_score")], 5, duplicates,
             num_partitions)
    score = F.col("total_orders_score") + F.col("lifetime_value_score")
    return s.withColumn("rfm_score", score).withColumn("segment", score_segment(score))


def segment_counts(segmented: DataFrame, col: str = "segment") -> DataFrame:
    """value_counts(): rows per segment, most frequent first."""
    return segmented.groupBy(col).agg(F.count("*").alias("count")) \
        .orderBy(F.col("count").desc(), F.col(col).asc_nulls_last())
