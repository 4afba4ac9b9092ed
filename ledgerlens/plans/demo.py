"""The compact demo chain: monthly KPIs and the KPI summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import safe_divide


def completed_sales(fct: DataFrame) -> DataFrame:
    """Everything but cancelled rows (SQL semantics: a null status is
    dropped too)."""
    return fct.filter(F.col("status") != "cancelled")


def monthly_summary(fct: DataFrame) -> DataFrame:
    """Per month: revenue, order count, distinct customers and mean order
    value, rounded to 2 decimals (half up, in decimal)."""
    done = completed_sales(fct)
    agg = done.groupBy(F.col("order_month")).agg(
        F.sum("net_revenue").alias("_rev"),
        F.count("sale_id").alias("order_count"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count("net_revenue").alias("_n"),
    )
    return agg.select(
        "order_month",
        F.round("_rev", 2).alias("total_revenue"),
        "order_count", "unique_customers",
        F.round(F.col("_rev").cast("decimal(28,4)") / F.col("_n"), 2).alias("avg_order_value"),
    )


def _diff0(a, b):
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))


def latest_month_growth(fct: DataFrame) -> DataFrame:
    """MoM and YoY revenue growth of the latest month (one row).

    The window runs over the monthly aggregate, whose size is bounded by
    the number of calendar months, not by the data."""
    done = completed_sales(fct)
    mon = done.groupBy(F.col("order_month").alias("period")).agg(F.sum("net_revenue").alias("revenue"))
    idx = F.year("period") * 12 + F.month("period")
    w = Window.orderBy(idx)
    m2 = mon.withColumns({
        "pm": F.max("revenue").over(w.rangeBetween(-1, -1)),
        "py": F.max("revenue").over(w.rangeBetween(-12, -12)),
    })
    last = m2.agg(F.max_by(F.struct("revenue", "pm", "py"), "period").alias("s"))
    cur, pm, py = F.col("s.revenue"), F.col("s.pm"), F.col("s.py")
    return last.select(
        safe_divide(_diff0(cur, pm), F.abs(pm)).alias("revenue_mom_growth"),
        safe_divide(_diff0(cur, py), F.abs(py)).alias("revenue_yoy_growth"),
    )


def kpi_summary(fct: DataFrame, segmented: DataFrame, segment_col: str = "segment") -> DataFrame:
    """One-row KPI summary: revenue, orders, customers, mean order value,
    gross margin, Champions share and latest-month growth - all computed,
    none hard-coded.

    The fact is aggregated once: ``rollup(order_month)`` yields the monthly
    rows and the grand total (whose distinct customer count cannot be
    rebuilt from months) in one pass; a window over that small frame finds
    the previous months and one global aggregate folds it to a row.  The
    Champions share comes from the segmented customers; the one-row parts
    are stacked with ``unionByName`` and folded by ``max`` (no cross join).
    """
    done = completed_sales(fct)
    r = done.rollup("order_month").agg(
        F.sum("net_revenue").alias("rev"),
        F.count(F.lit(1)).alias("n"),
        F.count("net_revenue").alias("nn"),
        F.count_distinct("customer_id").alias("uc"),
        F.sum("gross_profit").alias("gp"),
        F.grouping_id().alias("_g"),
    )
    month = F.col("_g") == 0
    idx = F.when(month, F.year("order_month") * 12 + F.month("order_month"))
    w = Window.orderBy(idx)          # months of one series: calendar-bounded
    r = r.withColumns({
        "pm": F.max(F.when(month, F.col("rev"))).over(w.rangeBetween(-1, -1)),
        "py": F.max(F.when(month, F.col("rev"))).over(w.rangeBetween(-12, -12)),
    })
    total = ~month
    latest = F.max_by(F.when(month, F.struct("rev", "pm", "py")), F.when(month, F.col("order_month")))
    folded = r.agg(
        F.max(F.when(total, F.col("rev"))).alias("_rev"),
        F.max(F.when(total, F.col("n"))).alias("total_orders"),
        F.max(F.when(total, F.col("nn"))).alias("_nn"),
        F.max(F.when(total, F.col("uc"))).alias("unique_customers"),
        F.max(F.when(total, F.col("gp"))).alias("_gp"),
        latest.alias("_last"),
    )
    cur, pm, py = F.col("_last.rev"), F.col("_last.pm"), F.col("_last.py")
    tot = folded.select(
        F.col("_rev").cast("double").alias("total_revenue"),
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        F.coalesce("unique_customers", F.lit(0)).alias("unique_customers"),
        safe_divide("_rev", "_nn").alias("avg_order_value"),
        safe_divide("_gp", "_rev", 0).alias("gross_margin_pct"),
        safe_divide(_diff0(cur, pm), F.abs(pm)).alias("revenue_mom_growth"),
        safe_divide(_diff0(cur, py), F.abs(py)).alias("revenue_yoy_growth"),
    )
    champions = segmented.agg(
        safe_divide(F.count_if(F.col(segment_col) == "Champions"), F.count(F.lit(1)), 0)
        .alias("champions_pct"))
    parts = [tot, champions]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    cols = ["total_revenue", "total_orders", "unique_customers", "avg_order_value",
            "gross_margin_pct", "champions_pct", "revenue_mom_growth", "revenue_yoy_growth"]
    return stacked.agg(*[F.max(c).alias(c) for c in cols])
