"""Measure library (D1-D28) over the semantic model.

A measure is evaluated for a grouping (``by``) and, for time intelligence,
a period grain.  Rules (ours, documented): blank = null; DIVIDE returns the
alternate (or blank) on a zero/blank denominator; SUM of no rows is blank;
in a difference where exactly one side is blank, blank counts as 0.

Additive measures share one ``groupBy().agg()``.  Distinct counts are
recomputed at each grain, never summed.  Time intelligence first reduces
the fact to keys x period, then gives every key all periods from its first
to the last of the data (as over a date table: a key whose sales stop still
has its later periods), so window frames and lags see every period; those
windows are partitioned by the keys and hold at most one row per period.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import safe_divide
from ledgerlens.functions.tiers import kpi_status
from ledgerlens.plans.model import BUDGET, CUSTOMERS, DATE, SALES, SemanticModel, customer_segment_measures

GRAINS = ("day", "month", "quarter", "year")
_STEP = {"day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH",
         "quarter": "INTERVAL 3 MONTH", "year": "INTERVAL 1 YEAR"}

# Legal grouping columns per source table (relationships: Sales -> Customers
# single direction, Sales <-> Date both; Budget keyed by territory, category
# and period).
BUDGET_KEYS = ("territory_id", "product_category")


def _period(col: str, grain: str) -> Column:
    if grain == "day":
        return F.col(col)
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    return F.trunc(F.col(col), grain)


def _null_safe_on(la: str, ra: str, keys) -> Column:
    """Null-safe equality of alias-qualified keys (``la.k <=> ra.k``)."""
    conds = [F.col(f"{la}.{k}").eqNullSafe(F.col(f"{ra}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def _diff_blank_as_zero(a: Column, b: Column) -> Column:
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))


# ---- D1-D8, D17, D21, D25 ---------------------------------------------------

def base_measures(sales: DataFrame, by=(), filters: Column | None = None, blank_ratio=0) -> DataFrame:
    """Revenue, profit, orders, units, discounts, customers, products and
    their ratios in one aggregate.  ``blank_ratio``: the value of a ratio over
    nothing, 0 or None (blank)."""
    df = sales if filters is None else sales.filter(filters)
    by = list(by)
    agg = df.groupBy(*by).agg(
        F.sum("net_revenue").alias("total_revenue"),
        F.sum("gross_profit").alias("total_gross_profit"),
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("quantity").alias("total_units_sold"),
        F.sum("discount_amount").alias("total_discounts"),
        F.sum("total_amount").alias("_gross_amount"),
        F.count_distinct("customer_id").alias("total_customers"),
        F.count_distinct("product_id").alias("products_sold"),
    )
    rev = F.col("total_revenue")
    return agg.select(
        *by, "total_revenue", "total_gross_profit", "total_orders", "total_units_sold",
        safe_divide(rev, "total_orders", blank_ratio).alias("avg_order_value"),
        safe_divide("total_gross_profit", rev, blank_ratio).alias("gross_margin_pct"),
        "total_discounts",
        safe_divide("total_discounts", "_gross_amount", blank_ratio).alias("discount_rate_pct"),
        "total_customers",
        safe_divide(rev, "total_customers", blank_ratio).alias("revenue_per_customer"),
        "products_sold",
    )


def _mean(c: str) -> Column:
    """Mean skipping nulls: exact decimal sum / count, as double."""
    return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0)).cast("double")


def default_aggregations(columns: dict[str, str]) -> dict[str, Column]:
    """``summarize_by`` defaults: {'net_revenue': 'sum', 'gross_margin_pct':
    'average', ...} -> aggregate columns (A15)."""
    fns = {"sum": F.sum, "average": _mean, "avg": _mean, "min": F.min, "max": F.max,
           "count": F.count, "distinctcount": F.count_distinct}
    return {c: fns[how.lower()](c).alias(c) for c, how in columns.items()}


# ---- densified key x period series ----------------------------------------------

def period_series(sales: DataFrame, by=(), grain: str = "month", value: str = "net_revenue",
                  out: str = "revenue", date_col: str = "order_date") -> DataFrame:
    """Sum ``value`` per keys x period (sparse)."""
    return sales.groupBy(*by, _period(date_col, grain).alias("period")).agg(F.sum(value).alias(out))


_BACK_ONE = {"day": lambda c: F.date_sub(c, 1), "month": lambda c: F.add_months(c, -1),
             "quarter": lambda c: F.add_months(c, -3), "year": lambda c: F.add_months(c, -12)}


def last_period(series: DataFrame) -> Column:
    """The last period of a series, as a scalar subquery.  It asks for the
    revenue as well, so that it is the series' own aggregate and Spark computes that once."""
    return series.agg(F.struct(F.max("period").alias("period"), F.max("revenue").alias("revenue")).alias("s")).scalar()["period"]


def densify(series: DataFrame, by=(), grain: str = "month", period: str = "period",
            last: Column | None = None) -> DataFrame:
    """Give every key a row for each period between its own first period and
    ``last`` (its own last one, if not given); missing values stay null (blank).

    One pass over the (sparse) series: each row looks at its key's next
    period (``lead``) and also emits the missing periods up to it.  The
    window is partitioned by the keys, which also serves the later
    per-key windows without another exchange, and the series is consumed
    once (a separate min/max 'bounds' branch would make Spark compute the
    fact aggregate twice)."""
    by = list(by)
    vals = [c for c in series.columns if c not in by and c != period]
    with_next = series.withColumn("_next", F.lead(period).over(Window.partitionBy(*by).orderBy(period)))
    end = F.col(period) if last is None else F.greatest(last, F.col(period))
    last = F.coalesce(_BACK_ONE[grain](F.col("_next")), end)
    spread = with_next.withColumn("_p", F.explode(F.sequence(F.col(period), last, F.expr(_STEP[grain]))))
    own = F.col("_p") == F.col(period)
    return spread.select(*by, F.col("_p").alias(period),
                         *[F.when(own, F.col(c)).alias(c) for c in vals])


def _ordered(by) -> Window:
    return Window.partitionBy(*by).orderBy("period")


# ---- D9-D11 --------------------------------------------------------------------

def period_to_date(sales: DataFrame, by=(), grain: str = "day") -> DataFrame:
    """Revenue MTD / QTD / YTD at day or month grain.

    At day grain the value on a day is the running sum since the start of
    its month/quarter/year.  At month grain MTD is the month itself, QTD and
    YTD sum the months of the quarter/year so far (the value on the
    period's last calendar day).  Days or months without sales have a row as
    well: the running values hold on them, the revenue is blank.  All three
    windows partition by the keys and the year first."""
    if grain not in ("day", "month"):
        raise ValueError("period_to_date supports grain 'day' or 'month'")
    by = list(by)
    series = period_series(sales, by, grain)
    s = densify(series, by, grain, last=last_period(series))
    y, q, m = F.trunc("period", "year"), F.trunc("period", "quarter"), F.trunc("period", "month")
    run = Window.unboundedPreceding, Window.currentRow
    wy = Window.partitionBy(*by, y).orderBy("period").rowsBetween(*run)
    wq = Window.partitionBy(*by, y, q).orderBy("period").rowsBetween(*run)
    wm = Window.partitionBy(*by, y, m).orderBy("period").rowsBetween(*run)
    return s.select(*by, "period", "revenue",
                    F.sum("revenue").over(wm).alias("revenue_mtd"),
                    F.sum("revenue").over(wq).alias("revenue_qtd"),
                    F.sum("revenue").over(wy).alias("revenue_ytd"))


# ---- D12-D14, D16 -----------------------------------------------------------------

def time_intelligence(sales: DataFrame, by=(), grain: str = "month",
                      abs_denominator: bool = True, cumulative: str = "all") -> DataFrame:
    """YTD, PYTD, MoM / YoY growth and cumulative revenue on the dense
    keys x period grid (grain 'day', 'month' or 'year').

    PYTD is YTD of the same period one year earlier; growth is
    DIVIDE(cur - prev, ABS(prev)) (``abs_denominator=False``: divide by
    prev); cumulative is the running total over all earlier periods
    (``cumulative='ytd'``: the YTD definition).
    """
    if grain not in ("day", "month", "year"):
        raise ValueError("time_intelligence supports grain 'day', 'month' or 'year'")
    by = list(by)
    series = period_series(sales, by, grain)
    dense = densify(series, by, grain, last=last_period(series))
    if grain == "day":
        return _daily_intelligence(dense, by, abs_denominator, cumulative)
    per_year = 12 if grain == "month" else 1
    w = _ordered(by)
    wy = Window.partitionBy(*by, F.trunc("period", "year")).orderBy("period") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wall = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ytd = F.sum("revenue").over(wy)
    d = dense.withColumn("revenue_ytd", ytd)
    prev_m = F.lag("revenue", 1).over(w) if grain == "month" else F.lit(None).cast(d.schema["revenue"].dataType)
    prev_y = F.lag("revenue", per_year).over(w)
    d = d.withColumns({
        "revenue_pytd": F.lag("revenue_ytd", per_year).over(w),
        "_prev_m": prev_m,
        "_prev_y": prev_y,
        "cumulative_revenue": (F.sum("revenue").over(wall) if cumulative == "all"
                               else F.col("revenue_ytd")),
    })

    def growth(prev: str) -> Column:
        den = F.abs(F.col(prev)) if abs_denominator else F.col(prev)
        return safe_divide(_diff_blank_as_zero(F.col("revenue"), F.col(prev)), den)

    return d.select(*by, "period", "revenue", "revenue_ytd", "revenue_pytd",
                    growth("_prev_m").alias("revenue_mom_growth"),
                    growth("_prev_y").alias("revenue_yoy_growth"),
                    "cumulative_revenue")


def _daily_intelligence(dense: DataFrame, by: list, abs_denominator: bool, cumulative: str) -> DataFrame:
    """The day grain: the compared days are the same dates one month and one
    year earlier (the last of that month where it is shorter), found by an
    equi-join of the key x day grid with itself."""
    run = Window.unboundedPreceding, Window.currentRow
    wy = Window.partitionBy(*by, F.trunc("period", "year")).orderBy("period").rowsBetween(*run)
    d = dense.withColumn("revenue_ytd", F.sum("revenue").over(wy))
    d = d.withColumn("cumulative_revenue", F.sum("revenue").over(_ordered(by).rowsBetween(*run))
                     if cumulative == "all" else F.col("revenue_ytd"))
    d = d.withColumns({"_month": F.add_months("period", -1), "_year": F.add_months("period", -12)})

    def earlier(frame: DataFrame, at: str, **columns: str) -> DataFrame:
        then = d.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(by)], F.col("period").alias("_p"),
                        *[F.col(c).alias(name) for name, c in columns.items()])
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(by)],
                    F.col(at) == F.col("_p"))
        return frame.join(then, on, "left").drop("_p", *[f"_k{i}" for i in range(len(by))])

    d = earlier(earlier(d, "_month", _prev_m="revenue"), "_year", _prev_y="revenue", revenue_pytd="revenue_ytd")

    def growth(prev: str) -> Column:
        den = F.abs(F.col(prev)) if abs_denominator else F.col(prev)
        return safe_divide(_diff_blank_as_zero(F.col("revenue"), F.col(prev)), den)

    return d.select(*by, "period", "revenue", "revenue_ytd", "revenue_pytd",
                    growth("_prev_m").alias("revenue_mom_growth"),
                    growth("_prev_y").alias("revenue_yoy_growth"), "cumulative_revenue")


# ---- D17-D21 -----------------------------------------------------------------------

def customer_activity(sales: DataFrame, customers: DataFrame, by=(), grain: str | None = "month") -> DataFrame:
    """Total / new / returning customers, retention rate and revenue per
    customer per keys x period.  New = distinct customers whose
    ``first_order_date`` (from the customer dimension) falls inside the
    period; without a grain, inside the dates of the data."""
    by = list(by)
    keys = by + (["period"] if grain else [])
    c = customers.select("customer_id", "first_order_date")
    # One row for each key, period and customer before the join: a customer
    # with a third of all sales is a handful of rows there, and the distinct
    # counts become plain ones.
    period = {"period": _period("order_date", grain)} if grain else {}
    each = (sales.withColumns(period) if grain else sales).groupBy(*keys, "customer_id").agg(
        F.sum("net_revenue").alias("revenue"), F.min("order_date").alias("_from"), F.max("order_date").alias("_to"))
    j = each.join(c, "customer_id", "left")
    if not grain:
        start, end = sales.agg(F.min("order_date")).scalar(), sales.agg(F.max("order_date")).scalar()
    elif grain == "day":
        start = end = F.col("period")
    else:
        step = {"month": 1, "quarter": 3, "year": 12}[grain]
        start, end = F.col("period"), F.date_sub(F.add_months("period", step), 1)
    is_new = F.col("first_order_date").between(start, end)
    agg = j.withColumn("_new", F.col("customer_id").isNotNull() & is_new).groupBy(*keys).agg(
        F.count("customer_id").alias("total_customers"),
        F.count_if("_new").alias("new_customers"),
        F.sum("revenue").alias("revenue"),
    )
    returning = F.col("total_customers") - F.col("new_customers")
    return agg.select(*keys, "total_customers", "new_customers",
                      returning.alias("returning_customers"),
                      safe_divide(returning, "total_customers", 0).alias("customer_retention_rate"),
                      safe_divide("revenue", "total_customers", 0).alias("revenue_per_customer"))


# ---- A13, W6 ------------------------------------------------------------------------

def repeat_ratio(sales: DataFrame, by=()) -> DataFrame:
    """Share of the customers of ``sales`` with more than one sale."""
    per = sales.groupBy(*by, "customer_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("customer_id").isNotNull())
    return per.groupBy(*by).agg(F.count_if(F.col("n") > 1).alias("repeat_customers"), F.count(F.lit(1)).alias("customers")) \
        .withColumn("repeat_ratio", safe_divide("repeat_customers", "customers", 0))


def month_growth(sales: DataFrame, by=(), value: str = "net_revenue") -> DataFrame:
    """Growth of ``value`` over the month before, by rows of the month series (W6): a window over at most one row per month."""
    months = period_series(sales, by, "month", value, "amount")
    prev = F.lag("amount").over(Window.partitionBy(*by).orderBy("period"))
    return months.withColumn("prev_amount", prev).withColumn(
        "growth", safe_divide(F.col("amount") - F.col("prev_amount"), "prev_amount"))


# ---- D24 -----------------------------------------------------------------------------

def product_revenue(sales: DataFrame, by=()) -> DataFrame:
    return sales.groupBy(*by, "product_id").agg(F.sum("net_revenue").alias("product_revenue"))


def top_product_revenue(sales: DataFrame, by=()) -> DataFrame:
    """MAXX(TOPN(1, SUMMARIZE(Sales, product_id, Rev), Rev), Rev)."""
    return product_revenue(sales, by).groupBy(*by).agg(
        F.max("product_revenue").alias("top_product_revenue"))


def top_products(sales: DataFrame, n: int, by=()) -> DataFrame:
    """Products whose revenue ranks within the top ``n`` of their group,
    ties kept (``rank``).  Spark inserts a WindowGroupLimit before the
    exchange, so each map task forwards at most its top n per group."""
    by = list(by)
    pr = product_revenue(sales, by)
    w = Window.partitionBy(*by).orderBy(F.col("product_revenue").desc_nulls_last())
    return pr.withColumn("revenue_rank", F.rank().over(w)).filter(F.col("revenue_rank") <= n)


# ---- D15, D26, D27 ------------------------------------------------------------------

def budget_measures(sales: DataFrame, budget: DataFrame, by=(), grain: str | None = "month") -> DataFrame:
    """Actual vs budget at keys x period; keys must be budget keys.

    Each side is aggregated to the common grain first, then the two small
    aggregates meet in a full outer join (never fact joined to fact)."""
    by = list(by)
    bad = [k for k in by if k not in BUDGET_KEYS]
    if bad:
        raise ValueError(f"budget measures can only group by {BUDGET_KEYS}, got {bad}")
    if grain not in (None, "month", "quarter", "year"):
        raise ValueError("budget grain must be month, quarter or year")

    def at(date_col: str) -> list:
        return [_period(date_col, grain).alias("period")] if grain else []

    act = sales.groupBy(*by, *at("order_date")).agg(F.sum("net_revenue").alias("actual_revenue"))
    bud = budget.groupBy(*by, *at("period_date")).agg(F.sum("budget_amount").alias("budget_amount"))
    keys = by + (["period"] if grain else [])
    j = act.alias("a").join(bud.alias("b"), _null_safe_on("a", "b", keys), "full")
    out = j.select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys],
                   F.col("a.actual_revenue"), F.col("b.budget_amount"))
    act_c, bud_c = F.col("actual_revenue"), F.col("budget_amount")
    attainment = safe_divide(act_c, bud_c)
    return out.select(*keys, "actual_revenue", "budget_amount",
                      safe_divide(_diff_blank_as_zero(act_c, bud_c), bud_c).alias("revenue_vs_budget"),
                      attainment.alias("revenue_target_attainment"),
                      kpi_status(attainment).alias("kpi_status"))


# ---- generic entry point ----------------------------------------------------------------

def evaluate(sales: DataFrame, measures, by=(), grain: str | None = None,
             customers: DataFrame | None = None, budget: DataFrame | None = None,
             filters: Column | None = None, dates: tuple | None = None, date_table: DataFrame | None = None,
             customer_filters: Column | None = None, date_filters: Column | None = None,
             blank_ratio=0) -> DataFrame:
    """Evaluate named measures for ``by`` (plus ``period`` when ``grain`` is
    given) over the model of these tables (``plans.model``): columns of
    Customers and Date reach Sales measures, customer measures see only what reaches Customers.

    ``filters`` restricts sales by anything but dates, ``customer_filters`` and
    ``date_filters`` their tables; ``dates`` (first, last,
    inclusive) is the date filter.  Time intelligence looks back beyond it:
    its values are computed on all dates and shown for the periods inside.
    Without a grain there is one row for each key, and time intelligence has
    the values of the last month in range.
    """
    model = SemanticModel({SALES: sales, CUSTOMERS: customers, DATE: date_table, BUDGET: budget})
    chosen = {SALES: filters, CUSTOMERS: customer_filters, DATE: date_filters}
    return model.evaluate(measures, by, grain, {t: f for t, f in chosen.items() if f is not None}, dates, blank_ratio)
