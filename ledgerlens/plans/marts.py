"""Gold layer: enriched sales fact, monthly KPI table and semantic views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import as_ts_lit, days_between, pct_of
from ledgerlens.operators.joins import checked_broadcast, deal, fits_broadcast, hot_key_lists, salted_left_join
from ledgerlens.plans.staging import DERIVED, derived

PERF_KEYS = ["period_date", "period_type", "territory_id", "territory_name",
             "territory_region", "product_category", "channel", "customer_tier"]
TERRITORY = ["territory_id", "territory_name", "territory_region"]
# Keys of the LAG partition, and the tie-break that makes "previous row"
# deterministic when several rows share a month.
LAG_PARTITION = ["territory_id", "product_category"]
LAG_ORDER = ["period_date", "channel", "customer_tier", "territory_name", "territory_region"]

# Columns of few values that the fact's shuffles carry as one struct: inside
# one its bytes do not depend on the rest of the row, so they compress.
CUSTOMER_ATTRIBUTES = ["tier", "country", "region", "industry"]
SALE_KINDS = ["channel", "status"]

# What tells the sales of one hot customer or product apart.
DEAL_BY = ["customer_id", "product_id", "order_date", "total_amount"]


def fct_sales(sales: DataFrame, customers: DataFrame, products: DataFrame,
              territories: DataFrame, run_ts=None, dim_row_bounds: dict | None = None,
              salt_hot_keys: bool = True, co_located: tuple[str, ...] = ()) -> DataFrame:
    """Central sales fact (M5): three left joins that never drop a sale.

    Only the dimension columns the fact needs are selected, so each
    dimension scan reads a handful of columns.  ``dim_row_bounds`` (upper
    bounds on the rows of 'customers', 'products', 'territories') lets a
    small dimension be broadcast after a checked size; any other dimension
    stays a shuffle join, which AQE may still convert after measuring it,
    and whose hot fact-side keys the skew-join rule splits.  ``co_located``
    names dimensions that are bucketed by their key like the sales
    (``sinks.write_bucketed``): they are merged bucket by bucket, and the fact
    is not shuffled for them.  What follows from a sale's other columns is
    left out of the shuffles and derived after them.
    """
    bounds = dim_row_bounds or {}
    c = customers.select("customer_id", *CUSTOMER_ATTRIBUTES)
    p = products.select("product_id", "category", "subcategory", "brand", "cost_price", "list_price")
    t = checked_broadcast(territories.select("territory_id", "territory_name",
                                             F.col("region").alias("territory_region"),
                                             F.col("country").alias("territory_country")),
                          bounds.get("territories"))

    def join_dim(left, dim, key, bound, name):
        if name in co_located:
            return left.join(dim.hint("merge"), key, "left")
        # Small (checked) dimension: broadcast.  Known-large dimension: a
        # shuffle join whose hot keys (a customer with a third of all sales)
        # are salted, so no single task receives them; unknown size: left
        # to AQE (which measures, converts or splits skew at run time).
        if fits_broadcast(dim, bound):
            return left.join(checked_broadcast(dim, bound), key, "left")
        if bound is not None and salt_hot_keys:
            return salted_left_join(left, dim, key, "sale_id", hot=hot[key], dealt="_deal")
        return left.join(dim, key, "left")

    # Both keys' hot values come from one pass over the key columns, and each
    # sale is dealt once, by values that most queries read anyway: the shuffles
    # need not carry its id for the salts.
    salted = [key for name, key, dim in (("customers", "customer_id", c), ("products", "product_id", p))
              if salt_hot_keys and name not in co_located and bounds.get(name) is not None and not fits_broadcast(dim, bounds[name])]
    hot = hot_key_lists(sales, salted) if salted else {}
    j = sales.drop(*DERIVED).withColumn("_kinds", F.struct(*SALE_KINDS)).drop(*SALE_KINDS)
    if salted:
        j = j.withColumn("_deal", deal(*DEAL_BY))
    if not fits_broadcast(c, bounds.get("customers")):
        c = c.select("customer_id", F.struct(*CUSTOMER_ATTRIBUTES).alias("_customer"))
    j = join_dim(j, c, "customer_id", bounds.get("customers"), "customers")
    j = join_dim(j, p, "product_id", bounds.get("products"), "products")
    j = derived(j.join(t, "territory_id", "left").select("*", "_kinds.*"))
    if "_customer" in j.columns:
        j = j.select("*", "_customer.*")
    qty, cost, net = F.col("quantity"), F.col("cost_price"), F.col("net_revenue")
    unit_cost = qty * cost
    return j.select(
        "sale_id", "customer_id", "product_id", "territory_id", "salesperson_id",
        "order_date", "ship_date", "order_month", "order_quarter", "order_year",
        "quantity", "unit_price", "discount_pct", "total_amount", "net_revenue",
        "discount_amount", "days_to_ship", "deal_size_tier", "channel", "status", "currency",
        F.col("tier").alias("customer_tier"),
        F.col("country").alias("customer_country"),
        F.col("region").alias("customer_region"),
        F.col("industry").alias("customer_industry"),
        F.col("category").alias("product_category"),
        F.col("subcategory").alias("product_subcategory"),
        F.col("brand").alias("product_brand"),
        F.round(unit_cost, 4).cast("decimal(22,4)").alias("total_cost"),
        F.round(net - unit_cost, 4).cast("decimal(22,4)").alias("gross_profit"),
        F.when(cost > 0, pct_of(net - unit_cost, net, 2)).cast("decimal(20,2)")
         .alias("gross_margin_pct"),
        "territory_name", "territory_region", "territory_country",
        "_transformed_at",
        as_ts_lit(run_ts).alias("_updated_at"),
    )


def monthly_kpis(fct: DataFrame, sale_id_unique: bool = True) -> DataFrame:
    """Non-cancelled sales grouped by month x the seven dimension keys.

    ``sale_id`` is the fact's unique key, so its distinct count equals its
    row count; ``sale_id_unique=True`` uses ``count`` and saves one count
    under the id.

    The rows move once, to the task of their seven keys, and are counted there
    under their customer and under their product: no partial result is shuffled
    for the distinct counts.  They are sorted before, so that equal keys stand
    together and compress.  A group's rows are aggregated by one task, which
    spills; AQE sizes the tasks.
    """
    base = fct.filter(F.col("status") != "cancelled")
    sums = {"total_units": "quantity", "total_revenue": "net_revenue", "total_gross_profit": "gross_profit",
            "total_discounts": "discount_amount", "_margin": "gross_margin_pct", "_days": "days_to_ship"}
    ids = {"unique_customers": "customer_id", "unique_products": "product_id"}
    if not sale_id_unique:
        ids["order_count"] = "sale_id"
    keys = ["period_date", "_territory", "product_category", "_sold"]
    rows = base.select(
        F.col("order_month").alias("period_date"), F.struct(*TERRITORY).alias("_territory"), "product_category",
        F.struct("channel", "customer_tier").alias("_sold"), F.col("sale_id").isNotNull().alias("_sale"),
        *ids.values(), *sums.values()).sortWithinPartitions(*keys[1:]).repartition(*keys)
    # The first id's row carries the sums.
    own = F.col("_as.kind") == 0
    each = rows.select(*keys, "_sale", *sums.values(), F.explode(F.array(*[
        F.struct(F.lit(i).alias("kind"), F.col(c).cast("string").alias("id")) for i, c in enumerate(ids.values())])).alias("_as"))
    first = each.groupBy(*keys, "_as").agg(
        F.count_if(own & F.col("_sale")).alias("_orders"),
        *[F.sum(F.when(own, F.col(c))).alias(n) for n, c in sums.items()],
        *[F.count(F.when(own, F.col(sums[n]))).alias(f"{n}_n") for n in ("total_revenue", "_margin", "_days")])
    total = lambda n: F.sum(n).cast(first.schema[n].dataType).alias(n)
    agg = first.groupBy(*keys).agg(
        F.sum("_orders").alias("_orders"), *[total(n) for n in sums],
        *[F.sum(f"{n}_n").alias(f"{n}_n") for n in ("total_revenue", "_margin", "_days")],
        *[F.count_if((F.col("_as.kind") == i) & F.col("_as.id").isNotNull()).alias(n) for i, n in enumerate(ids)])
    if sale_id_unique:
        agg = agg.withColumn("order_count", F.col("_orders"))
    mean = lambda n: F.col(n).cast("double") / F.nullif(f"{n}_n", F.lit(0)).cast("double")
    return agg.select(
        "period_date", F.lit("month").alias("period_type"), "_territory.*", "product_category", "_sold.*",
        "order_count", "unique_customers", "unique_products", "total_units", "total_revenue", "total_gross_profit",
        "total_discounts", mean("total_revenue").alias("avg_order_value"), mean("_margin").alias("avg_margin_pct"),
        mean("_days").alias("avg_days_to_ship"))


def _growth(cur, prev):
    return F.col(cur).cast("double") / F.nullif(F.col(prev).cast("double"), F.lit(0.0)) - F.lit(1.0)


def fct_sales_performance(fct: DataFrame, mode: str = "row", run_ts=None,
                          sale_id_unique: bool = True) -> DataFrame:
    """Monthly KPI table with MoM / YoY revenue growth.

    ``mode='row'``: previous row / 12 rows back inside (territory, category),
    ordered by month with a deterministic tie-break - the literal LAG.
    ``mode='calendar'``: the same 8-key row exactly 1 / 12 months earlier,
    null when that month is missing; a RANGE frame on a month index does
    this without a self-join.  Both windows run on the aggregate, whose
    partitions are bounded by months x dimension values, not by data size.
    """
    agg = monthly_kpis(fct, sale_id_unique)
    if mode == "row":
        w = Window.partitionBy(*LAG_PARTITION).orderBy(*[F.col(c).asc_nulls_first() for c in LAG_ORDER])
        prev1 = F.lag("total_revenue", 1).over(w)
        prev12 = F.lag("total_revenue", 12).over(w)
    elif mode == "calendar":
        month_idx = F.year("period_date") * 12 + F.month("period_date")
        w = Window.partitionBy(*[k for k in PERF_KEYS if k != "period_date"]).orderBy(month_idx)
        prev1 = F.max("total_revenue").over(w.rangeBetween(-1, -1))
        prev12 = F.max("total_revenue").over(w.rangeBetween(-12, -12))
    else:
        raise ValueError(f"mode must be 'row' or 'calendar', got {mode!r}")
    out = agg.withColumns({"_prev1": prev1, "_prev12": prev12})
    return out.select(
        *agg.columns,
        _growth("total_revenue", "_prev1").alias("revenue_mom_growth"),
        _growth("total_revenue", "_prev12").alias("revenue_yoy_growth"),
        as_ts_lit(run_ts).alias("_updated_at"),
    )


def exact_net_revenue() -> Column:
    """Net revenue of the semantic view, not rounded."""
    return F.col("total_amount") * (F.lit(1) - F.col("discount_pct"))


def vw_sales_fact(fct: DataFrame) -> DataFrame:
    """Semantic sales view (M8).  Adds the columns measures and RLS need
    (gross_profit, gross_margin_pct, discount_amount, territory_region,
    product_category).  Days to ship has no default here: null ship date
    gives null days."""
    od = F.col("order_date")
    return fct.select(
        "sale_id", "customer_id", "product_id", "territory_id", "salesperson_id",
        "order_date", "ship_date",
        days_between(od, F.col("ship_date")).alias("days_to_ship"),
        "quantity", "unit_price", "discount_pct", "total_amount",
        exact_net_revenue().alias("net_revenue"),
        "currency", "channel", "status",
        F.year(od).alias("order_year"),
        F.month(od).alias("order_month"),
        F.quarter(od).alias("order_quarter"),
        F.trunc(od, "month").alias("order_month_date"),
        "gross_profit", "gross_margin_pct", "discount_amount", "territory_region",
        "territory_name", "product_category",
    )


CUSTOMER_VIEW_COLUMNS = [
    "customer_id", "full_name", "email", "company", "industry", "country", "region", "city",
    "tier", "signup_date", "lifetime_value", "total_orders", "avg_order_value",
    "days_since_last_order", "customer_segment", "is_active",
    # Needed by the semantic model and the customer measures.
    "lifetime_tier", "first_order_date",
]


def vw_customer_dim(dim: DataFrame) -> DataFrame:
    """Semantic customer view (M9)."""
    return dim.select(*CUSTOMER_VIEW_COLUMNS)
