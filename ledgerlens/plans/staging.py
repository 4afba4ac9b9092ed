"""Silver layer: typed, cleaned, validated tables.

Each model is a pure ``DataFrame -> DataFrame`` function; run timestamps and
the "as of" date are explicit parameters so a rerun is reproducible.
Filters come first and reference plain columns, so Catalyst pushes them into
the Parquet scan.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import (
    as_date_lit, as_ts_lit, clean_lower, clean_title, clean_upper, days_between,
    digits_and_plus, join_words, month_start, quarter_start,
)
from ledgerlens.functions.tiers import deal_size_tier

# Silver-layer defaults.
DEFAULT_CURRENCY = "USD"
DEFAULT_TIER = "standard"
SHIP_DAYS_IF_UNKNOWN = 3


def _zero_discount():
    return F.lit(Decimal("0.0000")).cast("decimal(5,4)")


def stg_sales(raw: DataFrame, run_ts=None) -> DataFrame:
    """Clean raw sales (M1).

    Rows need a sale, customer, product and order date, and a positive raw
    amount and quantity (so ``abs`` below only changes ``unit_price``).
    """
    src = raw.filter(
        F.col("sale_id").isNotNull() & F.col("customer_id").isNotNull()
        & F.col("product_id").isNotNull() & F.col("order_date").isNotNull()
        & (F.col("total_amount") > 0) & (F.col("quantity") > 0))
    validated = src.select(
        "sale_id", "customer_id", "product_id", "territory_id", "salesperson_id",
        F.col("order_date").cast("date").alias("order_date"),
        F.col("ship_date").cast("date").alias("ship_date"),
        F.abs("quantity").cast("bigint").alias("quantity"),
        F.round(F.abs("unit_price"), 4).cast("decimal(18,4)").alias("unit_price"),
        F.coalesce(F.col("discount_pct").cast("decimal(5,4)"), _zero_discount()).alias("discount_pct"),
        F.round(F.abs("total_amount"), 4).cast("decimal(18,4)").alias("total_amount"),
        F.upper(F.coalesce(F.col("currency"), F.lit(DEFAULT_CURRENCY))).alias("currency"),
        clean_lower("channel").alias("channel"),
        clean_lower("status").alias("status"),
        "_ingested_at", "_source", "_file_name",
    )
    return derived(validated).withColumn("_transformed_at", as_ts_lit(run_ts))


#: Columns that follow from a row's other columns (:func:`derived`).
DERIVED = ("net_revenue", "discount_amount", "days_to_ship", "deal_size_tier", "order_month", "order_quarter", "order_year")


def derived(sales: DataFrame) -> DataFrame:
    """Sales with the columns ``DERIVED`` from their amount, discount and dates."""
    total, disc, od = F.col("total_amount"), F.col("discount_pct"), F.col("order_date")
    return sales.withColumns({
        "net_revenue": F.round(total * (F.lit(1) - disc), 4).cast("decimal(18,4)"),
        "discount_amount": F.round(total * disc, 4).cast("decimal(18,4)"),
        "days_to_ship": days_between(od, F.coalesce(F.col("ship_date"), F.date_add(od, SHIP_DAYS_IF_UNKNOWN))),
        "deal_size_tier": deal_size_tier(total),
        "order_month": month_start(od),
        "order_quarter": quarter_start(od),
        "order_year": F.year(od),
    })


def stg_customers(raw: DataFrame, as_of=None, run_ts=None) -> DataFrame:
    """Clean raw customers (M2).  Key and email must be present."""
    src = raw.filter(F.col("customer_id").isNotNull() & F.col("email").isNotNull())
    first, last = clean_title("first_name"), clean_title("last_name")
    return src.select(
        "customer_id",
        first.alias("first_name"),
        last.alias("last_name"),
        join_words(first, last).alias("full_name"),
        clean_lower("email").alias("email"),
        digits_and_plus("phone").alias("phone"),
        F.trim("company").alias("company"),
        clean_lower("industry").alias("industry"),
        clean_upper("country").alias("country"),
        F.trim("region").alias("region"),
        clean_title("city").alias("city"),
        F.lower(F.coalesce(F.col("tier"), F.lit(DEFAULT_TIER))).alias("tier"),
        F.col("signup_date").cast("date").alias("signup_date"),
        days_between(F.col("signup_date").cast("date"), as_date_lit(as_of)).alias("days_since_signup"),
        "_ingested_at",
        as_ts_lit(run_ts).alias("_transformed_at"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    """Clean raw products (M3): non-null key, trimmed text, typed prices."""
    return raw.filter(F.col("product_id").isNotNull()).select(
        "product_id",
        F.trim("product_name").alias("product_name"),
        F.trim("category").alias("category"),
        F.trim("subcategory").alias("subcategory"),
        F.trim("brand").alias("brand"),
        F.col("cost_price").cast("decimal(18,4)").alias("cost_price"),
        F.col("list_price").cast("decimal(18,4)").alias("list_price"),
        F.col("weight_kg").cast("decimal(10,3)").alias("weight_kg"),
        F.coalesce(F.col("is_active"), F.lit(True)).alias("is_active"),
        F.col("launched_date").cast("date").alias("launched_date"),
        "_ingested_at",
    )


def stg_territories(raw: DataFrame) -> DataFrame:
    """Clean raw territories (M4)."""
    return raw.filter(F.col("territory_id").isNotNull()).select(
        "territory_id",
        F.trim("territory_name").alias("territory_name"),
        F.trim("region").alias("region"),
        F.trim("country").alias("country"),
        F.trim("manager_id").alias("manager_id"),
        F.col("quota_amount").cast("decimal(18,2)").alias("quota_amount"),
        "_ingested_at",
    )


def budget_periods(raw: DataFrame) -> DataFrame:
    """Budget rows with a first-of-month ``period_date``."""
    return raw.filter(F.col("budget_id").isNotNull()).select(
        "budget_id", "territory_id", "product_category",
        F.col("fiscal_year").cast("int").alias("fiscal_year"),
        F.col("fiscal_month").cast("int").alias("fiscal_month"),
        F.col("budget_amount").cast("decimal(18,2)").alias("budget_amount"),
        F.make_date(F.col("fiscal_year"), F.col("fiscal_month"), F.lit(1)).alias("period_date"),
        "_ingested_at",
    )


def star_budget(sales: DataFrame, products: DataFrame) -> DataFrame:
    """RAW budget derived from the data: per territory x category x month,
    the same month's non-cancelled revenue of the prior year times 1.1."""
    p = products.select("product_id", "category")
    base = (sales.filter(F.col("status") != "cancelled")
            .join(p, "product_id", "inner")
            .filter(F.col("territory_id").isNotNull() & F.col("category").isNotNull()))
    agg = base.groupBy("territory_id", F.col("category").alias("product_category"),
                       (F.year("order_month") + 1).alias("fiscal_year"),
                       F.month("order_month").alias("fiscal_month")
                       ).agg(F.sum("net_revenue").alias("rev"))
    return agg.select(
        F.concat_ws("-", "territory_id", "product_category", F.col("fiscal_year").cast("string"),
                    F.col("fiscal_month").cast("string")).alias("budget_id"),
        "territory_id", "product_category",
        F.col("fiscal_year").cast("int").alias("fiscal_year"),
        F.col("fiscal_month").cast("int").alias("fiscal_month"),
        F.round(F.col("rev") * F.lit(Decimal("1.1")), 2).cast("decimal(18,2)").alias("budget_amount"),
        F.make_timestamp_ntz(F.col("fiscal_year") - 1, F.lit(12), F.lit(1), F.lit(0), F.lit(0),
                             F.lit(0)).alias("_ingested_at"),
    )
