"""Map the driver's star-schema tables onto the RAW sales contract.

The test data is a TPC-H-like star (region, nation, customer, part,
orders, lineitem).  ``from_star`` re-expresses it as the five RAW tables the
pipeline expects, lazily: nothing is read until a plan downstream runs, and
column pruning reaches each Parquet scan.

Join order matters at scale: orders is joined to customer first (both keyed
by customer), so the big lineitem side is shuffled exactly once, on the
order key.  Dimension-size joins are left to AQE, which broadcasts a side
only after measuring it.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events")


# Declared schemas of the star tables: the scan needs no footer inference,
# and a file with drifted types fails loudly instead of silently widening.
# The files store wall-clock timestamps (no zone), hence timestamp_ntz: dates
# derived from them do not depend on the session time zone.
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

_READ_CACHE: dict[tuple, DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one star table (cached per session and path: a
    DataFrame is only a plan, so reusing it costs nothing at run time and
    saves the file listing when plans are built)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _READ_CACHE.get(key)
    if df is None or df.sparkSession is not spark:
        schema = STAR_SCHEMAS.get(name)
        reader = spark.read.schema(schema) if schema else spark.read
        df = reader.parquet(path)
        _READ_CACHE[key] = df
    return df


def _s(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


# Order-priority -> sales channel.
CHANNEL_BY_PRIORITY = {
    "1-URGENT": "direct",
    "2-HIGH": "partner",
    "3-MEDIUM": "online",
    "4-NOT SPECIFIED": "reseller",
    "5-LOW": "online",
}

# Amount scale factor by o_custkey % 3, so every deal-size and
# lifetime tier is populated.
AMOUNT_FACTOR = {0: Decimal("0.01"), 1: Decimal("0.05"), 2: Decimal("1.00")}


def channel_expr(priority: Column) -> Column:
    out = None
    for k, v in CHANNEL_BY_PRIORITY.items():
        out = (F.when(priority == k, v) if out is None else out.when(priority == k, v))
    return out


def status_expr(returnflag: Column, linestatus: Column, orderstatus: Column) -> Column:
    return (F.when((returnflag == "R") & (linestatus == "O"), "cancelled")
            .when((returnflag == "R") & (linestatus == "F"), "returned")
            .when(orderstatus == "F", "completed")
            .when(orderstatus == "O", "pending")
            .when(orderstatus == "P", "shipped"))


def amount_factor(custkey: Column) -> Column:
    m = custkey % 3
    return (F.when(m == 0, F.lit(AMOUNT_FACTOR[0]))
            .when(m == 1, F.lit(AMOUNT_FACTOR[1]))
            .otherwise(F.lit(AMOUNT_FACTOR[2])))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").alias("l_shipdate"))
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    oc = orders.join(cust, orders.o_custkey == cust.c_custkey, "inner")
    # Fact-to-fact join: both sides grow with the data, so it is a shuffle
    # sort-merge join on the order key.  The hint keeps the planner from
    # broadcasting the fact side when a small sample's compressed files
    # happen to sit under the broadcast threshold.
    j = li.join(oc.hint("merge"), li.l_orderkey == oc.o_orderkey, "inner")
    order_date = F.col("o_orderdate").cast("date")
    ship_date = F.col("l_shipdate").cast("date")
    total = (F.col("l_extendedprice").cast("decimal(18,4)") * amount_factor(F.col("o_custkey"))
             ).cast("decimal(18,4)")
    qty = F.col("l_quantity").cast("bigint")
    return j.select(
        F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"),
                    _s("l_suppkey"), _s(ship_date)).alias("sale_id"),
        _s("o_custkey").alias("customer_id"),
        _s("l_partkey").alias("product_id"),
        _s("c_nationkey").alias("territory_id"),
        _s("l_suppkey").alias("salesperson_id"),
        order_date.alias("order_date"),
        ship_date.alias("ship_date"),
        qty.alias("quantity"),
        F.try_divide(total, qty).cast("decimal(18,4)").alias("unit_price"),
        F.col("l_discount").cast("decimal(5,4)").alias("discount_pct"),
        total.alias("total_amount"),
        F.lit("USD").alias("currency"),
        channel_expr(F.col("o_orderpriority")).alias("channel"),
        status_expr(F.col("l_returnflag"), F.col("l_linestatus"),
                    F.col("o_orderstatus")).alias("status"),
        F.lit(None).cast("string").alias("metadata"),
        F.lit("star").alias("_source"),
        order_date.cast("timestamp_ntz").alias("_ingested_at"),
        F.lit("lineitem.parquet").alias("_file_name"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    j = c.join(geo, c.c_nationkey == geo.n_nationkey, "left")
    return j.select(
        _s("c_custkey").alias("customer_id"),
        F.lower(F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+1 ("), _s(F.col("c_nationkey") + 100), F.lit(") "),
                 _s("c_custkey")).alias("phone"),
        F.col("c_name").alias("company"),
        F.col("c_mktsegment").alias("industry"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        F.lower("n_name").alias("city"),
        F.col("c_mktsegment").alias("tier"),
        F.date_add(F.lit("1994-01-01").cast("date"),
                   (F.col("c_custkey") % 365).cast("int")).alias("signup_date"),
        F.lit(None).cast("string").alias("attributes"),
        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("_ingested_at"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    list_price = F.col("p_retailprice").cast("decimal(18,4)")
    return p.select(
        _s("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.try_element_at(F.split("p_name", " "), F.lit(2)).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        (list_price * F.lit(Decimal("0.6"))).cast("decimal(18,4)").alias("cost_price"),
        list_price.alias("list_price"),
        F.col("p_size").cast("decimal(10,3)").alias("weight_kg"),
        F.lit(True).alias("is_active"),
        F.lit(None).cast("date").alias("launched_date"),
        F.lit(None).cast("string").alias("attributes"),
        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("_ingested_at"),
    )


def raw_territories(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    return j.select(
        _s("n_nationkey").alias("territory_id"),
        F.col("n_name").alias("territory_name"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("country"),
        F.lit(None).cast("string").alias("manager_id"),
        F.lit(None).cast("decimal(18,2)").alias("quota_amount"),
        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("_ingested_at"),
    )


def from_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """RAW sales, customers, products and territories (lazy).  The budget
    table is derived from sales; see ``plans.staging.star_budget``."""
    return {
        "sales": raw_sales(spark, sf_dir),
        "customers": raw_customers(spark, sf_dir),
        "products": raw_products(spark, sf_dir),
        "territories": raw_territories(spark, sf_dir),
    }
