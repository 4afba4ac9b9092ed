"""Registered queries: each callable takes ``(spark, sf_dir)`` and returns a
lazy DataFrame built from the driver's star tables.

Results are normalised for comparison with the SQL oracle
(``ledgerlens.oracle_sql``): decimals become doubles, small integers
become bigint, and run timestamps are left out.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.plans import customers, demo, marts, measures, staging
from ledgerlens.sources.star import from_star

# Fixed run parameters so every run is reproducible: "today" for recency
# and a run timestamp for the lineage columns.
AS_OF = dt.date(2001, 12, 31)
RUN_TS = dt.datetime(2002, 1, 1, 0, 0, 0)


_MODELS: dict[tuple, "Models"] = {}


class Models:
    """Lazily built pipeline models over one star directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Models":
        """Shared per session and (read-only) folder.  Only lazy logical plans
        are cached on it - anything that materializes data (checkpointed
        customer stats, qcut inputs) is rebuilt per query, so every query
        still reads and computes its whole input when it runs."""
        key = (id(spark), sf_dir)
        m = _MODELS.get(key)
        if m is None or m.spark is not spark:
            m = _MODELS[key] = cls(spark, sf_dir)
        return m

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return from_star(self.spark, self.sf_dir)

    @cached_property
    def stg_sales(self) -> DataFrame:
        return staging.stg_sales(self.raw["sales"], RUN_TS)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw["customers"], AS_OF, RUN_TS)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw["products"])

    @cached_property
    def stg_territories(self) -> DataFrame:
        return staging.stg_territories(self.raw["territories"])

    @cached_property
    def dim_row_bounds(self) -> dict:
        """Upper bounds on dimension rows from the source tables' footers
        (the driver's tables are read-only, so once per session and folder)."""
        from ledgerlens.operators.joins import source_row_counts
        src = {"customers": "customer", "products": "part", "territories": "nation"}
        return source_row_counts(self.spark, {k: f"{self.sf_dir.rstrip('/')}/{v}.parquet" for k, v in src.items()})

    @cached_property
    def fct(self) -> DataFrame:
        return marts.fct_sales(self.stg_sales, self.stg_customers, self.stg_products,
                               self.stg_territories, RUN_TS, self.dim_row_bounds)


    @property
    def dim_customers(self) -> DataFrame:
        # Not cached: building it materializes (checkpoints) the customer
        # stats, and each query must pay for its own data.
        return customers.dim_customers(self.stg_customers, self.fct, AS_OF, RUN_TS)


    @cached_property
    def view(self) -> DataFrame:
        return marts.vw_sales_fact(self.fct)

    @cached_property
    def budget(self) -> DataFrame:
        return staging.budget_periods(staging.star_budget(self.stg_sales, self.stg_products))


def oracle_types(df: DataFrame, drop=("_transformed_at", "_updated_at", "_ingested_at")) -> DataFrame:
    """Cast to comparison-friendly types: decimal/float -> double,
    byte/short/int -> bigint; drop run-time lineage timestamps."""
    cols = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        t = f.dataType
        if isinstance(t, (T.DecimalType, T.FloatType)):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def q_monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship slice: star -> stg_sales -> fct_sales -> monthly KPI group-by."""
    m = Models.of(spark, sf_dir)
    return oracle_types(marts.monthly_kpis(m.fct))


def q_sales_performance_row(spark, sf_dir):
    """Monthly KPIs with literal-LAG MoM/YoY growth (W4, W5, mode='row')."""
    return oracle_types(marts.fct_sales_performance(Models.of(spark, sf_dir).fct, "row", RUN_TS))


def q_sales_performance_calendar(spark, sf_dir):
    """Monthly KPIs with calendar-exact MoM/YoY growth (mode='calendar')."""
    return oracle_types(marts.fct_sales_performance(Models.of(spark, sf_dir).fct, "calendar", RUN_TS))


def q_dim_customers(spark, sf_dir):
    """RFM-segmented customer dimension (M6; W1-W3 distributed NTILE)."""
    return oracle_types(Models.of(spark, sf_dir).dim_customers)


def q_rfm_quantile(spark, sf_dir):
    """Quantile RFM variant (M12; W7 exact qcut edges, P11)."""
    return oracle_types(customers.rfm_quantile(Models.of(spark, sf_dir).fct, AS_OF))


def q_segment_counts(spark, sf_dir):
    """Segment value counts of the quantile RFM."""
    rq = customers.rfm_quantile(Models.of(spark, sf_dir).fct, AS_OF)
    return oracle_types(customers.segment_counts(rq, "segment"))


def q_customer_segments(spark, sf_dir):
    """Customers and lifetime value per RFM segment x lifetime tier."""
    dim = Models.of(spark, sf_dir).dim_customers
    return oracle_types(dim.groupBy("customer_segment", "lifetime_tier").agg(
        F.count("*").alias("customers"), F.sum("lifetime_value").alias("lifetime_value")))


def q_base_measures(spark, sf_dir):
    """D1-D8, D17, D21, D25 by region x year in one aggregate."""
    return oracle_types(measures.base_measures(Models.of(spark, sf_dir).view,
                                               ["territory_region", "order_year"]))


def q_period_to_date(spark, sf_dir):
    """Revenue MTD / QTD / YTD per region x day."""
    return oracle_types(measures.period_to_date(Models.of(spark, sf_dir).view, ["territory_region"], "day"))


def q_time_intelligence_month(spark, sf_dir):
    """D11-D14, D16 per region x month on the densified grid."""
    return oracle_types(measures.time_intelligence(Models.of(spark, sf_dir).view, ["territory_region"], "month"))


def q_time_intelligence_year(spark, sf_dir):
    """Year-grain YTD / PYTD / YoY / cumulative per product category."""
    return oracle_types(measures.time_intelligence(Models.of(spark, sf_dir).view, ["product_category"], "year"))


def q_new_returning(spark, sf_dir):
    """Total, new, returning customers and retention."""
    m = Models.of(spark, sf_dir)
    # first_order_date of the customer dimension is the per-customer minimum
    # non-cancelled order date; the light aggregate carries the same values
    # without the RFM ranking plan.
    first = customers.customer_sales_stats(m.fct, AS_OF).select("customer_id", "first_order_date")
    return oracle_types(measures.customer_activity(m.view, first, ["territory_region"], "month"))


def q_budget_attainment(spark, sf_dir):
    """Actual vs budget per territory x month."""
    m = Models.of(spark, sf_dir)
    return oracle_types(measures.budget_measures(m.view, m.budget, ["territory_id"], "month"))


def q_top_products(spark, sf_dir):
    """Top product revenue per region."""
    return oracle_types(measures.top_product_revenue(Models.of(spark, sf_dir).view, ["territory_region"]))


def q_top_products_ties(spark, sf_dir):
    """T2 with ties: products ranked in the top 3 of their region."""
    return oracle_types(measures.top_products(Models.of(spark, sf_dir).view, 3, ["territory_region"]))


def q_customer_measures(spark, sf_dir):
    """D22, D23, D28 per customer country (customer-table measures)."""
    return oracle_types(measures.customer_segment_measures(Models.of(spark, sf_dir).dim_customers, ["country"]))


def q_kpi_summary(spark, sf_dir):
    """One-row KPI summary with computed margin and growth."""
    # The fact is computed once, for the summary and for the segments, which ask of a sale's id whether it is null.
    has_id = F.when(F.col("sale_id").isNotNull(), "").alias("sale_id")
    fct = written(spark, Models.of(spark, sf_dir).fct.select(
        has_id, "customer_id", "order_date", "order_month", "status", "net_revenue", "gross_profit"), "kpi-fact")
    return oracle_types(demo.kpi_summary(fct, customers.rfm_quantile(fct, AS_OF)))


def queries():
    from ledgerlens import load_queries
    return {**_core_queries(), **more_queries(), **load_queries.queries()}


def _core_queries():
    return {
        "base_measures": q_base_measures,
        "period_to_date": q_period_to_date,
        "time_intelligence_month": q_time_intelligence_month,
        "time_intelligence_year": q_time_intelligence_year,
        "new_returning": q_new_returning,
        "budget_attainment": q_budget_attainment,
        "top_products": q_top_products,
        "top_products_ties": q_top_products_ties,
        "customer_measures": q_customer_measures,
        "kpi_summary": q_kpi_summary,
        "monthly_revenue": q_monthly_revenue,
        "sales_performance_row": q_sales_performance_row,
        "sales_performance_calendar": q_sales_performance_calendar,
        "dim_customers": q_dim_customers,
        "rfm_quantile": q_rfm_quantile,
        "segment_counts": q_segment_counts,
        "customer_segments": q_customer_segments,
    }


# ---- Silver / Gold tables, views, calendar -------------------------------------------

def q_stg_sales(spark, sf_dir):
    """M1 Silver sales (F1, F2, X1-X6, X10-X14, X17, P5).  ``unit_price``
    is a decimal quotient and is left out of the comparison."""
    return oracle_types(Models.of(spark, sf_dir).stg_sales.drop("unit_price", "_source", "_file_name"))


def q_stg_customers(spark, sf_dir):
    """M2 Silver customers."""
    return oracle_types(Models.of(spark, sf_dir).stg_customers)


def q_stg_products(spark, sf_dir):
    """M3 Silver products."""
    return oracle_types(Models.of(spark, sf_dir).stg_products.drop("weight_kg", "is_active", "launched_date"))


def q_stg_territories(spark, sf_dir):
    """M4 Silver territories."""
    return oracle_types(Models.of(spark, sf_dir).stg_territories.drop("manager_id", "quota_amount"))


def q_budget_periods(spark, sf_dir):
    """M14 budget with period_date (budget derived from prior-year revenue)."""
    return oracle_types(Models.of(spark, sf_dir).budget.drop("budget_id"))


def q_fct_sales(spark, sf_dir):
    """M5 Gold sales fact."""
    return oracle_types(Models.of(spark, sf_dir).fct.drop("unit_price", "cost_price"))


def q_fct_sales_salted(spark, sf_dir):
    """M5 with customers and products taken for too large to broadcast: the
    salted shuffle joins give the same fact."""
    m = Models.of(spark, sf_dir)
    large = {"customers": 1 << 50, "products": 1 << 50, "territories": m.dim_row_bounds["territories"]}
    fct = marts.fct_sales(m.stg_sales, m.stg_customers, m.stg_products, m.stg_territories, RUN_TS, large)
    return oracle_types(fct.drop("unit_price", "cost_price"))


def q_pipeline_fact(spark, sf_dir):
    """The daily pipeline over landing files cut from the tables: a day of
    dimensions with an outdated product list, sales with the list sent again,
    then a late file of that day and a backfill of the day before.  The fact
    must be the batch fact."""
    from ledgerlens.plans.pipeline import run_pipeline
    from ledgerlens.sources.readers import daily_path
    raw = Models.of(spark, sf_dir).raw
    base = _scratch(spark, "pipeline")
    land, wh = f"{base}/landing", f"{base}/warehouse"
    days = [dt.date(1998, 1, 1) + dt.timedelta(days=i) for i in range(2)]

    def put(table: str, df: DataFrame, day: dt.date, name: str) -> None:
        df.write.parquet(f"{daily_path(f'{land}/{table}', day)}/{name}")

    part = F.pmod(F.xxhash64("sale_id"), F.lit(4))
    old = raw["products"].withColumn("cost_price", (F.col("cost_price") * 2).cast(raw["products"].schema["cost_price"].dataType))
    put("products", old, days[0], "a")
    put("customers", raw["customers"], days[0], "a")
    put("territories", raw["territories"], days[0], "a")
    run_pipeline(spark, land, wh, days[0], as_of=AS_OF, rebuild=False)
    put("products", raw["products"], days[1], "a")
    # The sales are cut into their parts once.
    raw["sales"].withColumn("_part", part).write.partitionBy("_part").parquet(f"{base}/cut")
    cut = spark.read.schema(raw["sales"].withColumn("_part", part).schema).parquet(f"{base}/cut")
    sales = lambda *parts: cut.filter(F.col("_part").isin(*parts)).drop("_part")
    put("sales", sales(0, 3), days[1], "a")
    run_pipeline(spark, land, wh, days[1], as_of=AS_OF, rebuild=False)
    put("sales", sales(1), days[1], "late")
    run_pipeline(spark, land, wh, days[1], as_of=AS_OF, rebuild=False)
    put("sales", sales(2), days[0], "backfill")
    run_pipeline(spark, land, wh, days[0], as_of=AS_OF, rebuild=False)
    return oracle_types(spark.read.parquet(f"{wh}/marts/fct_sales").drop("unit_price", "cost_price"))


def q_vw_sales_fact(spark, sf_dir):
    """M8 semantic sales view."""
    return oracle_types(Models.of(spark, sf_dir).view.drop("unit_price"))


def q_vw_customer_dim(spark, sf_dir):
    """M9 semantic customer view."""
    return oracle_types(marts.vw_customer_dim(Models.of(spark, sf_dir).dim_customers))


def q_dim_date(spark, sf_dir):
    """Date dimension over the order-date range."""
    from ledgerlens.plans.calendar import dim_date_of
    return oracle_types(dim_date_of(Models.of(spark, sf_dir).stg_sales, "order_date"))


# ---- quality, security, incremental ---------------------------------------------------

def q_quality_report(spark, sf_dir):
    """Q1-Q4, Q6, Q7, Q9 on Silver and Gold tables in one pass per table
    (+ one aggregation per unique key)."""
    from ledgerlens.functions.tiers import LIFETIME_TIER_VALUES, SEGMENTS, STATUS_VALUES
    from ledgerlens.operators import quality as q
    m = Models.of(spark, sf_dir)
    # The fact is computed once, for its own checks and for the customer statistics.
    fct = written(spark, m.fct.select("sale_id", "customer_id", "product_id", "order_date", "status", "net_revenue", "gross_profit",
                                      "gross_margin_pct"), "quality-fact")
    parts = [
        q.run_checks(m.stg_sales, "stg_sales", [
            q.not_null("sale_id"), q.unique("sale_id"), q.not_null("net_revenue"),
            q.accepted_range("net_revenue", 0, None), q.accepted_range("discount_pct", 0, 1),
            q.accepted_values("status", STATUS_VALUES), q.not_future("order_date", AS_OF),
            q.expression_true("net_revenue_le_total", F.col("net_revenue") <= F.col("total_amount")),
        ]),
        q.run_checks(fct, "fct_sales", [
            q.not_null("sale_id"), q.unique("sale_id"), q.not_null("net_revenue"),
            q.accepted_range("gross_margin_pct", -100, 100), q.finite("gross_profit"),
        ]),
        q.run_checks(customers.dim_customers(m.stg_customers, fct, AS_OF, RUN_TS), "dim_customers", [
            q.not_null("customer_id"), q.unique("customer_id"),
            q.accepted_values("customer_segment", SEGMENTS),
            q.accepted_values("lifetime_tier", LIFETIME_TIER_VALUES),
        ]),
    ]
    from functools import reduce
    return reduce(lambda a, b: a.unionByName(b), parts)


def q_quality_report_declared(spark, sf_dir):
    """All 33 declared rules of the raw, Silver and Gold tables."""
    from ledgerlens.plans import quality_rules
    m = Models.of(spark, sf_dir)
    # The fact is computed once, for its own rules, the customer statistics and the monthly table.
    fct = written(spark, m.fct.select(
        "sale_id", "customer_id", "product_id", "order_date", "order_month", "status", "channel", "quantity", "net_revenue",
        "discount_amount", "days_to_ship", "gross_profit", "gross_margin_pct", "product_category", "customer_tier",
        *marts.TERRITORY), "declared-fact")
    return quality_rules.report({
        **{f"raw_{t}": m.raw[t] for t in ("sales", "customers", "products", "territories")},
        "raw_budget": staging.star_budget(m.stg_sales, m.stg_products), "stg_sales": m.stg_sales,
        "stg_customers": m.stg_customers, "fct_sales": fct,
        "dim_customers": customers.dim_customers(m.stg_customers, fct, AS_OF, RUN_TS),
        "fct_sales_performance": marts.fct_sales_performance(fct, "row", RUN_TS)})


def q_freshness(spark, sf_dir):
    """Q5: raw sales freshness at the run timestamp (warn 6 h, error 24 h)."""
    from ledgerlens.operators.quality import freshness
    return oracle_types(freshness(Models.of(spark, sf_dir).raw["sales"], "_ingested_at", RUN_TS),
                        drop=("max_loaded_at",))


def q_rls_region(spark, sf_dir):
    """a RegionalManager for EUROPE sees only that region's rows."""
    from ledgerlens.operators.security import secure
    v = secure(Models.of(spark, sf_dir).view, "RegionalManager", "EUROPE")
    return oracle_types(measures.base_measures(v, ["territory_region", "territory_name"]))


# Previous load boundary for the incremental queries: the target holds
# what was loaded before this date.
PREVIOUS_LOAD = dt.date(2000, 1, 1)


def q_hwm_filter(spark, sf_dir):
    """Raw rows ingested after the target's high-water mark."""
    from ledgerlens.operators.incremental import after_high_water_mark
    m = Models.of(spark, sf_dir)
    raw = m.raw["sales"]
    target = m.stg_sales.filter(F.col("order_date") < F.lit(PREVIOUS_LOAD))
    new = after_high_water_mark(raw, target, "_ingested_at")
    return oracle_types(new.select("sale_id", "customer_id", "order_date", "total_amount"))


def q_events_after_hwm(spark, sf_dir):
    """F4 on the event stream: events newer than the last purchase event."""
    from ledgerlens.operators.incremental import after_high_water_mark
    from ledgerlens.sources.star import read_table
    ev = read_table(spark, sf_dir, "events")
    target = ev.filter(F.col("event_type") == "purchase")
    return oracle_types(after_high_water_mark(ev, target, "ts").drop("ts", "props"))


def _upsert_inputs(m: Models):
    """Target = Silver rows loaded before PREVIOUS_LOAD; batch = rows from
    six months earlier on (overlapping keys are updates), plus a re-sent,
    later version of every 'online' row in the batch (status corrected)."""
    s = m.stg_sales.drop("unit_price", "_source", "_file_name", "_transformed_at")
    # Target and batches come from one run of the Silver plan.
    path = _scratch(m.spark, "upsert-inputs")
    s.write.parquet(path)
    s = m.spark.read.schema(s.schema).parquet(path)
    target = s.filter(F.col("order_date") < F.lit(PREVIOUS_LOAD))
    batch = s.filter(F.col("order_date") >= F.lit(dt.date(1999, 7, 1)))
    resent = batch.filter(F.col("channel") == "online").withColumns({
        "status": F.lit("returned"),
        "_ingested_at": F.col("_ingested_at") + F.expr("INTERVAL 1 DAY"),
    })
    return target, batch.unionByName(resent)


def q_upsert_latest(spark, sf_dir):
    """K4 + W11: the table that two keyed upserts write, read back (target minus
    replaced keys, plus the latest version of each incoming key)."""
    from ledgerlens.operators.incremental import merge_upsert
    target, batch = _upsert_inputs(Models.of(spark, sf_dir))
    path = _scratch(spark, "upsert")
    merge_upsert(spark, path, target, "sale_id", "_ingested_at", "order_month")
    merge_upsert(spark, path, batch, "sale_id", "_ingested_at", "order_month")
    merged = spark.read.parquet(path)
    # The version timestamp is returned as ISO text, so any value hashing
    # compares it exactly.
    return oracle_types(merged.select("sale_id", "order_date", "status", "net_revenue",
                                      F.col("_ingested_at").cast("string").alias("_ingested_at")),
                        drop=())


def q_latest_per_customer(spark, sf_dir):
    """Each customer's latest sale by (order_date, sale_id)."""
    from ledgerlens.operators.incremental import latest_per_key
    s = Models.of(spark, sf_dir).stg_sales.select("customer_id", "order_date", "sale_id", "net_revenue")
    return oracle_types(latest_per_key(s, "customer_id", ["order_date", "sale_id"]))


# ---- single-operator checks ---------------------------------------------------------

def q_deal_tiers(spark, sf_dir):
    """P5: SQL deal-size ladder (lower bounds inclusive)."""
    s = Models.of(spark, sf_dir).stg_sales
    return oracle_types(s.groupBy("deal_size_tier").agg(
        F.count(F.lit(1)).alias("n"), F.min("total_amount").alias("min_amount"),
        F.max("total_amount").alias("max_amount")))


def q_tier_bins_right_closed(spark, sf_dir):
    """Right-closed bins (0,100], (100,1000], ... on completed sales."""
    from ledgerlens.functions.tiers import deal_size_bin
    s = Models.of(spark, sf_dir).stg_sales.filter(F.col("status") != "cancelled")
    return oracle_types(s.groupBy(deal_size_bin(F.col("total_amount")).alias("deal_size_bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("total_amount").alias("min_amount"),
        F.max("total_amount").alias("max_amount")))


def q_lifetime_tiers(spark, sf_dir):
    """Lifetime tiers of the customer dimension."""
    d = Models.of(spark, sf_dir).dim_customers
    return oracle_types(d.groupBy("lifetime_tier").agg(
        F.count(F.lit(1)).alias("n"), F.min("lifetime_value").alias("min_ltv"),
        F.max("lifetime_value").alias("max_ltv")))


def q_not_cancelled(spark, sf_dir):
    """status != 'cancelled' (SQL semantics) - rows per remaining status."""
    s = Models.of(spark, sf_dir).stg_sales.filter(F.col("status") != "cancelled")
    return oracle_types(s.groupBy("status").agg(F.count(F.lit(1)).alias("n")))


def q_left_join_dims(spark, sf_dir):
    """Left joins keep every sale; unmatched-dimension counts."""
    from ledgerlens.operators.quality import row_count_preserved
    m = Models.of(spark, sf_dir)
    kept = row_count_preserved(m.stg_sales, m.fct, "fct_sales_left_joins")
    unmatched = m.fct.agg(
        F.count_if(F.col("customer_tier").isNull()).alias("no_customer"),
        F.count_if(F.col("product_category").isNull()).alias("no_product"),
        F.count_if(F.col("territory_name").isNull()).alias("no_territory"))
    both = kept.unionByName(unmatched, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in kept.columns + unmatched.columns])


def q_multi_distinct(spark, sf_dir):
    """A4: three distinct counts in one group-by."""
    f = Models.of(spark, sf_dir).fct
    return oracle_types(f.groupBy("order_year").agg(
        F.count_distinct("sale_id").alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("product_id").alias("products")))


def q_repeat_ratio(spark, sf_dir):
    """Share of customers with more than one completed sale."""
    s = Models.of(spark, sf_dir).stg_sales.filter(F.col("status") != "cancelled")
    per = s.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    from ledgerlens.functions.scalar import safe_divide
    return per.agg(F.count_if(F.col("n") > 1).alias("repeat_customers"),
                   F.count(F.lit(1)).alias("customers"),
                   safe_divide(F.count_if(F.col("n") > 1), F.count(F.lit(1)), 0).alias("repeat_ratio"))


def q_global_month_growth(spark, sf_dir):
    """Month-over-month growth of total amount over the month series
    (window over the monthly aggregate, at most one row per month)."""
    from pyspark.sql import Window
    s = Models.of(spark, sf_dir).stg_sales
    mon = s.groupBy(F.col("order_month")).agg(F.sum("total_amount").alias("total_amount"))
    prev = F.lag("total_amount", 1).over(Window.orderBy("order_month"))
    out = mon.withColumn("prev_amount", prev).withColumn(
        "mom_growth", (F.col("total_amount").cast("double") - F.col("prev_amount").cast("double"))
        / F.col("prev_amount").cast("double"))
    return oracle_types(out)


def q_running_total_month(spark, sf_dir):
    """Cumulative revenue over all months (no keys)."""
    t = measures.time_intelligence(Models.of(spark, sf_dir).view, [], "month")
    return oracle_types(t.select("period", "revenue", "cumulative_revenue"))


def q_status_outside_allowed(spark, sf_dir):
    """Status values outside the demo's allowed set (left anti join)."""
    from ledgerlens.operators.quality import values_outside
    s = Models.of(spark, sf_dir).stg_sales
    return values_outside(s, "status", ["completed", "pending", "shipped", "cancelled"])


def q_text_cleaning(spark, sf_dir):
    """trim/case, null-propagating concatenation, phone cleanup."""
    c = Models.of(spark, sf_dir).stg_customers
    return c.select("customer_id", "first_name", "last_name", "full_name", "email", "phone",
                    "industry", "country", "city")


def q_date_parts(spark, sf_dir):
    """Day differences, month/quarter truncation, year/month/quarter."""
    from ledgerlens.functions.scalar import days_between
    od = F.col("order_date")
    return oracle_types(Models.of(spark, sf_dir).stg_sales.select(
        "sale_id", "days_to_ship", F.col("order_month").alias("month_start"),
        F.col("order_quarter").alias("quarter_start"),
        days_between(od, F.col("ship_date")).alias("raw_days_to_ship"),
        F.year(od).alias("order_year"), F.month(od).alias("order_month"), F.quarter(od).alias("order_quarter")))


def q_margin_math(spark, sf_dir):
    """Total cost, gross profit and margin % per sale."""
    f = Models.of(spark, sf_dir).fct
    return oracle_types(f.select("sale_id", "quantity", "net_revenue", "total_cost", "gross_profit",
                                 "gross_margin_pct"))


def q_duplicate_keys(spark, sf_dir):
    """(order, line number) pairs that occur more than once."""
    from ledgerlens.operators.quality import duplicate_keys
    from ledgerlens.sources.star import read_table
    return duplicate_keys(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_range_violations(spark, sf_dir):
    """Q3: sales whose margin is outside -100..100 (nulls pass)."""
    f = Models.of(spark, sf_dir).fct
    bad = F.coalesce((F.col("gross_margin_pct") < -100) | (F.col("gross_margin_pct") > 100), F.lit(False))
    return oracle_types(f.filter(bad).select("sale_id", "gross_margin_pct"))


def q_dataset_stats(spark, sf_dir):
    """K7: row count of every table of the folder (sizes and change times
    differ between copies of the data and are left out)."""
    from ledgerlens.oracle_sql import ALL_TABLES
    from ledgerlens.sources.sinks import dataset_stats
    tables = {t: ("RAW" if t in ("orders", "lineitem", "events") else "REFERENCE",
                  f"{sf_dir.rstrip('/')}/{t}.parquet") for t in ALL_TABLES}
    return dataset_stats(spark, tables).select("table_name", "row_count")


def q_monthly_summary(spark, sf_dir):
    """The demo's monthly KPIs (sum, count, distinct, mean; 2 decimals)."""
    return oracle_types(demo.monthly_summary(Models.of(spark, sf_dir).fct))


def q_time_intelligence_alt(spark, sf_dir):
    """Alternate measure definitions: growth divided by the signed previous
    value, cumulative revenue = YTD (per product category x month)."""
    t = measures.time_intelligence(Models.of(spark, sf_dir).view, ["product_category"], "month",
                                   abs_denominator=False, cumulative="ytd")
    return oracle_types(t)


def q_measure_evaluate(spark, sf_dir):
    """The generic entry point: several measure groups for one grouping,
    joined null-safely on (keys, period)."""
    m = Models.of(spark, sf_dir)
    # The sales are computed once, for the measures and for the customers' first dates.
    sales = written(spark, m.view.select("customer_id", "product_id", "order_date", "status", "net_revenue", "product_category"),
                    "evaluate-sales")
    # Of the statistics the first date alone is used, which the profit has no part in.
    no_profit = F.lit(None).cast(m.fct.schema["gross_profit"].dataType)
    first = (customers.customer_sales_stats(sales.withColumn("gross_profit", no_profit), AS_OF)
             .select("customer_id", "first_order_date"))
    out = measures.evaluate(
        sales, ["total_revenue", "total_orders", "avg_order_value", "revenue_ytd",
                 "revenue_mom_growth", "new_customers", "customer_retention_rate",
                 "top_product_revenue", "revenue_vs_budget", "kpi_status"],
        by=["product_category"], grain="month", customers=first, budget=m.budget)
    return oracle_types(out)


def q_measure_evaluate_total(spark, sf_dir):
    """The generic entry point without a grain: one row for each key."""
    m = Models.of(spark, sf_dir)
    first = customers.customer_sales_stats(m.fct, AS_OF).select("customer_id", "first_order_date")
    return oracle_types(measures.evaluate(
        m.view, ["total_revenue", "total_orders", "revenue_ytd", "revenue_mom_growth", "new_customers",
                 "revenue_vs_budget"], by=["product_category"], customers=first, budget=m.budget))


def q_time_intelligence_day(spark, sf_dir):
    """D11-D14, D16 per region x day."""
    return oracle_types(measures.time_intelligence(Models.of(spark, sf_dir).view, ["territory_region"], "day"))


def q_dates_with_sales(spark, sf_dir):
    """Date rows cross-filtered by Sales (left semi join)."""
    from ledgerlens.plans.calendar import dates_with_sales, dim_date_of
    s = Models.of(spark, sf_dir).stg_sales
    d = dim_date_of(s, "order_date")
    return oracle_types(dates_with_sales(d, s).select("date_day", "year", "month", "is_weekday"))


def q_summarize_defaults(spark, sf_dir):
    """Column default aggregations (sum / average) by region."""
    v = Models.of(spark, sf_dir).view
    aggs = measures.default_aggregations({"net_revenue": "sum", "gross_profit": "sum",
                                          "quantity": "sum", "gross_margin_pct": "average",
                                          "discount_pct": "average"})
    return oracle_types(v.groupBy("territory_region").agg(*aggs.values()))


def _scratch(spark, name: str) -> str:
    import uuid
    from ledgerlens.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def written(spark, df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back, for plans that use it several times."""
    path = _scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def q_csv_roundtrip(spark, sf_dir):
    """S2, S7, S8, S10, S12, S13 on a whole table: raw sales are written as
    CSV with reordered, differently cased headers, then loaded back through
    the permissive reader; totals must survive the round trip."""
    from ledgerlens.sources.readers import read_permissive
    raw = Models.of(spark, sf_dir).raw["sales"]
    cols = list(reversed(raw.columns))
    landed = raw.select(*[F.col(c).alias(c.upper() if i % 2 else c.title()) for i, c in enumerate(cols)])
    path = _scratch(spark, "csv-landing")
    landed.write.option("header", "true").csv(path)
    good, bad = read_permissive(spark, path, "sales", "csv", load_ts=RUN_TS, source="landing")
    g = good.agg(F.count(F.lit(1)).alias("rows_loaded"),
                 F.sum("total_amount").alias("total_amount"),
                 F.sum("discount_pct").alias("discount_pct"),
                 F.count_distinct("sale_id").alias("sales"),
                 F.min("order_date").alias("first_order"), F.max("ship_date").alias("last_ship"),
                 F.count_if(F.col("_source") == "landing").alias("with_source"),
                 F.lit(None).cast("bigint").alias("errors"))
    b = bad.agg(F.count(F.lit(1)).alias("errors"))
    both = g.unionByName(b, allowMissingColumns=True)
    return oracle_types(both.agg(*[F.max(c).alias(c) for c in g.columns]))


def q_jsonl_roundtrip(spark, sf_dir):
    """S3, S7, S8 on a whole table: raw customers written as JSON lines with
    upper-case keys, loaded back case-insensitively."""
    from ledgerlens.sources.readers import read_permissive
    raw = Models.of(spark, sf_dir).raw["customers"]
    path = _scratch(spark, "jsonl-landing")
    raw.select(*[F.col(c).alias(c.upper()) for c in raw.columns]).write.json(path)
    good, bad = read_permissive(spark, path, "customers", "jsonl", load_ts=RUN_TS)
    g = good.agg(F.count(F.lit(1)).alias("rows_loaded"),
                 F.count_distinct("email").alias("emails"),
                 F.min("signup_date").alias("first_signup"),
                 F.count("tier").alias("with_tier"),
                 F.count("attributes").alias("with_attributes"),
                 F.lit(None).cast("bigint").alias("errors"))
    b = bad.agg(F.count(F.lit(1)).alias("errors"))
    both = g.unionByName(b, allowMissingColumns=True)
    return oracle_types(both.agg(*[F.max(c).alias(c) for c in g.columns]))


def q_quarantine_rows(spark, sf_dir):
    """S8 / S10 at full scale: raw sales landed as CSV where every cancelled
    sale carries an unparseable order date (derived from the data, not made
    up); the loader must quarantine exactly those rows, with the reason, and
    load the rest."""
    from ledgerlens.sources.readers import read_permissive
    raw = Models.of(spark, sf_dir).raw["sales"]
    landed = raw.withColumn("order_date", F.when(F.col("status") == "cancelled", F.lit("cancelled"))
                            .otherwise(F.col("order_date").cast("string")))
    path = _scratch(spark, "csv-quarantine")
    landed.write.option("header", "true").csv(path)
    good, bad = read_permissive(spark, path, "sales", "csv", load_ts=RUN_TS)
    per_reason = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"),
                                          F.count_distinct("sale_id").alias("sales"))
    loaded = good.agg(F.lit("loaded").alias("reason"), F.count(F.lit(1)).alias("rows"),
                      F.count_distinct("sale_id").alias("sales"))
    return per_reason.unionByName(loaded)


def more_queries():
    return {
        "quarantine_rows": q_quarantine_rows,
        "csv_roundtrip": q_csv_roundtrip,
        "jsonl_roundtrip": q_jsonl_roundtrip,
        "time_intelligence_alt": q_time_intelligence_alt,
        "measure_evaluate": q_measure_evaluate,
        "measure_evaluate_total": q_measure_evaluate_total,
        "time_intelligence_day": q_time_intelligence_day,
        "fct_sales_salted": q_fct_sales_salted,
        "pipeline_fact": q_pipeline_fact,
        "dates_with_sales": q_dates_with_sales,
        "summarize_defaults": q_summarize_defaults,
        "stg_sales": q_stg_sales,
        "stg_customers": q_stg_customers,
        "stg_products": q_stg_products,
        "stg_territories": q_stg_territories,
        "budget_periods": q_budget_periods,
        "fct_sales": q_fct_sales,
        "vw_sales_fact": q_vw_sales_fact,
        "vw_customer_dim": q_vw_customer_dim,
        "dim_date": q_dim_date,
        "quality_report": q_quality_report,
        "quality_report_declared": q_quality_report_declared,
        "freshness": q_freshness,
        "rls_region": q_rls_region,
        "hwm_filter": q_hwm_filter,
        "events_after_hwm": q_events_after_hwm,
        "upsert_latest": q_upsert_latest,
        "latest_per_customer": q_latest_per_customer,
        "deal_tiers": q_deal_tiers,
        "tier_bins_right_closed": q_tier_bins_right_closed,
        "lifetime_tiers": q_lifetime_tiers,
        "not_cancelled": q_not_cancelled,
        "left_join_dims": q_left_join_dims,
        "multi_distinct": q_multi_distinct,
        "repeat_ratio": q_repeat_ratio,
        "global_month_growth": q_global_month_growth,
        "running_total_month": q_running_total_month,
        "status_outside_allowed": q_status_outside_allowed,
        "text_cleaning": q_text_cleaning,
        "date_parts": q_date_parts,
        "margin_math": q_margin_math,
        "duplicate_keys": q_duplicate_keys,
        "range_violations": q_range_violations,
        "dataset_stats": q_dataset_stats,
        "monthly_summary": q_monthly_summary,
    }
