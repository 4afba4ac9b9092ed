"""The reference's own test invariants, asserted on Spark outputs built
from the driver tables (smallest scale)."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens import queries as Q
from ledgerlens.plans import demo, marts, measures


@pytest.fixture(scope="module")
def m(spark):
    return Q.Models(spark, SF_SMALL)


def test_data_quality_invariants(m):
    s = m.stg_sales
    r = s.agg(F.count_if(F.col("sale_id").isNull()).alias("null_ids"),
              (F.count("*") - F.count_distinct("sale_id")).alias("dups"),
              F.count_if(F.col("total_amount") <= 0).alias("nonpos_amount"),
              F.count_if(F.col("quantity") <= 0).alias("nonpos_qty"),
              F.count_if(~F.col("discount_pct").between(0, 1)).alias("bad_disc"),
              F.count_if(F.col("order_date") > F.lit(Q.AS_OF)).alias("future"),
              F.count_if(F.col("customer_id").isNull()).alias("null_cust")).first()
    assert all(v == 0 for v in r.asDict().values()), r
    statuses = {x[0] for x in s.select("status").distinct().collect()}
    assert statuses <= {"completed", "pending", "shipped", "cancelled", "returned"}


def test_transformation_invariants(m):
    s = m.stg_sales
    assert s.filter((F.col("net_revenue") > F.col("total_amount")) | (F.col("net_revenue") < 0)).count() == 0
    tiers = {x[0] for x in s.select("deal_size_tier").distinct().collect()}
    assert tiers == {"micro", "smb", "mid_market", "enterprise"}
    gp = [x[0] for x in m.fct.select(F.col("gross_profit").cast("double")).collect()]
    assert all(v is not None and math.isfinite(v) for v in gp)
    monthly = demo.monthly_summary(m.fct).collect()
    assert monthly and all(x["total_revenue"] > 0 for x in monthly)


def test_dax_logic_invariants(m):
    t = measures.time_intelligence(m.view, [], "month").collect()
    assert all(x["revenue_mom_growth"] is None or math.isfinite(x["revenue_mom_growth"]) for x in t)
    year = m.view.agg(F.max("order_year")).first()[0]
    ytd = m.view.filter(F.col("order_year") == year).agg(F.sum("net_revenue")).first()[0]
    assert ytd > 0
    ratio = Q.q_repeat_ratio(m.spark, SF_SMALL).first()["repeat_ratio"]
    assert 0 <= ratio <= 1


def test_integration_pipeline(m):
    assert m.fct.count() == m.stg_sales.count()          # left joins preserve rows
    k = Q.q_kpi_summary(m.spark, SF_SMALL).first()
    assert k["total_revenue"] > 0 and k["total_orders"] > 0 and k["unique_customers"] > 0
    assert k["avg_order_value"] > 0 and -100 < k["gross_margin_pct"] < 1
    perf = marts.fct_sales_performance(m.fct, "calendar")
    assert perf.filter(F.col("total_revenue").isNull() | F.col("order_count").isNull()).count() == 0
