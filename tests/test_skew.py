"""A key holding a third of all rows: results stay exact (checked against
pandas brute force) and the plans reduce it before the shuffle."""

import datetime as dt
import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.incremental import latest_per_key
from ledgerlens.operators.ranking import add_ntiles
from ledgerlens.plans import customers as cust
from ledgerlens.plans import measures


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        cid = "HOT" if i % 3 == 0 else f"C{rnd.randint(0, 400):03d}"
        rows.append((f"S{i:05d}", cid, f"P{rnd.randint(0, 50):02d}", dt.date(2023, 1, 1) + dt.timedelta(days=rnd.randint(0, 700)),
                     Decimal(rnd.randint(100, 100000)) / 100, rnd.choice(["completed", "cancelled", "pending"]),
                     "EU" if i % 3 == 0 else rnd.choice(["US", "APAC"])))
    schema = ("sale_id string, customer_id string, product_id string, order_date date, "
              "net_revenue decimal(18,2), status string, territory_region string")
    df = spark.createDataFrame(rows, schema).withColumn("gross_profit", F.col("net_revenue"))
    return df.repartition(6), pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_customer_stats_partial_aggregation(spark, skewed):
    df, pdf = skewed
    stats = cust.customer_sales_stats(df, dt.date(2025, 1, 1))
    got = {r["customer_id"]: (r["total_orders"], r["lifetime_value"], r["unique_products_bought"])
           for r in stats.collect()}
    p = pdf[pdf["status"] != "cancelled"]
    exp = p.groupby("customer_id").agg(n=("sale_id", "count"), v=("net_revenue", "sum"),
                                       u=("product_id", "nunique"))
    assert got == {k: (r.n, r.v, r.u) for k, r in exp.iterrows()}
    plan = _plan(stats)
    first_exchange = plan.index("Exchange")
    assert "partial_count" in plan[first_exchange:]      # partial aggregates sit below the shuffle


def test_latest_per_key_no_window(spark, skewed):
    df, pdf = skewed
    out = latest_per_key(df.select("customer_id", "order_date", "sale_id"), "customer_id",
                         ["order_date", "sale_id"])
    assert "Window" not in _plan(out)
    got = {r["customer_id"]: r["sale_id"] for r in out.collect()}
    exp = pdf.sort_values(["order_date", "sale_id"]).groupby("customer_id").tail(1)
    assert got == dict(zip(exp["customer_id"], exp["sale_id"]))


def test_ntile_hot_value_spread(spark, skewed):
    df, pdf = skewed
    per = df.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    # every customer but HOT has a small count: many ties on few values
    out = {r["customer_id"]: r["t"] for r in add_ntiles(per, "customer_id", [("t", "n", True, True)], 4,
                                                        num_partitions=5).collect()}
    ppd = pdf.groupby("customer_id").size().reset_index(name="n").sort_values(["n", "customer_id"])
    n = len(ppd)
    q, r = divmod(n, 4)
    exp, i = {}, 0
    for b in range(4):
        size = q + (1 if b < r else 0)
        for cid in ppd["customer_id"].iloc[i:i + size]:
            exp[cid] = b + 1
        i += size
    assert out == exp


def test_top_products_hot_region(spark, skewed):
    df, pdf = skewed
    top = measures.top_products(df, 2, ["territory_region"])
    assert "WindowGroupLimit" in _plan(top)
    got = sorted((r["territory_region"], r["product_id"]) for r in top.collect())
    pr = pdf.groupby(["territory_region", "product_id"])["net_revenue"].sum().reset_index()
    pr["rk"] = pr.groupby("territory_region")["net_revenue"].rank(method="min", ascending=False)
    exp = sorted(map(tuple, pr[pr["rk"] <= 2][["territory_region", "product_id"]].values))
    assert got == exp


def test_salted_left_join_equals_plain_join(spark, skewed):
    from ledgerlens.operators.joins import hot_keys, salted_left_join
    df, pdf = skewed
    dim = spark.createDataFrame([(c, f"tier-{c[-1]}") for c in sorted(set(pdf["customer_id"]))] + [("NOPE", "x")],
                                "customer_id string, tier string")
    assert [r["_hot"] for r in hot_keys(df, "customer_id", hot_fraction=0.2).collect()] == ["HOT"]
    salted = salted_left_join(df.select("sale_id", "customer_id"), dim, "customer_id", "sale_id", salts=8,
                              hot_fraction=0.2)
    plain = df.select("sale_id", "customer_id").join(dim, "customer_id", "left")
    assert salted.count() == plain.count() == len(pdf)
    assert salted.exceptAll(plain.select(*salted.columns)).count() == 0
    # the join key includes the salt, so a hot key's rows spread over join partitions
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()


def test_bucketed_fact_is_not_shuffled(spark, tmp_dir):
    """Sales and customers bucketed alike: no exchange above either scan, and the plain join's rows."""
    from conftest import SF_SMALL
    from ledgerlens import queries as Q
    from ledgerlens.plans import marts
    from ledgerlens.sources.sinks import write_bucketed
    m = Q.Models(spark, SF_SMALL)
    sales = write_bucketed(m.stg_sales, "b_sales", f"{tmp_dir}/s", "customer_id", 4)
    people = write_bucketed(m.stg_customers, "b_customers", f"{tmp_dir}/c", "customer_id", 4)
    bounds = {"products": 1000, "territories": 100}
    try:
        fct = marts.fct_sales(sales, people, m.stg_products, m.stg_territories, Q.RUN_TS, bounds, co_located=("customers",))
        plan = fct._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and "SortMergeJoin" in plan
        assert "Exchange hashpartitioning(customer_id" not in plan and "Exchange hashpartitioning(product_id" not in plan
        cols = ["sale_id", "customer_tier", "customer_region", "product_category", "gross_profit", "territory_region"]
        assert fct.select(*cols).exceptAll(m.fct.select(*cols)).count() == 0 and fct.count() == m.fct.count()
    finally:
        spark.sql("DROP TABLE b_sales")
        spark.sql("DROP TABLE b_customers")
