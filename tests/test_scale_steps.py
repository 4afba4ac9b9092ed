"""Steps whose cost must follow the input: what is scanned, compared and written."""

import bisect
import json
import os

from pyspark.sql import functions as F

from ledgerlens.operators import joins, ranking
from ledgerlens.operators.incremental import merge_upsert, prepare_upsert
from ledgerlens.plans import marts
from ledgerlens.sources.readers import read_permissive
from ledgerlens.sources.sinks import MIN_BUCKETS, bucket_count


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k string, ts int, m string, v int")


def _scratch(write):
    return {n for n in os.listdir(write.folder) if n.startswith("_")}


def test_upsert_writes_rows_again_only_for_keys_on_both_sides(spark, tmp_dir):
    path, args = f"{tmp_dir}/t", ("k", "ts", "m")
    write, _ = prepare_upsert(spark, path, _frame(spark, [("a", 5, "x", 1), ("b", 5, "x", 2), (None, 5, "y", 3)]), *args)
    assert _scratch(write) == {"_again"}            # no repeated key: one write, the table
    write.finish()
    write, _ = prepare_upsert(spark, path, _frame(spark, [("c", 6, "x", 4), ("d", 6, "z", 5)]), *args)
    assert _scratch(write) == {"_batch", "_again", "_held"}     # no key of the table
    write.finish()
    # a: older than the table's; b: repeated and moved; null: twice in the batch, matched with nothing.
    merge_upsert(spark, path, _frame(spark, [("a", 1, "x", 9), ("b", 7, "y", 6), ("b", 6, "x", 7), (None, 5, "y", 8), (None, 9, "y", 9)]), *args)
    got = sorted((r["k"] or "", r["ts"], r["m"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [("", 5, "y", 3), ("", 9, "y", 9), ("a", 5, "x", 1), ("b", 7, "y", 6), ("c", 6, "x", 4), ("d", 6, "z", 5)]


def test_buckets_are_found_by_halving(spark):
    df = spark.range(500).selectExpr("cast(id as string) as _id", "0 as _m", "1 as _nr", "if(id % 7 = 0, null, id % 90) as _key")
    bounds = ranking._bounds(df, 37)
    placed = ranking._bucketed(df, bounds)
    assert "filter(" not in placed._jdf.queryExecution().analyzed().toString().lower()   # not every bound is compared
    order = lambda r: (r["_m"], r["_nr"], r["_key"] is not None, r["_key"] or 0, r["_id"])
    limits = [order(b) for b in spark.range(1).select(bounds.alias("b")).first()["b"]]
    assert all(r["_b"] == bisect.bisect_right(limits, order(r)) for r in placed.collect())


def test_hot_keys_of_all_joins_come_from_one_pass(spark):
    fact = spark.createDataFrame([("h" if i % 2 else f"c{i}", "p" if i % 3 else None) for i in range(60)], "c string, p string")
    hot = joins.hot_key_lists(fact, ["c", "p"], 0.3)
    r = spark.range(1).select(hot["c"].alias("c"), hot["p"].alias("p")).first()
    assert (r["c"], r["p"]) == (["h"], ["p"])
    from conftest import SF_SMALL
    from ledgerlens import queries as Q
    m = Q.Models(spark, SF_SMALL)
    large = {"customers": 1 << 50, "products": 1 << 50, "territories": 25}
    fct = marts.fct_sales(m.stg_sales, m.stg_customers, m.stg_products, m.stg_territories, Q.RUN_TS, large)
    rows = fct.groupBy("product_category").agg(F.sum("net_revenue"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "concat_ws" not in plan       # the sale's id is not carried for the salts


def test_bucket_number_follows_the_rows():
    assert bucket_count(0) == bucket_count(600_000) == MIN_BUCKETS
    assert bucket_count(36_000_000) == 72 and bucket_count(216_000_000) == 432


def test_json_fields_are_read_once(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/j")
    with open(f"{tmp_dir}/j/a.json", "w") as f:
        json.dump([{"CUSTOMER_ID": "1", "Email": "a@x", "signup_date": "no date"}, "bare", {"email": "b@x"},
                   {"customer_id": "2", "Tier": None}, {"customer_id": "3", "CUSTOMER_ID": "3"}], f)
    good, bad = read_permissive(spark, f"{tmp_dir}/j", "customers", "json")
    assert [(r["customer_id"], r["email"], r["tier"]) for r in good.collect()] == [("2", None, None)]
    assert sorted(r["reason"] for r in bad.collect()) == ["malformed", "malformed", "missing key", "type:signup_date"]
    assert good._jdf.queryExecution().optimizedPlan().toString().count("map_from_entries") == 1


def test_a_row_s_bucket_is_searched_once(spark):
    df = spark.range(500).selectExpr("cast(id as string) as c", "cast(id % 7 as int) as a", "cast(if(id % 5 = 0, null, id % 90) as int) as b").checkpoint()
    ranks = ranking.global_ranks(df, "c", [("a", False, False), ("b", True, True)], 4)
    got = {(r["_id"], r["_m"]): (r["_rank"], r["_n"]) for r in ranks.collect()}
    plan = ranks._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "isnotnull(aggregate" not in plan      # counts and ranks share the search, no filter repeats it
    assert "1073741824" not in plan                                            # nor does it take steps beyond the bounds there are
    rows = [(r["c"], r["a"], r["b"]) for r in df.collect()]
    orders = (sorted(rows, key=lambda r: (-r[1], r[0])), sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[0])))
    assert got == {(r[0], m): (i, 500) for m, rows in enumerate(orders) for i, r in enumerate(rows)}


def test_quality_report_computes_the_fact_once(spark):
    from conftest import SF_SMALL
    from ledgerlens import queries as Q
    plan = Q.q_quality_report(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 1      # the Silver sales; the fact's two readers find it written


def _large_dimensions(spark):
    from conftest import SF_SMALL
    from ledgerlens import queries as Q
    m = Q.Models(spark, SF_SMALL)
    large = {"customers": 1 << 50, "products": 1 << 50, "territories": 25}
    return m, marts.fct_sales(m.stg_sales, m.stg_customers, m.stg_products, m.stg_territories, Q.RUN_TS, large)


def test_the_fact_s_shuffles_carry_no_derived_column(spark):
    _, fct = _large_dimensions(spark)
    late = ("deal_size_tier", "days_to_ship", "net_revenue", "order_quarter")
    plan = fct.select(*late, "customer_tier", "product_category")._jdf.queryExecution().optimizedPlan().toString()
    joins_from = plan.index("Join LeftOuter")
    for column in late:
        assert f"AS {column}#" in plan[:joins_from] and f"AS {column}#" not in plan[joins_from:]


def test_hot_keys_are_found_by_sketches(spark):
    """No exchange of a row for each key: a task forwards its sketch alone."""
    fact = spark.range(5000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as c", "if(id % 4 = 0, null, id) as p")
    hot = joins.hot_key_lists(fact, ["c", "p"])
    out = spark.range(1).select(hot["c"].alias("c"), hot["p"].alias("p"))
    r = out.first()
    assert (r["c"], r["p"]) == (["hot"], [])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "approx_top_k" in plan and "hashpartitioning" not in plan


def test_monthly_kpis_move_the_rows_once(spark):
    m, fct = _large_dimensions(spark)
    kpis = marts.monthly_kpis(fct.drop("order_count"))
    plan = kpis._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange hashpartitioning(period_date") == 1
    assert plan[:plan.index("Exchange hashpartitioning(period_date")].count("Exchange") == 0
    done = fct.filter("status != 'cancelled'")
    keys = ["order_month", "territory_id", "product_category", "channel", "customer_tier"]
    want = done.groupBy(*keys).agg(F.count("sale_id"), F.count_distinct("customer_id"), F.count_distinct("product_id"),
                                   F.sum("net_revenue"), F.sum("gross_profit"))
    got = kpis.select("period_date", *keys[1:], "order_count", "unique_customers", "unique_products", "total_revenue", "total_gross_profit")
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, (tuple(r) for r in want.collect())))
    assert got.schema["total_revenue"].dataType == want.schema["sum(net_revenue)"].dataType
    rows = marts.monthly_kpis(fct, sale_id_unique=False)
    assert rows.select(*kpis.columns).exceptAll(kpis).count() == 0 == kpis.exceptAll(rows.select(*kpis.columns)).count()


def test_queries_that_use_the_fact_twice_compute_it_once(spark):
    from conftest import SF_SMALL
    from ledgerlens import load_queries as L
    from ledgerlens import queries as Q
    # What is left reads the sales for tables of their own: the budget, raw and Silver sales.
    for query, left in ((Q.q_kpi_summary, 0), (Q.q_measure_evaluate, 1), (L.q_measure_evaluate_customer, 0), (Q.q_quality_report_declared, 3)):
        plan = query(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [l_orderkey") == left, query.__name__
