"""Measure library rules: blanks, densified periods, budget joins, ties."""

from decimal import Decimal

import pytest
from helpers import D, customers, products, sales, territories

from ledgerlens.plans import customers as cust
from ledgerlens.plans import marts, measures, staging


def _view(spark, rows):
    s = staging.stg_sales(sales(spark, rows))
    ids = sorted({r["customer_id"] for r in rows})
    c = staging.stg_customers(customers(spark, [{"customer_id": i, "email": "e"} for i in ids]))
    p = staging.stg_products(products(spark, [{"product_id": "P1", "category": "A", "cost_price": 1},
                                              {"product_id": "P2", "category": "B", "cost_price": 1}]))
    t = staging.stg_territories(territories(spark, [{"territory_id": "T1", "region": "EU"}]))
    f = marts.fct_sales(s, c, p, t)
    return marts.vw_sales_fact(f), c, f


def _row(i, cid, d, amt, pid="P1", status="completed"):
    return {"sale_id": f"S{i}", "customer_id": cid, "product_id": pid, "order_date": d,
            "total_amount": amt, "status": status}


def test_time_intelligence_blank_rules(spark):
    v, _, _ = _view(spark, [_row(1, "C1", D(2023, 11, 5), 100), _row(2, "C1", D(2024, 1, 5), 50),
                            _row(3, "C1", D(2024, 11, 5), 300)])
    out = {r["period"]: r for r in measures.time_intelligence(v, [], "month").collect()}
    assert len(out) == 13                                   # Nov 2023 .. Nov 2024, dense
    assert out[D(2023, 11, 1)]["revenue_mom_growth"] is None
    assert out[D(2023, 12, 1)]["revenue_mom_growth"] == -1.0   # no sales, previous month had
    assert out[D(2023, 12, 1)]["revenue"] is None
    assert out[D(2024, 2, 1)]["revenue_mom_growth"] == -1.0
    assert out[D(2024, 3, 1)]["revenue_mom_growth"] is None    # both blank
    assert out[D(2024, 11, 1)]["revenue_yoy_growth"] == 2.0
    assert out[D(2024, 2, 1)]["revenue_ytd"] == Decimal("50")
    assert out[D(2024, 11, 1)]["revenue_pytd"] == Decimal("100")
    assert out[D(2024, 11, 1)]["cumulative_revenue"] == Decimal("450")
    assert out[D(2024, 10, 1)]["cumulative_revenue"] == Decimal("150")


def test_period_to_date_day_grain(spark):
    v, _, _ = _view(spark, [_row(1, "C1", D(2024, 3, 30), 10), _row(2, "C1", D(2024, 3, 31), 20),
                            _row(3, "C1", D(2024, 4, 1), 5), _row(4, "C1", D(2024, 1, 1), 1)])
    out = {r["period"]: r for r in measures.period_to_date(v, [], "day").collect()}
    r = out[D(2024, 4, 1)]
    assert (r["revenue_mtd"], r["revenue_qtd"], r["revenue_ytd"]) == (Decimal("5"), Decimal("5"), Decimal("36"))
    assert out[D(2024, 3, 31)]["revenue_mtd"] == Decimal("30")
    m = {r["period"]: r for r in measures.period_to_date(v, [], "month").collect()}
    assert m[D(2024, 3, 1)]["revenue_qtd"] == Decimal("31") and m[D(2024, 4, 1)]["revenue_qtd"] == Decimal("5")


def test_budget_full_outer_and_status(spark):
    v, _, _ = _view(spark, [_row(1, "C1", D(2024, 1, 5), 90), _row(2, "C1", D(2024, 2, 5), 100)])
    budget = spark.createDataFrame(
        [("T1", D(2024, 1, 1), Decimal("100.00")), ("T1", D(2024, 3, 1), Decimal("50.00"))],
        "territory_id string, period_date date, budget_amount decimal(18,2)")
    out = {r["period"]: r for r in measures.budget_measures(v, budget, ["territory_id"]).collect()}
    jan, feb, mar = out[D(2024, 1, 1)], out[D(2024, 2, 1)], out[D(2024, 3, 1)]
    assert jan["revenue_target_attainment"] == 0.9 and jan["kpi_status"] == "At Risk"
    assert abs(jan["revenue_vs_budget"] + 0.1) < 1e-12
    assert feb["budget_amount"] is None and feb["revenue_target_attainment"] is None
    assert feb["kpi_status"] == "Behind"
    assert mar["actual_revenue"] is None and mar["revenue_vs_budget"] == -1.0
    with pytest.raises(ValueError):
        measures.budget_measures(v, budget, ["customer_id"])


def test_new_and_returning_customers(spark):
    rows = [_row(1, "C1", D(2024, 1, 5), 10, status="cancelled"), _row(2, "C1", D(2024, 2, 5), 10),
            _row(3, "C2", D(2024, 1, 9), 10), _row(4, "C2", D(2024, 2, 9), 10)]
    v, c, f = _view(spark, rows)
    dim = cust.dim_customers(c, f, D(2024, 12, 31))
    out = {r["period"]: r for r in measures.customer_activity(v, dim, [], "month").collect()}
    # C1's first completed order is in February: in January it is returning.
    assert (out[D(2024, 1, 1)]["new_customers"], out[D(2024, 1, 1)]["returning_customers"]) == (1, 1)
    assert (out[D(2024, 2, 1)]["new_customers"], out[D(2024, 2, 1)]["returning_customers"]) == (1, 1)
    assert out[D(2024, 2, 1)]["customer_retention_rate"] == 0.5


def test_top_products_keep_ties_and_base_measures(spark):
    v, c, f = _view(spark, [_row(1, "C1", D(2024, 1, 5), 10, "P1"), _row(2, "C2", D(2024, 1, 6), 10, "P2")])
    top = measures.top_products(v, 1).collect()
    assert {r["product_id"] for r in top} == {"P1", "P2"}
    assert measures.top_product_revenue(v).first()["top_product_revenue"] == Decimal("10")
    b = measures.base_measures(v).first()
    assert b["total_orders"] == 2 and b["avg_order_value"] == 10.0 and b["total_customers"] == 2
    empty = measures.base_measures(v.filter("1 = 0")).first()
    assert empty["total_revenue"] is None and empty["avg_order_value"] == 0.0


def test_evaluate_combines_groups(spark):
    v, c, f = _view(spark, [_row(1, "C1", D(2024, 1, 5), 10), _row(2, "C2", D(2024, 2, 6), 30, "P2")])
    dim = cust.dim_customers(c, f, D(2024, 12, 31))
    out = measures.evaluate(v, ["total_revenue", "revenue_ytd", "new_customers", "top_product_revenue"],
                            by=["product_category"], grain="month", customers=dim)
    rows = {(r["product_category"], r["period"]): r for r in out.collect()}
    assert rows[("A", D(2024, 1, 1))]["total_revenue"] == Decimal("10")
    assert rows[("B", D(2024, 2, 1))]["new_customers"] == 1
    with pytest.raises(ValueError):
        measures.evaluate(v, ["no_such_measure"])


def test_customer_segment_measures(spark):
    dim = spark.createDataFrame([("C1", "US", "Champions"), ("C2", "US", "At Risk"), ("C3", "DE", "Lost")],
                                "customer_id string, country string, customer_segment string")
    out = {r["country"]: r for r in measures.customer_segment_measures(dim, ["country"]).collect()}
    assert out["US"]["champions_pct"] == 0.5 and out["US"]["at_risk_customers"] == 1
    assert out["DE"]["customer_count"] == 1 and out["DE"]["champions_pct"] == 0.0
