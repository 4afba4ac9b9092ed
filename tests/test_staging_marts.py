"""Silver and Gold models on hand-made edge rows."""

from decimal import Decimal

from helpers import D, customers, products, sales, territories

from ledgerlens.plans import marts, staging

AS_OF = D(2024, 12, 31)


def test_stg_sales_filters_and_cleaning(spark):
    raw = sales(spark, [
        {"sale_id": "S1", "customer_id": "C1", "product_id": "P1", "order_date": D(2024, 1, 31),
         "ship_date": None, "total_amount": 99.99, "discount_pct": None, "currency": None,
         "channel": "  Online ", "status": " COMPLETED", "quantity": 2, "unit_price": -5},
        {"sale_id": None, "customer_id": "C1", "product_id": "P1", "order_date": D(2024, 1, 1), "total_amount": 10},
        {"sale_id": "S2", "customer_id": None, "product_id": "P1", "order_date": D(2024, 1, 1), "total_amount": 10},
        {"sale_id": "S3", "customer_id": "C1", "product_id": "P1", "order_date": None, "total_amount": 10},
        {"sale_id": "S4", "customer_id": "C1", "product_id": "P1", "order_date": D(2024, 1, 1), "total_amount": -10},
        {"sale_id": "S5", "customer_id": "C1", "product_id": "P1", "order_date": D(2024, 1, 1), "total_amount": 10,
         "quantity": 0},
        {"sale_id": "S6", "customer_id": "C1", "product_id": "P1", "order_date": D(2024, 2, 10),
         "ship_date": D(2024, 2, 8), "total_amount": 10000, "discount_pct": 0.1234},
        {"sale_id": "S7", "customer_id": "C1", "product_id": "P1", "order_date": D(2024, 2, 10),
         "total_amount": 1000, "status": None},
    ])
    out = {r["sale_id"]: r for r in staging.stg_sales(raw).collect()}
    assert set(out) == {"S1", "S6", "S7"}
    s1 = out["S1"]
    assert s1["discount_pct"] == Decimal("0") and s1["currency"] == "USD"
    assert s1["channel"] == "online" and s1["status"] == "completed"
    assert s1["days_to_ship"] == 3                      # null ship date -> order date + 3
    assert s1["deal_size_tier"] == "micro" and s1["unit_price"] == Decimal("5.0000")
    assert s1["order_month"] == D(2024, 1, 1) and s1["order_quarter"] == D(2024, 1, 1)
    s6 = out["S6"]
    assert s6["net_revenue"] == Decimal("8766.0000") and s6["discount_amount"] == Decimal("1234.0000")
    assert s6["days_to_ship"] == -2 and s6["deal_size_tier"] == "enterprise"
    assert out["S7"]["status"] is None and out["S7"]["deal_size_tier"] == "mid_market"


def test_stg_customers(spark):
    raw = customers(spark, [
        {"customer_id": "C1", "first_name": "  mary ann", "last_name": "SMITH ", "email": " A@B.COM ",
         "phone": "+1 (555) 123-4567", "country": " us", "city": "new york", "tier": None,
         "signup_date": D(2024, 12, 1)},
        {"customer_id": "C2", "first_name": None, "last_name": "x", "email": "c2@x"},
        {"customer_id": "C3", "email": None},
    ])
    out = {r["customer_id"]: r for r in staging.stg_customers(raw, AS_OF).collect()}
    assert set(out) == {"C1", "C2"}
    c1 = out["C1"]
    assert c1["first_name"] == "Mary Ann" and c1["last_name"] == "Smith"
    assert c1["full_name"] == "Mary Ann Smith" and c1["email"] == "a@b.com"
    assert c1["phone"] == "+15551234567" and c1["country"] == "US" and c1["city"] == "New York"
    assert c1["tier"] == "standard" and c1["days_since_signup"] == 30
    assert out["C2"]["full_name"] is None


def _model(spark):
    s = staging.stg_sales(sales(spark, [
        {"sale_id": "S1", "customer_id": "C1", "product_id": "P1", "order_date": D(2024, 1, 5),
         "total_amount": 100, "quantity": 2},
        {"sale_id": "S2", "customer_id": "C9", "product_id": "P9", "order_date": D(2024, 1, 6),
         "total_amount": 100, "territory_id": "T9"},
        {"sale_id": "S3", "customer_id": "C1", "product_id": "P0", "order_date": D(2024, 1, 7),
         "total_amount": 100},
    ]))
    c = staging.stg_customers(customers(spark, [{"customer_id": "C1", "email": "e", "tier": "Gold"}]), AS_OF)
    p = staging.stg_products(products(spark, [
        {"product_id": "P1", "category": "A", "cost_price": 30},
        {"product_id": "P0", "category": "B", "cost_price": 0}]))
    t = staging.stg_territories(territories(spark, [{"territory_id": "T1", "territory_name": "North",
                                                      "region": "EU", "country": "DE"}]))
    return s, c, p, t


def test_fct_sales_left_joins_and_margin(spark):
    s, c, p, t = _model(spark)
    f = marts.fct_sales(s, c, p, t)
    rows = {r["sale_id"]: r for r in f.collect()}
    assert len(rows) == s.count() == 3                  # no sale lost, no fan-out
    r1 = rows["S1"]
    assert r1["total_cost"] == Decimal("60.0000") and r1["gross_profit"] == Decimal("40.0000")
    assert r1["gross_margin_pct"] == Decimal("40.00")
    assert r1["customer_tier"] == "gold" and r1["territory_region"] == "EU"
    r2 = rows["S2"]                                     # unmatched product / customer / territory
    assert r2["total_cost"] is None and r2["gross_profit"] is None and r2["gross_margin_pct"] is None
    assert r2["customer_tier"] is None and r2["territory_name"] is None
    assert rows["S3"]["gross_margin_pct"] is None      # cost 0 -> no margin


def _perf_input(spark):
    rows = []
    months = [D(2023, 1, 1), D(2023, 2, 1), D(2023, 4, 1), D(2024, 1, 1), D(2024, 2, 1)]
    for i, m in enumerate(months):
        rows.append({"sale_id": f"S{i}", "customer_id": "C1", "product_id": "P1", "order_date": m,
                     "total_amount": 100 * (i + 1), "channel": "online"})
    rows.append({"sale_id": "X1", "customer_id": "C1", "product_id": "P1", "order_date": D(2023, 2, 5),
                 "total_amount": 50, "channel": "direct"})
    s = staging.stg_sales(sales(spark, rows))
    _, c, p, t = _model(spark)
    return marts.fct_sales(s, c, p, t)


def test_performance_calendar_mode_exact_months(spark):
    f = _perf_input(spark)
    out = {(r["period_date"], r["channel"]): r for r in marts.fct_sales_performance(f, "calendar").collect()}
    assert out[(D(2023, 1, 1), "online")]["revenue_mom_growth"] is None
    assert out[(D(2023, 2, 1), "online")]["revenue_mom_growth"] == 200 / 100 - 1
    assert out[(D(2023, 4, 1), "online")]["revenue_mom_growth"] is None   # March missing
    assert out[(D(2024, 1, 1), "online")]["revenue_yoy_growth"] == 400 / 100 - 1
    assert out[(D(2024, 2, 1), "online")]["revenue_yoy_growth"] == 500 / 200 - 1
    assert out[(D(2023, 2, 1), "direct")]["revenue_mom_growth"] is None


def test_performance_row_mode_literal_lag(spark):
    f = _perf_input(spark)
    out = {(r["period_date"], r["channel"]): r for r in marts.fct_sales_performance(f, "row").collect()}
    # Feb 2023 has two rows; ordered by (month, channel): direct then online.
    assert out[(D(2023, 2, 1), "direct")]["revenue_mom_growth"] == 50 / 100 - 1
    assert out[(D(2023, 2, 1), "online")]["revenue_mom_growth"] == 200 / 50 - 1
    assert out[(D(2023, 4, 1), "online")]["revenue_mom_growth"] == 300 / 200 - 1
    assert all(r["revenue_yoy_growth"] is None for r in out.values())   # only 6 rows


def test_views_add_semantic_columns(spark):
    s, c, p, t = _model(spark)
    v = marts.vw_sales_fact(marts.fct_sales(s, c, p, t))
    for col in ("gross_profit", "gross_margin_pct", "discount_amount", "territory_region",
                "order_month_date"):
        assert col in v.columns
    r = v.filter("sale_id = 'S1'").first()
    assert r["order_month"] == 1 and r["order_quarter"] == 1 and r["days_to_ship"] is None


def test_fct_sales_large_dimension_path(spark):
    """Dimensions over the broadcast bound take the salted shuffle join; the
    fact is the same."""
    s, c, p, t = _model(spark)
    small = marts.fct_sales(s, c, p, t, dim_row_bounds={"customers": 1, "products": 2, "territories": 1})
    spark.conf.set("ledgerlens.broadcast.maxBytes", "0")
    try:
        large = marts.fct_sales(s, c, p, t, dim_row_bounds={"customers": 10**9, "products": 10**9,
                                                            "territories": 1})
        cols = [x for x in small.columns if x not in ("_updated_at", "_transformed_at")]
        assert large.select(*cols).exceptAll(small.select(*cols)).count() == 0
        assert large.count() == small.count()
    finally:
        spark.conf.unset("ledgerlens.broadcast.maxBytes")
