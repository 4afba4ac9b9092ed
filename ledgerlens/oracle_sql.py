"""Reference SQL (DuckDB dialect) for every registered query.

Each string is self-contained: it rebuilds the RAW tables from the driver's
star tables, applies the Silver/Gold model logic in plain SQL, and selects
the same columns, names and types as the Spark query.  Conventions shared
with the Spark side: money is summed as DECIMAL and cast to DOUBLE last;
averages are ``CAST(sum AS DOUBLE) / count``; ratios divide DOUBLEs; counts
and years are BIGINT; null ordering is written out.
"""

from __future__ import annotations

AS_OF_SQL = "DATE '2001-12-31'"


def pct_sql(num: str, den: str) -> str:
    """Exact ROUND(num * 100 / den, 2), half away from zero, for scale-4
    decimals, via integer arithmetic (DuckDB divides decimals as doubles)."""
    n = f"CAST(({num}) * 10000 AS HUGEINT)"
    d = f"CAST(({den}) * 10000 AS HUGEINT)"
    return (f"(CASE WHEN ({den}) = 0 THEN NULL ELSE "
            f"CAST(sign({n}) * sign({d}) * ((2 * abs({n}) * 10000 + abs({d})) // (2 * abs({d})))"
            f" AS DECIMAL(38,0)) * 0.01 END)")


def round_div_sql(num: str, den: str, digits: int = 2) -> str:
    """Exact ROUND(num / den, digits), half away from zero, where num is a
    scale-4 decimal and den an integer."""
    n = f"CAST(({num}) * 10000 AS HUGEINT)"
    d = f"(CAST({10 ** (4 - digits)} AS HUGEINT) * ({den}))"
    return (f"(CASE WHEN ({den}) = 0 THEN NULL ELSE "
            f"CAST(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})) AS DECIMAL(38,0))"
            f" * {10.0 ** -digits:.{digits}f} END)")


RAW_SALES = """
raw_sales AS (
  SELECT
    concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR),
              CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR),
              CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR))        AS sale_id,
    CAST(o.o_custkey AS VARCHAR)                                  AS customer_id,
    CAST(l.l_partkey AS VARCHAR)                                  AS product_id,
    CAST(c.c_nationkey AS VARCHAR)                                AS territory_id,
    CAST(l.l_suppkey AS VARCHAR)                                  AS salesperson_id,
    CAST(o.o_orderdate AS DATE)                                   AS order_date,
    CAST(l.l_shipdate AS DATE)                                    AS ship_date,
    CAST(l.l_quantity AS BIGINT)                                  AS quantity,
    CAST(l.l_discount AS DECIMAL(5,4))                            AS discount_pct,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,4)) *
         (CASE o.o_custkey % 3 WHEN 0 THEN 0.01 WHEN 1 THEN 0.05 ELSE 1.00 END)
         AS DECIMAL(18,4))                                        AS total_amount,
    'USD'                                                         AS currency,
    CASE o.o_orderpriority WHEN '1-URGENT' THEN 'direct' WHEN '2-HIGH' THEN 'partner'
         WHEN '3-MEDIUM' THEN 'online' WHEN '4-NOT SPECIFIED' THEN 'reseller'
         WHEN '5-LOW' THEN 'online' END                           AS channel,
    CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN 'cancelled'
         WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'returned'
         WHEN o.o_orderstatus = 'F' THEN 'completed'
         WHEN o.o_orderstatus = 'O' THEN 'pending'
         WHEN o.o_orderstatus = 'P' THEN 'shipped' END            AS status,
    CAST(CAST(o.o_orderdate AS DATE) AS TIMESTAMP)                AS _ingested_at
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
)"""

# Amounts are positive here, so a row's tier is the number of lower bounds that it reaches.
STG_SALES = """
stg_sales AS (
  SELECT sale_id, customer_id, product_id, territory_id, salesperson_id, order_date, ship_date, quantity,
    ifnull(discount_pct, 0) AS discount_pct, total_amount, upper(ifnull(currency, 'USD')) AS currency,
    lower(trim(channel)) AS channel, lower(trim(status)) AS status, _ingested_at,
    ROUND(total_amount - total_amount * ifnull(discount_pct, 0), 4) AS net_revenue,
    ROUND(total_amount * ifnull(discount_pct, 0), 4) AS discount_amount,
    ifnull(ship_date - order_date, 3) AS days_to_ship,
    (['micro', 'smb', 'mid_market', 'enterprise'])[
      1 + (total_amount >= 100)::INT + (total_amount >= 1000)::INT + (total_amount >= 10000)::INT] AS deal_size_tier,
    make_date(year(order_date), month(order_date), 1) AS order_month,
    make_date(year(order_date), 3 * quarter(order_date) - 2, 1) AS order_quarter,
    year(order_date)::BIGINT AS order_year
  FROM raw_sales
  WHERE least(quantity, total_amount) > 0 AND (sale_id || customer_id || product_id) IS NOT NULL AND order_date IS NOT NULL
)"""

STG_CUSTOMERS = """
stg_customers AS (
  SELECT *, first_name || ' ' || last_name AS full_name FROM (
  SELECT
    CAST(c.c_custkey AS VARCHAR)                                  AS customer_id,
    upper(lower(split_part(c.c_name, '#', 1))[1]) || lower(lower(split_part(c.c_name, '#', 1))[2:])
                                                                  AS first_name,
    upper(split_part(c.c_name, '#', 2)[1]) || lower(split_part(c.c_name, '#', 2)[2:])
                                                                  AS last_name,
    lower(c.c_name) || '@example.com'                             AS email,
    regexp_replace('+1 (' || CAST(c.c_nationkey + 100 AS VARCHAR) || ') ' ||
                   CAST(c.c_custkey AS VARCHAR), '[^0-9+]', '', 'g') AS phone,
    c.c_name                                                      AS company,
    lower(trim(c.c_mktsegment))                                   AS industry,
    upper(trim(n.n_name))                                         AS country,
    trim(r.r_name)                                                AS region,
    upper(lower(n.n_name)[1]) || lower(lower(n.n_name)[2:])       AS city,
    lower(COALESCE(c.c_mktsegment, 'standard'))                   AS tier,
    DATE '1994-01-01' + CAST(c.c_custkey % 365 AS INTEGER)        AS signup_date,
    date_diff('day', DATE '1994-01-01' + CAST(c.c_custkey % 365 AS INTEGER), DATE '2001-12-31')
                                                                  AS days_since_signup
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  ) cc
)"""

STG_PRODUCTS = """
stg_products AS (
  SELECT
    CAST(p_partkey AS VARCHAR)                                    AS product_id,
    trim(p_name)                                                  AS product_name,
    trim(p_type)                                                  AS category,
    trim(string_split(p_name, ' ')[2])                            AS subcategory,
    trim(p_brand)                                                 AS brand,
    CAST(CAST(p_retailprice AS DECIMAL(18,4)) * 0.6 AS DECIMAL(18,4)) AS cost_price,
    CAST(p_retailprice AS DECIMAL(18,4))                          AS list_price
  FROM part
)"""

STG_TERRITORIES = """
stg_territories AS (
  SELECT
    CAST(n.n_nationkey AS VARCHAR)                                AS territory_id,
    trim(n.n_name)                                                AS territory_name,
    trim(r.r_name)                                                AS region,
    trim(n.n_name)                                                AS country
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

FCT_SALES = f"""
fct_sales AS (
  SELECT s.*,
    c.tier AS customer_tier, c.country AS customer_country, c.region AS customer_region,
    c.industry AS customer_industry,
    p.category AS product_category, p.subcategory AS product_subcategory,
    p.brand AS product_brand, p.cost_price,
    ROUND(s.quantity * p.cost_price, 4)                           AS total_cost,
    ROUND(s.net_revenue - s.quantity * p.cost_price, 4)           AS gross_profit,
    CASE WHEN p.cost_price > 0 THEN
      {pct_sql("s.net_revenue - s.quantity * p.cost_price", "s.net_revenue")} END
                                                                  AS gross_margin_pct,
    t.territory_name, t.region AS territory_region, t.country AS territory_country
  FROM stg_sales s
  LEFT JOIN stg_customers c ON s.customer_id = c.customer_id
  LEFT JOIN stg_products p ON s.product_id = p.product_id
  LEFT JOIN stg_territories t ON s.territory_id = t.territory_id
)"""

BASE_CTES = [RAW_SALES, STG_SALES, STG_CUSTOMERS, STG_PRODUCTS, STG_TERRITORIES, FCT_SALES]


def with_base(*extra_ctes: str, body: str) -> str:
    """WITH <base CTEs>, <extra CTEs> <body>."""
    ctes = ",".join(BASE_CTES + list(extra_ctes))
    return f"WITH {ctes}\n{body}"


MONTHLY = """
monthly AS (
  SELECT order_month AS period_date, 'month' AS period_type, territory_id, territory_name,
    territory_region, product_category, channel, customer_tier,
    count(sale_id)                                                AS order_count,
    count(DISTINCT customer_id)                                   AS unique_customers,
    count(DISTINCT product_id)                                    AS unique_products,
    sum(quantity)                                                 AS total_units,
    sum(net_revenue)                                              AS total_revenue,
    sum(gross_profit)                                             AS total_gross_profit,
    sum(discount_amount)                                          AS total_discounts,
    CAST(sum(net_revenue) AS DOUBLE) / NULLIF(count(net_revenue), 0) AS avg_order_value,
    CAST(sum(gross_margin_pct) AS DOUBLE) / NULLIF(count(gross_margin_pct), 0) AS avg_margin_pct,
    CAST(sum(days_to_ship) AS DOUBLE) / NULLIF(count(days_to_ship), 0) AS avg_days_to_ship
  FROM fct_sales WHERE status != 'cancelled'
  GROUP BY ALL
)"""

MONTHLY_COLS = """period_date, period_type, territory_id, territory_name, territory_region,
  product_category, channel, customer_tier, order_count, unique_customers, unique_products,
  CAST(total_units AS BIGINT) AS total_units, CAST(total_revenue AS DOUBLE) AS total_revenue,
  CAST(total_gross_profit AS DOUBLE) AS total_gross_profit,
  CAST(total_discounts AS DOUBLE) AS total_discounts, avg_order_value, avg_margin_pct,
  avg_days_to_ship"""


def _q_monthly_revenue() -> str:
    return with_base(MONTHLY, body=f"SELECT {MONTHLY_COLS} FROM monthly")


def _perf(mode: str) -> str:
    if mode == "row":
        win = ("PARTITION BY territory_id, product_category ORDER BY period_date NULLS FIRST, "
               "channel NULLS FIRST, customer_tier NULLS FIRST, territory_name NULLS FIRST, "
               "territory_region NULLS FIRST")
        prev1 = f"LAG(total_revenue, 1) OVER ({win})"
        prev12 = f"LAG(total_revenue, 12) OVER ({win})"
    else:
        part = ("PARTITION BY period_type, territory_id, territory_name, territory_region, "
                "product_category, channel, customer_tier ORDER BY year(period_date) * 12 + month(period_date)")
        prev1 = f"max(total_revenue) OVER ({part} RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING)"
        prev12 = f"max(total_revenue) OVER ({part} RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING)"
    perf = f"""
perf AS (SELECT *, {prev1} AS p1, {prev12} AS p12 FROM monthly)"""
    return with_base(MONTHLY, perf, body=f"""SELECT {MONTHLY_COLS},
  CAST(total_revenue AS DOUBLE) / NULLIF(CAST(p1 AS DOUBLE), 0) - 1 AS revenue_mom_growth,
  CAST(total_revenue AS DOUBLE) / NULLIF(CAST(p12 AS DOUBLE), 0) - 1 AS revenue_yoy_growth
FROM perf""")


# Customer statistics (survey 2.10) over the sales that count.
SALES_STATS = f"""
sales_stats AS (
  SELECT customer_id, orders AS total_orders, revenue AS lifetime_value,
    {round_div_sql("revenue", "orders")} AS avg_order_value, span[1] AS first_order_date, span[2] AS last_order_date,
    {AS_OF_SQL} - span[2] AS days_since_last_order, products AS unique_products_bought, profit AS total_gross_profit
  FROM (SELECT customer_id, count(*) AS orders, sum(net_revenue) AS revenue, sum(gross_profit) AS profit,
               [min(order_date), max(order_date)] AS span, len(list_distinct(list(product_id))) AS products
        FROM fct_sales WHERE status IS DISTINCT FROM 'cancelled' GROUP BY customer_id)
)"""

# A bucket of five by position: the first n % 5 buckets have one row more.
RFM = """
rfm AS (
  SELECT customer_id,
    CASE WHEN a < (n % 5) * (n // 5 + 1) THEN a // (n // 5 + 1) ELSE (a - n % 5) // greatest(n // 5, 1) END + 1 AS recency_score,
    CASE WHEN b < (n % 5) * (n // 5 + 1) THEN b // (n // 5 + 1) ELSE (b - n % 5) // greatest(n // 5, 1) END + 1 AS frequency_score,
    CASE WHEN c < (n % 5) * (n // 5 + 1) THEN c // (n // 5 + 1) ELSE (c - n % 5) // greatest(n // 5, 1) END + 1 AS monetary_score
  FROM (SELECT customer_id, count(*) OVER () AS n,
               row_number() OVER (ORDER BY last_order_date NULLS FIRST, customer_id) - 1 AS a,
               row_number() OVER (ORDER BY total_orders, customer_id) - 1 AS b,
               row_number() OVER (ORDER BY lifetime_value NULLS FIRST, customer_id) - 1 AS c
        FROM sales_stats)
)"""

# The rules of the segments in order: least and greatest score of recency, frequency and money.
SEGMENT_RULES = """(VALUES (1, 'Champions', 4, 5, 4, 5, 4, 5), (2, 'Loyal Customers', 3, 5, 1, 5, 3, 5),
  (3, 'Recent Customers', 4, 5, 1, 5, 1, 5), (4, 'Potential Loyalists', 1, 5, 4, 5, 1, 5), (5, 'At Risk', 1, 2, 1, 5, 4, 5),
  (6, 'Lost', 1, 1, 1, 1, 1, 5), (7, 'Needs Attention', 1, 5, 1, 5, 1, 5)) AS rules(no, label, r0, r1, f0, f1, m0, m1)"""

DIM_CUSTOMERS = f"""
profiles AS (
  SELECT c.*, ifnull(total_orders, 0) AS total_orders, ifnull(lifetime_value, 0) AS lifetime_value,
    ifnull(avg_order_value, 0) AS avg_order_value, first_order_date, last_order_date,
    ifnull(days_since_last_order, 9999) AS days_since_last_order, ifnull(unique_products_bought, 0) AS unique_products_bought,
    ifnull(total_gross_profit, 0) AS total_gross_profit, ifnull(recency_score, 1) AS recency_score,
    ifnull(frequency_score, 1) AS frequency_score, ifnull(monetary_score, 1) AS monetary_score
  FROM stg_customers c LEFT JOIN (sales_stats JOIN rfm USING (customer_id)) USING (customer_id)
),
segments AS (
  SELECT customer_id, arg_min(label, no) AS customer_segment FROM profiles JOIN {SEGMENT_RULES}
    ON recency_score BETWEEN r0 AND r1 AND frequency_score BETWEEN f0 AND f1 AND monetary_score BETWEEN m0 AND m1
  GROUP BY customer_id
),
dim_customers AS (
  SELECT profiles.*, recency_score + frequency_score + monetary_score AS rfm_total, customer_segment,
    (['Bronze', 'Silver', 'Gold', 'Platinum'])[1 + (lifetime_value >= 5000)::INT + (lifetime_value >= 25000)::INT
      + (lifetime_value >= 100000)::INT] AS lifetime_tier, total_orders > 0 AS is_active
  FROM profiles JOIN segments USING (customer_id)
)"""

DIM_CUSTOMER_COLS = """customer_id, first_name, last_name, full_name, email, phone, company, industry,
  country, region, city, tier, signup_date, days_since_signup, total_orders,
  CAST(lifetime_value AS DOUBLE) AS lifetime_value, CAST(avg_order_value AS DOUBLE) AS avg_order_value,
  first_order_date, last_order_date, days_since_last_order, unique_products_bought,
  CAST(total_gross_profit AS DOUBLE) AS total_gross_profit, recency_score, frequency_score,
  monetary_score, rfm_total, customer_segment, lifetime_tier, is_active"""

RFM_QUANTILE = f"""
q_stats AS (
  SELECT customer_id, count(sale_id) AS total_orders, sum(net_revenue) AS lifetime_value,
    max(order_date) AS last_order, date_diff('day', max(order_date), {AS_OF_SQL}) AS days_since
  FROM fct_sales WHERE status != 'cancelled' GROUP BY customer_id
),
q_edges AS (
  SELECT quantile_cont(total_orders, [0.2, 0.4, 0.6, 0.8]) AS fo,
         quantile_cont(lifetime_value, [0.2, 0.4, 0.6, 0.8]) AS mo
  FROM q_stats
),
q_scored AS (
  SELECT s.*,
    CAST(CASE WHEN total_orders <= fo[1] THEN 1 WHEN total_orders <= fo[2] THEN 2
         WHEN total_orders <= fo[3] THEN 3 WHEN total_orders <= fo[4] THEN 4 ELSE 5 END AS BIGINT)
      AS total_orders_score,
    CAST(CASE WHEN lifetime_value <= mo[1] THEN 1 WHEN lifetime_value <= mo[2] THEN 2
         WHEN lifetime_value <= mo[3] THEN 3 WHEN lifetime_value <= mo[4] THEN 4 ELSE 5 END AS BIGINT)
      AS lifetime_value_score
  FROM q_stats s CROSS JOIN q_edges
),
rfm_q AS (
  SELECT *, total_orders_score + lifetime_value_score AS rfm_score,
    CASE WHEN total_orders_score + lifetime_value_score <= 0 THEN NULL
         WHEN total_orders_score + lifetime_value_score <= 4 THEN 'At Risk'
         WHEN total_orders_score + lifetime_value_score <= 6 THEN 'Needs Attention'
         WHEN total_orders_score + lifetime_value_score <= 8 THEN 'Loyal Customers'
         WHEN total_orders_score + lifetime_value_score <= 10 THEN 'Champions' END AS segment
  FROM q_scored
)"""


def oracle_sql() -> dict[str, str]:
    return {**_model_oracles(), **measure_oracles(), **more_oracles(), **extra_oracles(), **load_oracles()}


def _model_oracles() -> dict[str, str]:
    return {
        "monthly_revenue": _q_monthly_revenue(),
        "sales_performance_row": _perf("row"),
        "sales_performance_calendar": _perf("calendar"),
        "dim_customers": with_base(SALES_STATS, RFM, DIM_CUSTOMERS,
                                   body=f"SELECT {DIM_CUSTOMER_COLS} FROM dim_customers"),
        "rfm_quantile": with_base(RFM_QUANTILE, body="""SELECT customer_id, total_orders,
  CAST(lifetime_value AS DOUBLE) AS lifetime_value, last_order, days_since, total_orders_score,
  lifetime_value_score, rfm_score, segment FROM rfm_q"""),
        "segment_counts": with_base(RFM_QUANTILE, body="""SELECT segment, count(*) AS count
FROM rfm_q GROUP BY segment"""),
        "customer_segments": with_base(SALES_STATS, RFM, DIM_CUSTOMERS, body="""SELECT
  customer_segment, lifetime_tier, count(*) AS customers,
  CAST(sum(lifetime_value) AS DOUBLE) AS lifetime_value
FROM dim_customers GROUP BY customer_segment, lifetime_tier"""),
    }


# ---- semantic layer and measures -----------------------------------------------------

def div_sql(n: str, d: str, alt: str = "NULL") -> str:
    """DIVIDE(n, d, alt) with double division."""
    return (f"(CASE WHEN ({d}) IS NULL OR ({d}) = 0 THEN CAST({alt} AS DOUBLE) "
            f"ELSE CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END)")


def diff0_sql(a: str, b: str) -> str:
    return f"(CASE WHEN ({a}) IS NULL AND ({b}) IS NULL THEN NULL ELSE COALESCE({a}, 0) - COALESCE({b}, 0) END)"


VW_SALES = """
vw AS (
  SELECT sale_id, customer_id, product_id, territory_id, salesperson_id, order_date, ship_date,
    date_diff('day', order_date, ship_date) AS days_to_ship, quantity, discount_pct, total_amount,
    total_amount * (1 - discount_pct) AS net_revenue, currency, channel, status,
    CAST(year(order_date) AS BIGINT) AS order_year, CAST(month(order_date) AS BIGINT) AS order_month,
    CAST(quarter(order_date) AS BIGINT) AS order_quarter,
    CAST(date_trunc('month', order_date) AS DATE) AS order_month_date,
    gross_profit, gross_margin_pct, discount_amount, territory_region, territory_name, product_category
  FROM fct_sales
)"""

BUDGET = """
budget AS (
  SELECT s.territory_id, p.category AS product_category,
    make_date(CAST(year(s.order_month) + 1 AS INTEGER), CAST(month(s.order_month) AS INTEGER), 1) AS period_date,
    CAST(ROUND(sum(s.net_revenue) * 1.1, 2) AS DECIMAL(18,2)) AS budget_amount,
    CAST(year(s.order_month) + 1 AS BIGINT) AS fiscal_year, CAST(month(s.order_month) AS BIGINT) AS fiscal_month
  FROM stg_sales s JOIN stg_products p ON s.product_id = p.product_id
  WHERE s.status != 'cancelled' AND s.territory_id IS NOT NULL AND p.category IS NOT NULL
  GROUP BY s.territory_id, p.category, year(s.order_month), month(s.order_month)
)"""


def _growth_sql(cur: str, prev: str) -> str:
    return div_sql(diff0_sql(cur, prev), f"abs({prev})")


def _q_base_measures() -> str:
    return with_base(VW_SALES, body=f"""SELECT territory_region, order_year,
  CAST(sum(net_revenue) AS DOUBLE) AS total_revenue,
  CAST(sum(gross_profit) AS DOUBLE) AS total_gross_profit,
  count(*) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
  {div_sql("sum(net_revenue)", "count(*)", "0")} AS avg_order_value,
  {div_sql("sum(gross_profit)", "sum(net_revenue)", "0")} AS gross_margin_pct,
  CAST(sum(discount_amount) AS DOUBLE) AS total_discounts,
  {div_sql("sum(discount_amount)", "sum(total_amount)", "0")} AS discount_rate_pct,
  count(DISTINCT customer_id) AS total_customers,
  {div_sql("sum(net_revenue)", "count(DISTINCT customer_id)", "0")} AS revenue_per_customer,
  count(DISTINCT product_id) AS products_sold
FROM vw GROUP BY territory_region, order_year""")


def _q_period_to_date() -> str:
    run = "ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return with_base(VW_SALES, """
sold AS (SELECT territory_region, order_date AS period, sum(net_revenue) AS revenue FROM vw
      GROUP BY territory_region, order_date)""", """
days AS (SELECT territory_region, CAST(unnest(generate_series(lo, (SELECT max(period) FROM sold), INTERVAL 1 DAY)) AS DATE)
         AS period FROM (SELECT territory_region, min(period) AS lo FROM sold GROUP BY territory_region))""", """
s AS (SELECT d.territory_region, d.period, sold.revenue FROM days d LEFT JOIN sold
      ON d.territory_region IS NOT DISTINCT FROM sold.territory_region AND d.period = sold.period)""", body=f"""SELECT territory_region, period,
  CAST(revenue AS DOUBLE) AS revenue,
  CAST(sum(revenue) OVER (PARTITION BY territory_region, date_trunc('month', period) {run}) AS DOUBLE) AS revenue_mtd,
  CAST(sum(revenue) OVER (PARTITION BY territory_region, date_trunc('quarter', period) {run}) AS DOUBLE) AS revenue_qtd,
  CAST(sum(revenue) OVER (PARTITION BY territory_region, date_trunc('year', period) {run}) AS DOUBLE) AS revenue_ytd
FROM s""")


def _dense_sql(key: str, grain: str, source: str = "vw") -> list[str]:
    step = {"month": "INTERVAL 1 MONTH", "year": "INTERVAL 1 YEAR"}[grain]
    return [f"""
s AS (SELECT {key}, CAST(date_trunc('{grain}', order_date) AS DATE) AS period,
      sum(net_revenue) AS revenue FROM {source} GROUP BY ALL)""", f"""
b AS (SELECT {key}, min(period) AS lo, (SELECT max(period) FROM s) AS hi FROM s GROUP BY {key})""", f"""
g AS (SELECT {key}, CAST(unnest(generate_series(lo, hi, {step})) AS DATE) AS period FROM b)""", f"""
d AS (SELECT g.{key}, g.period, s.revenue FROM g LEFT JOIN s
      ON g.{key} IS NOT DISTINCT FROM s.{key} AND g.period = s.period)"""]


def _q_time_intelligence(key: str, grain: str, abs_den: bool = True, cumulative: str = "all") -> str:
    per_year = 12 if grain == "month" else 1
    run = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    mom = f"LAG(revenue, 1) OVER (PARTITION BY {key} ORDER BY period)" if grain == "month" else "NULL"
    ctes = _dense_sql(key, grain) + [f"""
y AS (SELECT *, sum(revenue) OVER (PARTITION BY {key}, date_trunc('year', period) ORDER BY period {run})
      AS revenue_ytd FROM d)""", f"""
t AS (SELECT *,
      LAG(revenue_ytd, {per_year}) OVER (PARTITION BY {key} ORDER BY period) AS revenue_pytd,
      {mom} AS pm,
      LAG(revenue, {per_year}) OVER (PARTITION BY {key} ORDER BY period) AS py,
      sum(revenue) OVER (PARTITION BY {key} ORDER BY period {run}) AS cumulative_revenue
      FROM y)"""]
    growth = _growth_sql if abs_den else (lambda c, p: div_sql(diff0_sql(c, p), p))
    cum = "cumulative_revenue" if cumulative == "all" else "revenue_ytd"
    return with_base(VW_SALES, *ctes, body=f"""SELECT {key}, period, CAST(revenue AS DOUBLE) AS revenue,
  CAST(revenue_ytd AS DOUBLE) AS revenue_ytd, CAST(revenue_pytd AS DOUBLE) AS revenue_pytd,
  {growth("revenue", "pm")} AS revenue_mom_growth,
  {growth("revenue", "py")} AS revenue_yoy_growth,
  CAST({cum} AS DOUBLE) AS cumulative_revenue
FROM t""")


def _q_customer_activity() -> str:
    return with_base(VW_SALES, SALES_STATS, RFM, DIM_CUSTOMERS, """
ca AS (
  SELECT v.territory_region, CAST(date_trunc('month', v.order_date) AS DATE) AS period,
    count(DISTINCT v.customer_id) AS total_customers,
    count(DISTINCT CASE WHEN d.first_order_date >= CAST(date_trunc('month', v.order_date) AS DATE)
                         AND d.first_order_date <= last_day(v.order_date) THEN v.customer_id END)
      AS new_customers,
    sum(v.net_revenue) AS revenue
  FROM vw v LEFT JOIN dim_customers d ON v.customer_id = d.customer_id
  GROUP BY ALL
)""", body=f"""SELECT territory_region, period, total_customers, new_customers,
  total_customers - new_customers AS returning_customers,
  {div_sql("total_customers - new_customers", "total_customers", "0")} AS customer_retention_rate,
  {div_sql("revenue", "total_customers", "0")} AS revenue_per_customer
FROM ca""")


def _q_budget_attainment() -> str:
    att = div_sql("actual_revenue", "budget_amount")
    return with_base(VW_SALES, BUDGET, """
a AS (SELECT territory_id, CAST(date_trunc('month', order_date) AS DATE) AS period,
      sum(net_revenue) AS actual_revenue FROM vw GROUP BY ALL)""", """
bb AS (SELECT territory_id, CAST(date_trunc('month', period_date) AS DATE) AS period,
       sum(budget_amount) AS budget_amount FROM budget GROUP BY ALL)""", """
j AS (SELECT COALESCE(a.territory_id, bb.territory_id) AS territory_id,
        COALESCE(a.period, bb.period) AS period, a.actual_revenue, bb.budget_amount
      FROM a FULL JOIN bb ON a.territory_id IS NOT DISTINCT FROM bb.territory_id AND a.period = bb.period)""",
                     body=f"""SELECT territory_id, period, CAST(actual_revenue AS DOUBLE) AS actual_revenue,
  CAST(budget_amount AS DOUBLE) AS budget_amount,
  {div_sql(diff0_sql("actual_revenue", "budget_amount"), "budget_amount")} AS revenue_vs_budget,
  {att} AS revenue_target_attainment,
  CASE WHEN {att} >= 1.0 THEN 'On Track' WHEN {att} >= 0.85 THEN 'At Risk' ELSE 'Behind' END AS kpi_status
FROM j""")


PRODUCT_REV = """
pr AS (SELECT territory_region, product_id, sum(net_revenue) AS product_revenue FROM vw GROUP BY ALL)"""


def _q_top_products() -> str:
    return with_base(VW_SALES, PRODUCT_REV, body="""SELECT territory_region,
  CAST(max(product_revenue) AS DOUBLE) AS top_product_revenue FROM pr GROUP BY territory_region""")


def _q_top_products_ties() -> str:
    return with_base(VW_SALES, PRODUCT_REV, body="""SELECT territory_region, product_id,
  CAST(product_revenue AS DOUBLE) AS product_revenue, revenue_rank FROM (
  SELECT *, rank() OVER (PARTITION BY territory_region ORDER BY product_revenue DESC NULLS LAST)
    AS revenue_rank FROM pr) WHERE revenue_rank <= 3""")


def _q_customer_measures() -> str:
    return with_base(SALES_STATS, RFM, DIM_CUSTOMERS, body=f"""SELECT country,
  count(*) AS customer_count,
  {div_sql("count_if(customer_segment = 'Champions')", "count(*)", "0")} AS champions_pct,
  CAST(count_if(customer_segment = 'At Risk') AS BIGINT) AS at_risk_customers
FROM dim_customers GROUP BY country""")


def _q_kpi_summary() -> str:
    return with_base(RFM_QUANTILE, """
done AS (SELECT * FROM fct_sales WHERE status != 'cancelled')""", f"""
tot AS (SELECT CAST(sum(net_revenue) AS DOUBLE) AS total_revenue, count(*) AS total_orders,
  count(DISTINCT customer_id) AS unique_customers,
  {div_sql("sum(net_revenue)", "count(net_revenue)")} AS avg_order_value,
  {div_sql("sum(gross_profit)", "sum(net_revenue)", "0")} AS gross_margin_pct FROM done)""", """
mon AS (SELECT order_month AS period, sum(net_revenue) AS revenue FROM done GROUP BY order_month)""", """
last AS (SELECT m.revenue AS cur,
  (SELECT p.revenue FROM mon p WHERE p.period = m.period - INTERVAL 1 MONTH) AS pm,
  (SELECT p.revenue FROM mon p WHERE p.period = m.period - INTERVAL 12 MONTH) AS py
  FROM mon m WHERE m.period = (SELECT max(period) FROM mon))""", f"""
ch AS (SELECT {div_sql("count_if(segment = 'Champions')", "count(*)", "0")} AS champions_pct FROM rfm_q)""",
                     body=f"""SELECT tot.*, ch.champions_pct,
  {_growth_sql("last.cur", "last.pm")} AS revenue_mom_growth,
  {_growth_sql("last.cur", "last.py")} AS revenue_yoy_growth
FROM tot CROSS JOIN ch CROSS JOIN last""")


def measure_oracles() -> dict[str, str]:
    return {
        "base_measures": _q_base_measures(),
        "period_to_date": _q_period_to_date(),
        "time_intelligence_month": _q_time_intelligence("territory_region", "month"),
        "time_intelligence_year": _q_time_intelligence("product_category", "year"),
        "new_returning": _q_customer_activity(),
        "budget_attainment": _q_budget_attainment(),
        "top_products": _q_top_products(),
        "top_products_ties": _q_top_products_ties(),
        "customer_measures": _q_customer_measures(),
        "kpi_summary": _q_kpi_summary(),
    }


# ---- Silver / Gold tables, views, calendar, quality, incremental, single operators ----

STG_SALES_COLS = """sale_id, customer_id, product_id, territory_id, salesperson_id, order_date, ship_date,
  quantity, CAST(discount_pct AS DOUBLE) AS discount_pct, CAST(total_amount AS DOUBLE) AS total_amount,
  currency, channel, status, CAST(net_revenue AS DOUBLE) AS net_revenue,
  CAST(discount_amount AS DOUBLE) AS discount_amount, days_to_ship, deal_size_tier, order_month,
  order_quarter, order_year"""

FCT_COLS = STG_SALES_COLS + """, customer_tier, customer_country, customer_region, customer_industry,
  product_category, product_subcategory, product_brand, CAST(total_cost AS DOUBLE) AS total_cost,
  CAST(gross_profit AS DOUBLE) AS gross_profit, CAST(gross_margin_pct AS DOUBLE) AS gross_margin_pct,
  territory_name, territory_region, territory_country"""

VW_COLS = """sale_id, customer_id, product_id, territory_id, salesperson_id, order_date, ship_date,
  days_to_ship, quantity, CAST(discount_pct AS DOUBLE) AS discount_pct,
  CAST(total_amount AS DOUBLE) AS total_amount, CAST(net_revenue AS DOUBLE) AS net_revenue, currency,
  channel, status, order_year, order_month, order_quarter, order_month_date,
  CAST(gross_profit AS DOUBLE) AS gross_profit, CAST(gross_margin_pct AS DOUBLE) AS gross_margin_pct,
  CAST(discount_amount AS DOUBLE) AS discount_amount, territory_region, territory_name, product_category"""

DIM_PARTS = (SALES_STATS, RFM, DIM_CUSTOMERS)


def _quality_sql() -> str:
    def row(check, table, col, failed, total):
        return (f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", '{col}' AS \"column\", "
                f"CAST({failed} AS BIGINT) AS failed_rows, CAST({total} AS BIGINT) AS total_rows FROM {table}")

    def uniq(table, col):
        return (f"SELECT 'unique' AS \"check\", '{table}' AS \"table\", '{col}' AS \"column\", "
                f"CAST(count_if(n > 1) AS BIGINT) AS failed_rows, CAST(COALESCE(sum(n), 0) AS BIGINT) AS total_rows "
                f"FROM (SELECT {col}, count(*) AS n FROM {table} WHERE {col} IS NOT NULL GROUP BY {col})")
    status = "'completed', 'pending', 'shipped', 'cancelled', 'returned'"
    segs = ("'Champions', 'Loyal Customers', 'Recent Customers', 'Potential Loyalists', 'At Risk', "
            "'Lost', 'Needs Attention'")
    tiers = "'Platinum', 'Gold', 'Silver', 'Bronze'"
    parts = [
        row("not_null", "stg_sales", "sale_id", "count_if(sale_id IS NULL)", "count(*)"),
        uniq("stg_sales", "sale_id"),
        row("not_null", "stg_sales", "net_revenue", "count_if(net_revenue IS NULL)", "count(*)"),
        row("accepted_range", "stg_sales", "net_revenue", "count_if(net_revenue < 0)", "count(*)"),
        row("accepted_range", "stg_sales", "discount_pct",
            "count_if(discount_pct < 0 OR discount_pct > 1)", "count(*)"),
        row("accepted_values", "stg_sales", "status", f"count_if(status NOT IN ({status}))", "count(*)"),
        row("not_future", "stg_sales", "order_date", f"count_if(order_date > {AS_OF_SQL})", "count(*)"),
        row("expression_true", "stg_sales", "net_revenue_le_total",
            "count_if(NOT COALESCE(net_revenue <= total_amount, false))", "count(*)"),
        row("not_null", "fct_sales", "sale_id", "count_if(sale_id IS NULL)", "count(*)"),
        uniq("fct_sales", "sale_id"),
        row("not_null", "fct_sales", "net_revenue", "count_if(net_revenue IS NULL)", "count(*)"),
        row("accepted_range", "fct_sales", "gross_margin_pct",
            "count_if(gross_margin_pct < -100 OR gross_margin_pct > 100)", "count(*)"),
        row("finite", "fct_sales", "gross_profit",
            "count_if(gross_profit IS NULL OR isnan(CAST(gross_profit AS DOUBLE)) OR isinf(CAST(gross_profit AS DOUBLE)))",
            "count(*)"),
        row("not_null", "dim_customers", "customer_id", "count_if(customer_id IS NULL)", "count(*)"),
        uniq("dim_customers", "customer_id"),
        row("accepted_values", "dim_customers", "customer_segment",
            f"count_if(customer_segment NOT IN ({segs}))", "count(*)"),
        row("accepted_values", "dim_customers", "lifetime_tier",
            f"count_if(lifetime_tier NOT IN ({tiers}))", "count(*)"),
    ]
    union = "\nUNION ALL ".join(parts)
    return with_base(*DIM_PARTS, body=f"""SELECT *, failed_rows = 0 AS passed FROM (
{union})""")


def _quality_declared_sql() -> str:
    """One row for each rule: (table, column, rule, failing condition)."""
    status = "'completed', 'pending', 'shipped', 'cancelled', 'returned'"
    segments = ("'Champions', 'Loyal Customers', 'Recent Customers', 'Potential Loyalists', 'At Risk', "
                "'Lost', 'Needs Attention'")
    tiers = "'Platinum', 'Gold', 'Silver', 'Bronze'"
    keys = [("raw_sales", "sale_id"), ("raw_customers", "customer_id"), ("raw_products", "product_id"),
            ("raw_territories", "territory_id"), ("raw_budget", "budget_id"), ("stg_sales", "sale_id"),
            ("stg_customers", "customer_id"), ("fct_sales", "sale_id"), ("dim_customers", "customer_id")]
    present = keys + [("raw_sales", "customer_id"), ("raw_sales", "total_amount"), ("raw_customers", "email"),
                      ("stg_sales", "net_revenue"), ("stg_customers", "email"), ("fct_sales", "net_revenue"),
                      ("perf_rows", "total_revenue"), ("perf_rows", "order_count")]
    rules = [(t, c, "not_null", f"{c} IS NULL") for t, c in present]
    rules += [("raw_sales", "total_amount", "accepted_range", "total_amount < 0 OR total_amount > 10000000"),
              ("stg_sales", "net_revenue", "accepted_range", "net_revenue < 0"),
              ("stg_sales", "discount_pct", "accepted_range", "discount_pct < 0 OR discount_pct > 1"),
              ("stg_sales", "status", "accepted_values", f"status NOT IN ({status})"),
              ("fct_sales", "gross_margin_pct", "accepted_range", "gross_margin_pct < -100 OR gross_margin_pct > 100"),
              ("dim_customers", "customer_segment", "accepted_values", f"customer_segment NOT IN ({segments})"),
              ("dim_customers", "lifetime_tier", "accepted_values", f"lifetime_tier NOT IN ({tiers})")]
    parts = [f"SELECT '{rule}' AS \"check\", '{t}' AS \"table\", '{c}' AS \"column\", "
             f"CAST(count_if({bad}) AS BIGINT) AS failed_rows, count(*) AS total_rows FROM {t}" for t, c, rule, bad in rules]
    parts += [f"SELECT 'unique', '{t}', '{c}', CAST(count_if(n > 1) AS BIGINT), CAST(coalesce(sum(n), 0) AS BIGINT) "
              f"FROM (SELECT count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY {c})" for t, c in keys]
    union = "\nUNION ALL ".join(parts)
    return with_base(*DIM_PARTS, MONTHLY, BUDGET, """
raw_customers AS (SELECT c_custkey AS customer_id, lower(c_name) || '@example.com' AS email FROM customer)""", """
raw_products AS (SELECT p_partkey AS product_id FROM part)""", """
raw_territories AS (SELECT n_nationkey AS territory_id FROM nation)""", """
raw_budget AS (SELECT concat_ws('-', territory_id, product_category, CAST(fiscal_year AS VARCHAR),
                                CAST(fiscal_month AS VARCHAR)) AS budget_id FROM budget)""", """
perf_rows AS (SELECT total_revenue, order_count FROM monthly)""", body=f"""
SELECT "check", CASE "table" WHEN 'perf_rows' THEN 'fct_sales_performance' ELSE "table" END AS "table", "column",
  failed_rows, total_rows, failed_rows = 0 AS passed FROM ({union})""")


def _upsert_sql() -> str:
    cols = "sale_id, order_date, status, net_revenue, _ingested_at"
    return with_base("""
s AS (SELECT sale_id, order_date, status, net_revenue, _ingested_at, channel FROM stg_sales)""", """
tgt AS (SELECT * FROM s WHERE order_date < DATE '2000-01-01')""", f"""
batch AS (SELECT {cols} FROM s WHERE order_date >= DATE '1999-07-01'
          UNION ALL
          SELECT sale_id, order_date, 'returned', net_revenue, _ingested_at + INTERVAL 1 DAY
          FROM s WHERE order_date >= DATE '1999-07-01' AND channel = 'online')""", """
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sale_id ORDER BY _ingested_at DESC) AS rn
           FROM batch) WHERE rn = 1)""", body=f"""
SELECT sale_id, order_date, status, CAST(net_revenue AS DOUBLE) AS net_revenue,
  CAST(_ingested_at AS VARCHAR) AS _ingested_at
FROM tgt WHERE sale_id NOT IN (SELECT sale_id FROM latest)
UNION ALL
SELECT sale_id, order_date, status, CAST(net_revenue AS DOUBLE) AS net_revenue,
  CAST(_ingested_at AS VARCHAR) AS _ingested_at FROM latest""")


def _running_total_sql() -> str:
    return with_base(VW_SALES, """
s AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS period, sum(net_revenue) AS revenue
      FROM vw GROUP BY ALL)""", """
g AS (SELECT CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH)) AS DATE) AS period FROM s)""",
                     body="""SELECT g.period, CAST(s.revenue AS DOUBLE) AS revenue,
  CAST(sum(s.revenue) OVER (ORDER BY g.period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
    AS cumulative_revenue
FROM g LEFT JOIN s ON g.period = s.period""")


def _dim_date_sql() -> str:
    return with_base("""
dd AS (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE) AS date_day
       FROM stg_sales)""", body="""SELECT date_day, CAST(year(date_day) AS BIGINT) AS year,
  CAST(quarter(date_day) AS BIGINT) AS quarter, CAST(month(date_day) AS BIGINT) AS month,
  CAST(day(date_day) AS BIGINT) AS day, strftime(date_day, '%B') AS month_name,
  strftime(date_day, '%A') AS day_name, isodow(date_day) <= 5 AS is_weekday,
  CAST(year(date_day) AS BIGINT) AS fiscal_year, 'Q' || CAST(quarter(date_day) AS VARCHAR) AS fiscal_quarter,
  CAST(month(date_day) AS BIGINT) AS fiscal_month,
  CAST(date_trunc('month', date_day) AS DATE) AS month_start,
  CAST(date_trunc('quarter', date_day) AS DATE) AS quarter_start,
  CAST(date_trunc('year', date_day) AS DATE) AS year_start
FROM dd""")


def _tier_sql(expr: str, name: str, where: str = "") -> str:
    return with_base(body=f"""SELECT {expr} AS {name}, count(*) AS n,
  CAST(min(total_amount) AS DOUBLE) AS min_amount, CAST(max(total_amount) AS DOUBLE) AS max_amount
FROM stg_sales {where} GROUP BY 1""")


def more_oracles() -> dict[str, str]:
    deal_bin = ("CASE WHEN total_amount <= 0 THEN NULL WHEN total_amount <= 100 THEN 'micro' "
                "WHEN total_amount <= 1000 THEN 'smb' WHEN total_amount <= 10000 THEN 'mid_market' "
                "WHEN total_amount > 10000 THEN 'enterprise' END")
    return {
        "stg_sales": with_base(body=f"SELECT {STG_SALES_COLS} FROM stg_sales"),
        "stg_customers": with_base(body="SELECT * FROM stg_customers"),
        "stg_products": with_base(body="""SELECT product_id, product_name, category, subcategory, brand,
  CAST(cost_price AS DOUBLE) AS cost_price, CAST(list_price AS DOUBLE) AS list_price FROM stg_products"""),
        "stg_territories": with_base(body="SELECT * FROM stg_territories"),
        "budget_periods": with_base(BUDGET, body="""SELECT territory_id, product_category, fiscal_year,
  fiscal_month, CAST(budget_amount AS DOUBLE) AS budget_amount, period_date FROM budget"""),
        "fct_sales": with_base(body=f"SELECT {FCT_COLS} FROM fct_sales"),
        "vw_sales_fact": with_base(VW_SALES, body=f"SELECT {VW_COLS} FROM vw"),
        "vw_customer_dim": with_base(*DIM_PARTS, body="""SELECT customer_id, full_name, email, company,
  industry, country, region, city, tier, signup_date, CAST(lifetime_value AS DOUBLE) AS lifetime_value,
  total_orders, CAST(avg_order_value AS DOUBLE) AS avg_order_value, days_since_last_order,
  customer_segment, is_active, lifetime_tier, first_order_date FROM dim_customers"""),
        "dim_date": _dim_date_sql(),
        "quality_report": _quality_sql(),
        "freshness": with_base(body="""SELECT
  (epoch(TIMESTAMP '2002-01-01 00:00:00') - epoch(max(_ingested_at))) / 3600.0 AS age_hours,
  CASE WHEN max(_ingested_at) IS NULL THEN 'error'
       WHEN (epoch(TIMESTAMP '2002-01-01 00:00:00') - epoch(max(_ingested_at))) / 3600.0 > 24 THEN 'error'
       WHEN (epoch(TIMESTAMP '2002-01-01 00:00:00') - epoch(max(_ingested_at))) / 3600.0 > 6 THEN 'warn'
       ELSE 'pass' END AS status
FROM raw_sales"""),
        "rls_region": with_base(VW_SALES, body=f"""SELECT territory_region, territory_name,
  CAST(sum(net_revenue) AS DOUBLE) AS total_revenue,
  CAST(sum(gross_profit) AS DOUBLE) AS total_gross_profit,
  count(*) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
  {div_sql("sum(net_revenue)", "count(*)", "0")} AS avg_order_value,
  {div_sql("sum(gross_profit)", "sum(net_revenue)", "0")} AS gross_margin_pct,
  CAST(sum(discount_amount) AS DOUBLE) AS total_discounts,
  {div_sql("sum(discount_amount)", "sum(total_amount)", "0")} AS discount_rate_pct,
  count(DISTINCT customer_id) AS total_customers,
  {div_sql("sum(net_revenue)", "count(DISTINCT customer_id)", "0")} AS revenue_per_customer,
  count(DISTINCT product_id) AS products_sold
FROM vw WHERE territory_region = 'EUROPE' GROUP BY territory_region, territory_name"""),
        "hwm_filter": with_base(body="""SELECT sale_id, customer_id, order_date,
  CAST(total_amount AS DOUBLE) AS total_amount FROM raw_sales
WHERE _ingested_at > (SELECT max(_ingested_at) FROM stg_sales WHERE order_date < DATE '2000-01-01')"""),
        "events_after_hwm": """SELECT event_id, user_id, event_type, value FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'purchase')""",
        "upsert_latest": _upsert_sql(),
        "latest_per_customer": with_base(body="""SELECT customer_id, order_date, sale_id,
  CAST(net_revenue AS DOUBLE) AS net_revenue FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, sale_id DESC) AS rn
  FROM stg_sales) WHERE rn = 1"""),
        "deal_tiers": _tier_sql("deal_size_tier", "deal_size_tier"),
        "tier_bins_right_closed": _tier_sql(deal_bin, "deal_size_bin", "WHERE status != 'cancelled'"),
        "lifetime_tiers": with_base(*DIM_PARTS, body="""SELECT lifetime_tier, count(*) AS n,
  CAST(min(lifetime_value) AS DOUBLE) AS min_ltv, CAST(max(lifetime_value) AS DOUBLE) AS max_ltv
FROM dim_customers GROUP BY lifetime_tier"""),
        "not_cancelled": with_base(body="""SELECT status, count(*) AS n FROM stg_sales
WHERE status != 'cancelled' GROUP BY status"""),
        "left_join_dims": with_base(body="""SELECT 'fct_sales_left_joins' AS "check",
  (SELECT count(*) FROM stg_sales) AS rows_before, (SELECT count(*) FROM fct_sales) AS rows_after,
  (SELECT count(*) FROM stg_sales) = (SELECT count(*) FROM fct_sales) AS passed,
  CAST((SELECT count_if(customer_tier IS NULL) FROM fct_sales) AS BIGINT) AS no_customer,
  CAST((SELECT count_if(product_category IS NULL) FROM fct_sales) AS BIGINT) AS no_product,
  CAST((SELECT count_if(territory_name IS NULL) FROM fct_sales) AS BIGINT) AS no_territory"""),
        "multi_distinct": with_base(body="""SELECT order_year, count(DISTINCT sale_id) AS orders,
  count(DISTINCT customer_id) AS customers, count(DISTINCT product_id) AS products
FROM fct_sales GROUP BY order_year"""),
        "repeat_ratio": with_base(body=f"""SELECT CAST(count_if(n > 1) AS BIGINT) AS repeat_customers, count(*) AS customers,
  {div_sql("count_if(n > 1)", "count(*)", "0")} AS repeat_ratio
FROM (SELECT customer_id, count(*) AS n FROM stg_sales WHERE status != 'cancelled' GROUP BY customer_id)"""),
        "global_month_growth": with_base(body="""SELECT order_month, CAST(total_amount AS DOUBLE) AS total_amount,
  CAST(prev_amount AS DOUBLE) AS prev_amount,
  (CAST(total_amount AS DOUBLE) - CAST(prev_amount AS DOUBLE)) / CAST(prev_amount AS DOUBLE) AS mom_growth
FROM (SELECT order_month, total_amount, LAG(total_amount, 1) OVER (ORDER BY order_month) AS prev_amount
      FROM (SELECT order_month, sum(total_amount) AS total_amount FROM stg_sales GROUP BY order_month))"""),
        "running_total_month": _running_total_sql(),
        "status_outside_allowed": with_base(body="""SELECT DISTINCT status FROM stg_sales
WHERE status IS NOT NULL AND status NOT IN ('completed', 'pending', 'shipped', 'cancelled')"""),
        "text_cleaning": with_base(body="""SELECT customer_id, first_name, last_name, full_name, email,
  phone, industry, country, city FROM stg_customers"""),
        "date_parts": with_base(VW_SALES, body="""SELECT s.sale_id, s.days_to_ship, s.order_month AS month_start,
  s.order_quarter AS quarter_start, v.days_to_ship AS raw_days_to_ship, v.order_year, v.order_month,
  v.order_quarter
FROM stg_sales s JOIN vw v ON s.sale_id = v.sale_id"""),
        "margin_math": with_base(body="""SELECT sale_id, quantity, CAST(net_revenue AS DOUBLE) AS net_revenue,
  CAST(total_cost AS DOUBLE) AS total_cost, CAST(gross_profit AS DOUBLE) AS gross_profit,
  CAST(gross_margin_pct AS DOUBLE) AS gross_margin_pct FROM fct_sales"""),
        "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "range_violations": with_base(body="""SELECT sale_id, CAST(gross_margin_pct AS DOUBLE) AS gross_margin_pct
FROM fct_sales WHERE gross_margin_pct < -100 OR gross_margin_pct > 100"""),
        "monthly_summary": with_base(body=f"""SELECT order_month,
  CAST(ROUND(sum(net_revenue), 2) AS DOUBLE) AS total_revenue, count(sale_id) AS order_count,
  count(DISTINCT customer_id) AS unique_customers,
  CAST({round_div_sql("sum(net_revenue)", "count(net_revenue)")} AS DOUBLE) AS avg_order_value
FROM fct_sales WHERE status != 'cancelled' GROUP BY order_month"""),
    }


def _measure_evaluate_sql() -> str:
    k = "product_category"
    ctes = [VW_SALES, BUDGET, f"""
e_base AS (SELECT {k}, CAST(date_trunc('month', order_date) AS DATE) AS period,
  sum(net_revenue) AS total_revenue, count(*) AS total_orders,
  {div_sql("sum(net_revenue)", "count(*)", "0")} AS avg_order_value FROM vw GROUP BY ALL)""", f"""
e_top AS (SELECT {k}, period, max(pr) AS top_product_revenue FROM (
  SELECT {k}, CAST(date_trunc('month', order_date) AS DATE) AS period, product_id, sum(net_revenue) AS pr
  FROM vw GROUP BY ALL) GROUP BY ALL)"""] + _dense_sql(k, "month") + [f"""
e_time AS (SELECT {k}, period,
  sum(revenue) OVER (PARTITION BY {k}, date_trunc('year', period) ORDER BY period
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS revenue_ytd,
  {_growth_sql("revenue", f"LAG(revenue, 1) OVER (PARTITION BY {k} ORDER BY period)")} AS revenue_mom_growth
  FROM d)""", f"""
first_order AS (SELECT customer_id, min(order_date) AS first_order_date FROM fct_sales
  WHERE status != 'cancelled' GROUP BY customer_id)""", f"""
e_act AS (SELECT {k}, period, new_customers,
  {div_sql("total_customers - new_customers", "total_customers", "0")} AS customer_retention_rate FROM (
  SELECT v.{k}, CAST(date_trunc('month', v.order_date) AS DATE) AS period,
    count(DISTINCT v.customer_id) AS total_customers,
    count(DISTINCT CASE WHEN f.first_order_date >= CAST(date_trunc('month', v.order_date) AS DATE)
                         AND f.first_order_date <= last_day(v.order_date) THEN v.customer_id END) AS new_customers
  FROM vw v LEFT JOIN first_order f ON v.customer_id = f.customer_id GROUP BY ALL))""", f"""
e_a AS (SELECT {k}, CAST(date_trunc('month', order_date) AS DATE) AS period, sum(net_revenue) AS actual_revenue
  FROM vw GROUP BY ALL)""", f"""
e_b AS (SELECT {k}, CAST(date_trunc('month', period_date) AS DATE) AS period, sum(budget_amount) AS budget_amount
  FROM budget GROUP BY ALL)""", f"""
e_bud AS (SELECT COALESCE(a.{k}, b.{k}) AS {k}, COALESCE(a.period, b.period) AS period,
  {div_sql(diff0_sql("a.actual_revenue", "b.budget_amount"), "b.budget_amount")} AS revenue_vs_budget,
  CASE WHEN {div_sql("a.actual_revenue", "b.budget_amount")} >= 1.0 THEN 'On Track'
       WHEN {div_sql("a.actual_revenue", "b.budget_amount")} >= 0.85 THEN 'At Risk' ELSE 'Behind' END AS kpi_status
  FROM e_a a FULL JOIN e_b b ON a.{k} IS NOT DISTINCT FROM b.{k} AND a.period = b.period)"""]
    parts = ["e_base", "e_top", "e_time", "e_act", "e_bud"]
    sql = f"SELECT * FROM {parts[0]}"
    for i, p in enumerate(parts[1:], start=1):
        sql = (f"SELECT COALESCE(l.{k}, r.{k}) AS {k}, COALESCE(l.period, r.period) AS period, "
               f"l.* EXCLUDE ({k}, period), r.* EXCLUDE ({k}, period) FROM ({sql}) l FULL JOIN {p} r "
               f"ON l.{k} IS NOT DISTINCT FROM r.{k} AND l.period IS NOT DISTINCT FROM r.period")
    return with_base(*ctes, body=f"""SELECT {k}, period, CAST(total_revenue AS DOUBLE) AS total_revenue,
  total_orders, avg_order_value, CAST(revenue_ytd AS DOUBLE) AS revenue_ytd, revenue_mom_growth,
  new_customers, customer_retention_rate, CAST(top_product_revenue AS DOUBLE) AS top_product_revenue,
  revenue_vs_budget, kpi_status FROM ({sql})""")


ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations")


def _measure_evaluate_total_sql() -> str:
    """No grain: totals of each category, year to date and month growth at the last month of the data."""
    k = "product_category"
    return with_base(VW_SALES, BUDGET, f"""
span AS (SELECT min(order_date) AS lo, max(order_date) AS hi FROM vw)""", """
first_order AS (SELECT customer_id, min(order_date) AS first_order_date FROM fct_sales
  WHERE status != 'cancelled' GROUP BY customer_id)""", f"""
m AS (SELECT {k}, date_trunc('month', order_date) AS mo, sum(net_revenue) AS revenue FROM vw GROUP BY ALL)""", f"""
t AS (SELECT {k}, sum(net_revenue) AS total_revenue, count(*) AS total_orders,
  sum(CASE WHEN year(order_date) = (SELECT year(hi) FROM span) THEN net_revenue END) AS revenue_ytd,
  count(DISTINCT CASE WHEN f.first_order_date BETWEEN (SELECT lo FROM span) AND (SELECT hi FROM span)
                      THEN v.customer_id END) AS new_customers
  FROM vw v LEFT JOIN first_order f USING (customer_id) GROUP BY {k})""", f"""
bud AS (SELECT {k}, sum(budget_amount) AS budget_amount FROM budget GROUP BY {k})""", f"""
g AS (SELECT t.*, bud.budget_amount,
  (SELECT revenue FROM m WHERE m.{k} IS NOT DISTINCT FROM t.{k}
     AND mo = (SELECT date_trunc('month', hi) FROM span)) AS cur,
  (SELECT revenue FROM m WHERE m.{k} IS NOT DISTINCT FROM t.{k}
     AND mo = (SELECT date_trunc('month', hi) - INTERVAL 1 MONTH FROM span)) AS prev
  FROM t FULL JOIN bud ON t.{k} IS NOT DISTINCT FROM bud.{k})""", body=f"""SELECT {k},
  CAST(total_revenue AS DOUBLE) AS total_revenue, total_orders, CAST(revenue_ytd AS DOUBLE) AS revenue_ytd,
  {_growth_sql("cur", "prev")} AS revenue_mom_growth, new_customers,
  {div_sql(diff0_sql("total_revenue", "budget_amount"), "budget_amount")} AS revenue_vs_budget FROM g""")


def _time_intelligence_day_sql() -> str:
    """Day grain: the same date a month and a year earlier (the month's last day where it is shorter)."""
    k = "territory_region"
    run = "ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    back = "least(last_day(CAST(date_trunc('month', period) - INTERVAL {n} MONTH AS DATE)), CAST(period - INTERVAL {n} MONTH AS DATE))"
    return with_base(VW_SALES, f"""
sold AS (SELECT {k}, order_date AS period, sum(net_revenue) AS revenue FROM vw GROUP BY ALL)""", f"""
days AS (SELECT {k}, CAST(unnest(generate_series(lo, (SELECT max(period) FROM sold), INTERVAL 1 DAY)) AS DATE)
         AS period FROM (SELECT {k}, min(period) AS lo FROM sold GROUP BY {k}))""", f"""
d AS (SELECT days.*, sold.revenue,
      sum(sold.revenue) OVER (PARTITION BY days.{k}, year(days.period) {run.replace("period", "days.period")}) AS ytd,
      sum(sold.revenue) OVER (PARTITION BY days.{k} {run.replace("period", "days.period")}) AS cum
      FROM days LEFT JOIN sold ON days.{k} IS NOT DISTINCT FROM sold.{k} AND days.period = sold.period)""", f"""
b AS (SELECT *, {back.format(n=1)} AS pm, {back.format(n=12)} AS py FROM d)""", body=f"""SELECT b.{k}, b.period,
  CAST(b.revenue AS DOUBLE) AS revenue, CAST(b.ytd AS DOUBLE) AS revenue_ytd, CAST(y.ytd AS DOUBLE) AS revenue_pytd,
  {_growth_sql("b.revenue", "m.revenue")} AS revenue_mom_growth,
  {_growth_sql("b.revenue", "y.revenue")} AS revenue_yoy_growth, CAST(b.cum AS DOUBLE) AS cumulative_revenue
FROM b LEFT JOIN d m ON m.{k} IS NOT DISTINCT FROM b.{k} AND m.period = b.pm
LEFT JOIN d y ON y.{k} IS NOT DISTINCT FROM b.{k} AND y.period = b.py""")


def extra_oracles() -> dict[str, str]:
    return {
        "quarantine_rows": with_base(body="""SELECT CASE WHEN status = 'cancelled' THEN 'type:order_date'
         ELSE 'loaded' END AS reason, count(*) AS rows, count(DISTINCT sale_id) AS sales
FROM raw_sales GROUP BY 1"""),
        "csv_roundtrip": with_base(body="""SELECT count(*) AS rows_loaded,
  CAST(sum(total_amount) AS DOUBLE) AS total_amount, CAST(sum(discount_pct) AS DOUBLE) AS discount_pct,
  count(DISTINCT sale_id) AS sales, min(order_date) AS first_order, max(ship_date) AS last_ship,
  count(*) AS with_source, CAST(0 AS BIGINT) AS errors
FROM raw_sales"""),
        "jsonl_roundtrip": """SELECT count(*) AS rows_loaded,
  count(DISTINCT lower(c_name) || '@example.com') AS emails,
  min(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER)) AS first_signup,
  count(c_mktsegment) AS with_tier, CAST(0 AS BIGINT) AS with_attributes, CAST(0 AS BIGINT) AS errors
FROM customer""",
        "time_intelligence_alt": _q_time_intelligence("product_category", "month", abs_den=False,
                                                      cumulative="ytd"),
        "measure_evaluate": _measure_evaluate_sql(),
        "measure_evaluate_total": _measure_evaluate_total_sql(),
        "time_intelligence_day": _time_intelligence_day_sql(),
        "quality_report_declared": _quality_declared_sql(),
        "fct_sales_salted": with_base(body=f"SELECT {FCT_COLS} FROM fct_sales"),
        "pipeline_fact": with_base(body=f"SELECT {FCT_COLS} FROM fct_sales"),
        "dataset_stats": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ALL_TABLES),
        "dates_with_sales": with_base("""
dd AS (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE) AS date_day
       FROM stg_sales)""", body="""SELECT date_day, CAST(year(date_day) AS BIGINT) AS year,
  CAST(month(date_day) AS BIGINT) AS month, isodow(date_day) <= 5 AS is_weekday
FROM dd WHERE date_day IN (SELECT order_date FROM stg_sales)"""),
        "summarize_defaults": with_base(VW_SALES, body="""SELECT territory_region,
  CAST(sum(net_revenue) AS DOUBLE) AS net_revenue, CAST(sum(gross_profit) AS DOUBLE) AS gross_profit,
  CAST(sum(quantity) AS BIGINT) AS quantity,
  CAST(sum(gross_margin_pct) AS DOUBLE) / NULLIF(count(gross_margin_pct), 0) AS gross_margin_pct,
  CAST(sum(discount_pct) AS DOUBLE) / NULLIF(count(discount_pct), 0) AS discount_pct
FROM vw GROUP BY territory_region"""),
    }


# ---- loads, recovery and the model --------------------------------------------------------

def load_oracles() -> dict[str, str]:
    dim = (SALES_STATS, RFM, DIM_CUSTOMERS)
    merged = _upsert_sql()
    customer = "(SELECT *, lower(c_mktsegment) = 'machinery' AS bad FROM customer JOIN nation ON c_nationkey = n_nationkey)"
    of_customers = """count(*) AS customer_count, count_if(customer_segment = 'Champions') / count(*) AS champions_pct,
  CAST(count_if(customer_segment = 'At Risk') AS BIGINT) AS at_risk_customers"""
    return {
        "upsert_recovered": f"""SELECT phase, CAST(date_trunc('month', order_date) AS DATE) AS order_month, status,
  count(*) AS sales, count(DISTINCT sale_id) AS keys, CAST(sum(net_revenue::DECIMAL(18,4)) AS DOUBLE) AS net_revenue
FROM ({merged}) AS merged, (VALUES ('committed'), ('rerun')) AS phases(phase) GROUP BY ALL""",
        "load_once": f"""WITH c AS {customer}
SELECT what, n::BIGINT AS n, keys::BIGINT AS keys FROM (SELECT 'rows' AS what, count_if(NOT bad)::BIGINT AS n, count_if(NOT bad)::BIGINT AS keys FROM c
UNION ALL SELECT 'rejected', count_if(bad), count_if(bad) FROM c
UNION ALL SELECT 'files', 3, 3
UNION ALL SELECT 'reported', count_if(NOT bad), count_if(bad) FROM c
UNION ALL SELECT 'loads after the first', 0, 0)""",
        "csv_mixed_headers": with_base(body="""SELECT channel,
  CASE channel WHEN 'online' THEN 'EUR' WHEN 'direct' THEN 'USD' END AS currency, count(*) AS sales,
  CAST(sum(CASE WHEN channel = 'direct' THEN 0 ELSE discount_pct END) AS DOUBLE) AS discount_pct,
  CAST(sum(CASE WHEN channel = 'direct' THEN total_amount ELSE net_revenue END) AS DOUBLE) AS net_revenue,
  CAST(0 AS BIGINT) AS rejected FROM stg_sales GROUP BY ALL"""),
        "json_document": f"""SELECT 'loaded' AS reason, n_name AS country, count(*) AS records, count(DISTINCT c_custkey) AS keys
FROM {customer} WHERE NOT bad GROUP BY n_name
UNION ALL SELECT 'malformed', NULL, count(*), count(DISTINCT c_custkey) FROM {customer} WHERE bad HAVING count(*) > 0""",
        "parquet_corrupt": """SELECT 'loaded' AS reason, count(*) AS records, count(DISTINCT c_custkey) AS keys FROM customer
UNION ALL SELECT 'corrupt file', 1, 1""",
        "stg_sales_repaired": with_base(body=f"""SELECT sale_id,
  CAST({round_div_sql("total_amount", "quantity", 4)} AS DOUBLE) AS unit_price,
  CASE WHEN channel <> 'partner' THEN ship_date END AS ship_date,
  CASE WHEN channel = 'partner' THEN 3 ELSE ship_date - order_date END AS days_to_ship FROM stg_sales"""),
        "fct_sales_bucketed": with_base(body=f"SELECT {FCT_COLS} FROM fct_sales"),
        "sales_of_year": with_base(body="""SELECT order_month, count(*) AS sales, CAST(sum(net_revenue) AS DOUBLE) AS net_revenue
FROM stg_sales WHERE year(order_date) = 1997 GROUP BY order_month"""),
        "measure_evaluate_customer": with_base(VW_SALES, *dim, """
x AS (SELECT v.*, c.country, c.first_order_date, year(v.order_date + INTERVAL 6 MONTH)::BIGINT AS fiscal_year
      FROM vw v JOIN dim_customers c USING (customer_id)
      WHERE c.lifetime_tier <> 'Bronze' AND v.channel = 'online' AND isodow(v.order_date) <= 5)""", """
span AS (SELECT min(order_date) AS lo, max(order_date) AS hi FROM x)""", f"""
k AS (SELECT country, {of_customers} FROM dim_customers WHERE lifetime_tier <> 'Bronze' GROUP BY country)""", """
s AS (SELECT country, fiscal_year, CAST(sum(net_revenue) AS DOUBLE) AS total_revenue, count(*) AS total_orders,
        count(DISTINCT product_id) AS products_sold, count(DISTINCT customer_id) AS total_customers,
        count(DISTINCT CASE WHEN first_order_date BETWEEN lo AND hi THEN customer_id END) AS new_customers
      FROM x, span GROUP BY country, fiscal_year)""", body="SELECT * FROM s LEFT JOIN k USING (country)"),
        "customer_measures_any": with_base(VW_SALES, *dim, body=f"""SELECT territory_region, total_orders,
  customer_count, champions_pct, at_risk_customers
FROM (SELECT territory_region, count(*) AS total_orders FROM vw WHERE channel = 'online' GROUP BY territory_region),
     (SELECT {of_customers} FROM dim_customers)"""),
        "pipeline_views": with_base(VW_SALES, *dim, body="""SELECT year(order_date)::BIGINT AS year, territory_region,
  customer_segment, count(*) AS sales, CAST(sum(net_revenue) AS DOUBLE) AS net_revenue
FROM vw JOIN dim_customers USING (customer_id) GROUP BY ALL"""),
        "repeat_ratio_by": with_base(VW_SALES, body="""SELECT territory_region, count_if(n > 1)::BIGINT AS repeat_customers,
  count(*) AS customers, count_if(n > 1) / count(*) AS repeat_ratio
FROM (SELECT territory_region, customer_id, count(*) AS n FROM vw WHERE status <> 'cancelled' GROUP BY ALL) GROUP BY ALL"""),
        "month_growth_by": with_base(VW_SALES, body=f"""SELECT product_category, period, CAST(amount AS DOUBLE) AS amount,
  CAST(prev AS DOUBLE) AS prev_amount, {div_sql("amount - prev", "prev")} AS growth
FROM (SELECT *, LAG(amount) OVER (PARTITION BY product_category ORDER BY period) AS prev FROM (
  SELECT product_category, CAST(date_trunc('month', order_date) AS DATE) AS period, sum(net_revenue) AS amount FROM vw GROUP BY ALL))"""),
    }
