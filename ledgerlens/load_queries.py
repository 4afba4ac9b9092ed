"""Queries over landings and tables that Spark derives from the given tables:
files that disagree, files that are broken, loads and upserts that die."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.functions.scalar import in_year
from ledgerlens.operators.incremental import merge_upsert, prepare_upsert
from ledgerlens.operators.joins import source_row_count
from ledgerlens.plans import calendar, customers, marts, measures, staging
from ledgerlens.queries import AS_OF, RUN_TS, Models, _scratch, _upsert_inputs, oracle_types, written
from ledgerlens.sources.commits import read_table
from ledgerlens.sources.readers import prepare_load, read_permissive
from ledgerlens.sources.sinks import bucket_count, write_bucketed


def q_upsert_recovered(spark, sf_dir):
    """K2, K4: the writer dies right after its commit, before any new file is
    in place.  Readers that follow the commit see the new table ('committed');
    the same batch again finishes the first write and changes nothing ('rerun')."""
    target, batch = _upsert_inputs(Models.of(spark, sf_dir))
    path = _scratch(spark, "upsert-recovered")
    args = ("sale_id", "_ingested_at", "order_month")
    merge_upsert(spark, path, target, *args)
    write, _ = prepare_upsert(spark, path, batch, *args)
    write.commit()

    def seen(phase):
        return read_table(spark, path, target.schema).groupBy("order_month", "status").agg(
            F.lit(phase).alias("phase"), F.count(F.lit(1)).alias("sales"), F.count_distinct("sale_id").alias("keys"),
            F.sum("net_revenue").alias("net_revenue"))

    committed = _scratch(spark, "upsert-committed")
    seen("committed").write.parquet(committed)
    merge_upsert(spark, path, batch, *args)
    return oracle_types(spark.read.parquet(committed).unionByName(seen("rerun")))


def q_load_once(spark, sf_dir):
    """Raw customers land as JSON lines in several files; the load
    dies after its commit, runs again, and runs a third time.  Rows, rejected
    rows and loaded files are each there once."""
    raw = Models.of(spark, sf_dir).raw["customers"]
    base = _scratch(spark, "load-once")
    landed = raw.withColumn("customer_id", F.when(F.lower("tier") != "machinery", F.col("customer_id")))    # those lose the key
    landed.repartition(3, "email").write.json(f"{base}/landing")
    cfg = {"name": "customers", "path": f"{base}/landing", "format": "jsonl", "target": f"{base}/raw",
           "quarantine": f"{base}/quarantine", "loaded_log": f"{base}/log"}
    write, first = prepare_load(spark, cfg, RUN_TS)
    write.commit()
    results = [prepare_load(spark, cfg, RUN_TS)[1] for _ in range(2)]
    rows, rejected, files = (read_table(spark, f"{base}/{t}") for t in ("raw", "quarantine", "log"))
    counts = [rows.agg(F.lit("rows").alias("what"), F.count(F.lit(1)).alias("n"), F.count_distinct("customer_id").alias("keys")),
              rejected.agg(F.lit("rejected").alias("what"), F.count(F.lit(1)).alias("n"), F.count_distinct("email").alias("keys")),
              files.agg(F.lit("files").alias("what"), F.count(F.lit(1)).alias("n"), F.count_distinct("file_path").alias("keys"))]
    said = spark.createDataFrame(
        [("reported", first["rows_loaded"], first["errors"]),
         ("loads after the first", sum(r["status"] != "no_new_files" for r in results), 0)], "what string, n long, keys long")
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(said)


def q_csv_mixed_headers(spark, sf_dir):
    """Raw sales land as CSV files of three shapes in one folder: all
    columns; without currency and discount, which then take their defaults;
    and with another column order, an empty currency and a nameless last column."""
    raw = Models.of(spark, sf_dir).raw["sales"]
    cols = ["sale_id", "customer_id", "product_id", "order_date", "quantity", "total_amount", "channel", "status"]
    path = _scratch(spark, "csv-mixed")
    kind = F.col("channel")

    def land(rows, mode):
        rows.write.mode(mode).option("header", "true").csv(path)

    land(raw.where(kind == "online").select(*cols, F.lit("EUR").alias("Currency"), "discount_pct"), "overwrite")
    land(raw.where(kind == "direct").select(*cols), "append")
    land(raw.where(~kind.isin("online", "direct")).select(
        *[F.col(c).alias(c.upper()) for c in reversed(cols)], "discount_pct", F.lit(None).cast("string").alias("currency"),
        F.lit("rest").alias(" ")), "append")
    good, bad = read_permissive(spark, path, "sales", "csv", load_ts=RUN_TS)
    out = staging.stg_sales(good, RUN_TS).join(good.select(F.col("sale_id").alias("s"), F.col("currency").alias("landed")),
                                              F.col("sale_id") == F.col("s"))
    rejected = bad.agg(F.count(F.lit(1)).alias("rejected")).scalar()
    return oracle_types(out.groupBy("channel", F.col("landed").alias("currency")).agg(
        F.count(F.lit(1)).alias("sales"), F.sum("discount_pct").alias("discount_pct"),
        F.sum("net_revenue").alias("net_revenue"), F.max(rejected).alias("rejected")))


def q_json_document(spark, sf_dir):
    """Raw customers land as one JSON document for each country, an
    array in which the customers of one market segment are bare strings; these elements are
    rejected and the others of their document load."""
    raw = Models.of(spark, sf_dir).raw["customers"].select("customer_id", "email", "country", "industry")
    record = F.to_json(F.struct(F.col("customer_id").alias("CUSTOMER_ID"), "email", "country", "industry"))
    element = F.when(F.lower("industry") == "machinery", F.concat(F.lit('"'), "customer_id", F.lit('"'))).otherwise(record)
    docs = raw.groupBy("country").agg(F.concat(F.lit("["), F.array_join(F.collect_list(element), ","), F.lit("]")).alias("value"))
    path = _scratch(spark, "json-documents")
    docs.repartition("country").write.partitionBy("country").text(path)
    good, bad = read_permissive(spark, path, "customers", "json", load_ts=RUN_TS)
    loaded = good.groupBy(F.lit("loaded").alias("reason"), "country").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("customer_id").alias("keys"))
    rejected = bad.groupBy("reason", F.lit(None).cast("string").alias("country")).agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("raw_record").alias("keys"))
    return loaded.unionByName(rejected)


def q_parquet_corrupt(spark, sf_dir):
    """Raw customers land as Parquet beside a file of their e-mail
    addresses that is no Parquet at all; that file is rejected, the others load."""
    raw = Models.of(spark, sf_dir).raw["customers"]
    base = _scratch(spark, "parquet-corrupt")
    raw.repartition(4, "customer_id").write.parquet(f"{base}/sound")
    raw.select("email").coalesce(1).write.text(f"{base}/broken")
    good, bad = read_permissive(spark, [f"{base}/sound", f"{base}/broken"], "customers", load_ts=RUN_TS, check_files=True)
    loaded = good.agg(F.lit("loaded").alias("reason"), F.count(F.lit(1)).alias("records"),
                      F.count_distinct("customer_id").alias("keys"))
    rejected = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("file_name").alias("keys"))
    return loaded.unionByName(rejected)


def q_stg_sales_repaired(spark, sf_dir):
    """Unit prices and ship dates as they should not be: returned
    sales have a negative unit price and sales of partners no ship date."""
    raw = Models.of(spark, sf_dir).raw["sales"].withColumns({
        "unit_price": F.when(F.col("status") == "returned", -F.col("unit_price")).otherwise(F.col("unit_price")),
        "ship_date": F.when(F.col("channel") != "partner", F.col("ship_date"))})
    return oracle_types(staging.stg_sales(raw, RUN_TS).select("sale_id", "unit_price", "ship_date", "days_to_ship"))


def q_fct_sales_bucketed(spark, sf_dir):
    """Sales and customers bucketed by customer are merged bucket by
    bucket into the fact; products and territories are broadcast within their bounds."""
    m, base = Models.of(spark, sf_dir), _scratch(spark, "bucketed")
    name = base.rsplit("-", 1)[1]
    n = bucket_count(source_row_count(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet"))
    sales = write_bucketed(m.stg_sales, f"sales_{name}", f"{base}/sales", "customer_id", n)
    people = write_bucketed(m.stg_customers, f"customers_{name}", f"{base}/customers", "customer_id", n)
    fct = marts.fct_sales(sales, people, m.stg_products, m.stg_territories, RUN_TS, m.dim_row_bounds, co_located=("customers",))
    return oracle_types(fct.drop("unit_price", "cost_price"))


def q_sales_of_year(spark, sf_dir):
    """sales of one year by month, filtered as a range of dates."""
    s = Models.of(spark, sf_dir).stg_sales.filter(in_year("order_date", 1997))
    return oracle_types(s.groupBy("order_month").agg(F.count(F.lit(1)).alias("sales"), F.sum("net_revenue").alias("net_revenue")))


def q_measure_evaluate_customer(spark, sf_dir):
    """J6, J7, J9, D22, D23, D28 through the model: customer and date columns
    divide sales measures; customer measures see the customer filter, not the
    filters of sales and dates."""
    m = Models.of(spark, sf_dir)
    dates = calendar.dim_date(spark, dt.date(1990, 1, 1), dt.date(2005, 12, 31), 7)
    # The fact is computed once, for the sales and for the customer statistics.
    fct = written(spark, m.fct.select("customer_id", "product_id", "order_date", "status", "channel", "total_amount", "discount_pct",
                                      "net_revenue", "gross_profit"), "evaluate-fact")
    sales = fct.withColumn("net_revenue", marts.exact_net_revenue())
    people = customers.dim_customers(m.stg_customers, fct, AS_OF, RUN_TS)
    return oracle_types(measures.evaluate(
        sales, ["total_revenue", "total_orders", "products_sold", "total_customers", "new_customers",
                "customer_count", "champions_pct", "at_risk_customers"],
        by=["Customers.country", "fiscal_year"], customers=people, date_table=dates,
        filters=F.col("channel") == "online", customer_filters=F.col("lifetime_tier") != "Bronze",
        date_filters=F.col("is_weekday")))


def q_customer_measures_any(spark, sf_dir):
    """D22, D23, D28 where no grouping column reaches Customers: one value for every region."""
    m = Models.of(spark, sf_dir)
    return oracle_types(measures.evaluate(
        m.view, ["total_orders", "customer_count", "champions_pct", "at_risk_customers"], by=["territory_region"],
        customers=m.dim_customers, filters=F.col("channel") == "online"))


def q_pipeline_views(spark, sf_dir):
    """Gold tables of one day's run, read through the semantic views."""
    from ledgerlens.plans.pipeline import publish_views, run_pipeline
    from ledgerlens.sources.readers import daily_path
    raw, base = Models.of(spark, sf_dir).raw, _scratch(spark, "pipeline-views")
    day = dt.date(2001, 12, 31)
    for t in ("sales", "customers", "products", "territories"):
        raw[t].write.parquet(daily_path(f"{base}/landing/{t}", day) + "/a")
    run_pipeline(spark, f"{base}/landing", f"{base}/wh", day, run_ts=RUN_TS, as_of=AS_OF, gate=True)
    publish_views(spark, f"{base}/wh")
    return oracle_types(spark.sql("""
        SELECT d.year, s.territory_region, c.customer_segment, count(*) AS sales, sum(s.net_revenue) AS net_revenue
        FROM vw_sales_fact s JOIN vw_customer_dim c USING (customer_id) JOIN dim_date d ON d.date_day = s.order_date
        GROUP BY ALL"""))


def q_repeat_ratio_by(spark, sf_dir):
    """A13 by region: share of customers with more than one sale."""
    sales = Models.of(spark, sf_dir).view.where("status != 'cancelled'")
    return oracle_types(measures.repeat_ratio(sales, ["territory_region"]))


def q_month_growth_by(spark, sf_dir):
    """W6 by category: growth of revenue over the month before, by rows."""
    return oracle_types(measures.month_growth(Models.of(spark, sf_dir).view, ["product_category"]))


def queries():
    return {f.__name__[2:]: f for f in (
        q_upsert_recovered, q_load_once, q_csv_mixed_headers, q_json_document, q_parquet_corrupt, q_stg_sales_repaired,
        q_sales_of_year, q_fct_sales_bucketed, q_measure_evaluate_customer, q_customer_measures_any, q_pipeline_views, q_repeat_ratio_by,
        q_month_growth_by)}
