"""Date dimension, fiscal years, semi-join cross filter, default
aggregations, UTC timestamps."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.functions.scalar import utc_now
from ledgerlens.plans import calendar, measures


def test_date_spine_inclusive_and_parallel(spark):
    s = calendar.date_spine(spark, "2024-02-27", "2024-03-02", num_partitions=3)
    assert [r["date_day"] for r in s.orderBy("date_day").collect()] == [
        dt.date(2024, 2, 27), dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1),
        dt.date(2024, 3, 2)]
    assert calendar.date_spine(spark, "2024-01-02", "2024-01-01").count() == 0


def test_dim_date_attributes_and_fiscal_shift(spark):
    d = {r["date_day"]: r for r in calendar.dim_date(spark, "2023-06-30", "2023-07-03", 7).collect()}
    jun30, jul1 = d[dt.date(2023, 6, 30)], d[dt.date(2023, 7, 1)]
    assert jun30["fiscal_year"] == 2023 and jun30["fiscal_quarter"] == "Q4" and jun30["fiscal_month"] == 12
    assert jul1["fiscal_year"] == 2024 and jul1["fiscal_quarter"] == "Q1" and jul1["fiscal_month"] == 1
    assert jul1["month_name"] == "July" and jul1["day_name"] == "Saturday" and jul1["is_weekday"] is False
    assert d[dt.date(2023, 7, 3)]["is_weekday"] is True
    cal = calendar.dim_date(spark, "2023-12-31", "2024-01-01").collect()
    assert [r["fiscal_year"] for r in cal] == [2023, 2024]


def test_dates_with_sales_semi_join(spark):
    dates = calendar.dim_date(spark, "2024-01-01", "2024-01-05")
    sales = spark.createDataFrame([(dt.date(2024, 1, 2),), (dt.date(2024, 1, 2),), (dt.date(2024, 1, 4),)],
                                  "order_date date")
    got = [r["date_day"] for r in calendar.dates_with_sales(dates, sales).orderBy("date_day").collect()]
    assert got == [dt.date(2024, 1, 2), dt.date(2024, 1, 4)]      # no fan-out


def test_default_aggregations(spark):
    df = spark.createDataFrame([("a", 1.0, 10.0), ("a", 3.0, 20.0)], "k string, net double, pct double")
    aggs = measures.default_aggregations({"net": "sum", "pct": "average"})
    r = df.groupBy("k").agg(*aggs.values()).first()
    assert r["net"] == 4.0 and r["pct"] == 15.0


def test_utc_now_is_ntz(spark):
    r = spark.range(1).select(utc_now().alias("t")).first()["t"]
    assert isinstance(r, dt.datetime) and r.tzinfo is None
    assert abs((dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - r).total_seconds()) < 600


def test_dim_date_of_data(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 30),), (dt.date(2024, 2, 2),)], "order_date date")
    d = calendar.dim_date_of(df, "order_date")
    assert d.count() == 4 and d.agg(F.max("date_day")).first()[0] == dt.date(2024, 2, 2)
