"""Small helpers: cluster sizing, hot-key detection edges, salted join with
null keys, file listing, schema application."""

import datetime as dt
import os

from pyspark.sql import functions as F

from ledgerlens.operators.joins import checked_broadcast, hot_keys, salted_left_join, source_row_counts
from ledgerlens.session import cluster_settings
from ledgerlens.sources import readers


def test_cluster_settings_bounds():
    assert cluster_settings(10 ** 6)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_settings(100 * 10 ** 12)["spark.sql.shuffle.partitions"] == "100000"
    mid = int(cluster_settings(256 * 1000 * (1 << 20))["spark.sql.shuffle.partitions"])
    assert mid == 1000


def test_hot_keys_edges(spark):
    empty = spark.createDataFrame([], "k string")
    assert hot_keys(empty, "k").count() == 0
    nulls = spark.createDataFrame([(None,)] * 50 + [("a",)] * 50, "k string")
    assert [r["_hot"] for r in hot_keys(nulls, "k", hot_fraction=0.3).collect()] == ["a"]   # null keys never salted


def test_salted_join_keeps_null_and_unmatched_rows(spark):
    fact = spark.createDataFrame([("a", 1)] * 40 + [(None, 2), ("zz", 3)], "k string, v int")
    dim = spark.createDataFrame([("a", "A")], "k string, name string")
    out = salted_left_join(fact, dim, "k", "v", salts=4)
    rows = out.collect()
    assert len(rows) == 42
    assert sum(1 for r in rows if r["name"] == "A") == 40
    assert {r["v"] for r in rows if r["name"] is None} == {2, 3}


def test_checked_broadcast_and_counts(spark, tmp_dir):
    spark.range(7).write.parquet(f"{tmp_dir}/t7")
    spark.range(3).write.parquet(f"{tmp_dir}/t3")
    assert source_row_counts(spark, {"a": f"{tmp_dir}/t7", "b": f"{tmp_dir}/t3"}) == {"a": 7, "b": 3}
    df = spark.range(3)
    assert checked_broadcast(df, None) is df
    assert checked_broadcast(df, 10, max_bytes=300) is df
    assert checked_broadcast(df, 3, max_bytes=300) is not df


def test_new_files_and_apply_schema(spark, tmp_dir):
    spark.createDataFrame([("S1", "c1", "p1", "2024-01-01", "5.5")],
                          "SALE_ID string, customer_id string, Product_Id string, order_date string, "
                          "total_amount string").coalesce(1).write.parquet(f"{tmp_dir}/land/a")
    listed = readers.new_files(spark, f"{tmp_dir}/land", since_hours=1, path_glob="*.parquet").collect()
    assert len(listed) == 1 and listed[0]["bytes"] > 0
    assert readers.new_files(spark, f"{tmp_dir}/land", since_hours=1,
                             now=dt.datetime(2000, 1, 1)).count() == 1          # modified after 1999-12-31
    typed = readers.apply_schema(spark.read.parquet(f"{tmp_dir}/land/a"), "sales", load_ts="2024-02-01 00:00:00")
    r = typed.first()
    assert r["sale_id"] == "S1" and r["product_id"] == "p1" and r["order_date"] == dt.date(2024, 1, 1)
    assert str(r["total_amount"]) == "5.5000" and r["currency"] == "USD" and r["discount_pct"] == 0
    assert r["_ingested_at"] == dt.datetime(2024, 2, 1)
    assert os.path.isdir(f"{tmp_dir}/land/a")
    assert "quantity" in typed.columns and r["quantity"] is None
    assert typed.filter(F.col("sale_id").isNotNull()).count() == 1
