"""Keep-latest dedupe, high-water mark, keyed upsert and streaming ingest."""

import datetime as dt
import os

import pytest

from ledgerlens.operators.incremental import after_high_water_mark, latest_per_key, merge_upsert
from ledgerlens.sources import schemas
from ledgerlens.streaming.ingest import ingest_stream

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "k string, m date, v int, ts timestamp_ntz"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_latest_per_key_deterministic(spark):
    df = _df(spark, [("a", dt.date(2024, 1, 1), 1, T0), ("a", dt.date(2024, 1, 1), 2, T0 + dt.timedelta(1)),
                     ("b", dt.date(2024, 1, 1), 5, T0), ("b", dt.date(2024, 1, 1), 7, T0)])
    out = {r["k"]: r["v"] for r in latest_per_key(df, "k", "ts").collect()}
    assert out == {"a": 2, "b": 7}                    # tie on ts -> greatest remaining columns
    assert latest_per_key(df, "k", "ts").columns == df.columns


def test_high_water_mark(spark):
    src = _df(spark, [("a", None, 1, T0), ("b", None, 2, T0 + dt.timedelta(hours=1))])
    assert after_high_water_mark(src, None, "ts").count() == 2
    assert after_high_water_mark(src, src.limit(0), "ts").count() == 2      # empty target -> full load
    tgt = _df(spark, [("a", None, 1, T0)])
    assert [r["k"] for r in after_high_water_mark(src, tgt, "ts").collect()] == ["b"]
    assert after_high_water_mark(src, tgt, "ts", lookback=dt.timedelta(minutes=1)).count() == 2


def _read(spark, path):
    return {r["k"]: (r["m"], r["v"]) for r in spark.read.parquet(path).collect()}


def test_merge_upsert_moves_and_empties_partitions(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    jan, feb, mar = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)
    merge_upsert(spark, target, _df(spark, [("a", jan, 1, T0), ("b", feb, 2, T0)]), "k", "ts", "m")
    assert _read(spark, target) == {"a": (jan, 1), "b": (feb, 2)}
    # 'b' moves from February to March; duplicate 'c' keeps the latest.
    batch = _df(spark, [("b", mar, 3, T0 + dt.timedelta(1)), ("c", jan, 4, T0), ("c", jan, 5, T0 + dt.timedelta(1))])
    res = merge_upsert(spark, target, batch, "k", "ts", "m")
    assert res["partitions_rewritten"] == 3
    expect = {"a": (jan, 1), "b": (mar, 3), "c": (jan, 5)}
    assert _read(spark, target) == expect
    merge_upsert(spark, target, batch, "k", "ts", "m")    # a retried batch changes nothing
    assert _read(spark, target) == expect
    with pytest.raises(ValueError):
        merge_upsert(spark, target, batch, "k", "ts", "m", on_duplicate="error")


def test_streaming_ingest_only_new_files(spark, tmp_dir):
    from ledgerlens.plans.staging import stg_sales
    land, target, ckpt = (os.path.join(tmp_dir, x) for x in ("land", "target", "ckpt"))

    def batch(ids, day):
        from helpers import sales
        return sales(spark, [{"sale_id": i, "customer_id": "C1", "product_id": "P1", "order_date": day,
                              "total_amount": 10, "_ingested_at": T0} for i in ids])

    batch(["S1", "S2"], dt.date(2024, 1, 3)).write.mode("append").parquet(land)
    nullable = type(schemas.SALES)([type(f)(f.name, f.dataType, True) for f in schemas.SALES.fields])
    ingest_stream(spark, land, nullable, target, ckpt, "sale_id", "_ingested_at", "order_month",
                  transform=lambda b: stg_sales(b))
    assert spark.read.parquet(target).count() == 2
    batch(["S2", "S3"], dt.date(2024, 2, 3)).write.mode("append").parquet(land)
    ingest_stream(spark, land, nullable, target, ckpt, "sale_id", "_ingested_at", "order_month",
                  transform=lambda b: stg_sales(b))
    out = {r["sale_id"]: r["order_month"] for r in spark.read.parquet(target).collect()}
    assert out == {"S1": dt.date(2024, 1, 1), "S2": dt.date(2024, 2, 1), "S3": dt.date(2024, 2, 1)}


def test_csv_stream_validates_header(spark, tmp_dir):
    import pytest as _pytest
    from pyspark.sql import types as T

    from ledgerlens.streaming.ingest import file_stream
    schema = T.StructType([T.StructField("sale_id", T.StringType()), T.StructField("amount", T.StringType())])
    good_dir, bad_dir = os.path.join(tmp_dir, "good"), os.path.join(tmp_dir, "bad")
    os.makedirs(good_dir)
    os.makedirs(bad_dir)
    with open(os.path.join(good_dir, "a.csv"), "w") as f:
        f.write("sale_id,amount\nS1,10\nS2,20\n")
    with open(os.path.join(bad_dir, "b.csv"), "w") as f:
        f.write("amount,sale_id\n10,S1\n")

    def run(path, name):
        q = (file_stream(spark, path, schema, "csv").writeStream.format("memory").queryName(name)
             .option("checkpointLocation", os.path.join(tmp_dir, f"ck_{name}"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return spark.sql(f"select * from {name}").collect()

    assert sorted(r["sale_id"] for r in run(good_dir, "csv_good")) == ["S1", "S2"]
    with _pytest.raises(Exception):
        run(bad_dir, "csv_bad")
