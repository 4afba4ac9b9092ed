"""Scalar helpers and classification ladders on hand-made edge values."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import (clean_title, deal_size_bin, deal_size_tier, digits_and_plus,
                                  join_words, kpi_status, lifetime_tier, rfm_segment, safe_divide,
                                  score_segment)


def _one(spark, expr, value, schema="x decimal(18,4)"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("amount,tier", [
    ("99.99", "micro"), ("100", "smb"), ("999.99", "smb"), ("1000", "mid_market"),
    ("9999.99", "mid_market"), ("10000", "enterprise"), ("0.01", "micro"),
])
def test_deal_size_tier_lower_bounds_inclusive(spark, amount, tier):
    assert _one(spark, deal_size_tier, Decimal(amount)) == tier


@pytest.mark.parametrize("amount,label", [
    ("100", "micro"), ("100.01", "smb"), ("1000", "smb"), ("10000", "mid_market"),
    ("10000.01", "enterprise"), ("0", None), ("-5", None), ("0.01", "micro"),
])
def test_deal_size_bins_right_closed(spark, amount, label):
    assert _one(spark, deal_size_bin, Decimal(amount)) == label


def test_bin_and_tier_differ_at_100(spark):
    assert _one(spark, deal_size_tier, Decimal("100")) == "smb"
    assert _one(spark, deal_size_bin, Decimal("100")) == "micro"


@pytest.mark.parametrize("ltv,tier", [
    (None, "Bronze"), ("4999.99", "Bronze"), ("5000", "Silver"), ("25000", "Gold"),
    ("100000", "Platinum"),
])
def test_lifetime_tier(spark, ltv, tier):
    assert _one(spark, lifetime_tier, Decimal(ltv) if ltv else None) == tier


@pytest.mark.parametrize("att,status", [(None, "Behind"), (1.0, "On Track"), (0.85, "At Risk"),
                                        (0.8499, "Behind"), (2.0, "On Track")])
def test_kpi_status(spark, att, status):
    assert _one(spark, kpi_status, att, "x double") == status


@pytest.mark.parametrize("r,f,m,seg", [
    (4, 4, 4, "Champions"), (3, 1, 3, "Loyal Customers"), (4, 1, 1, "Recent Customers"),
    (2, 4, 4, "Potential Loyalists"), (2, 1, 4, "At Risk"), (1, 1, 1, "Lost"),
    (2, 2, 2, "Needs Attention"), (5, 5, 2, "Recent Customers"),
])
def test_rfm_segment_order(spark, r, f, m, seg):
    df = spark.createDataFrame([(r, f, m)], "r int, f int, m int")
    assert df.select(rfm_segment(F.col("r"), F.col("f"), F.col("m"))).first()[0] == seg


@pytest.mark.parametrize("score,seg", [(2, "At Risk"), (4, "At Risk"), (5, "Needs Attention"),
                                       (7, "Loyal Customers"), (9, "Champions"), (10, "Champions"),
                                       (0, None)])
def test_score_segment(spark, score, seg):
    assert _one(spark, score_segment, score, "x int") == seg


def test_safe_divide(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, 2.0), (3.0, 2.0)], "a double, b double")
    rows = df.select(safe_divide("a", "b", 0).alias("d0"), safe_divide("a", "b").alias("dn")).collect()
    assert [r["d0"] for r in rows] == [0.0, 0.0, None, 1.5]
    assert [r["dn"] for r in rows] == [None, None, None, 1.5]


def test_text_helpers(spark):
    df = spark.createDataFrame([("  jean-luc ", "o'neil", "+1 (555) 010-99x")], "a string, b string, p string")
    r = df.select(clean_title("a").alias("a"), clean_title("b").alias("b"),
                  join_words(clean_title("a"), clean_title("b")).alias("full"),
                  digits_and_plus("p").alias("p")).first()
    assert r["a"] == "Jean-luc" and r["b"] == "O'neil"
    assert r["full"] == "Jean-luc O'neil"
    assert r["p"] == "+155501099"
    n = spark.createDataFrame([("x", None)], "a string, b string").select(join_words("a", "b")).first()[0]
    assert n is None
