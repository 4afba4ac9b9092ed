"""Classification ladders as JVM-side CASE expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Deal-size tiers, lower bounds inclusive (SQL ladder).
DEAL_TIERS = [(10000, "enterprise"), (1000, "mid_market"), (100, "smb")]
DEAL_TIER_ELSE = "micro"

# Right-closed bins (0,100], (100,1000], (1000,10000], (10000,inf)
# used by the demo variant; values <= 0 fall outside every bin.
DEAL_BINS = [(100, "micro"), (1000, "smb"), (10000, "mid_market")]
DEAL_BIN_TOP = "enterprise"

# Lifetime-value tiers, lower bounds inclusive.
LIFETIME_TIERS = [(100000, "Platinum"), (25000, "Gold"), (5000, "Silver")]
LIFETIME_TIER_ELSE = "Bronze"

# KPI status by target attainment.
KPI_STATUS = [(1.0, "On Track"), (0.85, "At Risk")]
KPI_STATUS_ELSE = "Behind"

# Demo segment cut on a 2..10 score, right-closed bins.
SCORE_SEGMENTS = [(4, "At Risk"), (6, "Needs Attention"), (8, "Loyal Customers"),
                  (10, "Champions")]

# The seven RFM segments, in evaluation order.
SEGMENTS = ["Champions", "Loyal Customers", "Recent Customers", "Potential Loyalists",
            "At Risk", "Lost", "Needs Attention"]
LIFETIME_TIER_VALUES = ["Platinum", "Gold", "Silver", "Bronze"]
STATUS_VALUES = ["completed", "pending", "shipped", "cancelled", "returned"]


def _ladder_ge(x: Column, steps, otherwise) -> Column:
    out = None
    for bound, label in steps:
        cond = x >= F.lit(bound)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(otherwise) if otherwise is not None else out


def deal_size_tier(amount: Column) -> Column:
    """>= 10000 enterprise, >= 1000 mid_market, >= 100 smb, else micro."""
    return _ladder_ge(amount, DEAL_TIERS, DEAL_TIER_ELSE)


def deal_size_bin(amount: Column) -> Column:
    """Right-closed binning: (0,100] micro ... (10000,inf) enterprise; <=0 or null -> null."""
    out = F.when(amount <= F.lit(0), F.lit(None).cast("string"))
    for bound, label in DEAL_BINS:
        out = out.when(amount <= F.lit(bound), label)
    return out.when(amount > F.lit(DEAL_BINS[-1][0]), DEAL_BIN_TOP)


def lifetime_tier(ltv: Column) -> Column:
    return _ladder_ge(F.coalesce(ltv, F.lit(0)), LIFETIME_TIERS, LIFETIME_TIER_ELSE)


def kpi_status(attainment: Column) -> Column:
    """On Track / At Risk / Behind; a blank attainment is Behind."""
    return _ladder_ge(attainment, KPI_STATUS, KPI_STATUS_ELSE)


def score_segment(score: Column) -> Column:
    """Right-closed cut of the demo RFM score; outside (0,10] -> null."""
    out = F.when(score <= F.lit(0), F.lit(None).cast("string"))
    for bound, label in SCORE_SEGMENTS:
        out = out.when(score <= F.lit(bound), label)
    return out


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Seven-way segment ladder; order matters (first match wins)."""
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
            .when((r >= 3) & (m >= 3), "Loyal Customers")
            .when(r >= 4, "Recent Customers")
            .when(f >= 4, "Potential Loyalists")
            .when((r <= 2) & (m >= 4), "At Risk")
            .when((r == 1) & (f == 1), "Lost")
            .otherwise("Needs Attention"))
