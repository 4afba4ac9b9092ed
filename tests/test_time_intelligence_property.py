"""Time intelligence against a pandas brute force on random sparse series."""

import datetime as dt
from decimal import Decimal

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlens.plans import measures


def _months(start: dt.date, n: int):
    y, m = start.year, start.month
    out = []
    for _ in range(n):
        out.append(dt.date(y, m, 1))
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return out


def _brute(rows):
    """Per key: all months from its first sale to the last of the data; blank rules."""
    df = pd.DataFrame(rows, columns=["k", "d", "v"])
    df["p"] = df["d"].map(lambda d: dt.date(d.year, d.month, 1))
    out = {}
    end = df["p"].max()
    for k, g in df.groupby("k"):
        sums = g.groupby("p")["v"].sum().to_dict()
        months = _months(min(sums), 1 + (end.year - min(sums).year) * 12 + end.month - min(sums).month)
        idx = {p: i for i, p in enumerate(months)}
        for p in months:
            rev = sums.get(p)
            ytd = [sums.get(q) for q in months if q.year == p.year and q <= p]
            ytd_v = sum(x for x in ytd if x is not None) if any(x is not None for x in ytd) else None
            prev = sums.get(months[idx[p] - 1]) if idx[p] >= 1 else None
            ly = months[idx[p] - 12] if idx[p] >= 12 else None
            prev_y = sums.get(ly) if ly else None

            def growth(cur, pr):
                if pr is None or pr == 0:
                    return None
                return float((cur or 0) - pr) / float(abs(pr))
            pytd = None
            if ly is not None:
                vals = [sums.get(q) for q in months if q.year == ly.year and q <= ly]
                pytd = sum(x for x in vals if x is not None) if any(x is not None for x in vals) else None
            cum = [sums.get(q) for q in months if q <= p]
            out[(k, p)] = (rev, ytd_v, pytd, growth(rev, prev), growth(rev, prev_y),
                           sum(x for x in cum if x is not None))
    return out


rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b"]),
              st.dates(min_value=dt.date(2021, 11, 1), max_value=dt.date(2023, 3, 31)),
              st.integers(min_value=0, max_value=500).map(lambda x: Decimal(x))),
    min_size=1, max_size=25)


@settings(max_examples=12, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_time_intelligence_matches_brute_force(spark, rows):
    sales = spark.createDataFrame(rows, "k string, order_date date, net_revenue decimal(18,2)")
    got = {(r["k"], r["period"]): (r["revenue"], r["revenue_ytd"], r["revenue_pytd"], r["revenue_mom_growth"],
                                   r["revenue_yoy_growth"], r["cumulative_revenue"])
           for r in measures.time_intelligence(sales, ["k"], "month").collect()}
    assert got == _brute(rows)
