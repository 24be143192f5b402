"""Metrics M1–M5 on small logs, against sums done by hand or by numpy."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest

from daybook.operators import metrics as M
from daybook.schema import TOP_N


def by_date(df, *names):
    rows = {str(r["date"]): tuple(r[n] for n in names) for r in df.collect()}
    return {d: v[0] if len(names) == 1 else v for d, v in rows.items()}


def test_daily_users_are_distinct_and_need_an_id(log):
    df = log("""
        2021-03-04 u1 page_view
        2021-03-04 u1 refund -3
        2021-03-04 u2 signup
        2021-03-06 u2 page_view
        2021-03-06 -  page_view
        2021-03-07 -  page_view
    """)
    assert by_date(M.dau(df), "dau") == {"2021-03-04": 2, "2021-03-06": 1}
    assert by_date(M.dau(pairs=M.user_days(df)), "dau") == by_date(M.dau(df), "dau")


def test_funnel_counts_and_ratios(log):
    df = log("""
        2021-03-04 u1 page_view
        2021-03-04 u2 page_view
        2021-03-04 u3 page_view
        2021-03-04 u1 signup
        2021-03-04 u2 signup
        2021-03-04 u1 purchase 4
        2021-03-05 u1 purchase 4
        2021-03-06 u1 refund -4
        2021-03-07 u9 signup
    """)
    assert by_date(M.funnel_daily(df), "pv", "signup", "purchase", "pv_to_signup", "signup_to_purchase") == {
        "2021-03-04": (3, 2, 1, 0.6667, 0.5),
        "2021-03-05": (0, 0, 1, 0.0, 0.0),
        "2021-03-07": (0, 1, 0, 0.0, 0.0),
    }


def test_ratios_round_half_to_even(log):
    # 1/32 = 0.03125 and 3/32 = 0.09375 end in an exact half at four places
    for signups, rate in ((1, 0.0312), (3, 0.0938)):
        df = log("2021-03-04 u1 page_view\n" * 32 + "2021-03-04 u1 signup\n" * signups)
        assert by_date(M.funnel_daily(df), "pv_to_signup") == {"2021-03-04": rate}


def test_revenue_nets_and_skips_days_without_money(log):
    df = log("""
        2021-03-04 u1 purchase 12.5
        2021-03-04 u2 purchase 0.25
        2021-03-04 u1 refund -2.75
        2021-03-05 u1 page_view
        2021-03-06 u1 refund -8
        2021-03-07 u1 purchase -
        2021-03-08 u1 purchase 9
        2021-03-08 u1 refund -9
    """)
    assert by_date(M.revenue_daily(df), "net_revenue") == {
        "2021-03-04": 10.0, "2021-03-06": -8.0, "2021-03-07": 0.0, "2021-03-08": 0.0}
    none = M.revenue_daily(log("2021-03-04 u1 page_view"))
    assert none.columns == ["date", "net_revenue"] and none.count() == 0


def test_money_is_the_same_rows_in_every_metric(log):
    """Days' and countries' totals cover the same purchases and refunds."""
    rnd = random.Random(8)
    lines, want = [], defaultdict(float)
    for _ in range(300):
        kind = rnd.choice(["purchase", "refund", "page_view"])
        amount = rnd.randrange(-400, 400) / 4
        country = rnd.choice("SE NO DK FI IS EE LV LT PL DE NL BE FR".split())
        lines.append(f"2021-03-{rnd.randrange(1, 28):02d} u{rnd.randrange(9)} {kind} {amount} {country}")
        if kind != "page_view":
            want[country] += amount
    df = log("\n".join(lines))
    top = M.top_countries(df).orderBy("rank").collect()
    best = sorted(want.items(), key=lambda kv: (-kv[1], kv[0]))[:TOP_N]
    assert [(r["country"], r["net_revenue"]) for r in top] == best
    assert [r["rank"] for r in top] == list(range(1, TOP_N + 1))
    assert sum(by_date(M.revenue_daily(df), "net_revenue").values()) == sum(want.values())
    assert [r["country"] for r in M.top_countries(df, n=2).orderBy("rank").collect()] == [c for c, _ in best[:2]]


def test_equal_countries_go_by_name(log):
    df = log("""
        2021-03-04 u1 purchase 5 NO
        2021-03-04 u1 purchase 5 DK
        2021-03-04 u1 purchase 5.004 SE
        2021-03-04 u1 page_view 99 IS
    """)
    rows = M.top_countries(df).orderBy("rank").collect()
    assert [(r["country"], r["net_revenue"]) for r in rows] == [("SE", 5.0), ("DK", 5.0), ("NO", 5.0)]


def series(spark, values):
    start = dt.date(2021, 3, 4)
    return spark.createDataFrame([(start + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)],
                                 "date date, net_revenue double")


@pytest.mark.parametrize("values", [
    [], [41.0], [6.0, 6.0, 6.0],                                # nothing to compare, or no spread
    [3, 5, 4, 6, 5, 4, 3, 5, 4, 6, 5, 4, 77],                   # one far above
    [3, 5, 4, 6, 5, 4, 3, 5, 4, 6, 5, 4, -77],                  # far below is no anomaly
    [0] * 9 + [10],                                             # exactly three deviations: not above
])
def test_anomalies_are_days_above_three_deviations(spark, values):
    got = M.order_anomalies(M.anomalies(series(spark, values))).collect()
    v = np.array(values, float)
    z = (v - v.mean()) / v.std() if len(v) > 1 and v.std() else np.zeros(len(v))
    assert [(r["net_revenue"], r["z"]) for r in got] == [(v[i], round(z[i], 4)) for i in np.flatnonzero(z > 3 + 1e-12)]


def test_anomalies_come_highest_first(spark):
    low = M.order_anomalies(M.anomalies(series(spark, [1, 1, 1, 1, 1, 9, 1, 11, 9]), threshold=1.0)).collect()
    assert [r["net_revenue"] for r in low] == [11.0, 9.0, 9.0] and low[1]["date"] < low[2]["date"]


def test_date_range(log):
    df = log("2021-03-09 u1 refund -1\n2021-03-04 u1 page_view")
    row = M.date_range(df).first()
    assert (str(row["start"]), str(row["end"])) == ("2021-03-04", "2021-03-09")
