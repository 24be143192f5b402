"""Randomised differential test: the whole report against a plain-Python model.

Random raw events carry every kind of dirt (duplicate ids, bad and sentinel
timestamps, unknown and missing types, messy countries, NaN amounts); the
model applies the rules and metrics row by row, the way the reference's
documentation states them, and the Spark report must agree exactly.
"""

from __future__ import annotations

import datetime as dt
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from daybook.plans.report import build_report

TYPES = ["page_view", "page_view", "signup", "purchase", "refund", "click", None, "Purchase"]
COUNTRIES = ["US", "br", "  mx ", "", None, "NA", "   ", "de\t"]
VALID = {"page_view", "signup", "purchase", "refund"}


def _ts(rnd):
    r = rnd.random()
    if r < 0.05:
        return "2099-03-01 00:00:00"
    if r < 0.08:
        return "garbage"
    if r < 0.1:
        return None
    day = dt.date(2023, 1, 1) + dt.timedelta(days=rnd.randrange(12))
    return f"{day} {rnd.randrange(24):02d}:{rnd.randrange(60):02d}:00"


def _rows(seed, n, hot=False):
    """Random dirty rows; with ``hot``, one user, one day and one event id
    each hold about a third of them."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        etype = rnd.choice(TYPES)
        amount = round(rnd.uniform(1, 300), 2)
        if etype == "refund":
            amount = -amount
        if rnd.random() < 0.03:
            amount = math.nan
        row = {"event_id": rnd.randrange(n) if rnd.random() < 0.15 else n + i,
               "user_id": rnd.randrange(25), "ts": _ts(rnd), "event_type": etype,
               "amount": amount, "country": rnd.choice(COUNTRIES)}
        if hot:
            if rnd.random() < 1 / 3:
                row["user_id"] = 0
            if rnd.random() < 1 / 3:
                row["ts"] = "2023-01-05 12:00:00"
            if rnd.random() < 1 / 3:
                row["event_id"] = 7
        rows.append(row)
    return rows


def _r4(x):
    return float(np.round(x, 4))


def model(rows):
    survivors, counts = [], {"invalid_ts": 0, "invalid_etype": 0, "duplicate_event_id": 0}
    for r in rows:
        ts = r["ts"]
        try:
            t = dt.datetime.fromisoformat(ts) if ts else None
        except ValueError:
            t = None
        if t is None or t.year >= 2099:
            counts["invalid_ts"] += 1
            continue
        if r["event_type"] not in VALID:
            counts["invalid_etype"] += 1
            continue
        survivors.append((r, t))
    seen, clean = set(), []
    for r, t in survivors:                      # input order = first seen
        if r["event_id"] in seen:
            counts["duplicate_event_id"] += 1
            continue
        seen.add(r["event_id"])
        country = r["country"] if r["country"] not in (None, "") else "UNK"
        amount = r["amount"] if r["event_type"] in ("purchase", "refund") else 0.0
        clean.append({"user": r["user_id"], "date": t.date(), "type": r["event_type"],
                      "amount": None if isinstance(amount, float) and math.isnan(amount) else amount,
                      "country": country.upper().strip()})
    days = sorted({c["date"] for c in clean})
    users = defaultdict(set)
    for c in clean:
        users[c["date"]].add(c["user"])
    funnel, revenue, by_country = [], [], defaultdict(float)
    for d in days:
        rows_d = [c for c in clean if c["date"] == d]
        pv, su, pu = (sum(c["type"] == k for c in rows_d) for k in ("page_view", "signup", "purchase"))
        if pv + su + pu:
            funnel.append({"date": str(d), "pv": pv, "signup": su, "purchase": pu,
                           "pv_to_signup": _r4(su / pv) if pv else 0.0,
                           "signup_to_purchase": _r4(pu / su) if su else 0.0})
        money = [c["amount"] for c in rows_d if c["type"] in ("purchase", "refund")]
        if money:
            revenue.append((d, sum(a for a in money if a is not None)))
    for c in clean:
        if c["type"] in ("purchase", "refund"):
            by_country[c["country"]] += c["amount"] or 0.0
    top = sorted(by_country.items(), key=lambda kv: (-kv[1], kv[0]))[:10]
    first = {}
    for c in clean:
        first[c["user"]] = min(first.get(c["user"], c["date"]), c["date"])
    active = {(c["user"], c["date"]) for c in clean}
    last = max(days)
    cohorts = defaultdict(lambda: [0, 0])
    for u, d0 in first.items():
        cohorts[d0][0] += 1
        cohorts[d0][1] += (u, d0 + dt.timedelta(days=1)) in active
    retention = [{"cohort_date": str(d), "users": n, "retained": k, "rate": _r4(k / n)}
                 for d, (n, k) in sorted(cohorts.items()) if d < last]
    values = np.array([v for _, v in revenue])
    anomalies = []
    if len(values) >= 2 and values.std() > 0:
        z = (values - values.mean()) / values.std()
        anomalies = [{"date": str(d), "net_revenue": round(v, 2), "z": _r4(zz)}
                     for (d, v), zz in zip(revenue, z) if zz > 3]
    return {
        "range": {"start": str(days[0]), "end": str(days[-1])},
        "counts": {"raw_rows": len(rows), "valid_rows": len(clean),
                   "dropped_rows": len(rows) - len(clean), "breakdown": counts},
        "dau": [{"date": str(d), "dau": len(users[d])} for d in days],
        "funnel": funnel,
        "revenue_daily": [{"date": str(d), "net_revenue": round(v, 2)} for d, v in revenue],
        "top_countries": [{"country": k, "net_revenue": round(v, 2)} for k, v in top],
        "anomalies": sorted(anomalies, key=lambda a: (-a["z"], a["date"])),
        "retention_d1": retention,
    }


def _close(a, b, key=None):
    """Exact, except money, which may differ by a cent at binary ties (README)."""
    if isinstance(a, dict):
        return a.keys() == b.keys() and all(_close(a[k], b[k], k) for k in a)
    if isinstance(a, list):
        return len(a) == len(b) and all(_close(x, y, key) for x, y in zip(a, b))
    if key == "net_revenue":
        return abs(a - b) <= 0.0100001
    return a == b


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_report_matches_model(make_raw, seed):
    rows = _rows(seed, 400)
    report = build_report(make_raw(rows))
    got = report.to_dict()
    report.release()
    want = model(rows)
    for section in want:
        assert _close(got[section], want[section]), section


@pytest.mark.parametrize("seed", [4, 5])
def test_report_matches_model_with_hot_keys(make_raw, seed):
    rows = _rows(seed, 600, hot=True)
    report = build_report(make_raw(rows).repartition(8))
    got = report.to_dict()
    report.release()
    want = model(rows)
    for section in want:
        assert _close(got[section], want[section]), section


def test_spike_detected_end_to_end(make_raw):
    rows = [{"event_id": i, "user_id": i % 7, "ts": f"2023-02-{1 + i % 28:02d} 10:00:00",
             "event_type": "purchase", "amount": 10.0, "country": "US"} for i in range(280)]
    rows.append({"event_id": 999, "user_id": 1, "ts": "2023-02-05 11:00:00",
                 "event_type": "purchase", "amount": 5000.0, "country": "US"})
    report = build_report(make_raw(rows))
    got = report.to_dict()
    report.release()
    assert got["anomalies"] == model(rows)["anomalies"] and len(got["anomalies"]) == 1
