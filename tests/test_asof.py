"""The as-of join and refund witnesses against plain searches."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest

from daybook.operators import asof
from daybook.operators import quality as Q

T0 = dt.datetime(2021, 3, 1, tzinfo=dt.timezone.utc)


def at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


def plain_latest(probes, events):
    """(key, time, name) -> (id, time) of the latest earlier event, the smaller id first."""
    out = []
    for key, time, name in probes:
        best = None
        if key is not None and time is not None:
            for k, t, i in events:
                if k == key and t is not None and t < time:
                    place = (t, i is not None, -(i or 0))
                    if best is None or place > best[0]:
                        best = (place, (i, t))
        out.append((key, time, name, *(best[1] if best else (None, None))))
    return sorted(out, key=repr)


def found_latest(spark, probes, events, parts):
    p = spark.createDataFrame([(k, at(t), n) for k, t, n in probes], "k string, ts timestamp, name int")
    e = spark.createDataFrame([(k, at(t), i) for k, t, i in events], "k string, ts timestamp, id long")
    stored = []
    df = asof.latest_before(p, e, ["k"], "ts", "id", {"id": "e_id", "ts": "e_ts"}, parts=parts, stored=stored)
    rows = [(r.k, None if r.ts is None else int((r.ts.replace(tzinfo=dt.timezone.utc) - T0).total_seconds()), r.name, r.e_id,
             None if r.e_ts is None else int((r.e_ts.replace(tzinfo=dt.timezone.utc) - T0).total_seconds())) for r in df.collect()]
    asof.release(spark, stored)
    return sorted(rows, key=repr)


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_latest_before_equals_a_plain_search(spark, parts):
    """A hot key over all parts, ties in time, nulls, repeated probes and events."""
    rng = random.Random(parts)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    probes = [(rng.choice(keys), rng.choice([None, *range(300)]), n) for n in range(250)]
    events = [(rng.choice(keys), rng.choice([None, *range(0, 300, 7)]), rng.choice([None, *range(60)])) for _ in range(250)]
    probes += probes[:20] + [("never", 5, 1)]
    events += events[:20] + [("late", 290, 3)]
    assert found_latest(spark, probes, events, parts) == plain_latest(probes, events)


def test_only_probes_or_only_events(spark):
    assert found_latest(spark, [("a", 4, 1)], [], 3) == [("a", 4, 1, None, None)]
    assert found_latest(spark, [], [("a", 4, 1)], 3) == []
    # the only event of a hot key lies in the first part, all probes behind it
    probes = [("a", 10 + i, i) for i in range(200)]
    assert {r[3] for r in found_latest(spark, probes, [("a", 1, 77)], 20)} == {77}


def test_condition_hides_what_is_too_old(spark):
    p = spark.createDataFrame([("a", at(100)), ("a", at(11))], "k string, ts timestamp")
    e = spark.createDataFrame([("a", at(10), 5)], "k string, ts timestamp, id long")
    near = "unix_seconds(e_ts) >= unix_seconds(ts) - 30"
    from pyspark.sql import functions as F
    rows = asof.latest_before(p, e, ["k"], "ts", "id", {"id": "e_id", "ts": "e_ts"}, F.expr(near)).collect()
    assert sorted((r.e_id is None, r.e_ts is None) for r in rows) == [(False, False), (True, True)]


def plain_witnesses(rows, days=30):
    """(event_id, user, session, amount, ts) -> (copies, purchase id) of dict rows, by trying every pair."""
    out = {}
    for r in rows:
        if r["event_type"] != "refund":
            continue
        key = tuple(r[c] for c in ("event_id", "user_id", "session_id", "amount", "ts"))
        best = None
        for p in rows:
            if (p["event_type"] == "purchase" and None not in (r["user_id"], r["session_id"], r["amount"], p["amount"])
                    and (p["user_id"], p["session_id"]) == (r["user_id"], r["session_id"])
                    and abs(r["amount"] + p["amount"]) <= 1e-4 + 1e-5 * abs(p["amount"])):
                t, u = (dt.datetime.fromisoformat(x["ts"].replace("Z", "+00:00")) for x in (p, r))
                if t < u <= t + dt.timedelta(days=days):
                    best = max(best or (t, -p["event_id"]), (t, -p["event_id"]))
        copies = out.get(key, (0, None))[0] + 1
        out[key] = (copies, None if best is None else -best[1])
    return out


def witnesses(df):
    return {(r.event_id, r.user_id, r.session_id, r.amount, r.ts.strftime("%Y-%m-%dT%H:%M:%SZ")): (r.copies, r.purchase_id)
            for r in df.collect()}


@pytest.mark.parametrize("parts", [2, 30])
def test_witnesses_equal_a_plain_search(make_raw, parts):
    """One hot session with few amounts, near amounts, ties, copies and faults."""
    rng = random.Random(9)
    rows = []
    for _ in range(400):
        amount = rng.choice([10.0, 10.0, 10.00005, 10.5, 999.99, 1000.0, 0.0])
        kind = rng.choice(["purchase", "purchase", "refund", "signup"])
        day, second = rng.randrange(1, 70), rng.choice([0, 0, 0, 30])
        ts = (T0 + dt.timedelta(days=day, seconds=second)).strftime("%Y-%m-%dT%H:%M:%SZ")
        user, session = rng.choice([(7, 7)] * 6 + [(1, 2), (1, None), (None, 3)])
        rows.append({"user_id": user, "session_id": session, "event_type": kind, "ts": ts,
                     "amount": rng.choice([None, -amount, -amount, -amount]) if kind == "refund" else amount})
    rows += [dict(rows[i]) for i in range(40)]
    whole = [{"event_id": 501 + (i if i < 400 else i - 400)} | r for i, r in enumerate(rows)]
    raw = make_raw(whole)
    found = witnesses(Q.refund_witnesses(raw, parts=parts))
    assert found == plain_witnesses(whole)
    linked = {r.event_id for r in Q.refund_links(raw).where("status = 'linked'").collect()}
    assert linked == {k[0] for k, (_, p) in found.items() if p is not None}


def test_witness_limits(make_raw):
    """Exactly thirty days back counts, the same moment doesn't; unreadable times are left out."""
    rows = [{"event_type": "purchase", "amount": 5.0, "ts": "2021-03-01T00:00:00Z"},
            {"event_type": "refund", "amount": -5.0, "ts": "2021-03-31T00:00:00Z"},
            {"event_type": "refund", "amount": -5.0, "ts": "2021-03-31T00:00:01Z"},
            {"event_type": "refund", "amount": -5.0, "ts": "2021-03-01T00:00:00Z"},
            {"event_type": "refund", "amount": -5.0, "ts": "2099-03-01T00:00:00Z"},
            {"event_type": "refund", "amount": math.nan, "ts": "2021-03-02T00:00:00Z"}]
    got = {r.event_id: (r.purchase_id, r.lag_seconds, r.purchase_amount) for r in Q.refund_witnesses(make_raw(rows)).collect()}
    assert got == {502: (501, 30 * 86_400, 5.0), 503: (None, None, None), 504: (None, None, None), 506: (None, None, None)}
