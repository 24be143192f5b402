"""Cleaning rules as tables of boundary cases, and the drop accounting against a plain model."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest

from daybook.operators.clean import clean_counts, clean_events, clean_with_counts, tag_rules
from daybook.schema import CLEAN_EVENT_SCHEMA, RULES, VALID_EVENT_TYPES

# text, and its UTC instant; None: not a timestamp
STAMPS = [
    ("2021-03-04T05:06:07Z", "2021-03-04 05:06:07"),
    ("2021-03-04 05:06:07.250", "2021-03-04 05:06:07.25"),
    ("2021-03-04T23:50:00-00:30", "2021-03-05 00:20:00"),
    ("2021-03-04 00:10+01:00", "2021-03-03 23:10:00"),
    ("2021-3-4 05:06:07", "2021-03-04 05:06:07"),
    ("  2021-03-04  ", "2021-03-04 00:00:00"),
    ("2021-03", "2021-03-01 00:00:00"),
    ("2098-12-31T23:59:59Z", "2098-12-31 23:59:59"),
    ("2099-01-01T00:30:00+01:00", "2098-12-31 23:30:00"),
    ("2098-12-31T23:30:00-01:00", None),                # 2099 in UTC
    ("2099-07-01", None),
    ("2150-01-01 00:00:00", None),
    ("12:30:00", None),                                 # a time of day alone
    ("T08:00", None),
    ("2021", None),                                     # a bare number
    ("2021-02-30", None),
    ("2021-03-04 25:00:00", None),
    ("04/03/2021", None),
    ("yesterday", None),
    ("", None),
    (None, None),
]


def stamps(make_raw):
    df = tag_rules(make_raw([{"ts": t} for t, _ in STAMPS])).orderBy("ord")
    return [None if r.rule else r.micros for r in df.selectExpr("rule", "ord", "unix_micros(ts) AS micros").collect()], \
        [None if r.rule else r.date for r in df.collect()]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_timestamps_in_any_session_zone(spark, make_raw, zone):
    was = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        micros, dates = stamps(make_raw)
    finally:
        spark.conf.set("spark.sql.session.timeZone", was)
    for (text, utc), got, date in zip(STAMPS, micros, dates):
        if utc is None:
            assert got is None, text
        else:
            want = dt.datetime.fromisoformat(utc).replace(tzinfo=dt.timezone.utc)
            assert got == round(want.timestamp() * 1e6) and date == want.date(), text


@pytest.mark.parametrize("value", [None, "", "se", "sE", "\t no\n", "   ", "NA", "UNK", "é", "straße",
                                   " gb ", "ﬁ"])
def test_country_is_filled_then_raised_then_stripped(make_raw, value):
    got = clean_events(make_raw([{"country": value}])).first()["country"]
    assert got == (value or "UNK").upper().strip()


def test_only_the_allowlist_survives_and_only_money_keeps_its_amount(make_raw):
    kinds = [*VALID_EVENT_TYPES, *map(str.upper, VALID_EVENT_TYPES), "login", " refund", "", None]
    df = make_raw([{"event_type": k, "amount": a} for k in kinds for a in (7.25, -7.25, math.nan, None)])
    rows = clean_events(df).orderBy("event_id").collect()
    assert [r["event_type"] for r in rows] == [k for k in VALID_EVENT_TYPES for _ in range(4)]
    for r, amount in zip(rows, [7.25, -7.25, None, None] * 4):
        assert r["amount"] == (amount if r["event_type"] in ("purchase", "refund") else 0.0)
    assert clean_counts(df).first()["breakdown"]["invalid_etype"] == 4 * (len(kinds) - 4)


def plain_model(rows):
    """(event_id, ord) of the survivors and the count of each rule, row by row."""
    seen, kept, dropped = set(), [], dict.fromkeys(RULES, 0)
    for i, r in enumerate(rows):
        if r["ts"] is None or r["ts"].startswith(("2099", "n")):
            dropped["invalid_ts"] += 1
        elif r["event_type"] not in VALID_EVENT_TYPES:
            dropped["invalid_etype"] += 1
        elif r["event_id"] in seen:
            dropped["duplicate_event_id"] += 1
        else:
            seen.add(r["event_id"])
            kept.append((r["event_id"], i))
    return kept, dropped


@pytest.mark.parametrize("seed,hot", [(1, 0.0), (2, 0.4), (3, 0.9)])
def test_first_valid_copy_wins_and_every_drop_is_counted(make_raw, seed, hot):
    rnd = random.Random(seed)
    rows = [{"event_id": 1 if rnd.random() < hot else rnd.randrange(60), "user_id": i,
             "ts": rnd.choice(["2021-03-04", "2021-03-05", "2099-09-09", "never", None]),
             "event_type": rnd.choice([*VALID_EVENT_TYPES, "login"])} for i in range(400)]
    kept, dropped = plain_model(rows)
    clean, counts, _ = clean_with_counts(make_raw(rows).repartition(7))
    # users are numbered by position, so they tell which copy stayed
    assert sorted((r.event_id, r.user_id) for r in clean.collect()) == sorted(kept)
    row = counts.first()
    assert row["breakdown"].asDict() == dropped
    assert (row["raw_rows"], row["valid_rows"], row["dropped_rows"]) == (400, len(kept), 400 - len(kept))
    assert clean_counts(make_raw(rows)).first() == row


def test_rows_without_ids_are_counted(make_raw):
    df = make_raw([{"event_id": None}, {"user_id": None}, {"session_id": None, "user_id": None}, {}])
    assert clean_counts(df).first()["null_id_rows"] == 3


def test_first_seen_without_an_order_column(spark):
    rows = [(9, 30 + i, "2021-03-04", "page_view", 0.0, "SE", "web", 1) for i in range(50)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts string, event_type string, "
                                     "amount double, country string, device string, session_id long")
    assert clean_events(df.coalesce(1)).first()["user_id"] == 30


def test_clean_schema_and_chosen_columns(make_raw):
    df = clean_events(make_raw([{}]))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in CLEAN_EVENT_SCHEMA]
    assert clean_events(make_raw([{}]), ("date", "user_id")).columns == ["event_id", "date", "user_id"]
    with pytest.raises(ValueError, match="nonsense"):
        clean_events(make_raw([{}]), ("nonsense",))
