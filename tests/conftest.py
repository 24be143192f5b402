"""One local session, and two ways to write events down.

``make_raw`` takes dicts that override a plain raw row; ``ord`` is the row's
position.  ``log`` reads clean events from text, one per line:

    2021-03-04 u3 purchase 12.5 SE

(day, user, type, and for what it matters amount and country; ``-`` is null).
"""

from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daybook.schema import CLEAN_EVENT_SCHEMA, RAW_EVENT_SCHEMA  # noqa: E402
from daybook.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

PLAIN = {"user_id": 31, "ts": "2021-03-04T05:06:07Z", "event_type": "signup", "amount": None,
         "country": "SE", "device": "ios", "session_id": 70}
FIRST_ID = 501


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="daybook-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def make_raw(spark):
    schema = "ord bigint, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_EVENT_SCHEMA)

    def make(rows):
        whole = [{"ord": i, "event_id": FIRST_ID + i} | PLAIN | row for i, row in enumerate(rows)]
        return spark.createDataFrame([tuple(r[c] for c in ("ord", *RAW_EVENT_SCHEMA.names)) for r in whole], schema)
    return make


@pytest.fixture
def log(spark):
    def read(text: str):
        rows = []
        for i, line in enumerate(filter(None, map(str.strip, text.splitlines()))):
            day, user, kind, amount, country = (line.split() + ["0", "SE"][max(0, len(line.split()) - 3):])[:5]
            noon = dt.datetime.fromisoformat(day).replace(hour=12, tzinfo=dt.timezone.utc)
            rows.append((FIRST_ID + i, None if user == "-" else int(user[1:]), noon, noon.date(), kind,
                         None if amount == "-" else float(amount), country, "ios", 70))
        return spark.createDataFrame(rows, CLEAN_EVENT_SCHEMA)
    return read
