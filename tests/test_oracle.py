"""Every registered query against its DuckDB oracle (the driver's gate)."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, repr(round(v, 9)))
    if hasattr(v, "isoformat"):
        return (3, v.isoformat())
    return (4, str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_own_query_has_an_oracle():
    """The two documents are checked value by value as report_sections and its snapshot form."""
    missing = set(E._QUERIES) - set(E.oracle_sql())
    assert missing == {"report_document", "report_snapshot"}
    assert {"report_sections", "report_snapshot_sections"} <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["report"] and df.count() == 1
