"""Periodic runs against a direct scan of every period."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.llm import periodic, registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w):
    """(start, length, period) of all runs: for each period the stretches that keep it, the smallest period first."""
    found, w = {}, np.unique(np.array(w, object).astype(str), return_inverse=True)[1] if len(w) else np.zeros(0, int)
    for q in range(1, len(w) // 2 + 1):
        edge = np.flatnonzero(np.diff(np.concatenate(([0], w[q:] == w[:-q], [0]))))
        for s, stop in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if stop - s + q >= max(12, 2 * q):
                found.setdefault((s, stop - s + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, plant=True):
    w = WORD.findall(text or "")
    if plant and doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return runs, " ".join(x for i, x in enumerate(w) if i not in gone)


def spell(texts):
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    return np.array([x for t in texts for x in t], np.int64), offsets


def runs_of(texts):
    codes, offsets = spell(texts)
    start, length, period = periodic.find_runs(codes, offsets)
    out = [[] for _ in texts]
    for s, n, q in zip(start.tolist(), length.tolist(), period.tolist()):
        t = int(np.searchsorted(offsets, s, "right")) - 1
        out[t].append((s - int(offsets[t]), n, q))
    return out


repeated = st.builds(lambda w, n, at, x: [x if i == at else w[i % len(w)] for i in range(n)],
                     st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(0, 60), st.integers(0, 80), st.integers(0, 3))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(repeated, st.lists(st.integers(0, 2), max_size=60)), min_size=1, max_size=5))
def test_runs_equal_a_direct_scan(texts):
    assert runs_of(texts) == [plain_runs(t) for t in texts]


def test_same_words_in_two_texts_are_no_run():
    assert runs_of([[1, 2, 3, 4, 5, 6, 7], [1, 2, 3, 4, 5, 6, 7]]) == [[], []]
    assert runs_of([[5] * 11, [5] * 12]) == [[], [(0, 12, 1)]]


def test_pairs_stay_few_on_very_periodic_texts():
    """One word a hundred thousand times, and a list whose items differ in their first word only."""
    n = 100_000
    assert runs_of([[7] * n]) == [[(0, n, 1)]]
    assert runs_of([[x for i in range(8_000) for x in [100 + i, *range(9)]]]) == [[]]
    a, b = [0], [0, 1]
    while len(b) < 2_000:
        a, b = b, b + a
    assert runs_of([b]) == [plain_runs(b)]


def check(rows, docs):
    want = {}
    for doc_id, text in docs:
        want.setdefault(doc_id, []).append((text or "", *plain_row(doc_id, text)))
    for r in rows:
        runs, collapsed = [tuple(x) for x in r.runs], r.collapsed
        assert any((runs, collapsed) == w[1:] for w in want[r.doc_id])
    assert len(rows) == len(docs)


def test_operator_on_awkward_and_given_texts(awkward, sample):
    for docs in (awkward, sample):
        check(periodic.periodic_runs(docs, plant=True).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_without_planting(spark, nothing):
    docs = spark.createDataFrame([(i, "a b c " * 6 + "x") for i in range(30)] + [(None, "q " * 30), (7, None)], "doc_id long, text string")
    rows = periodic.periodic_runs(docs).collect()
    assert all([tuple(x) for x in r.runs] == [(0, 18, 3)] and r.collapsed == "a b c x" for r in rows[:30])
    assert [tuple(x) for x in rows[30].runs] == [(0, 30, 1)] and rows[30].collapsed == "q"
    assert rows[31].runs == [] and rows[31].collapsed == ""
    assert periodic.periodic_runs(nothing).count() == 0


def test_registered_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = registry.QUERIES["op13_periodic_runs"](spark, SF001).collect()
    assert len(rows) == len(docs) and any(r.n_runs for r in rows)
    for r in rows:
        runs, collapsed = plain_row(r.doc_id, docs[r.doc_id])
        top = min(((-n, s, q) for s, n, q in runs), default=None)
        want = (-top[0], top[1], top[2], -top[0] * 1000 // top[2]) if top else (None,) * 4
        assert (r.length, r.start, r.period, r.exponent_milli) == want and r.n_runs == len(runs)
        spelt = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r.runs_sha256 == hashlib.sha256(spelt.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed.encode()).hexdigest()
