"""SimHash, repeated strings, components and toxicity against plain versions."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.llm import repeats, simhash, toxicity
from daybook.llm.common import Scratch
from daybook.llm.components import connected_components


def plain_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b) and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_connected_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (35, 2))] + [(i, i + 1) for i in range(100, 160)]
    edges += [(500, n) for n in range(501, 540)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    found = {r.node: r.label for r in connected_components(df, Scratch(spark, "test")).collect()}
    both = {(a, b) for a, b in edges} | {(b, a) for a, b in edges}
    plain = plain_components(sorted({n for e in edges if None not in e and e[0] != e[1] for n in e}),
                             lambda a, b: (a, b) in both)
    assert found == plain


# --- SimHash --------------------------------------------------------------

def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("table", ["awkward", "sample", "nothing"])
def test_simhash_groups(request, table):
    docs = request.getfixturevalue(table)
    rows = docs.select("doc_id", "text").collect()
    fps = {plain_fingerprint(r.text) for r in rows}
    group = plain_components(sorted(fps), lambda a, b: bin(a ^ b).count("1") <= 4)
    smallest = {}
    for r in rows:
        g = group[plain_fingerprint(r.text)]
        if r.doc_id is not None:
            smallest[g] = min(smallest.get(g, r.doc_id), r.doc_id)
    expected = sorted(((r.doc_id, f"{plain_fingerprint(r.text):016x}", smallest.get(group[plain_fingerprint(r.text)]))
                       for r in rows), key=str)
    found = simhash.simhash_groups(docs)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found.collect()), key=str) == expected


def test_dense_values_are_split(spark):
    rng = np.random.default_rng(2)
    centre = int(rng.integers(0, 2**62))
    fps = {centre}
    for _ in range(300):
        x = centre
        for b in rng.integers(0, 64, int(rng.integers(0, 4))).tolist():
            x ^= 1 << b
        fps.add(x)
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    scratch = Scratch(spark, "test")
    for tile in (20, 8192):
        links = simhash.near_duplicates(df, scratch, tile=tile)
        rows = links.collect()
        assert all(bin((r.u ^ r.v) & (2**64 - 1)).count("1") <= 4 for r in rows)
        found = {r.node: r.label for r in connected_components(links, scratch).collect()}
        plain = plain_components(sorted(signed), lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1") <= 4)
        assert {n: found.get(n, n) for n in signed} == plain


def test_segments_cover_every_split_of_the_distance():
    for k, n in ((4, 3), (3, 4), (5, 2), (0, 2)):
        parts = simhash.segments(k, n)
        radius = [r for *_, r in parts] + [-1] * (n - len(parts))
        worst = sum(r + 1 for r in radius)
        assert worst > k                          # more than k bits are needed to miss all segments


# --- repeated strings -----------------------------------------------------

def plain_repeats(texts, length):
    """Remaining bytes and removed runs of each text."""
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] = seen.get(t[i:i + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(t), int(gone.sum()), runs, bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


def test_many_copies_of_a_partly_shared_text(spark):
    """Copies are one entry after the first join; their cover and that of the others stay exact."""
    rng = random.Random(12)

    def text(n):
        return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(3000)}" for _ in range(n))

    shared, own, tail = text(300), [text(150) for _ in range(4)], text(90)
    hot = own[0] + shared + own[1]
    texts = [hot] * 400 + [own[2] + shared[:900] + own[3], tail + shared[500:1400], tail, own[1][:390]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(docs).collect()}
    assert found == dict(enumerate(plain_repeats([t.encode() for t in texts], 400)))
    assert found[0][3] == b"" and found[403][1] == 0


@pytest.mark.parametrize("table", ["awkward", "sample", "nothing"])
def test_repeats_removed(request, table):
    docs = request.getfixturevalue(table)
    rows = docs.select("doc_id", "text").collect()
    plain = plain_repeats([(r.text or "").encode() for r in rows], 400)
    expected = sorted(((r.doc_id, *p) for r, p in zip(rows, plain)), key=str)
    found = repeats.remove_repeats(docs, bucket_rows=500).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found), key=str) == expected


def periodic_texts():
    rng = np.random.default_rng(9)
    base = "".join(rng.choice(list("abé"), 200))
    return [base, base[20:90], "x" + base[50:130] + "y" + base[60:100], "a" * 70, "ab" * 40, "", base[:11],
            "".join(rng.choice(list("ab"), 150))]


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_runs_hold_every_window_once(monkeypatch, block):
    """Also those that a block's end cuts."""
    monkeypatch.setattr(repeats, "_BLOCK", block)
    data = [t.encode() for t in periodic_texts()]
    offsets = np.cumsum([0, *map(len, data)])
    of, first, last, *_ = repeats.anchor_runs(np.frombuffer(b"".join(data), np.uint8), offsets, 24, 4)
    covered = sorted((d, p) for d, a, b in zip(of.tolist(), first.tolist(), last.tolist()) for p in range(a, b + 1))
    assert covered == [(d, p) for d, t in enumerate(data) for p in range(len(t) - 23)]


def test_short_strings(spark):
    """Periodic texts and overlaps."""
    texts = periodic_texts()
    plain = plain_repeats([t.encode() for t in texts], 24)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = repeats.remove_repeats(docs, length=24, gram=4, bucket_rows=30).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found] == plain
    whole = repeats.remove_repeats(docs, length=24, gram=4, whole_characters=True).orderBy("doc_id").collect()
    for r, p in zip(whole, plain):
        assert r.kept.decode() is not None and r.n_removed <= p[1]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=30))
def test_multikey_order(rows):
    keys = [np.array(k) for k in zip(*rows)]
    order = repeats.multikey_order(*keys)
    assert [rows[i] for i in order] == sorted(rows)


# --- toxicity -------------------------------------------------------------

def toxic_corpus(spark, n=600):
    rng = np.random.default_rng(1)
    plain = [f"w{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        words = rng.choice(plain, 40).tolist()
        toxic = i % 7 == 0
        if toxic:
            for w in rng.choice(["vile", "foul", "rotten"], 4):
                words[int(rng.integers(40))] = str(w)
        docs.append((i, " ".join(words), "x"))
        if i % 4:
            labels.append((i, 1, int(toxic)))
    docs += [(n, None, "x"), (n + 1, "", "x"), (n + 2, "vile foul vile " * 9000, "x"), (None, "rotten vile", "x"), docs[7]]
    labels += [(None, 1, 1), (5, 1, None), (9, 0, 0), (9, 0, 0)]
    return (spark.createDataFrame(docs, "doc_id bigint, text string, evidence string"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_toxicity_scores(spark):
    docs, labels = toxic_corpus(spark)
    found = toxicity.score_toxicity(docs, labels).collect()
    assert len(found) == docs.count()
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if r.doc_id is not None and r.doc_id < 600:
            assert r.predicted == int(r.doc_id % 7 == 0)
    by_id = {r.doc_id: r for r in found}
    assert by_id[602].predicted == 1 and by_id[None].predicted == 1
    assert by_id[600].score == by_id[601].score < 0.1
    assert all(e.toxic == 1 and e.cosine <= 1 + 1e-9 for e in by_id[602].evidence)


def test_scores_equal_a_plain_computation(spark):
    """Votes over all examples but the text itself, by full cosines; then the fitted levels."""
    docs, labels = toxic_corpus(spark, 300)
    limits = toxicity.Limits(k=7, block=16)
    model = toxicity.fit_model(docs, labels, limits)
    index, texts = model.index, {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}
    own_text = {i: texts[i] for i in index.ids.tolist()}
    rows = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels, limits).collect() if r.doc_id is not None}
    vectors = [dict(index.vector(toxicity.term_counts(own_text[i].encode()))) for i in index.ids.tolist()]
    assert any(texts[i] == own_text[j] for i in texts for j in own_text)
    for doc_id, text in texts.items():
        q = dict(index.vector(toxicity.term_counts(text.encode())))
        near = sorted(((-sum(w * q.get(t, 0) for t, w in v.items()), i, int(t)) for i, t, v in
                       zip(index.ids.tolist(), index.toxic, vectors) if own_text[i] != text))[:limits.k]
        near = [n for n in near if n[0] < 0]
        weights = [1 / (1.05 - min(-c, 1)) for c, _, _ in near]
        vote = sum(w * t for w, (_, _, t) in zip(weights, near)) / sum(weights) if near else -1.0
        at = max(0, int(np.searchsorted(model.levels, vote + 1e-12, "right")) - 1)
        below = max(0, int(np.searchsorted(model.levels, vote - 1e-12, "right")) - 1)
        assert any(rows[doc_id].score == pytest.approx(float(model.probability[k])) for k in (at, below))
        shown = [e.doc_id for e in rows[doc_id].evidence]
        assert all(own_text[i] != text for i in shown) and len(shown) == min(3, len(near))


@pytest.mark.parametrize("percent", [20, 50, 80])
def test_toxicity_at_every_base_rate(spark, percent):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        words = rng.choice([f"w{j}" for j in range(200)], 40).tolist()
        toxic = i % 100 * 7 % 100 < percent
        if toxic:
            words[:5] = rng.choice(["vile", "foul", "rotten"], 5).tolist()
        elif i % 9 == 0:
            words[0] = "foul"                      # a term needn't be pure
        rows.append((i, " ".join(words), 1, int(toxic)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, quality int, toxic int")
    found = toxicity.score_toxicity(table.select("doc_id", "text"), table.drop("text")).collect()
    toxic = {r[0]: r[3] for r in rows}
    held = [(toxic[r.doc_id], r.predicted) for r in found if r.held_out]
    assert len(held) > 150 and sum(t == p for t, p in held) >= 0.95 * len(held)
    assert all(r.evidence for r in found if toxic[r.doc_id])


def test_held_out_labels_are_not_read(spark):
    docs, labels = toxic_corpus(spark, 200)
    turned = labels.selectExpr("doc_id", "quality", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1, 1 - toxic, toxic) AS toxic")
    a, b = (sorted((str(r.doc_id), r.score) for r in toxicity.score_toxicity(docs, x).collect()) for x in (labels, turned))
    assert a == b


def test_toxicity_without_labels_or_rows(spark, nothing):
    docs, labels = toxic_corpus(spark, 20)
    assert {r.score for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score_toxicity(nothing, labels).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdef"), min_size=1, max_size=6), min_size=1, max_size=40),
       st.lists(st.sampled_from("abcdefg"), max_size=6), st.integers(1, 6))
def test_nearest_is_exact(examples, text, k):
    limits = toxicity.Limits(k=k, block=4)
    counts = [toxicity.Counter(w.encode() for w in e) for e in examples]
    idf = {w.encode(): 1.0 + i for i, w in enumerate("abcdef")}
    index = toxicity.Index(np.arange(len(counts)), np.zeros(len(counts)), counts, idf, limits)
    query = index.vector(toxicity.Counter(w.encode() for w in text))
    rows, cosines = index.nearest(query)
    q = dict(query)
    plain = [sum(w * q.get(t, 0) for t, w in index.vector(c)) for c in counts]
    best = sorted((c for c in plain if c > 0), reverse=True)[:k]
    assert np.allclose(cosines, best) and np.allclose([plain[r] for r in rows], cosines)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("abAé -"), max_size=40), min_size=1, max_size=4), st.randoms())
def test_reader_counts_known_terms(texts, rnd):
    every = sorted({w for t in texts for w in toxicity.term_counts(t.encode())})
    known = set(rnd.sample(every, len(every) // 2))
    for remember in (2, 1000):
        read = toxicity.TermReader(known, remember)
        for t in texts:
            assert read(t.encode()) == {w: n for w, n in toxicity.term_counts(t.encode()).items() if w in known}


def test_monotone_fit():
    votes = np.array([-1, -1, 0.2, 0.2, 0.5, 0.9, 0.9, 0.95])
    levels, p = toxicity.monotone_fit(votes, np.array([0, 0, 1, 0, 0, 1, 1, 1.0]))
    assert (np.diff(levels) > 0).all() and (np.diff(p) > 0).all() and levels[0] == -1
