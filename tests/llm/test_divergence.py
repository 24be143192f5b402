"""Source divergence against a plain count over all terms and sources."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.llm import divergence

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall((text or "").encode().lower())


def plain_divergence(rows, least=3, top=200):
    """(lang, source, part, item) -> (value, rank) of rows (text, lang, source)."""
    groups, df = {}, {}
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = terms_of(text)
        groups.setdefault(lang, {}).setdefault(source, Counter()).update(words)
        df.setdefault(lang, Counter()).update(set(words))
    out = {}
    for lang, sources in groups.items():
        kept = [w for w, n in df[lang].items() if n >= least]

        def shares(counts):
            total = sum(counts[w] for w in kept)
            return {w: 1 + 10 ** 9 * (counts[w] + 1) // (total + len(kept)) for w in kept}

        p = {s: shares(c) for s, c in sources.items()}
        q = shares(sum(sources.values(), Counter()))
        for s in sources:
            pair = [(-sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept), o.encode()) for o in sources if o != s]
            term = [(-((p[s][w] - q[w]) ** 2 // q[w]), w) for w in kept if sources[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                for rank, (value, item) in enumerate(found, 1):
                    out[lang, s, part, item.decode()] = (-value, rank)
    return out


def result(df):
    rows = df.collect()
    out = {(r.lang, r.source, r.part, r.item): (r.value, r.rank) for r in rows}
    assert len(out) == len(rows)
    return out


def plain_rows(docs):
    return [(r.text, r.lang, r.source) for r in docs.collect()]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text(st.sampled_from("abAB é日 ,1"), max_size=40), st.integers(0, 2)), max_size=8))
def test_sorted_pointers_count_terms(rows):
    texts = [t.encode() for t, _ in rows]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    group = np.array([g for _, g in rows], np.int64)
    low, start, size, own, n, documents = divergence.count_terms(data, offsets, group)
    found = {(low[a:a + k].tobytes(), g): (c, d) for a, k, g, c, d in zip(start, size, own, n, documents)}
    counts, df = Counter(), Counter()
    for t, g in rows:
        for w, c in Counter(terms_of(t)).items():
            counts[w, g] += c
            df[w, g] += 1
    assert found == {k: (c, df[k]) for k, c in counts.items()} and len(start) == len(found)


def test_words_equal_in_many_slices_are_told_apart():
    words = [b"a" * n for n in (7, 8, 9, 16, 17, 40, 41)] + [b"a" * 39 + b"b", b"b"] * 3
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts, sizes = divergence.word_pointers(data, np.array([0, len(data)]))
    order, new = divergence.sort_pointers(data, starts, sizes)
    assert [words[i] for i in order] == sorted(words)
    assert int(new.sum()) == len(set(words))


@pytest.mark.parametrize("blocks", [256, 2])
def test_awkward_and_given_texts(awkward, sample, nothing, blocks, monkeypatch):
    """Also with lists of two sources, so that blocks of one term meet each other."""
    monkeypatch.setattr(divergence, "_BLOCK_SOURCES", blocks)
    for docs in (awkward, sample):
        assert result(divergence.source_divergence(docs)) == plain_divergence(plain_rows(docs))
    assert divergence.source_divergence(nothing).count() == 0


def test_groups_and_languages_without_terms(spark):
    rows = [("x y z", "en", "a"), ("x y", "en", "b"), ("x 1 2", "en", None), (None, "en", "none"), ("", "en", "a"),
            ("only here", "de", "a"), (None, "de", "b"), (None, None, None), ("x x x x", "en", "a"), ("x x x x", "en", "a")]
    docs = spark.createDataFrame([(i, *r, "c") for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, term string")
    found = result(divergence.source_divergence(docs, top_terms=1))
    assert found == plain_divergence(rows, top=1)
    assert found["de", "a", "pair", "b"] == (0, 1) and ("en", "none", "pair", "a") in found
    assert not any(k[0] == "" for k in found)


def test_shares_are_exact_for_large_counts(spark):
    n, total, kept = 812_345_678_901_234, 9_007_199_254_740_993, 50_000_001
    row = spark.range(1).select(divergence._share(f"{n}L", f"{total}L", f"{kept}L").alias("p")).first()
    assert row.p == 1 + 10 ** 9 * (n + 1) // (total + kept)
