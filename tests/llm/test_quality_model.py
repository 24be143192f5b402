"""The quality classifier: gradients, plain forward pass, held-out labels."""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.llm import quality

SMALL = quality.Limits(hidden=5, gate=3, steps=30, batch=8)
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def buffers(texts):
    raw = [t.encode() if isinstance(t, str) else t for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in raw]))).astype(np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), offsets


def plain_passages(text):
    """The text cut before every 64th word."""
    cuts = [m.start() for i, m in enumerate(WORD.finditer(text)) if i and i % quality.WORDS == 0]
    return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 200), st.sampled_from([" ", "\n", "  "]), st.sampled_from(["a", "éx", "日"])), max_size=6))
def test_passages_cut_at_words(shapes):
    texts = [(sep + (w + sep) * n).encode() for n, sep, w in shapes]
    data, offsets = buffers(texts)
    at, bags = quality.passages(data, offsets)
    cut = [data[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
    assert [cut[a:b] for a, b in zip(bags[:-1], bags[1:])] == [plain_passages(t) for t in texts]


def test_description_counts_bytes_and_words():
    data, offsets = buffers(["go go go é!", "", "other words here"])
    x = quality.describe(data, offsets)
    assert x.shape == (3, quality.WIDTH) and not x[1].any()
    assert x[0, ord("!")] == pytest.approx(math.sqrt(1 / 12)) and x[0, 128] == pytest.approx(math.sqrt(2 / 12))
    n, distinct, again, most, _ = x[0, -5:]
    assert (n, distinct, again, most) == pytest.approx((4 / 64, 2 / 4, 2 / 4, 3 / 4))
    # a passage is described alike wherever it stands
    assert np.array_equal(quality.describe(*buffers(["x" * 40 + " y", "go go go é!"]))[1], x[0])


def plain_logit(model, x):
    p = {k: v.astype(float) for k, v in model.weights.items()}
    h = [np.tanh(row @ p["W"] + p["b"]) for row in x.astype(float)]
    a = [np.exp(p["w"] @ (np.tanh(v @ p["V"]) / (1 + np.exp(-(v @ p["U"]))))) for v in h]
    z = sum(k * v for k, v in zip(a, h)) / sum(a)
    return p["c"] @ z + p["d"][0]


def bags_of(rng, sizes):
    return rng.random((sum(sizes), quality.WIDTH)).astype(np.float32), np.append(0, np.cumsum(sizes))


def test_score_is_the_weighted_representation():
    rng = np.random.default_rng(3)
    x, bags = bags_of(rng, [1, 4, 2])
    model = quality.GatedAttention(SMALL)
    found = model.bag_logits(*model.passage_scores(x), bags)
    assert found == pytest.approx([plain_logit(model, x[a:b]) for a, b in zip(bags[:-1], bags[1:])], abs=1e-4)


def test_gradient_equals_differences():
    rng = np.random.default_rng(4)
    x, bags = bags_of(rng, [2, 3, 1, 4])
    label = np.array([1, 0, 1, 0])
    model = quality.GatedAttention(SMALL)
    model.weights = {k: v.astype(float) for k, v in model.weights.items()}

    def loss():
        logit = model.bag_logits(*model.passage_scores(x), bags)
        return float(np.mean(np.logaddexp(0, logit) - label * logit))

    gradient = model._gradient(x, bags, label)
    for k, w in model.weights.items():
        for i in rng.choice(w.size, min(6, w.size), replace=False):
            keep = w.flat[i]
            w.flat[i] = keep + 1e-5
            up = loss()
            w.flat[i] = keep - 1e-5
            down = loss()
            w.flat[i] = keep
            assert np.ravel(gradient[k])[i] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_attention_finds_the_deciding_passage():
    """Bags are good but for one bad passage among good ones: only attention can tell them."""
    rng = np.random.default_rng(5)
    sizes = rng.integers(2, 9, 400)
    x, bags = bags_of(rng, sizes)
    x *= 0.1
    x[:, 7] = 0
    label = (rng.random(400) < 0.5).astype(np.float32)
    bad = [int(bags[i] + rng.integers(0, sizes[i])) if not label[i] else -1 for i in range(400)]
    x[[b for b in bad if b >= 0], 7] = 1
    model = quality.GatedAttention(quality.Limits(steps=800, batch=16)).fit(x[:bags[300]], bags[:301], label[:300])
    attention, own = model.passage_scores(x)
    logit = model.bag_logits(attention, own, bags)
    assert ((logit[300:] > 0) == label[300:]).mean() > 0.95
    hit = [np.argmax(attention[bags[i]:bags[i + 1]]) + bags[i] == bad[i] for i in range(300, 400) if bad[i] >= 0]
    assert np.mean(hit) > 0.9


@pytest.fixture(scope="module")
def given_rows(spark):
    folder = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet").cache(), spark.read.parquet(f"{folder}/labels.parquet").cache()


def test_held_out_labels(spark, given_rows):
    docs, labels = given_rows
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.5) and 0 <= r.top_passage < r.n_passages for r in rows)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and np.mean([a == b for a, b in held]) > 0.97
    bad = [a == b for a, b in held if b == 0]
    assert bad and np.mean(bad) > 0.85


def test_labels_of_held_out_rows_teach_nothing(given_rows):
    from pyspark.sql import functions as F

    docs, labels = given_rows
    other = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    few = docs.limit(300).cache()
    a, b = ({r.doc_id: r.score for r in quality.score_quality(few, x, SMALL).collect()} for x in (labels, other))
    assert a == b


def test_awkward_texts(spark, awkward, nothing):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(3, None, 0), (None, 1, 0), (4, 0, 1)],
                                   "doc_id long, quality int, text int")
    rows = quality.score_quality(awkward, labels, SMALL).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (0, 1)}
    assert len(empty) == 1 and all(not r.held_out for r in rows if r.doc_id is None)
    assert quality.score_quality(nothing, labels, SMALL).count() == 0
    ones = labels.where("quality = 1")
    assert {r.score for r in quality.score_quality(awkward, ones, SMALL).collect()} == {1.0}
    none = labels.where("quality = 7")
    assert {r.score for r in quality.score_quality(awkward, none, SMALL).collect()} == {0.5}


def test_sample_is_bounded(awkward, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    tight = quality.Limits(max_examples=12, max_passages=6, longest=2, hidden=4, gate=2, steps=3)
    assert quality.score_quality(awkward, labels, tight).count() == awkward.count()
