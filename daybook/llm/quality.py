"""Document quality by attention-based multiple-instance learning (operator 12).

A document is a bag of passages of ``WORDS`` words; only the document has a label.

Encoding.  A passage is described by the square roots of its bytes' shares, hashed
words, and how often words recur; a learned layer makes that h = tanh(W x + b).
Attention.  A learned gate weighs the passages: a_k is the softmax over a document's
passages of w . (tanh(V h_k) * sigmoid(U h_k)).
Score.  The logistic of c . z + d for the weighted representation z = sum a_k h_k.

All weights are learned together from the documents' labels by gradient
descent (Adam) on the cross entropy.  The model is fitted on a bounded sample
of rows whose crc32(doc_id) mod 3 is not 1: at most ``max_examples`` labelled
documents, by hash of the id, and as many of them as have ``max_passages``
passages together, leaving out those of more than ``longest`` passages.
Passages are described on the executors; only the sample's descriptions reach
the driver.  Scoring is one map over whole texts, block by block: a passage
leaves two numbers, its attention and its own score, so memory doesn't grow
with a document's length beyond its text.

Neither labels nor language, source or id enter a text's score.

Defined results: null or empty text is one passage without words; repeated
rows get equal scores; a document labelled more than once is good if all labels
say so; null labels and ids teach nothing; with no or only one kind of labels
every score is their share (0.5 without any).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Scratch, slices, text_column, utf8

WORDS = 64                         # words in a passage
THRESHOLD = 0.5
_HASHED = 256
_BYTES = 129                       # each ASCII byte, and all others together
_COUNTS = 5
WIDTH = _BYTES + _HASHED + _COUNTS
_PART = 2 << 20

_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[[0x20, *range(0x09, 0x0E)]] = False
_KIND = np.minimum(np.arange(256), 128)


@dataclass(frozen=True)
class Limits:
    """Bounds of the sample and sizes of the model."""

    max_examples: int = 4_000
    max_passages: int = 30_000
    longest: int = 1_000
    hidden: int = 32
    gate: int = 16
    steps: int = 500
    batch: int = 64                # documents in a step
    rate: float = 3e-3
    decay: float = 1e-4


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each word from its length and its first and last eight bytes."""
    padded = np.concatenate((np.zeros(8, np.uint8), data, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(padded) - 7,), ">u8", buffer=padded, strides=(1,))
    size = stops - starts
    short = (8 - np.minimum(size, 8)).astype(np.uint64) * np.uint64(8)
    first = eight[starts + 8].astype(np.uint64) >> short
    last = eight[stops].astype(np.uint64) << short
    return _mix(_mix(first) ^ last ^ (size.astype(np.uint64) << np.uint64(48)))


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the passages into the bytes, and of the texts into the passages.

    A passage reaches from its first word to the next passage's, or to its text's end.
    """
    inside = _WORD_BYTE[data]
    before = np.concatenate(([False], inside))[:-1] if len(data) else inside
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    words = np.searchsorted(starts, offsets)
    each = np.maximum(1, -(-np.diff(words) // WORDS))
    texts = np.append(0, np.cumsum(each))
    of = np.repeat(np.arange(len(each)), each)
    k = np.arange(len(of)) - texts[of]
    at = offsets[of]                                 # blanks before a text's first word are its first passage's
    later = np.flatnonzero(k)
    at[later] = starts[words[of[later]] + k[later] * WORDS]
    return np.append(at, len(data)), texts


def describe(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of ``WIDTH`` numbers per passage; ``at`` are the passages' n + 1 offsets."""
    n = len(at) - 1
    data, at = data[at[0]:at[-1]], at - at[0]
    out = np.zeros((n, WIDTH), np.float32)
    size = np.diff(at)
    of = np.repeat(np.arange(n), size)
    share = np.bincount(of * _BYTES + _KIND[data], minlength=n * _BYTES).reshape(n, _BYTES)
    out[:, :_BYTES] = np.sqrt(share / np.maximum(size, 1)[:, None])
    inside = _WORD_BYTE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.concatenate(([False], inside))[:-1] if len(data) else inside
    after = np.concatenate((inside, [False]))[1:] if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    stops = np.flatnonzero(inside & (~after | edge[1:])) + 1
    words = _word_hashes(data, starts, stops)
    own = of[starts]
    count = np.bincount(own, minlength=n)
    many = np.maximum(count, 1)
    hashed = np.bincount(own * _HASHED + (words >> np.uint64(56)).astype(np.int64), minlength=n * _HASHED).reshape(n, _HASHED)
    out[:, _BYTES:_BYTES + _HASHED] = np.sqrt(hashed / many[:, None])
    by = np.lexsort((words, own))
    ranked, place = words[by], own[by]
    new = np.ones(len(by), bool)
    new[1:] = (ranked[1:] != ranked[:-1]) | (place[1:] != place[:-1])
    again = np.zeros(len(own), bool)
    again[1:] = (words[1:] == words[:-1]) & (own[1:] == own[:-1])
    heads = np.flatnonzero(new)
    most = np.zeros(n)
    np.maximum.at(most, place[heads], np.diff(np.append(heads, len(by))))
    out[:, -_COUNTS:] = np.stack([
        count / WORDS, np.bincount(place[new], minlength=n) / many, np.bincount(own[again], minlength=n) / many, most / many,
        np.log1p(np.bincount(own, stops - starts, minlength=n) / many) / 3], axis=1)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class GatedAttention:
    """Encoder, gated attention and scorer, learned together from labelled bags."""

    def __init__(self, limits: Limits, seed: int = 12):
        rng = np.random.default_rng(seed)
        h, g = limits.hidden, limits.gate

        def start(rows, columns):
            return (rng.standard_normal((rows, columns)) / np.sqrt(rows)).astype(np.float32)

        self.limits = limits
        self.weights = {"W": start(WIDTH, h), "b": np.zeros(h, np.float32), "V": start(h, g), "U": start(h, g),
                        "w": start(g, 1)[:, 0], "c": start(h, 1)[:, 0], "d": np.zeros(1, np.float32)}

    def _forward(self, x: np.ndarray):
        p = self.weights
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        return h, t, s, (t * s) @ p["w"]

    def passage_scores(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Attention before the softmax, and c . h, of each passage."""
        h, _, _, attention = self._forward(x)
        return attention, h @ self.weights["c"]

    def bag_logits(self, attention: np.ndarray, own: np.ndarray, bags: np.ndarray) -> np.ndarray:
        """Logit of each bag; ``bags`` are the n + 1 offsets into the passages, no bag empty."""
        if len(bags) < 2:
            return np.zeros(0)
        heads, size = bags[:-1], np.diff(bags)
        weight = np.exp(attention - np.repeat(np.maximum.reduceat(attention, heads), size))
        return np.add.reduceat(weight * own, heads) / np.add.reduceat(weight, heads) + float(self.weights["d"][0])

    def _gradient(self, x: np.ndarray, bags: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        p, heads, size = self.weights, bags[:-1], np.diff(bags)
        h, t, s, attention = self._forward(x)
        weight = np.exp(attention - np.repeat(np.maximum.reduceat(attention, heads), size))
        weight /= np.repeat(np.add.reduceat(weight, heads), size)
        own = h @ p["c"]
        logit = np.add.reduceat(weight * own, heads)
        error = np.repeat((_sigmoid(logit + p["d"]) - label) / len(label), size)
        to_attention = error * weight * (own - np.repeat(logit, size))
        to_t = to_attention[:, None] * p["w"] * s * (1 - t * t)
        to_s = to_attention[:, None] * p["w"] * t * s * (1 - s)
        to_h = (error * weight)[:, None] * p["c"] + to_t @ p["V"].T + to_s @ p["U"].T
        to_x = to_h * (1 - h * h)
        return {"W": x.T @ to_x, "b": to_x.sum(0), "V": h.T @ to_t, "U": h.T @ to_s, "w": (t * s).T @ to_attention,
                "c": h.T @ (error * weight), "d": np.array([(error * weight).sum()])}

    def fit(self, x: np.ndarray, bags: np.ndarray, label: np.ndarray, seed: int = 21) -> GatedAttention:
        share = label.mean() if len(label) else 0.5
        if share in (0.0, 1.0) or not len(label):
            self.weights["c"][:] = 0
            self.weights["d"][:] = np.clip(np.log(max(share, 1e-9) / max(1 - share, 1e-9)), -20, 20)
            return self
        limits, rng = self.limits, np.random.default_rng(seed)
        self.weights["d"][:] = np.log(share / (1 - share))
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.weights.items()}
        queue, done = np.zeros(0, np.int64), 0
        while done < limits.steps:
            if len(queue) < min(limits.batch, len(label)):
                queue = np.append(queue, rng.permutation(len(label)))
            chosen, queue = queue[:limits.batch], queue[limits.batch:]
            size = np.diff(bags)[chosen]
            own = np.append(0, np.cumsum(size))
            rows = np.repeat(bags[chosen] - own[:-1], size) + np.arange(own[-1])
            done += 1
            rate = limits.rate * 0.5 * (1 + math.cos(math.pi * done / limits.steps))
            for k, g in self._gradient(x[rows], own, label[chosen]).items():
                m, v = moment[k]
                w = self.weights[k]
                if k in "WVU":
                    g = g + limits.decay * w
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9 ** done)) / (np.sqrt(v / (1 - 0.99 ** done)) + 1e-8)
        return self


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _described(sample: DataFrame, longest: int) -> DataFrame:
    """``doc_id, good, n, x``: the sample's passages, but for documents of more than ``longest``."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", _PART):
                data, offsets = utf8(part.column("text"))
                at, texts = passages(data, offsets)
                n = np.diff(texts)
                for row in np.flatnonzero(n <= longest).tolist():
                    x = describe(data, at[texts[row]:texts[row + 1] + 1])
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").slice(row, 1), part.column("good").slice(row, 1), pa.array([n[row]], pa.int64()),
                         pa.array([x.astype(np.float16).tobytes()], pa.binary())], ["doc_id", "good", "n", "x"])

    return sample.select("doc_id", "good", "text").mapInArrow(run, "doc_id bigint, good int, n bigint, x binary")


def fit_model(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality") -> GatedAttention:
    """Fits on the sample; what the driver sees is bounded by ``limits``."""
    scratch = Scratch(docs.sparkSession, "quality")
    seen = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("good"))
            .where(F.col("doc_id").isNotNull() & F.col("good").isNotNull() & ~held_out("doc_id"))
            .groupBy("doc_id").agg(F.min("good").alias("good")))
    chosen = seen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limits.max_examples)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_column(text_col))
    # one example per text and label, so that copies don't teach together
    sample = (texts.join(F.broadcast(chosen), "doc_id").groupBy("text", "good").agg(F.min("doc_id").alias("doc_id")))
    table = scratch.table(_described(sample, limits.longest))
    order = [F.xxhash64("doc_id"), "doc_id", "good", "n"]
    size = np.array([r["n"] for r in table.orderBy(*order).select("n").collect()], np.int64)
    n_chosen = int(np.searchsorted(np.cumsum(size), limits.max_passages, "right"))
    rows = table.orderBy(*order).limit(n_chosen).toArrow() if n_chosen else None
    scratch.drop(table)
    if rows is None:
        return GatedAttention(limits).fit(np.zeros((0, WIDTH), np.float32), np.zeros(1, np.int64), np.zeros(0))
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float16).astype(np.float32).reshape(-1, WIDTH)
    bags = np.append(0, np.cumsum(size[:n_chosen]))
    return GatedAttention(limits).fit(x, bags, (rows.column("good").to_numpy() > 0).astype(np.float32))


def score_texts(model: GatedAttention, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, number of passages and the one of most attention, of each text."""
    at, texts = passages(data, offsets)
    attention, own = np.empty(len(at) - 1), np.empty(len(at) - 1)
    for lo in range(0, len(at) - 1, 4096):
        hi = min(lo + 4096, len(at) - 1)
        attention[lo:hi], own[lo:hi] = model.passage_scores(describe(data, at[lo:hi + 1]))
    score = np.round(_sigmoid(model.bag_logits(attention, own, texts)), 6)
    of = np.repeat(np.arange(len(texts) - 1), np.diff(texts))
    first = np.lexsort((-np.round(attention, 6), of))[texts[:-1]] - texts[:-1]
    return score, np.diff(texts), first


def score_quality(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages, top_passage`` for every document.

    ``top_passage`` is the passage of most attention, counted from 0.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_model(docs, labels, limits, id_col, text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_column(text_col)).withColumn("held_out", held_out("doc_id"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", _PART):
                score, n, first = score_texts(model.value, *utf8(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32)),
                     pa.array(n), pa.array(first)], ["doc_id", "held_out", "score", "predicted", "n_passages", "top_passage"])

    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int, n_passages bigint, top_passage bigint")
