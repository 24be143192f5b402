"""Toxicity scores from the nearest labelled examples (operator 6).

Learning.  Labels are read from rows whose crc32(doc_id) mod 3 is not 1.  The
model is fitted on a bounded sample of them (``max_examples``, by hash of
the id): terms are words, word beginnings and repeated beginnings that mark a
toxic text, chosen by log-likelihood ratio; each example is its TF-IDF vector
over these terms.  The inverse document frequencies count all documents.

Search.  The examples' inverted index is cut into blocks of examples; a term
stores its largest weight in each block.  For a text the block bounds are
summed, blocks are searched from the highest bound down, and the search
stops when no bound reaches the k-th best cosine: the k nearest are exact.
Ties go to the smaller example id.

Scores.  Votes are weighted by 1 / (distance + 0.05).  The vote is mapped to a
probability by a monotone fit over cross-fitted votes of the sample: each
half is voted on by terms and examples of the other half.  Texts without any
term are a level of their own.

Neither labels nor language, source or id enter a text's score, and of a text
that is an example itself, nor does its own label.  Scoring is one map; the sample, terms and index are bounded by parameters, so they may
travel with the tasks.

Defined results: null or empty text has no terms and gets that level's score;
repeated rows get equal scores; a document labelled more than once is toxic if
one label says so; null labels and null ids teach nothing; without toxic
examples every score is the level of texts without terms.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Scratch, held, slices, text_column

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
STEMS = (4, 6)
OFTEN = ((2, b"+2"), (3, b"+3"), (5, b"+5"))
THRESHOLD = 0.7


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _marked(stems: Counter) -> Counter:
    return Counter({w + mark: 1 for w, n in stems.items() for least, mark in OFTEN if n >= least})


def term_counts(text: bytes) -> Counter:
    """Terms with their counts.

    Terms are the words, their beginnings of STEMS bytes in upper case, and
    for each count in OFTEN a beginning that stands at least so often.
    """
    words = Counter(WORD.findall(text.lower()))
    stems: Counter = Counter()
    for w, n in words.items():
        for size in STEMS:
            if len(w) > size:
                stems[w[:size].upper()] += n
    return words + stems + _marked(stems)


class TermReader:
    """``term_counts`` for known terms only; words that give none are looked at once.

    The table of such words starts over beyond ``remember`` entries.
    """

    def __init__(self, known, remember: int = 300_000):
        self._known, self._remember = set(known), remember
        marks = tuple(mark for _, mark in OFTEN)
        self._stems = {w[:-len(m)] for w in self._known for m in marks if w.endswith(m)} | self._known
        self._plain: set[bytes] = set()

    def __call__(self, text: bytes) -> Counter:
        words = Counter(WORD.findall(text.lower()))
        if len(self._plain) > self._remember:
            self._plain.clear()
        found, stems = Counter(), Counter()
        for w in words.keys() - self._plain:
            own = [s for size in STEMS if len(w) > size and (s := w[:size].upper()) in self._stems]
            for s in own:
                stems[s] += words[w]
            if w in self._known:
                found[w] = words[w]
            elif not own:
                self._plain.add(w)
        for more in (stems, _marked(stems)):
            found.update({w: n for w, n in more.items() if w in self._known})
        return found


@dataclass(frozen=True)
class Limits:
    """Bounds and constants of the model."""

    max_examples: int = 20_000     # labelled rows in the sample
    max_terms: int = 20_000
    min_ratio: float = 20.0        # log-likelihood ratio of a term
    min_odds: float = 3.0          # odds of toxic among its texts against those among the others
    k: int = 25
    block: int = 64
    evidence: int = 3


def choose_terms(counts: DataFrame, whole: str, toxic: str, n: int, n1: int, limits: Limits) -> list[bytes]:
    """Terms that mark toxic texts, strongest first, from their counts of texts.

    A term marks them by its odds ratio, which doesn't depend on the share of toxic
    texts, and by a log-likelihood ratio that is no chance.
    ``whole`` and ``toxic`` name the columns with how many texts and toxic
    texts hold the term; n and n1 are how many texts there are.
    """
    n0 = n - n1
    if not n1 or not n0:
        return []
    df, a = F.col(whole).cast("double"), F.col(toxic).cast("double")

    def part(observed, expected):
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    ratio = 2 * (part(a, df * n1 / n) + part(df - a, df * n0 / n)
                 + part(n1 - a, (n - df) * n1 / n) + part(n0 - df + a, (n - df) * n0 / n))
    odds = a * (n0 - df + a) > limits.min_odds * (df - a) * (n1 - a)
    marks = counts.where((a > 1) & odds).withColumn("ratio", ratio)
    best = marks.where(F.col("ratio") >= limits.min_ratio).orderBy(F.desc("ratio"), "term").limit(limits.max_terms)
    return [bytes(r["term"]) for r in best.select("term").collect()]


class Index:
    """Block-max inverted index over labelled examples with at least one term."""

    def __init__(self, ids: np.ndarray, toxic: np.ndarray, counts: list[Counter], idf: dict[bytes, float], limits: Limits,
                 own: np.ndarray | None = None):
        self.limits, self.idf = limits, idf
        self.term = {w: i for i, w in enumerate(idf)}
        order = np.argsort(ids, kind="stable")
        vectors = [(int(i), self.vector(counts[i])) for i in order]
        vectors = [(i, v) for i, v in vectors if v]
        self.ids = np.array([ids[i] for i, _ in vectors], np.int64)
        self.toxic = np.array([toxic[i] for i, _ in vectors], float)
        self.own: dict[int, list[int]] = {}              # rows by the hash of their text
        for row, (i, _) in enumerate(vectors if own is not None else ()):
            self.own.setdefault(int(own[i]), []).append(row)
        postings: dict[int, list] = {}
        for row, (_, vector) in enumerate(vectors):
            for t, w in vector:
                postings.setdefault(t, []).append((row, w))
        self.n_blocks = -(-len(vectors) // limits.block)
        self.rows, self.weights, self.starts, self.bounds = {}, {}, {}, {}
        for t, found in postings.items():
            rows = np.array([r for r, _ in found], np.int64)
            weights = np.array([w for _, w in found])
            self.rows[t], self.weights[t] = rows, weights
            self.starts[t] = np.searchsorted(rows, np.arange(self.n_blocks + 1) * limits.block)
            self.bounds[t] = np.zeros(self.n_blocks)
            np.maximum.at(self.bounds[t], rows // limits.block, weights)

    def vector(self, counts: Counter) -> list[tuple[int, float]]:
        """Unit TF-IDF vector over the terms."""
        raw = [(self.term[w], (1 + math.log(c)) * self.idf[w]) for w, c in counts.items() if w in self.term]
        norm = math.sqrt(sum(w * w for _, w in raw))
        return sorted((t, w / norm) for t, w in raw) if norm else []

    def nearest(self, vector: list[tuple[int, float]], own: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the k nearest examples, nearest first; only cosines above zero.

        Examples whose text hashes to ``own`` are left out.
        """
        left_out = self.own.get(own, [])
        known = [(t, w) for t, w in vector if t in self.rows]
        if not known:
            return np.zeros(0, np.int64), np.zeros(0)
        bound = np.zeros(self.n_blocks)
        for t, w in known:
            bound += w * self.bounds[t]
        k, size = self.limits.k, self.limits.block
        rows, cosines, worst = np.zeros(0, np.int64), np.zeros(0), 0.0
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or bound[b] < worst - 1e-12:
                break
            scores = np.zeros(size)
            for t, w in known:
                lo, hi = self.starts[t][b], self.starts[t][b + 1]
                if lo < hi:
                    scores[self.rows[t][lo:hi] - b * size] += w * self.weights[t][lo:hi]
            for row in left_out:
                if row // size == b:
                    scores[row - b * size] = 0
            here = np.flatnonzero(scores)
            rows = np.concatenate((rows, here + b * size))
            cosines = np.concatenate((cosines, scores[here]))
            if len(rows) >= k:
                best = np.lexsort((rows, -cosines))[:k]
                rows, cosines = rows[best], cosines[best]
                worst = cosines[-1]
        best = np.lexsort((rows, -cosines))[:k]
        return rows[best], cosines[best]

    def vote(self, vector: list[tuple[int, float]], own: int | None = None) -> tuple[float, np.ndarray, np.ndarray]:
        """Distance-weighted share of toxic neighbours (below zero: no neighbour), rows, cosines."""
        rows, cosines = self.nearest(vector, own)
        if not len(rows):
            return -1.0, rows, cosines
        weight = 1 / (1.05 - np.minimum(cosines, 1.0))
        return float((weight * self.toxic[rows]).sum() / weight.sum()), rows, cosines


def monotone_fit(votes: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Levels of the vote and a rising probability for each (pooled adjacent violators)."""
    levels, of = np.unique(votes, return_inverse=True)
    pools = []
    for level, s, n in zip(levels, np.bincount(of, toxic), np.bincount(of)):
        pools.append([level, s, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            _, s, n = pools.pop()
            pools[-1][1] += s
            pools[-1][2] += n
    start, s, n = (np.array(c, float) for c in zip(*pools))
    return start, (s + 0.1) / (n + 0.2)


class Model:
    """Index and calibration, from the examples' term counts and corpus-wide document frequencies.

    ``terms`` are the terms of the whole sample, of its first half and of the
    other; ``second`` tells the halves apart.
    """

    def __init__(self, ids, toxic, second, own, counts: list[Counter], terms: list[list[bytes]], df: dict[bytes, int],
                 n_documents: int, limits: Limits):
        self.limits = limits
        ids, toxic, second, own = np.array(ids, np.int64), np.array(toxic, bool), np.array(second, bool), np.array(own, np.int64)

        def index(own_terms, part):
            idf = {w: math.log(1 + n_documents / (1 + df.get(w, 0))) for w in own_terms}
            rows = np.flatnonzero(part)
            return Index(ids[rows], toxic[rows], [counts[i] for i in rows], idf, limits, own[rows])

        votes = np.empty(len(ids))
        for own_terms, half in ((terms[1], ~second), (terms[2], second)):
            other = index(own_terms, half)
            for i in np.flatnonzero(~half):
                votes[i] = other.vote(other.vector(counts[i]))[0]
        self.levels, self.probability = (monotone_fit(votes, toxic.astype(float)) if len(votes)
                                         else (np.array([-1.0]), np.array([0.0])))
        self.index = index(terms[0], np.ones(len(ids), bool))

    def score(self, words: Counter, own: int | None = None) -> tuple[float, list[dict]]:
        """Probability and evidence from a text's counts of known terms; ``own`` is the text's hash.

        A text that is an example itself is judged by the others, as in the calibration.
        """
        vote, rows, cosines = self.index.vote(self.index.vector(words), own)
        at = max(0, int(np.searchsorted(self.levels, vote, "right")) - 1)
        show = self.limits.evidence
        return float(self.probability[at]), [
            {"doc_id": int(self.index.ids[r]), "cosine": float(c), "toxic": int(self.index.toxic[r])}
            for r, c in zip(rows[:show], cosines[:show])]


def _document_frequencies(docs: DataFrame, terms: list[bytes], text_col: str) -> tuple[dict[bytes, int], int]:
    """How many of all documents hold each term, and how many documents there are."""
    known = {w: i for i, w in enumerate(terms)}

    def count(batches):
        held("toxicity")
        df, n, read = np.zeros(len(known) + 1, np.int64), 0, TermReader(known)
        for batch in batches:
            n += batch.num_rows
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                for w in read(text):
                    df[known[w]] += 1
        df[-1] = n                                    # the last entry counts documents
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(df[some])], ["term", "n"])

    totals = (docs.select(text_column(text_col)).mapInArrow(count, "term int, n bigint")
              .groupBy("term").agg(F.sum("n").alias("n")).collect())
    df = {r["term"]: r["n"] for r in totals}
    return {w: df.get(i, 0) for w, i in known.items()}, df.get(len(terms), 0)


def _term_table(sample: DataFrame) -> DataFrame:
    """``term`` and in how many texts it is: all, toxic, and the same for each half."""
    def spell(batches):
        held("toxicity")
        for batch in batches:
            bags = [set(term_counts(t)) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            rows = pa.array(np.repeat(np.arange(len(bags)), [len(b) for b in bags]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for b in bags for w in b], pa.binary()), batch.column("toxic").take(rows),
                 batch.column("second").take(rows)], ["term", "toxic", "second"])

    toxic, second = F.col("toxic") == 1, F.col("second")
    each = sample.select("text", "toxic", "second").mapInArrow(spell, "term binary, toxic int, second boolean")
    return each.groupBy("term").agg(
        F.count("*").alias("n"), F.count_if(toxic).alias("t"), F.count_if(~second).alias("n_first"),
        F.count_if(toxic & ~second).alias("t_first"), F.count_if(second).alias("n_second"),
        F.count_if(toxic & second).alias("t_second")).where("t > 1")


def _example_counts(sample: DataFrame, known: list[bytes]) -> pa.Table:
    """The examples with the numbers and counts of their known terms; at most a bounded sample's rows."""
    number = {w: i for i, w in enumerate(known)}

    def count(batches):
        read = TermReader(number)
        for batch in batches:
            found = [read(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "toxic", "second", "own")),
                 pa.array([[number[w] for w in f] for f in found], pa.list_(pa.int32())),
                 pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))],
                ["doc_id", "toxic", "second", "own", "terms", "counts"])

    rows = sample.select("doc_id", "toxic", "second", F.xxhash64("text").alias("own"), "text").mapInArrow(
        count, "doc_id bigint, toxic int, second boolean, own bigint, terms array<int>, counts array<int>")
    return rows.orderBy("doc_id", "terms", "counts").toArrow()


def fit_model(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id",
              text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fits on the sample; its ids, at most ``max_examples``, are found from the labels alone.

    The driver sees the chosen terms, their document frequencies and the
    sample's counts of them, all bounded by ``limits``; texts stay on the
    executors.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    seen = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
            .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id"))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = seen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limits.max_examples)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_column(text_col))
    second = F.pmod(F.xxhash64(F.lit(7), F.col("doc_id")), F.lit(2)) == 1
    # one example per text and label, so that copies don't vote together
    sample = scratch.table(texts.join(F.broadcast(chosen), "doc_id").groupBy("text", "toxic")
                           .agg(F.min("doc_id").alias("doc_id")).withColumn("second", second))
    sizes = sample.groupBy("second").agg(F.count("*").alias("n"), F.count_if(F.col("toxic") == 1).alias("t")).collect()
    n, t = ({r["second"]: r[c] for r in sizes} for c in ("n", "t"))
    table = scratch.table(_term_table(sample))
    terms = [choose_terms(table, *columns, *size, limits) for columns, size in (
        (("n", "t"), (sum(n.values()), sum(t.values()))),
        (("n_first", "t_first"), (n.get(False, 0), t.get(False, 0))),
        (("n_second", "t_second"), (n.get(True, 0), t.get(True, 0))))]
    known = sorted({w for ws in terms for w in ws})
    examples = _example_counts(sample, known)
    counts = [Counter({known[i]: c for i, c in zip(*row)})
              for row in zip(examples.column("terms").to_pylist(), examples.column("counts").to_pylist())]
    scratch.drop(sample, table)
    return Model(*[examples.column(c).to_pylist() for c in ("doc_id", "toxic", "second", "own")], counts, terms,
                 *_document_frequencies(docs, known, text_col), limits)


def score_toxicity(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), threshold: float = THRESHOLD,
                   id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
                   with_text: bool = False) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` for every document.

    ``evidence`` holds the nearest examples with their cosine and label.
    ``carry`` names columns of ``docs`` to return as the struct ``carried``;
    ``with_text`` returns the ``text``, too.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_model(docs, labels, limits, id_col, text_col))
    carried = F.struct(*carry) if carry else F.lit(None).cast("struct<none: boolean>")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_column(text_col), carried.alias("carried"))
    rows = rows.withColumns({"held_out": held_out("doc_id"), "own": F.xxhash64("text")})
    kind = rows.schema["carried"].dataType.simpleString()
    shown = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    def score(batches):
        held("toxicity")
        fitted = model.value
        read = TermReader(fitted.index.term)
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                found = [fitted.score(read(t), own) for t, own in zip(part.column("text").cast(pa.binary()).to_pylist(),
                                                                        part.column("own").to_pylist())]
                scores = np.array([s for s, _ in found])
                columns = {
                    "doc_id": part.column("doc_id"), "held_out": part.column("held_out"),
                    "score": pa.array(scores, pa.float64()), "predicted": pa.array((scores >= threshold).astype(np.int32)),
                    "evidence": pa.array([e for _, e in found], shown), "carried": part.column("carried")}
                if with_text:
                    columns["text"] = part.column("text")
                yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(score, "doc_id bigint, held_out boolean, score double, predicted int, "
                                  f"evidence array<struct<doc_id: bigint, cosine: double, toxic: int>>, carried {kind}"
                                  + (", text string" if with_text else ""))
