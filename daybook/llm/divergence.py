"""Source divergence audit by sorting token-start pointers (operator 11).

Terms are the maximal stretches of letters and non-ASCII bytes, A-Z in lower
case.  A language keeps the terms that are in at least ``MIN_DOCUMENTS`` of its
documents, V of them.  In a group of N kept occurrences, a term with n of them
has the share p = 1 + floor(10^9 (n + 1) / (N + V)); the divergence of p from q is
f = floor((p - q)^2 / q).  Every (language, source) group is compared with each
other source of its language, over all kept terms, and its terms with the
language's.  All arithmetic is in whole numbers.

Counting.  Each shard of an Arrow buffer gets a pointer to every word start.  The
pointers are sorted by a multikey quicksort whose letters are slices of eight
bytes: what is equal so far is partitioned by the next slice.  A run of
equal pointers is one term; with the documents numbered by group, its stretches
give the term's occurrences and documents per group.  Only these counts are
shuffled.

Comparing.  A term that a group doesn't have has the group's least share p0.  So
with f0 = f(p0, q0), the sum over all kept terms is V f0, plus f(p, q0) - f0 over the
group's own terms, plus f(p0, q) - f0 over the other's, plus what is left over the
terms that both have.  The middle sums need only how many terms have each
share; the last one walks the terms' lists of sources, cut into blocks of a
bounded size, and adds up in each task.  No table of all terms by all sources
is made, and no list grows with the number of sources.

Defined results: null text, language or source is read as ''; every row is a
document, so repeated rows count each time, and null ids play no part; a group
without terms is compared, too; a language without kept terms has the value 0
between its sources; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import Scratch, slices, text_column, utf8

MIN_DOCUMENTS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
_BLOCK_SOURCES = 256               # sources in one list of a term, about
_PAIRS = 1 << 20                   # pairs worked on together

_LETTER = np.ones(256, bool)
_LETTER[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def word_pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of all words, none of which crosses an offset."""
    inside = _LETTER[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.concatenate(([False], inside))[:-1] if len(data) else inside
    after = np.concatenate((inside, [False]))[1:] if len(data) else inside
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    stops = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, stops - starts


def _slice(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The next eight bytes of each pointer as a number; beyond its ``size`` they are zero."""
    spelt = np.ndarray((len(data) - 7,), ">u8", buffer=data, strides=(1,))[at].astype(np.uint64)
    unused = (8 - np.clip(size, 1, 8)).astype(np.uint64) * np.uint64(8)
    return np.where(size > 0, spelt >> unused << unused, np.uint64(0))


def sort_pointers(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pointers by the words they point at, and where a new word begins in it."""
    data = np.concatenate((data, np.zeros(8, np.uint8)))
    key = _slice(data, starts, sizes)
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(order), bool)
    new[1:] = key[1:] != key[:-1]
    depth = 8
    while len(order):
        heads = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        # runs with a longer word; one word alone is sorted already
        unsorted = (np.maximum.reduceat(sizes[order], heads) > depth) & (np.diff(np.append(heads, len(order))) > 1)
        at = np.flatnonzero(unsorted[run])
        if not len(at):
            break
        pointers, of = order[at], run[at]
        left = sizes[pointers] - depth
        key = _slice(data, starts[pointers] + np.where(left > 0, depth, 0), left)
        by = np.lexsort((key, of))
        order[at], key = pointers[by], key[by]
        new[at[1:]] |= (key[1:] != key[:-1]) & (of[1:] == of[:-1])
        depth += 8
    return order, new


def count_terms(data: np.ndarray, offsets: np.ndarray, group: np.ndarray):
    """Per term and group of a shard: the term's pointer and size, the group, occurrences and documents."""
    data = _LOWER[data]
    starts, sizes = word_pointers(data, offsets)
    order, new = sort_pointers(data, starts, sizes)
    n_rows = len(group)
    by_group = np.argsort(group, kind="stable")
    number = np.empty(n_rows, np.int64)
    number[by_group] = np.arange(n_rows)                 # documents numbered group by group
    document = number[np.searchsorted(offsets, starts, "right") - 1]
    term = np.cumsum(new) - 1
    place = np.sort(term * n_rows + document[order])
    document, term_of = place % max(1, n_rows), place // max(1, n_rows)
    own = group[by_group][document]
    opens = np.ones(len(place), bool)                    # a document's first place in its term
    opens[1:] = place[1:] != place[:-1]
    heads = np.ones(len(place), bool)                    # a group's first place in its term
    heads[1:] = (term_of[1:] != term_of[:-1]) | (own[1:] != own[:-1])
    heads = np.flatnonzero(heads)
    pointer = order[np.flatnonzero(new)][term_of[heads]]
    documents = np.add.reduceat(opens.astype(np.int64), heads) if len(heads) else heads
    return data, starts[pointer], sizes[pointer], own[heads], np.diff(np.append(heads, len(place))), documents


def _spell(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The words at the pointers as an Arrow column."""
    ends = np.cumsum(sizes)
    at = np.arange(int(sizes.sum())) + np.repeat(starts - (ends - sizes), sizes)
    return pa.Array.from_buffers(pa.binary(), len(starts), [
        None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[at]))])


def _named(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    def plain(column, name):
        return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(name)

    return docs.select(plain(lang_col, "lang"), plain(source_col, "source"), text_column(text_col))


def term_counts(named: DataFrame) -> DataFrame:
    """``lang, source, term, n, df`` from ``lang, source, text``."""
    def count(batches):
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                lang, source = (part.column(c).dictionary_encode() for c in ("lang", "source"))
                width = len(source.dictionary)
                pair = lang.indices.to_numpy().astype(np.int64) * width + source.indices.to_numpy()
                data, starts, sizes, own, n, documents = count_terms(*utf8(part.column("text")), pair)
                for at in range(0, len(starts), 1 << 17):
                    cut = slice(at, at + (1 << 17))
                    yield pa.RecordBatch.from_arrays(
                        [lang.dictionary.take(pa.array(own[cut] // width)), source.dictionary.take(pa.array(own[cut] % width)),
                         _spell(data, starts[cut], sizes[cut]), pa.array(n[cut].astype(np.int64)), pa.array(documents[cut])],
                        ["lang", "source", "term", "n", "df"])

    found = named.mapInArrow(count, "lang string, source string, term binary, n bigint, df bigint")
    return (found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
            .withColumn("term", F.col("term").cast("string")))


def _share(n: str, total: str, kept: str):
    """p of a term with ``n`` of ``total`` occurrences among ``kept`` terms, exact for counts of any size."""
    return F.expr(f"1 + (CAST({SCALE} AS DECIMAL(10, 0)) * CAST({n} + 1 AS DECIMAL(19, 0))) "
                  f"div CAST({total} + {kept} AS DECIMAL(19, 0))")


def _f(p: str, q: str) -> str:
    return f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})"


def _both(lists: DataFrame) -> DataFrame:
    """``lang, source, other, value``: what the terms that both sources have add, summed per task's batch.

    ``lists`` has ``lang`` and the lists ``a`` and ``b`` of a term's sources, each with its
    share p and the least share p0.
    """
    def f(p, q):
        return (p - q) * (p - q) // q

    def add(batches):
        for batch in batches:
            lang = batch.column("lang").dictionary_encode()
            lists = [batch.column(c) for c in ("a", "b")]
            n = [np.diff(x.offsets.to_numpy()).astype(np.int64) for x in lists]
            first = [x.offsets.to_numpy().astype(np.int64)[:-1] - x.offsets[0].as_py() for x in lists]
            fields = [x.flatten().flatten() for x in lists]
            names = pa.chunked_array([fields[0][0], fields[1][0]]).dictionary_encode().combine_chunks()
            code = names.indices.to_numpy().astype(np.int64)
            code = code[:len(fields[0][0])], code[len(fields[0][0]):]
            p, p0 = ([x[k].to_numpy() for x in fields] for k in (1, 2))
            width = len(names.dictionary)
            done = np.concatenate(([0], np.cumsum(n[0] * n[1])))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(done, done[at] + _PAIRS, "right")) - 1)
                size = (n[0] * n[1])[at:to]
                row = np.repeat(np.arange(at, to), size)
                k = np.arange(int(size.sum())) - np.repeat(done[at:to] - done[at], size)
                i, j = first[0][row] + k // n[1][row], first[1][row] + k % n[1][row]
                other = code[0][i] != code[1][j]
                row, i, j = row[other], i[other], j[other]
                pa_, pb, a0, b0 = p[0][i], p[1][j], p0[0][i], p0[1][j]
                value = f(pa_, pb) - f(pa_, b0) - f(a0, pb) + f(a0, b0)
                key = (lang.indices.to_numpy()[row].astype(np.int64) * width + code[0][i]) * width + code[1][j]
                by = np.argsort(key, kind="stable")
                heads = np.flatnonzero(np.concatenate(([True], np.diff(key[by]) != 0))) if len(key) else by
                pair = key[by][heads]
                yield pa.RecordBatch.from_arrays(
                    [lang.dictionary.take(pa.array(pair // (width * width))),
                     names.dictionary.take(pa.array(pair // width % max(1, width))), names.dictionary.take(pa.array(pair % max(1, width))),
                     pa.array(np.add.reduceat(value[by], heads) if len(heads) else heads)], ["lang", "source", "other", "value"])
                at = to

    return lists.mapInArrow(add, "lang string, source string, other string, value bigint")


def _pairs(shares: DataFrame, groups: DataFrame, scratch: Scratch) -> DataFrame:
    """``lang, source, other, value`` for all ordered pairs of a language's sources."""
    other = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("o0"))
    least = _f("p0", "o0")
    base = groups.join(other, "lang").where("source <> other").select(
        "lang", "source", "other", F.expr(f"IF(kept > 0, kept * ({least}), 0)").alias("value"))
    levels = scratch.table(shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("terms")))
    met = levels.join(other, "lang").where("source <> other")
    own = met.select("lang", "source", "other", F.expr(f"terms * ({_f('p', 'o0')} - {least})").alias("value"))
    theirs = met.select("lang", F.col("other").alias("source"), F.col("source").alias("other"),
                        F.expr(f"terms * ({_f('o0', 'p')} - {_f('o0', 'p0')})").alias("value"))
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    blocks = -(-most // _BLOCK_SOURCES)
    lists = shares.groupBy("lang", "term", F.pmod(F.xxhash64("source"), F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("source", "p", "p0")).alias("a"))
    if blocks == 1:
        lists = lists.select("lang", "a", F.col("a").alias("b"))
    else:
        lists = scratch.table(lists)
        lists = lists.select("lang", "term", "a").join(
            lists.select("lang", "term", F.col("a").alias("b")), ["lang", "term"]).select("lang", "a", "b")
    parts = base.unionByName(own).unionByName(theirs).unionByName(_both(lists))
    return parts.groupBy("lang", "source", "other").agg(
        F.sum(F.col("value").cast("decimal(19,0)")).cast("long").alias("value"))


def source_divergence(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS,
                      text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: a source's divergence from each other source of its language.
    Part ``term``: its ``top_terms`` terms that diverge most upwards from the language.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    named = _named(docs, text_col, lang_col, source_col)
    counts = scratch.table(term_counts(named))
    kept = scratch.table(counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df"))
                         .where(F.col("df") >= min_documents).drop("df"))
    own = scratch.table(counts.drop("df").join(kept, ["lang", "term"]))
    scratch.drop(counts)
    totals = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    sums = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (named.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(totals, "lang", "left")
              .na.fill(0, ["total", "kept", "lang_total"]))
    groups = scratch.table(groups.withColumn("p0", F.when(F.col("kept") > 0, _share("0", "total", "kept"))))
    shares = scratch.table(own.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", _share("n", "total", "kept").alias("p"), "p0",
        _share("lang_n", "lang_total", "kept").alias("q")))
    scratch.drop(own)
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         F.expr(_f("p", "q")).alias("value"))
    pairs = _pairs(shares.drop("q"), groups, scratch).select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return (pairs.withColumn("rank", rank)
            .unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= top_terms)))


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents
),
w AS (
  SELECT id, lang, source,
         translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d
),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DOCUMENTS}),
v AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
t AS (SELECT lang, source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
         1 + ({SCALE} * (coalesce(c.n, 0) + 1)) // (t.n + v.v) AS p, 1 + ({SCALE} * (k.n + 1)) // (v.n + v.v) AS q
  FROM t JOIN v ON t.lang = v.lang JOIN k ON k.lang = t.lang
  LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term
),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q
),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM o WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
