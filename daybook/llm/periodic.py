"""Periodic runs of words by maximal-pair enumeration (operator 13).

A run is a stretch of words with smallest period q, at least ``MIN_LENGTH`` and
2 q words long, that no neighbouring word extends keeping period q.

A maximal pair is two places i < j with a common extension of l words that can
be lengthened neither to the left nor to the right.  If j - i <= l, the stretch
from i to j + l has period j - i, holds it twice and can't be extended: it is a
run, and every run of period q gives such a pair at distance q.  Multiples of
q give pairs with the same stretch, of which the smallest distance stays.

All documents of a part are handled together:

1. Words become numbers of an Arrow dictionary, which is exact.
2. Only places whose next six words stand elsewhere in their document can have
   a common extension of six words, the least that a run of twelve needs.
   A hash chooses them; a collision only adds a place.
3. Their suffixes are sorted by doubling: classes of six words, then of 12, 24
   and so on, sorting again only what is still equal.  The classes of all
   rounds give the common extension of any two places.
4. The intervals of the suffix order are walked bottom-up.  Each one holds
   its places by position, in blocks of equal left word (the left-word
   classes).  When two children meet at an interval of l words, each place of
   the smaller is paired with the places of the larger within l words; a
   block of its own left word is stepped over at once.

The number of pairs found is bounded by the sum of the runs' exponents, which
is linear in the words, so no text needs a cap.  A document is worked on whole,
in memory that grows with its length alone; there is no shuffle.

Defined results: null or empty text has no words, no runs and an empty rest; a
null id is carried through and changes no words; repeated rows get equal
results.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import slices, text_column, utf8

MIN_LENGTH = 12
_SEED = MIN_LENGTH // 2            # a run's maximal pair has at least so many common words
_PART = 1 << 20                    # bytes of text handled together

_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[[0x20, *range(0x09, 0x0E)]] = False


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All texts' words one after the other, and the texts' n + 1 offsets into them."""
    inside = _WORD_BYTE[data]
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    before[offsets[:-1][offsets[:-1] < len(data)]] = False       # a text's first byte follows nothing
    starts = np.flatnonzero(inside & ~before)
    kept = np.concatenate(([0], np.cumsum(inside)))
    at = np.append(kept[starts], kept[-1])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                  [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    return words, np.searchsorted(starts, offsets)


def _runs_of(starts: np.ndarray, n: int) -> np.ndarray:
    """The lengths of the groups that begin at ``starts`` among n rows."""
    return np.diff(np.append(starts, n))


class SuffixOrder:
    """Order and common extensions of the places whose next ``_SEED`` words recur in their text.

    ``order`` holds the places, equal beginnings together; ``common[r]`` is
    how many words ``order[r]`` and ``order[r + 1]`` have in common, 0 below ``_SEED``.
    """

    def __init__(self, codes: np.ndarray, text: np.ndarray, stop: np.ndarray):
        """``codes`` are the words, ``text`` their text's number and ``stop`` where it ends."""
        self._codes, self._stop = codes, stop
        n = len(codes)
        place = np.arange(n)
        whole = np.flatnonzero(place + _SEED <= stop)
        spelt = text[whole].astype(np.uint64)
        for k in range(_SEED):
            spelt = spelt * np.uint64(0x9E3779B97F4A7C15) + codes[whole + k].astype(np.uint64) + np.uint64(1)
            spelt ^= spelt >> np.uint64(29)
        by = np.argsort(spelt)
        ranked = spelt[by]
        same = np.flatnonzero(ranked[1:] == ranked[:-1])
        recurs = np.zeros(n, bool)
        recurs[whole[by[same]]] = recurs[whole[by[same + 1]]] = True
        # the places _SEED words on decide the order of what differs there
        asked = recurs.copy()
        asked[_SEED:] |= recurs[:max(0, n - _SEED)] & (text[_SEED:] == text[:-_SEED])
        places = np.flatnonzero(asked)
        m = len(places)
        self._number = np.full(n + 1, -1, np.int64)          # a place's number among the asked
        self._number[places] = np.arange(m)
        self._places = places
        # classes of _SEED words: each word splits the classes of those before it
        rank, open_ = self._split(np.zeros(m, np.int64), np.arange(m), text[places])
        for k in range(_SEED):
            at = places[open_] + k
            word = np.where(at < stop[places[open_]], codes[np.minimum(at, n - 1)], -1) if len(at) else at
            rank, open_ = self._split(rank, open_, word)
        self._ranks, width = [rank], _SEED
        while len(open_):
            rank, open_ = self._split(rank, open_, self._rank_at(rank, places[open_], width))
            self._ranks.append(rank)
            width *= 2
        order = places[np.argsort(rank)]
        self.order = order[recurs[order]]
        self.common = self._common(self.order[:-1], self.order[1:])

    def _rank_at(self, rank: np.ndarray, place: np.ndarray, ahead: int) -> np.ndarray:
        """Ranks ``ahead`` words on, a text's end before all."""
        at = place + ahead
        return np.where(at < self._stop[place], rank[self._number[np.minimum(at, len(self._codes))]], -1)

    @staticmethod
    def _split(rank: np.ndarray, open_: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Splits the classes of the places ``open_`` by ``key``; a class's rank is its first row in the order.

        Returns the new ranks and the places that aren't alone in their class.
        """
        rank = rank.copy()
        by = np.lexsort((key, rank[open_]))
        places = open_[by]
        old, own = rank[places], key[by]
        n = len(places)
        class_start = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1]))) if n else np.zeros(0, np.int64)
        start = np.flatnonzero(np.concatenate(([True], (old[1:] != old[:-1]) | (own[1:] != own[:-1])))) if n else class_start
        size = _runs_of(start, n)
        first_of_class = np.repeat(class_start, _runs_of(class_start, n))
        rank[places] = old + np.repeat(start, size) - first_of_class
        return rank, places[np.repeat(size, size) > 1]

    def _common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words the places i and j have in common; 0 below ``_SEED``."""
        n = np.zeros(len(i), np.int64)
        end = len(self._codes)
        for m in range(len(self._ranks) - 1, -1, -1):
            a, b = (self._number[np.minimum(x + n, end)] for x in (i, j))
            rank = self._ranks[m]
            same = (a >= 0) & (b >= 0)
            same[same] = rank[a[same]] == rank[b[same]]
            n += np.where(same, _SEED << m, 0)
        more = n >= _SEED
        for _ in range(_SEED - 1):
            a, b = i + n, j + n
            more &= (a < self._stop[np.minimum(i, end - 1)]) & (b < self._stop[np.minimum(j, end - 1)])
            more[more] = self._codes[a[more]] == self._codes[b[more]]
            n += more
        return np.where(n >= _SEED, n, 0)


class _Node:
    """An interval's places by position, and the first place of each block of equal left word."""

    __slots__ = ("places", "heads")

    def __init__(self, place: int):
        self.places, self.heads = [place], [place]

    def pair(self, p: int, left: list, reach: int, found: list) -> None:
        """Adds (i, j, reach) for p and each place within ``reach`` that has another left word."""
        places, heads, own = self.places, self.heads, left[p]
        at = bisect_left(places, p)
        k, n = at, len(places)
        while k < n and places[k] - p <= reach:
            if left[places[k]] != own:
                found.append((p, places[k], reach))
                k += 1
            else:
                block = bisect_right(heads, places[k])
                if block == len(heads):
                    break
                k = bisect_left(places, heads[block], k)
        k = at - 1
        while k >= 0 and p - places[k] <= reach:
            if left[places[k]] != own:
                found.append((places[k], p, reach))
                k -= 1
            else:
                k = bisect_left(places, heads[bisect_right(heads, places[k]) - 1]) - 1

    def add(self, p: int, left: list) -> None:
        places, heads, own = self.places, self.heads, left[p]
        at = bisect_left(places, p)
        before = at and left[places[at - 1]]
        if at < len(places):
            after = left[places[at]]
            was_head = not at or before != after
            if own == after:
                if was_head:
                    del heads[bisect_left(heads, places[at])]
            elif not was_head:
                insort(heads, places[at])
        if not at or before != own:
            insort(heads, p)
        places.insert(at, p)


def _meet(a: _Node, b: _Node, left: list, reach: int, found: list) -> _Node:
    """Pairs the places of two children of an interval of ``reach`` words, and joins them."""
    if len(a.places) < len(b.places):
        a, b = b, a
    for p in b.places:
        a.pair(p, left, reach, found)
    for p in b.places:
        a.add(p, left)
    return a


def maximal_pairs(order: list, common: list, left: list) -> list[tuple[int, int, int]]:
    """(i, j, l) of the maximal pairs with l >= j - i, from the intervals of the suffix order.

    ``left`` gives each place's left word; a text's first place has one of its own.
    """
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, _Node]] = []                 # open intervals: words in common, places
    for r, place in enumerate(order):
        node, words = _Node(place), common[r] if r < len(common) else 0
        while stack and stack[-1][0] > words:
            reach, other = stack.pop()
            node = _meet(other, node, left, reach, found)
        if stack and stack[-1][0] == words:
            reach, other = stack.pop()
            stack.append((reach, _meet(other, node, left, reach, found)))
        elif words:
            stack.append((words, node))
    return found


def find_runs(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs, in order of start and period; starts count over all texts."""
    size = np.diff(offsets)
    text = np.repeat(np.arange(len(size)), size)
    suffixes = SuffixOrder(codes, text, np.repeat(offsets[1:], size))
    left = np.empty(len(codes), np.int64)
    left[1:] = codes[:-1]
    left[offsets[:-1][size > 0]] = -1
    pairs = maximal_pairs(suffixes.order.tolist(), suffixes.common.tolist(), left.tolist())
    i, j, reach = (np.array(c, np.int64) for c in (zip(*pairs) if pairs else ([], [], [])))
    period, length = j - i, j - i + reach
    long = np.flatnonzero(length >= MIN_LENGTH)
    i, period, length = i[long], period[long], length[long]
    by = np.lexsort((period, length, i))
    i, period, length = i[by], period[by], length[by]
    first = np.concatenate(([True], (i[1:] != i[:-1]) | (length[1:] != length[:-1]))) if len(i) else np.zeros(0, bool)
    i, period, length = i[first], period[first], length[first]
    by = np.lexsort((period, i))
    return i[by], length[by], period[by]


def planted(ids: np.ndarray, crc: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which original word each word becomes.

    A text whose checksum ends in 0 repeats, from some word on, the words from there;
    place and period follow from the checksum (the query's contract).  ``ids`` tells
    the rows that have one.
    """
    take = np.arange(offsets[-1])
    for row in np.flatnonzero(ids & (crc % 10 == 0) & (np.diff(offsets) > 0)).tolist():
        n, g = int(offsets[row + 1] - offsets[row]), int(crc[row]) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        base = int(offsets[row])
        take[base + a:base + n] = base + a + np.arange(n - a) % p
    return take


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """``doc_id, runs, collapsed``, one row per document.

    ``runs`` holds every run's start, length and period by start, then period;
    ``collapsed`` the words that no run holds after its first period, joined by
    one space.  ``plant`` first writes repetitions into some texts (``planted``).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_column(text_col))
    rows = rows.withColumn("crc", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", _PART):
                words, offsets = split_words(*utf8(part.column("text")))
                if plant:
                    crc = part.column("crc")
                    words = words.take(pa.array(planted(np.array(crc.is_valid()), crc.fill_null(0).to_numpy(), offsets)))
                codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
                start, length, period = find_runs(codes, offsets)
                of = np.searchsorted(offsets, start, "right") - 1
                runs = pa.StructArray.from_arrays(
                    [pa.array(start - offsets[of]), pa.array(length), pa.array(period)], fields=list(kind))
                at = np.searchsorted(of, np.arange(part.num_rows + 1)).astype(np.int32)
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, start + period, 1)
                np.add.at(edge, start + length, -1)
                kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                lists = pa.LargeListArray.from_arrays(pa.array(np.searchsorted(kept, offsets)), words.take(pa.array(kept)))
                collapsed = pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(at), runs), collapsed.cast(pa.binary())],
                    ["doc_id", "runs", "collapsed"])

    found = rows.mapInArrow(run, "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
                                 "collapsed binary")
    return found.select("doc_id", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def longest_run(runs: str = "runs"):
    """The run of greatest length; ties: the smallest start, then period."""
    first = F.array_min(F.transform(runs, lambda r: F.struct(
        (-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    return F.when(first.isNotNull(), F.struct(first["start"].alias("start"), (-first["n"]).alias("length"),
                                              first["period"].alias("period")))


def run_lines(runs: str = "runs"):
    """Every run as a line ``start,length,period``."""
    return F.array_join(F.transform(runs, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
