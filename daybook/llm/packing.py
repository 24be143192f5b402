"""Best-fit packing with certified bounds (operator 8).

Tokenising.  A document is the tokenizer's ids followed by an end id; one
longer than a sequence is cut into whole sequences and a rest.  The word
vocabulary drops white space and never joins characters across it, so ids are
found once per distinct word of a batch and gathered for the texts.

Packing.  Pieces are dealt to groups of about ``group_rows`` rows, a number
that bounds a group's memory whatever the corpus size.  Each group runs
best-fit decreasing and computes a lower bound of its bin count from
dual-feasible functions.  A group that meets its bound is certified: no packing
of its pieces needs fewer bins, so its full and nearly full bins stay.  What
can still be saved lies between groups and in groups with a gap: groups with a
gap send the pieces of all bins that are not full, certified groups those of
their emptiest bin, and the pool is dealt anew and packed again.  This ends
when a round saves no bin or one group was left.

Defined results: null or empty text is the end id alone; repeated rows are
packed each as a document of its own; equal lengths go by (doc_id, piece);
an empty table gives no sequences; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable
from itertools import count

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Scratch, held, slices, text_column

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
CAPACITY = 4096


# Words of Latin-1 letters followed by ASCII punctuation other than the
# apostrophe: the tokenizer always cuts between the two.
_LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha() and c not in "ªµº")
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")


_ENCODED = 8_000                     # words that the tokenizer gets at once, as it holds much for each


def _gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one after the other."""
    stop = np.cumsum(length)
    place = np.repeat(start - (stop - length), length)
    place += np.arange(len(place))
    return flat[place]


class _Entries:
    """Distinct words and their ids, as columns: word i has ids[at[i]:at[i + 1]]."""

    def __init__(self, words: pa.Array, ids: np.ndarray, length: np.ndarray):
        self.words, self.ids, self.at = words, ids, np.concatenate(([0], np.cumsum(length)))

    @staticmethod
    def none() -> _Entries:
        return _Entries(pa.array([], pa.string()), np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def __len__(self) -> int:
        return len(self.words)

    def __contains__(self, word: str) -> bool:
        return pc.index(self.words, word).as_py() >= 0

    def places(self, words: pa.Array) -> np.ndarray:
        """Where the words stand, -1 for others."""
        return pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False)

    def take(self, rows: np.ndarray) -> _Entries:
        length = np.diff(self.at)[rows]
        return _Entries(self.words.take(pa.array(rows)), _gather(self.ids, self.at[rows], length), length)

    def and_all(self, *more: _Entries) -> _Entries:
        tables = (self, *more)
        return _Entries(pa.concat_arrays([t.words for t in tables]), np.concatenate([t.ids for t in tables]),
                        np.concatenate([np.diff(t.at) for t in tables]))


class _Remembered:
    """Ids of strings met lately, each encoded once while it is known.

    Two halves of ``limit`` / 2 bytes: a full newer half becomes the older one,
    whose place it takes, and what is met again moves to the newer one.  So what is
    frequent stays, and what was met once goes.  Both are columns, no objects per
    word: a text's distinct words are searched all at once.
    """

    ENTRY = 100                     # bytes of an entry besides its characters, about, with what a search of it takes

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int):
        self._encode, self._half, self._size = encode, limit // 2, 0
        self._new, self._old = _Entries.none(), _Entries.none()

    def __len__(self) -> int:
        return len(self._new) + len(self._old)

    def _keep(self, more: _Entries) -> None:
        size = np.cumsum(pc.binary_length(more.words).to_numpy(zero_copy_only=False).astype(np.int64) + self.ENTRY)
        if self._size + size[-1] > self._half:
            self._old, self._new, self._size = self._new, _Entries.none(), 0
            size = size[size <= self._half]
            more = more.take(np.arange(len(size)))
        if len(size):
            self._new, self._size = self._new.and_all(more), self._size + int(size[-1])

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All words' ids, whatever the table keeps of them: ids, and each word's start and number there."""
        words = words.cast(pa.string())
        at = self._new.places(words).astype(np.int64)
        other = np.flatnonzero(at < 0)
        if not len(other):
            return self._new.ids, self._new.at[at], np.diff(self._new.at)[at]
        again = self._old.places(words.take(pa.array(other)))
        unmet = words.take(pa.array(other[again < 0]))
        more = self._old.take(again[again >= 0])
        fresh = [unmet.slice(i, _ENCODED) for i in range(0, len(unmet), _ENCODED)]
        more = more.and_all(*[_Entries(words, *self._encode(words.to_pylist())) for words in fresh])
        every = self._new.and_all(more)
        at[np.concatenate((other[again >= 0], other[again < 0]))] = len(self._new) + np.arange(len(more))
        self._keep(more)
        return every.ids, every.at[at], np.diff(every.at)[at]


class WordBPE:
    """Ids of white-space separated words.

    Letters followed by marks are put together from the ids of both; those
    pieces, lower-cased, and all other words are remembered in at most about
    ``remember`` bytes.  Results don't depend on it.
    """

    def __init__(self, path: str, remember: int = 70_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)   # ids that end a piece
        self._ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._parts = _Remembered(self._encode_parts, remember * 3 // 4)
        self._others = _Remembered(self._encode_words, remember // 4)

    def _encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Parts are single pieces of the tokenizer: their ids end at an end of word."""
        ids = np.array(self._tokenizer.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, np.uint32)
        return ids, np.diff(np.flatnonzero(self._ends[ids]), prepend=-1)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for own in ids for i in own), np.uint32, int(length.sum())), length

    def ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, and each one's number of ids."""
        core, rest = pc.ascii_rtrim(words, _MARKS), pc.utf8_ltrim(words, _LETTERS)
        n_core, n_rest, n = (pc.binary_length(x).to_numpy(zero_copy_only=False) for x in (core, rest, words))
        plain = (n_core > 0) & (n_core + n_rest == n)        # what isn't letters is marks
        split, marked, whole = (np.flatnonzero(x) for x in (plain, plain & (n_rest > 0), ~plain))
        coded = pa.concat_arrays([pc.utf8_lower(core.take(pa.array(split))), rest.take(pa.array(marked))]).dictionary_encode()
        ids, start, length = self._parts.look_up(coded.dictionary)
        others, others_start, others_length = self._others.look_up(words.take(pa.array(whole)))
        # two stretches a word: letters and marks, or the whole word and nothing
        starts, lengths = np.zeros((len(words), 2), np.int64), np.zeros((len(words), 2), np.int64)
        part = coded.indices.to_numpy(zero_copy_only=False)
        for side, at, own in ((0, split, part[:len(split)]), (1, marked, part[len(split):])):
            starts[at, side], lengths[at, side] = start[own], length[own]
        starts[whole, 0], lengths[whole, 0] = others_start + len(ids), others_length
        return _gather(np.concatenate((ids, others)), starts.ravel(), lengths.ravel()), lengths.sum(axis=1)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, each text's followed by ``end_id``, and their n + 1 offsets."""
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        known, length = self.ids(coded.dictionary)
        flat, length = np.append(known, np.uint32(end_id)), np.append(length, 1)
        start = np.cumsum(length) - length
        stops = np.asarray(words.offsets, dtype=np.int64)[1:] - words.offsets[0].as_py()
        index = np.insert(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), stops, len(length) - 1)
        n = length[index]
        stop = np.cumsum(n)
        return _gather(flat, start[index], n), np.concatenate(([0], stop[stops + np.arange(len(stops))]))


def _vocabulary(path: str) -> WordBPE:
    """This worker's tokenizer, kept between tasks."""
    return held("packing", path, lambda: WordBPE(path))


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_documents(docs: DataFrame, path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY,
                  with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document; with ``ids`` (little-endian unsigned 32-bit) on request."""
    path = path or public_tokenizers.path(TOKENIZER)

    def cut(batches):
        bpe = _vocabulary(path)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                ids, at = bpe.encode(part.column("text"), end_id)
                n_pieces = -(-np.diff(at) // capacity)
                doc = np.repeat(np.arange(len(n_pieces)), n_pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                start = piece * capacity
                length = np.minimum(capacity, np.diff(at)[doc] - start)
                first = (at[doc] + start).tolist()
                raw = [ids[f:f + n].tobytes() for f, n in zip(first, length.tolist())]
                columns = [part.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()),
                           pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                           pa.array([zlib.crc32(r) for r in raw], pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(raw, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_column(text_col)).mapInArrow(
        cut, PIECES + (", ids binary" if with_ids else ""))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; ``lengths`` fall.

    ``open_bins[r]`` lists the bins with r left; the bits of ``rooms`` mark the
    values of r that have any, so the tightest fit is the lowest marked bit at
    or above the length.
    """
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, 0
    for i, n in enumerate(lengths.tolist()):
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            at = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, at, used = capacity, used, used + 1
        bins[i], offsets[i] = at, capacity - room
        left = room - n
        if left:
            open_bins[left].append(at)
            rooms |= 1 << left
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing of these lengths uses fewer bins.

    The largest sum over two families of dual-feasible functions.  One
    leaves out lengths below k, counts those above capacity - k as a whole
    bin and keeps the others' share; with k = 0 it is total length over
    capacity.  The other counts in units of k, rounding a length above
    capacity / 2 up by what is lost beside it and other lengths down.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    n_from = np.cumsum(counts[::-1])[::-1]                 # rows of at least this length
    total_to = np.cumsum(counts * size)
    best = -(-int(total_to[-1]) // capacity)
    for k in range(1, capacity // 2 + 1):
        whole = int(n_from[capacity - k + 1])
        middle = int(total_to[capacity - k] - total_to[k - 1])
        best = max(best, whole - (-middle // capacity))
    for k in (capacity // p for p in range(2, min(20, capacity) + 1)):
        units = capacity // k
        big = size > capacity // 2
        value = np.where(big, units - (capacity - size) // k, size // k)
        best = max(best, -(-int((counts * value).sum()) // units))
    return best


def _pack_group(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
    lengths = rows["length"].to_numpy()
    bins, offsets = best_fit_decreasing(lengths, capacity)
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    gap = len(fill) - lower_bound(lengths, capacity)
    emptiest = np.zeros(len(fill), bool)
    emptiest[np.argmin(fill)] = True
    again = (fill < capacity) if gap else emptiest & (fill < capacity)
    return rows.assign(bin=bins, offset=offsets, gap=gap, again=again[bins])


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = 40_000,
         report: Callable[[dict], None] | None = None) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``pieces`` (PIECES columns).

    ``report`` gets a dict with each round's groups, bins and certified groups.
    """
    spark = pieces.sparkSession
    scratch = Scratch(spark, "packing")
    schema = PIECES + ", row bigint, grp int, bin bigint, offset bigint, gap bigint, again boolean"
    # the rows' stored numbers deal them, so that rows without or with one id spread over the groups
    pool, done, pool_bins = scratch.table(pieces.withColumn("row", F.monotonically_increasing_id())), [], None
    for number in count():               # ends, as each round but the last saves a bin
        n = pool.count()
        if not n:
            break
        groups = -(-n // group_rows)
        dealt = pool.withColumn("grp", F.pmod(F.xxhash64("row", F.lit(number)), F.lit(groups)).cast("int"))
        packed = scratch.table(dealt.groupBy("grp").applyInPandas(
            lambda rows: _pack_group(rows, capacity), schema))
        seen = packed.groupBy("grp").agg(F.countDistinct("bin").alias("bins"), F.max("gap").alias("gap"),
                                         F.countDistinct(F.when(F.col("again"), F.col("bin"))).alias("again"))
        total = seen.agg(F.sum("bins").alias("bins"), F.sum("again").alias("again"),
                         F.count_if(F.col("gap") == 0).alias("certified")).first()
        if report:
            report({"groups": groups, "rows": n, **total.asDict()})
        if pool_bins is not None and total["bins"] >= pool_bins:
            break                                        # the exchange saved nothing: keep the last packing
        if done:
            done[-1] = done[-1].where(~F.col("again"))
        done.append(packed.withColumn("round", F.lit(number)))
        if groups == 1 or not total["again"]:
            break
        pool = packed.where("again").select(*pieces.columns, "row")
        pool_bins = total["again"]
    if not done:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    sequence = (F.shiftleft(F.col("round").cast("long"), 56) + F.shiftleft(F.col("grp").cast("long"), 32) + F.col("bin"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, path: str | None = None, end_id: int = END_ID,
                   capacity: int = CAPACITY, group_rows: int = 40_000) -> DataFrame:
    return pack(cut_documents(docs, path, end_id, capacity), capacity, group_rows)
