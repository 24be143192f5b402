"""Removal of repeated byte strings by a sampled suffix array (operator 5).

A byte goes if some string of ``length`` bytes covering it also starts
elsewhere; every occurrence goes, judged on the input.

Sampled suffixes.  In each window of ``length`` bytes the smallest hash of a
``gram``-byte string marks an anchor (the leftmost on ties).  Equal windows
have their anchors at equal places, so equal windows meet if the suffixes
that start at anchors are compared, about one position in 170.  Consecutive
windows with one anchor form a run; its span is the text the run covers.

1. An anchor whose gram occurs once has no repeated window.
2. Equal spans around equal grams repeat in all windows.  This resolves the
   inside of copies with one row per anchor.
3. What is left are runs that lie across the edge of a repeat: their gram
   occurs elsewhere, their span doesn't.  They, and one run of each other span
   of the gram, are cut at fixed distances from the anchor into blocks of
   ``BLOCK_WINDOWS`` windows.  A block whose core, the bytes common to all its
   windows, occurs once has no repeated window; equal block spans repeat
   in all of theirs.
4. The windows of the blocks still open are suffixes to be sorted.  A suffix is
   its two leading tokens, the fingerprints of the window's halves.  Sampled
   splitters (Spark's range partitioning) deal the suffixes by their tokens
   into buckets; each bucket is sorted locally by a multikey quicksort, and
   equal neighbours are repeats.  The splitters order ties by place, so a very
   frequent window spreads over buckets, and the buckets' first and last
   suffixes are compared across boundaries.

Texts are known by a 128-bit hash of their content: once frequent grams are
known, copies are one entry with their number as a weight, and their common
cover is found once.

Defined results: null or empty text has no bytes, nothing removed and an empty
rest; texts shorter than ``length`` stay whole; of repeated rows of at least
``length`` bytes nothing stays; a null id is carried through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Scratch, held, text_column, text_key, utf8

LENGTH = 400
GRAM = 64
BLOCK_WINDOWS = 16

_BLOCK = 1 << 18
_ODD = 0x9E3779B97F4A7C15                       # odd multiplier of the polynomial hash
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class _Hashes:
    """Polynomial hashes of all substrings of one block, from prefix sums modulo 2**64."""

    def __init__(self, size: int):
        byte = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        self._byte = _mix(_mix(byte))
        self._power = self._powers(_ODD, size + 1)
        self._inverse = self._powers(pow(_ODD, -1, 1 << 64), size + 1)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out, filled, jump = np.ones(n, np.uint64), 1, base
        while filled < n:
            more = min(filled, n - filled)
            out[filled:filled + more] = out[:more] * np.uint64(jump)
            filled, jump = filled + more, jump * jump & _MASK
        return out

    def load(self, data: np.ndarray) -> None:
        self._sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._byte[data] * self._power[:len(data)], out=self._sum[1:])

    def of(self, start, stop) -> np.ndarray:
        """Hashes of [start, stop); arrays or slices of positions."""
        return _mix((self._sum[stop] - self._sum[start]) * self._inverse[start])


def _hashes(size: int) -> _Hashes:
    return held("repeats", size, lambda: _Hashes(size))


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive keys."""
    span, low = 1, keys
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


def anchor_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Runs of windows with one anchor: text, first and last window, the anchor's
    distance from the first, gram and span hashes.

    Blocks bound the memory for long texts; a run that a block's end cuts is
    two runs, which step 3 resolves.
    """
    out = []
    hashes = _hashes(_BLOCK + length)
    for begin in range(0, max(0, len(data) - length + 1), _BLOCK):
        part = data[begin:begin + _BLOCK + length - 1]
        n = len(part) - length + 1
        hashes.load(part)
        grams = hashes.of(slice(0, len(part) - gram + 1), slice(gram, len(part) + 1))
        place = np.arange(len(grams), dtype=np.uint64)
        anchor = _window_minima((grams & np.uint64(0xFFFFFFFF00000000)) | place, length - gram + 1)
        anchor = (anchor & np.uint64(0xFFFFFFFF)).astype(np.int64)
        text = np.searchsorted(offsets, np.arange(begin, begin + n), "right") - 1
        new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))))
        last = np.append(new[1:], n) - 1
        of = text[new]
        last = np.minimum(last, offsets[of + 1] - length - begin)        # windows inside the text only
        ok = last >= new
        new, last, of = new[ok], last[ok], of[ok]
        a = anchor[new]
        shape = _mix((a - new).astype(np.uint64) << np.uint64(32) | (last - new).astype(np.uint64))
        span = _mix(hashes.of(new, last + length) ^ shape)
        out.append((of, begin + new - offsets[of], begin + last - offsets[of], a - new, grams[a], span))
    if not out:
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2
    return [np.concatenate(c) for c in zip(*out)]


def _parts(batch: pa.RecordBatch, column: str = "text"):
    """The batch in parts of about a block of text."""
    _, off = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + _BLOCK, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text`` and the text's 128-bit key."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_column(text_col)).withColumns(text_key())


def _runs(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in _parts(batch):
                of, first, last, lead, grams, span = anchor_runs(*utf8(part.column("text")), length, gram)
                rows = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [part.column("k1").take(rows), part.column("k2").take(rows),
                     *(pa.array(x.astype(np.int32)) for x in (first, last, lead)), _long(grams), _long(span)],
                    ["k1", "k2", "first", "last", "lead", "gram", "span"])

    return keyed.select("k1", "k2", "text").mapInArrow(
        run, "k1 bigint, k2 bigint, first int, last int, lead int, gram bigint, span bigint")


def _packed_text(keyed: DataFrame, *columns: str) -> DataFrame:
    """The columns with the text compressed as ``z``, to be shuffled."""
    schema = ", ".join(f"{c} {keyed.schema[c].dataType.simpleString()}" for c in columns) + ", z binary"

    def run(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in _parts(batch):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in columns], pa.array(map(press.compress, texts), pa.binary())],
                    [*columns, "z"])

    return keyed.select(*columns, "text").mapInArrow(run, schema)


def _excerpts(open_runs: DataFrame, keyed: DataFrame, length: int) -> DataFrame:
    """``run, lead, n, wanted, excerpt``: the span texts of the open runs.

    A text's runs travel as one list, no longer than the text; one of its
    copies is enough.
    """
    one = keyed.groupBy("k1", "k2").agg(F.min(F.coalesce("doc_id", F.lit(0))).alias("pick"))
    per_text = (open_runs.groupBy("k1", "k2").agg(F.collect_set(F.struct("run", "first", "last", "lead", "wanted")).alias("runs"))
                .join(one, ["k1", "k2"]))
    texts = _packed_text(keyed.withColumn("pick", F.coalesce("doc_id", F.lit(0))), "k1", "k2", "pick")

    def run(batches):
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for z, runs in zip(batch.column("z"), batch.column("runs")):
                text = unpress.decompress(z.as_py())
                own = runs.values.flatten()
                first, last = own[1].to_pylist(), own[2].to_pylist()
                n = pa.array([b - a + 1 for a, b in zip(first, last)], pa.int32())
                cut = pa.array([text[a:b + length] for a, b in zip(first, last)], pa.binary())
                yield pa.RecordBatch.from_arrays([own[0], own[3], n, own[4], cut],
                                                 ["run", "lead", "n", "wanted", "excerpt"])

    return texts.join(per_text, ["k1", "k2", "pick"]).select("z", "runs").mapInArrow(
        run, "run bigint, lead int, n int, wanted boolean, excerpt binary")


def _repeat(values: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value n times, and the number of each repetition."""
    return np.repeat(values, n), np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def _blocks(excerpts: DataFrame, length: int) -> DataFrame:
    """``run, block, wanted, core, span``: the runs' blocks; span null for a part of a block.

    A window lies ``lead - i`` bytes before its run's anchor, i counting from
    the run's first window; blocks are multiples of that distance.
    """
    width = BLOCK_WINDOWS

    def run(batches):
        hashes = _hashes(_BLOCK + 2 * length)
        for batch in batches:
            for part in _parts(batch, "excerpt"):
                data, off = utf8(part.column("excerpt"))
                hashes.load(data)
                lead, n = (part.column(c).to_numpy().astype(np.int64) for c in ("lead", "n"))
                low = lead - n + 1                        # the distances low..lead are in the run
                at, k = _repeat(np.arange(len(n)), lead // width - low // width + 1)
                block = low[at] // width + k
                anchor = off[at] + lead[at]
                core_start = anchor - block * width
                core = hashes.of(core_start, core_start - width + 1 + length)
                whole = (block * width >= low[at]) & (block * width + width - 1 <= lead[at])
                inner = np.where(whole, core_start, off[at] + width - 1)     # any place for parts
                span = hashes.of(inner - width + 1, np.minimum(inner + length, len(data)))
                rows = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [part.column("run").take(rows), pa.array(block.astype(np.int32)), part.column("wanted").take(rows),
                     _long(core), pa.array(span.view(np.int64), mask=~whole)], ["run", "block", "wanted", "core", "span"])

    return excerpts.mapInArrow(run, "run bigint, block int, wanted boolean, core bigint, span bigint")


def _suffixes(excerpts: DataFrame, open_blocks: DataFrame, length: int) -> DataFrame:
    """``t1, t2, place, wanted``: the windows of the open blocks; place is run * 2**10 + window."""
    half, width = length // 2, BLOCK_WINDOWS
    chosen = open_blocks.groupBy("run").agg(F.collect_set("block").alias("blocks"))

    def run(batches):
        hashes = _hashes(_BLOCK + 2 * length)
        for batch in batches:
            for part in _parts(batch, "excerpt"):
                data, off = utf8(part.column("excerpt"))
                hashes.load(data)
                lists = part.column("blocks")
                count = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                block = lists.flatten().to_numpy().astype(np.int64)
                of = np.repeat(np.arange(len(count)), count)
                lead, n = (part.column(c).to_numpy().astype(np.int64) for c in ("lead", "n"))
                near = np.maximum(block * width, (lead - n + 1)[of])
                far = np.minimum(block * width + width - 1, lead[of])
                at, k = _repeat(np.arange(len(block)), far - near + 1)
                window = lead[of[at]] - far[at] + k
                p = off[of[at]] + window
                runs = part.column("run").to_numpy()[of[at]]
                yield pa.RecordBatch.from_arrays(
                    [_long(hashes.of(p, p + half)), _long(hashes.of(p + half, p + length)),
                     pa.array(runs * 1024 + window), part.column("wanted").take(pa.array(of[at]))],
                    ["t1", "t2", "place", "wanted"])

    return excerpts.join(chosen, "run").mapInArrow(run, "t1 bigint, t2 bigint, place bigint, wanted boolean")


def multikey_order(*keys: np.ndarray) -> np.ndarray:
    """Order of rows by several keys: rows equal so far are partitioned by the next key."""
    order = np.argsort(keys[0], kind="quicksort")
    for depth in range(1, len(keys)):
        same = np.ones(max(0, len(order) - 1), bool)
        for k in keys[:depth]:
            ranked = k[order]
            same &= ranked[1:] == ranked[:-1]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).astype(np.int8)))
        for lo, hi in zip(edges[::2].tolist(), (edges[1::2] + 1).tolist()):
            part = order[lo:hi]
            order[lo:hi] = part[np.argsort(keys[depth][part], kind="quicksort")]
    return order


def _neighbours(batches):
    """Sorts one bucket; yields its repeated suffixes and, as edges, its first and last one."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    bucket = pa.Table.from_batches(held)
    t1, t2 = (bucket.column(k).to_numpy() for k in ("t1", "t2"))
    order = multikey_order(t1, t2)
    a, b = t1[order], t2[order]
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    repeated = np.concatenate((same, [False])) | np.concatenate(([False], same))
    wanted = bucket.column("wanted").to_numpy(zero_copy_only=False)[order].astype(bool)
    ends = np.zeros(len(order), bool)
    ends[[0, -1]] = True
    for pick, edge in ((repeated & wanted & ~ends, False), (ends, True)):
        rows = bucket.take(pa.array(order[pick])).combine_chunks()
        yield from (rows.append_column("edge", pa.array(np.full(rows.num_rows, edge)))
                    .append_column("repeated", pa.array(repeated[pick])).to_batches())


def _sorted_repeats(suffixes: DataFrame, scratch: Scratch, bucket_rows: int) -> DataFrame:
    """``place`` of the wanted windows that occur again."""
    buckets = max(1, -(-suffixes.count() // bucket_rows))
    dealt = suffixes.select("t1", "t2", "place", "wanted").repartitionByRange(buckets, "t1", "t2", "place")
    found = scratch.table(dealt.mapInArrow(
        _neighbours, "t1 bigint, t2 bigint, place bigint, wanted boolean, edge boolean, repeated boolean"))
    edges = found.where("edge")
    met = edges.groupBy("t1", "t2").agg(F.count("*").alias("n")).where("n > 1").select("t1", "t2", F.lit(True).alias("met"))
    across = edges.where("wanted").join(met, ["t1", "t2"], "left").where(F.col("repeated") | F.col("met"))
    return found.where("NOT edge").select("place").unionByName(across.select("place"))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_rows: int = 1_000_000,
                    id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """``k1, k2, ranges``: per text key, the byte ranges [start, stop) that repeat, unmerged."""
    if not gram <= length - BLOCK_WINDOWS + 1 or length - gram >= 1024:
        raise ValueError("a gram must fit into a block's core, and a run into 1024 windows")
    scratch = scratch or Scratch(docs.sparkSession, "repeats")
    keyed = _keyed(docs, id_col, text_col)
    runs = scratch.table(_runs(keyed, length, gram))
    grams = runs.groupBy("gram").agg(F.count("*").alias("n"), F.min("span").alias("lo"), F.max("span").alias("hi"))
    # what is joined back is stored first: between two plain tables, Spark
    # splits the tasks of a frequent gram, which it can't above an aggregate
    often = scratch.table(grams.where("n > 1").select("gram", (F.col("lo") != F.col("hi")).alias("varied")))
    # copies of a text are one from here on, with their number as a weight
    met = scratch.table(runs.join(often, "gram").groupBy("k1", "k2", "first").agg(
        *[F.min(c).alias(c) for c in ("last", "lead", "gram", "span", "varied")], F.count("*").alias("copies")))
    scratch.drop(runs)
    mark = F.xxhash64("k1", "k2", "first")
    spans = scratch.table(met.groupBy("gram", "span").agg(F.sum("copies").alias("n"), F.min(mark).alias("chosen")))
    lone = scratch.table(spans.where("n = 1").select("gram").distinct().select("gram", F.lit(True).alias("has_lone")))
    known = (met.join(spans, ["gram", "span"]).join(lone, "gram", "left")
             .withColumn("chosen", F.col("chosen") == mark))
    # the numbers of runs stay as they are written
    known = scratch.table(known.select("k1", "k2", "first", "last", "lead", "n", F.monotonically_increasing_id().alias("run"),
                                       (F.col("varied") & F.col("has_lone") & F.col("chosen")).alias("open")))
    scratch.drop(met)
    inside = known.where("n > 1").select("k1", "k2", F.col("first").alias("start"), (F.col("last") + length).alias("stop"))
    open_runs = known.where("open").withColumn("wanted", F.col("n") == 1)
    excerpts = scratch.table(_excerpts(open_runs, keyed, length))
    resolved, open_blocks = _resolve_blocks(scratch.table(_blocks(excerpts, length)), scratch)
    suffixes = scratch.table(_suffixes(excerpts, open_blocks, length))
    places = _sorted_repeats(suffixes, scratch, bucket_rows)
    own = open_runs.select("run", "k1", "k2", "first", "lead")
    block_stop = F.col("first") + F.col("lead") - F.col("block") * BLOCK_WINDOWS + length
    in_blocks = resolved.join(own, "run").select(
        "k1", "k2", (block_stop - length - BLOCK_WINDOWS + 1).alias("start"), block_stop.alias("stop"))
    window = F.col("first") + F.col("place").bitwiseAND(1023).cast("int")
    at_edges = places.withColumn("run", F.shiftright("place", 10)).join(own, "run").select(
        "k1", "k2", window.alias("start"), (window + length).alias("stop"))
    return (inside.unionByName(in_blocks).unionByName(at_edges).groupBy("k1", "k2")
            .agg(F.collect_set(F.struct("start", "stop")).alias("ranges")))


def _resolve_blocks(blocks: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``run, block`` of the wanted blocks that repeat whole, and of those to be sorted.

    Sorted are blocks whose core occurs again but not their span, and one
    block of each other span around such a core.
    """
    place = F.xxhash64("run", "block")
    cores = scratch.table(blocks.groupBy("core").agg(F.count("*").alias("n_core")).where("n_core > 1"))
    spans = scratch.table(blocks.where("span IS NOT NULL").groupBy("core", "span")
                          .agg(F.count("*").alias("n_span"), F.min(place).alias("chosen")))
    known = scratch.table(blocks.join(cores, "core").join(spans, ["core", "span"], "left")
                          .withColumn("unmet", F.coalesce(F.col("n_span") == 1, F.lit(True))))
    asked = scratch.table(known.where("wanted AND unmet").select("core").distinct())
    resolved = known.where("wanted AND NOT unmet").select("run", "block")
    open_blocks = known.where(F.col("unmet") | (F.col("chosen") == place)).join(asked, "core").select("run", "block")
    return resolved, open_blocks


def merge_ranges(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by any range."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    new = np.flatnonzero(np.concatenate(([True], start[1:] > reach[:-1])))
    return start[new], reach[np.append(new[1:], len(start)) - 1]


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_rows: int = 1_000_000,
                   whole_characters: bool = False, id_col: str = "doc_id", text_col: str = "text",
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes), one row per document.

    ``whole_characters`` keeps characters of which only a part would go.
    ``carry`` names columns of ``docs`` to return as the struct ``carried``.
    """
    ranges = repeated_ranges(docs, length, gram, bucket_rows, id_col, text_col)
    carried = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("struct<none: boolean>")
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_column(text_col),
                        carried.alias("carried")).withColumns(text_key())
    texts = _packed_text(keyed, "k1", "k2", "doc_id", "carried")
    joined = texts.join(ranges, ["k1", "k2"], "left").select("doc_id", "z", "ranges", "carried")
    kind = joined.schema["carried"].dataType.simpleString()

    def cut(text: bytes, ranges: pa.ListScalar) -> tuple[int, int, bytes]:
        if not ranges.is_valid or not len(ranges.values):
            return 0, 0, text
        start, stop = merge_ranges(*(c.to_numpy().astype(np.int64) for c in ranges.values.flatten()))
        if whole_characters:
            begins = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
            at = np.append(np.flatnonzero(begins), len(text))
            start, stop = at[np.searchsorted(at, start)], at[np.searchsorted(at, stop, "right") - 1]
            start, stop = start[stop > start], stop[stop > start]
        keep = zip(np.append(0, stop).tolist(), np.append(start, len(text)).tolist())
        return int((stop - start).sum()), len(start), b"".join(text[a:b] for a, b in keep)

    def run(batches):
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [unpress.decompress(z) for z in part.column("z").to_pylist()]
                done = [cut(t, r) for t, r in zip(texts, part.column("ranges"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array([d[0] for d in done], pa.int64()),
                     pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.binary()),
                     part.column("carried")], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "carried"])

    return joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, "
                                  f"carried {kind}")
