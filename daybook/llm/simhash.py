"""SimHash near-duplicates by multi-index hashing (operator 4).

Each text gets a 64-bit fingerprint from its word shingles.  Fingerprints
link at ``max_distance`` or fewer differing bits.  The fingerprint is cut into
segments; by the pigeonhole rule two linked fingerprints differ in few bits of
at least one segment, so each distinct fingerprint is filed under its segment
values and also under the values of a small Hamming ball around them.
Whatever meets under one value is compared over all 64 bits.

Equal fingerprints are one entry throughout, so exact copies never meet
pairwise.  A value with more than ``tile`` entries is split into tiles that
meet pair by pair in separate tasks, and a meeting returns links that join
what it found linked, at most one per entry when it is large, never all pairs;
components need no more.

Defined results: null or empty text has no shingles and fingerprint zero, and
links like any other; texts shorter than a shingle are one shingle; repeated
rows share a fingerprint; a null id is carried through and never names a
component unless its component has no other; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Scratch, held, slices, text_column, text_key
from daybook.llm.components import connected_components

BITS = 64
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingle_hashes(text: bytes, width: int, seed: int) -> list[int]:
    words = text.lower().split()          # ASCII case and ASCII white space only, as bytes
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) < width:
        return [xxhash.xxh64_intdigest(joined, seed)]
    length = np.fromiter(map(len, words), np.int64, len(words))
    stop = np.cumsum(length + 1) - 1
    start = stop - length
    cut = map(slice, start[:len(words) - width + 1].tolist(), stop[width - 1:].tolist())
    return list(map(xxhash.xxh64_intdigest, map(joined.__getitem__, cut), repeat(seed)))


def fingerprints(texts: list[bytes], width: int, seed: int) -> np.ndarray:
    """One signed 64-bit fingerprint per text: a bit is set if over half the hashes set it."""
    hashes = [shingle_hashes(t, width, seed) for t in texts]
    n = np.array([len(h) for h in hashes], np.int64)
    flat = np.fromiter((x for h in hashes for x in h), np.uint64, int(n.sum())).astype("<u8")
    row = np.repeat(np.arange(len(texts)) * 256, n)
    out = np.zeros(len(texts), np.uint64)
    for k, byte in enumerate(flat.view(np.uint8).reshape(-1, 8).T):
        counts = np.bincount(row + byte, minlength=len(texts) * 256).reshape(-1, 256) @ _BYTE_BITS
        bits = (counts * 2 > n[:, None]).astype(np.uint64)
        out |= (bits << np.arange(8, dtype=np.uint64)).sum(1, dtype=np.uint64) << np.uint64(8 * k)
    return out.view(np.int64)


def fingerprint_documents(docs: DataFrame, width: int = 4, seed: int = 42,
                          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` with fp as a signed 64-bit integer, and the text's 128-bit key ``k1, k2``."""
    names = ["doc_id", "k1", "k2"]

    def run(batches):
        held("simhash")
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [*map(part.column, names), pa.array(fingerprints(texts, width, seed), pa.int64())], [*names, "fp"])

    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_column(text_col)).withColumns(text_key())
    return keyed.mapInArrow(run, "doc_id bigint, k1 bigint, k2 bigint, fp bigint")


def segments(max_distance: int, n: int) -> list[tuple[int, int, int]]:
    """First bit, bits and ball radius of each segment.

    With k = a * n + b, fingerprints within k bits are within a bits in one of
    the first b + 1 segments or within a - 1 in one of the others; a segment
    with radius below zero is not needed.
    """
    a, b = divmod(max_distance, n)
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(lo, hi - lo, a if i <= b else a - 1) for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))
            if i <= b or a > 0]


def ball(bits: int, radius: int) -> list[int]:
    """Bit masks of one to ``radius`` bits."""
    return [sum(1 << i for i in c) for r in range(1, radius + 1) for c in combinations(range(bits), r)]


def _filed(fps: DataFrame, max_distance: int, n_segments: int) -> DataFrame:
    """``code, fp``: each fingerprint under its segment values and their balls.

    Of two values that differ, only the one with a zero at the lowest
    differing bit looks the other up; that finds every pair once a segment.
    """
    codes = []
    for s, (lo, bits, radius) in enumerate(segments(max_distance, n_segments)):
        value = F.shiftrightunsigned("fp", lo).bitwiseAND((1 << bits) - 1)
        tag = s << 58
        codes.append(F.array(value + F.lit(tag)))
        if masks := ball(bits, radius):
            probes = F.filter(F.array(*[F.lit(m).cast("long") for m in masks]),
                              lambda m: value.bitwiseAND(m).bitwiseAND(-m) == 0)
            codes.append(F.transform(probes, lambda m: value.bitwiseXOR(m) + F.lit(tag)))
    return fps.select("fp", F.explode(F.concat(*codes)).alias("code"))


def _meet(fps: np.ndarray, max_distance: int) -> tuple[list, list]:
    """Links that join the distinct fingerprints of one large meeting.

    A fingerprint is compared with those not reached yet; the ones it links
    leave the rest, so each is reached once.
    """
    us, vs, rest = [], [], fps
    while len(rest):
        frontier, rest = [rest[:1]], rest[1:]
        while frontier and len(rest):
            block = frontier.pop()
            for i, x in enumerate(block):
                near = np.bitwise_count(rest ^ x) <= max_distance
                if near.any():
                    found, rest = rest[near], rest[~near]
                    us.append(np.full(len(found), x))
                    vs.append(found)
                    frontier.append(found)
                if not len(rest):
                    break
    return us, vs


def _links(batches, max_distance: int, small: int = 8):
    """Links within each run of equal keys of sorted rows (code, a, b, fp)."""
    def link(keys: np.ndarray, fps: np.ndarray):
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        size = np.diff(np.append(first, len(keys)))
        of = np.repeat(size, size)
        us, vs = [], []
        few = of <= small
        k, f = keys[few], fps[few]
        for shift in range(1, small):
            hit = (k[shift:] == k[:-shift]) & (np.bitwise_count(f[shift:] ^ f[:-shift]) <= max_distance)
            us.append(f[shift:][hit])
            vs.append(f[:-shift][hit])
        for at, n in zip(first[size > small].tolist(), size[size > small].tolist()):
            u, v = _meet(np.unique(fps[at:at + n]), max_distance)
            us += u
            vs += v
        u, v = np.concatenate(us), np.concatenate(vs)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    held: list[pa.RecordBatch] = []

    def joined(parts):
        columns = [np.concatenate([p.column(i).to_numpy(zero_copy_only=False) for p in parts]) for i in range(4)]
        keys = np.rec.fromarrays(columns[:3])
        return keys, columns[3].astype(np.int64).view(np.uint64)

    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < 50_000:
            continue
        keys, fps = joined(held)
        whole = int(np.flatnonzero(keys == keys[-1])[0])        # the last key may go on
        if whole:
            yield link(keys[:whole], fps[:whole])
        held = [pa.RecordBatch.from_arrays([pa.array(keys[n][whole:]) for n in keys.dtype.names]
                                           + [pa.array(fps[whole:].view(np.int64))], batch.schema.names)]
        rows = 0
    if held:
        keys, fps = joined(held)
        if len(keys):
            yield link(keys, fps)


def near_duplicates(fps: DataFrame, scratch: Scratch, max_distance: int = 4, n_segments: int = 3,
                    tile: int = 8192) -> DataFrame:
    """Links ``u, v`` that join all distinct fingerprints ``fps(fp)`` within ``max_distance`` bits."""
    filed = _filed(fps, max_distance, n_segments)
    heavy = (filed.groupBy("code").agg(F.count("*").alias("n")).where(F.col("n") > tile)
             .select("code", F.ceil(F.col("n") / tile).cast("int").alias("tiles")))
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    met = F.explode(F.when(F.col("tiles").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = (filed.join(heavy, "code", "left").select("code", F.coalesce(own, F.lit(0)).alias("own"), met.alias("met"), "fp")
             .select("code", F.least("own", "met").alias("a"), F.greatest("own", "met").alias("b"), "fp"))
    keyed = dealt.repartition("code", "a", "b").sortWithinPartitions("code", "a", "b")
    return scratch.table(keyed.mapInArrow(lambda batches: _links(batches, max_distance), "u bigint, v bigint").distinct())


def simhash_groups(docs: DataFrame, width: int = 4, seed: int = 42, max_distance: int = 4, n_segments: int = 3,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id``: the smallest id that links lead to.

    Also ``kept``, true for one document of each group, and the text's key ``k1, k2``.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.table(fingerprint_documents(docs, width, seed, id_col, text_col))
    # the row that stays: the smallest id, rows without one last
    place = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "k1", "k2")
    distinct = scratch.table(marked.groupBy("fp").agg(F.min(place).alias("first")))
    links = near_duplicates(distinct.select("fp"), scratch, max_distance, n_segments)
    component = connected_components(links, scratch)
    named = (distinct.join(component, F.col("fp") == F.col("node"), "left")
             .select("fp", "first", F.coalesce("label", "fp").alias("label")))
    smallest = named.groupBy("label").agg(F.min("first").alias("chosen"))
    by_fp = named.join(smallest, "label").select("fp", "chosen")
    return marked.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("chosen.doc_id").alias("component_id"),
        (place == F.col("chosen")).alias("kept"), "k1", "k2")
