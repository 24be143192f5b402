"""Byte-level BPE encoding and decoding (operator 9).

The rank file of a byte-level vocabulary is loaded into the tokenizers
library: each byte is written as one printable character (the usual byte
table), every pair of known tokens whose concatenation is a token becomes a
merge at that token's rank, and a piece that is itself a token is taken
whole.  Texts are cut by the vocabulary's pattern; a piece's ids depend on the
piece alone, so each distinct piece is encoded once and remembered in a
bounded table.  Everything runs over Arrow batches in one map without a
shuffle.

Offsets give each token the characters it touches: a token that holds only
part of a character's bytes spans that whole character, so neighbouring
tokens of a split character share it.  Decoding looks ids up in the table of
token bytes and joins them before any UTF-8 decoding, so characters split
between tokens come back whole.

Defined results: null or empty text has no tokens; repeated rows give repeated
results; a null id is carried through; other columns are ignored.
"""

from __future__ import annotations

import base64
import os
import re
import struct

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import held, slices, text_column

RANKS = "byte_bpe_multi_50k.tiktoken"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE.

    Printable Latin-1 bytes stand for themselves; the rest are numbered
    from U+0100 in byte order.
    """
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


# The letters and numbers (Unicode L and N) below U+0100.
_L, _N = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"

# public_tokenizers.PATTERN for texts below U+0100 without U+001C..U+001F, which
# the two regular expression libraries class differently.
_LATIN = re.compile(public_tokenizers.PATTERN.replace(r"^\s\p{L}\p{N}", rf"^\s{_L}{_N}")
                    .replace(r"\p{L}", f"[{_L}]").replace(r"\p{N}", f"[{_N}]")).findall
_BEYOND_LATIN = re.compile("[\x1c-\x1f\u0100-\U0010ffff]").search


class ByteBPE:
    """Encoder and decoder of one vocabulary; built once per worker.

    A table holds the ids of the pieces met so far.  Beyond ``remember``
    characters (an entry counts 64 more) it starts over, which costs time
    and changes no result.
    """

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN, remember: int = 30_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks = load_ranks(path)
        letters = byte_characters()
        written = {t: "".join(letters[b] for b in t) for t in ranks}
        merges = [(written[t[:i]], written[t[i:]]) for t in sorted(ranks, key=ranks.get)
                  for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self._bpe = Tokenizer(models.BPE({written[t]: r for t, r in ranks.items()}, merges,
                                         ignore_merges=True))
        self._bpe.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._pieces = regex.compile(pattern).findall
        self._latin = _LATIN if pattern == public_tokenizers.PATTERN else self._pieces
        self._bytes = {r: t for t, r in ranks.items()}
        self._known: dict[str, bytes] = {}
        self._size, self._remember = 0, remember

    def _learn(self, new: set[str], pieces: list[str]) -> None:
        size = sum(map(len, new)) + 64 * len(new)
        if self._size + size > self._remember:
            self._known.clear()
            self._size, new = 0, set(pieces)
            size = sum(map(len, new)) + 64 * len(new)
        self._size += size
        new = list(new)
        for p, e in zip(new, self._bpe.encode_batch_fast(new, add_special_tokens=False)):
            ids = e.ids
            self._known[p] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        pieces = (self._pieces if _BEYOND_LATIN(text) else self._latin)(text)
        if new := set(pieces).difference(self._known):
            self._learn(new, pieces)
        return b"".join(map(self._known.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def offsets(self, text: str, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First character and the one after the last that each token touches."""
        lengths = np.array([len(self._bytes[i]) for i in np.frombuffer(ids, "<u4").tolist()], np.int64)
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1      # byte -> character
        stop = np.cumsum(lengths)
        return character[stop - lengths], character[stop - 1] + 1


def _vocabulary(path: str, pattern: str) -> ByteBPE:
    """This worker's vocabulary, kept between tasks."""
    return held("bpe", (path, pattern), lambda: ByteBPE(path, pattern))


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
                     with_offsets: bool = False, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit integers).

    With offsets also ``starts`` and ``stops``, one entry per token.
    """
    path = path or public_tokenizers.path(RANKS)
    schema = "doc_id bigint, n_tokens bigint, ids binary"
    if with_offsets:
        schema += ", starts array<bigint>, stops array<bigint>"

    def encode(batches):
        bpe = _vocabulary(path, pattern)
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                texts = part.column("text").to_pylist()
                ids = [bpe.encode(t) for t in texts]
                columns = [part.column("doc_id"),
                           pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
                names = ["doc_id", "n_tokens", "ids"]
                if with_offsets:
                    found = [bpe.offsets(t, i) for t, i in zip(texts, ids)]
                    columns += [pa.array([f[k].tolist() for f in found], pa.list_(pa.int64())) for k in (0, 1)]
                    names += ["starts", "stops"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       text_column(text_col)).mapInArrow(encode, schema)


def decode_documents(encoded: DataFrame, path: str | None = None,
                     pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Adds ``decoded`` (bytes) to ``doc_id, n_tokens, ids``; null ids decode to nothing."""
    path = path or public_tokenizers.path(RANKS)

    def decode(batches):
        bpe = _vocabulary(path, pattern)
        for batch in batches:
            for part in slices(batch, "ids", 8 << 20):
                decoded = [bpe.decode(i or b"") for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(decoded, pa.binary())], [*part.schema.names, "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        decode, "doc_id bigint, n_tokens bigint, ids binary, decoded binary")
