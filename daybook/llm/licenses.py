"""Licence scan (operator 1).

Licence templates and base phrases are word sequences.  One generalised
suffix automaton holds every template.  A document's words stream through it;
after each word the automaton gives the longest suffix read so far that occurs
in some template (the matching statistics).  Matches that cannot be extended
and are at least ``min_match`` words long are chained per template, in text
and template order with bounded gaps, into spans; a span's coverage is the
share of the template's words that it matched.

The automaton has a few thousand states at most (it grows with the
templates, never with the corpus) and is built once per task.  The scan
is a single map over the documents without a shuffle: a hot source or long text
costs its own length only.

Defined results: null or empty text has no words (counts 0, first/last word
null, labels empty, score 0); repeated rows give repeated results; a null id
is carried through; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import text_column

# The base phrases, by label.
BASE_PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)

# Wording of public licence notices, by label.
TEMPLATES = (
    ("mit", "released under the MIT License"),
    ("mit", "licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a "
                   "copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "licensed under the GNU General Public License"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of "
            "the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met"),
    ("bsd", "licensed under the BSD 3-Clause License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or "
            "neighboring rights to this work"),
)

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

SCHEMA = """doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint,
base_labels string, labels string, score double,
spans array<struct<label: string, first_word: bigint, n_words: bigint, coverage: double>>"""

_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
    ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
    ("labels", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()),
                                  ("n_words", pa.int64()), ("coverage", pa.float64())]))),
])


def words_of(text: str) -> list[bytes]:
    """The words of a text; bytes.lower() changes A-Z only."""
    return WORD.findall(text.encode("utf-8").lower())


class SuffixAutomaton:
    """Generalised suffix automaton over several token sequences."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(dict(edges))
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, token: int, q: int) -> int:
        """A copy of q that holds only its strings up to length(p) + 1."""
        copy = self._state(self.length[p] + 1, self.next[q], self.link[q])
        self.link[q] = copy
        while p != -1 and self.next[p].get(token) == q:
            self.next[p][token] = copy
            p = self.link[p]
        return copy

    def extend(self, last: int, token: int) -> int:
        q = self.next[last].get(token)
        if q is not None:                 # already there, from an earlier sequence
            return q if self.length[q] == self.length[last] + 1 else self._split(last, token, q)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p != -1 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][token]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, token, q)
        return new

    def add(self, tokens: list[int]) -> None:
        last = 0
        for t in tokens:
            last = self.extend(last, t)

    def step(self, state: int, matched: int, token: int) -> tuple[int, int]:
        """State and length of the longest known suffix after one more token."""
        while state and token not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        if token in self.next[state]:
            return self.next[state][token], matched + 1
        return 0, 0


class LicenseScanner:
    """The automaton of all templates, with where each state occurs in them."""

    def __init__(self, base, templates, min_match: int, max_gap: int, min_coverage: float):
        self.min_match, self.max_gap, self.min_coverage = min_match, max_gap, min_coverage
        entries = [(label, words_of(text)) for label, text in (*base, *templates)]
        vocabulary = sorted({w for _, ws in entries for w in ws})
        self.ids = {w: i for i, w in enumerate(vocabulary)}
        self.labels = [label for label, _ in entries]
        self.tokens = [[self.ids[w] for w in ws] for _, ws in entries]
        self.n_base = len(base)
        self.sam = SuffixAutomaton()
        for tokens in self.tokens:
            self.sam.add(tokens)
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.sam.next]
        for t, tokens in enumerate(self.tokens):
            state = matched = 0
            for end, token in enumerate(tokens, 1):
                state, matched = self.sam.step(state, matched, token)
                at = state
                while at > 0:
                    self.ends[at].append((t, end))
                    at = self.sam.link[at]
        # base phrases that are suffixes of a state's longest string: its own and
        # those of the states that its suffix links lead to
        self.phrases: list[list[tuple[int, int]]] = [[] for _ in self.sam.next]
        for state in range(len(self.sam.next)):
            for t, end in self.ends[state]:
                if t < self.n_base and end == len(self.tokens[t]) == self.sam.length[state]:
                    self.phrases[state].append((t, end))
        for state in sorted(range(1, len(self.sam.next)), key=self.sam.length.__getitem__):
            up = self.sam.link[state]
            self.phrases[state] = list({*self.phrases[state], *(self.phrases[up] if up > 0 else ())})

    def scan(self, words: list[bytes]) -> dict:
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int32, len(words))
        known = ids >= 0
        # runs of two or more known words; no phrase or chained match is shorter
        edges = np.flatnonzero(np.diff(np.concatenate(([False], known, [False])).astype(np.int8)))
        base: list[tuple[int, int]] = []                 # (phrase, first word)
        matches: dict[int, list[tuple[int, int, int]]] = {}   # template: (word, position, length)
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if stop - start >= 2:
                self._stream(ids[start:stop].tolist(), start, base, matches)
        spans = self._chain(matches)
        base_labels = sorted({self.labels[t] for t, _ in base})
        found = sorted({*base_labels, *(s["label"] for s in spans)})
        score = max([s["coverage"] for s in spans] + [1.0 if base else 0.0])
        starts = [s for _, s in base]
        return {"n_words": len(words), "n_base": len(base),
                "first_word": min(starts, default=None), "last_word": max(starts, default=None),
                "base_labels": ",".join(base_labels), "labels": ",".join(found),
                "score": score, "spans": spans}

    def _stream(self, tokens: list[int], at: int, base: list, matches: dict) -> None:
        """Matching statistics of one run of known words."""
        step, state, matched = self.sam.step, 0, 0
        for i, token in enumerate(tokens):
            before, length = state, matched
            state, matched = step(state, matched, token)
            if matched != length + 1 and length >= self.min_match:
                self._keep(before, length, at + i, matches)
            for t, n in self.phrases[state]:
                if n <= matched:
                    base.append((t, at + i + 1 - n))
        if matched >= self.min_match:
            self._keep(state, matched, at + len(tokens), matches)

    def _keep(self, state: int, length: int, stop: int, matches: dict) -> None:
        for t, end in self.ends[state]:
            if end >= length:
                matches.setdefault(t, []).append((stop - length, end - length, length))

    def _chain(self, matches: dict) -> list[dict]:
        """Per template, spans of matches in rising text and template order."""
        spans = []
        for t, found in matches.items():
            total, open_spans = len(self.tokens[t]), []
            for word, position, length in sorted(found):
                for span in reversed(open_spans):        # the nearest span it continues
                    gap = word - span[1]
                    if 0 <= gap <= self.max_gap and position >= span[2]:
                        span[1], span[2], span[3] = word + length, position + length, span[3] + length
                        break
                else:
                    open_spans.append([word, word + length, position + length, length])
                open_spans = [s for s in open_spans if word - s[1] <= self.max_gap or self._report(s, t, total, spans)]
            for s in open_spans:
                self._report(s, t, total, spans)
        return sorted(spans, key=lambda s: (s["first_word"], s["label"], s["n_words"]))

    def _report(self, span: list, t: int, total: int, spans: list) -> None:
        if span[3] >= self.min_coverage * total:
            spans.append({"label": self.labels[t], "first_word": span[0],
                          "n_words": span[1] - span[0], "coverage": span[3] / total})


def scan_licenses(docs: DataFrame, base=BASE_PHRASES, templates=TEMPLATES, min_match: int = 3,
                  max_gap: int = 6, min_coverage: float = 0.7,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base phrase places, licence labels and spans.

    ``score`` is the largest coverage of any template (1 if a base phrase
    occurs whole, 0 if nothing reaches ``min_coverage``).
    """
    base, templates = tuple(base), tuple(templates)

    def scan(batches):
        scanner = LicenseScanner(base, templates, min_match, max_gap, min_coverage)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [{"doc_id": i, **scanner.scan(words_of(t))}
                    for i, t in zip(ids, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       text_column(text_col)).mapInArrow(scan, SCHEMA)
