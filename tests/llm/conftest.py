"""Small awkward tables for the corpus operators."""

from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"

# Columns that also occur inside the operators' plans.
EXTRA = ["k1", "fp", "carried", "site", "ids", "z", "at", "node", "grp", "label"]
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in EXTRA)


def rows_of(texts, start=0):
    return [(start + i, t, "en", f"s{i % 3}", len(t or ""), *EXTRA) for i, t in enumerate(texts)]


def awkward_texts() -> list:
    rng = random.Random(5)
    words = ["the", "of", "naïve", "über", "x", "42", "don't", "licence", "été", "...", "{}", "日本語"]
    long = " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(30_000))
    passage = " ".join(rng.choice(words) + str(rng.randrange(900)) for _ in range(120))
    texts = [None, "", " ", "\n\n", "one", "one two three", "á ß İ   x", "🙂" * 300, "ab" * 500, long,
             "start " + passage + " end", "other " + passage + "\nlast line", passage, passage, long[:9000],
             "This work is licensed under the GNU General Public License, version 3. All rights reserved.",
             "cc by cc by CC-BY 4.0, all rights\nreserved"]
    return texts + [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(20)]


@pytest.fixture(scope="session")
def awkward(spark):
    """Null, empty and long texts, copies, a repeated row and rows without an id."""
    rows = rows_of(awkward_texts())
    rows += [rows[4], (None, "one", "en", None, 3, *EXTRA), (None, None, None, None, None, *EXTRA)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()
