"""Vector search and embedding near-duplicates against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import embedding_dedup, neighbours

VEC = "vec_id bigint, embedding array<float>, label int, k1 string, node string, score string"


def table(spark, vectors, ids=None):
    rows = [(i if ids is None else ids[i], None if v is None else [None if x is None else float(x) for x in v], 0,
             "k", "n", "s") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, VEC).repartition(3)


def awkward_vectors():
    """Clusters, copies, scaled copies, other lengths and rows that take no part."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8))
    near = [c + rng.normal(size=8) * s for c in centres for s in (0.0, 0.0, 0.1, 0.2, 0.3, 0.5)]
    far = list(rng.normal(size=(60, 8)))
    common = [centres[0]] * 40 + [centres[0] * 2, -centres[0]]
    short = [[1.0, 0.0], [1.0, 0.01], [0.0, 1.0]]
    out = [None, [], [0.0] * 8, [None] + [1.0] * 7, [math.nan] + [1.0] * 7, [math.inf] + [1.0] * 7]
    return near + far + common + short + out


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def cosine(a, b):
    a, b = np.asarray(a, np.float32).astype(float), np.asarray(b, np.float32).astype(float)
    return a @ b / (math.sqrt(a @ a) * math.sqrt(b @ b))


def plain_groups(vectors, threshold):
    n = len(vectors)
    links, parent = [0] * n, list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if usable(vectors[i]) and usable(vectors[j]) and len(vectors[i]) == len(vectors[j]) \
                    and cosine(vectors[i], vectors[j]) >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [(i, links[i], find(i), find(i) == i) for i in range(n)]


@pytest.mark.parametrize("block_rows", [40, 4096])
def test_embedding_groups(spark, block_rows):
    vectors = awkward_vectors()
    found = embedding_dedup.embedding_groups(table(spark, vectors), block_rows=block_rows).orderBy("vec_id").collect()
    assert [tuple(r) for r in found] == plain_groups(vectors, 0.9)


def test_embedding_groups_of_odd_tables(spark):
    assert embedding_dedup.embedding_groups(table(spark, [])).count() == 0
    none = embedding_dedup.embedding_groups(table(spark, [None, [0.0]])).orderBy("vec_id").collect()
    assert [tuple(r) for r in none] == [(0, 0, 0, True), (1, 0, 1, True)]
    # repeated rows and rows without an id
    rows = embedding_dedup.embedding_groups(table(spark, [[1.0, 0.0]] * 4, ids=[5, 5, None, 9])).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in rows) == [
        (0, 3, 5, False), (5, 3, 5, True), (5, 3, 5, True), (9, 3, 5, False)]


def test_leading_dimensions_leave_out_only_what_cannot_link():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 24)) * np.linspace(3, 0.1, 24)
    x = np.concatenate([x, x + rng.normal(size=x.shape) * 0.05])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    for threshold in (0.5, 0.9, 0.99):
        found = {(i, j) for a, b in embedding_dedup.linked_pairs(u, u, threshold, tile=64) for i, j in zip(a.tolist(), b.tolist())}
        i, j = np.nonzero(u @ u.T >= threshold)
        assert set(zip(i.tolist(), j.tolist())) <= found
        assert len(found) < 2 * len(i) + 50


def plain_nearest(vectors, ids, query, k):
    best = sorted((-cosine(vectors[query], v), i) for v, i in zip(vectors, ids)
                  if i != ids[query] and usable(v) and len(v) == len(vectors[query]))
    return [(i, -s) for s, i in best[:k]]


@pytest.mark.parametrize("shard_rows", [30, 4096])
def test_recall_and_exact_scores(spark, shard_rows):
    vectors = awkward_vectors()
    ids = list(range(100, 100 + len(vectors)))
    found = neighbours.nearest_neighbours(table(spark, vectors, ids), is_query=F.col("vec_id") % 5 == 0,
                                          shard_rows=shard_rows).collect()
    hits = total = 0
    for q in (i for i, v in zip(range(len(ids)), vectors) if ids[i] % 5 == 0):
        got = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == ids[q])
        if not usable(vectors[q]):
            assert got == []
            continue
        want = plain_nearest(vectors, ids, q, 5)
        assert [r for r, *_ in got] == list(range(1, len(want) + 1))
        for _, i, s in got:
            assert i != ids[q] and s == pytest.approx(cosine(vectors[q], vectors[i - 100]), abs=1e-12)
        assert [(-s, i) for _, i, s in got] == sorted((-s, i) for _, i, s in got)
        total += len(want)
        hits += sum(s >= want[-1][1] - 1e-9 for _, _, s in got)
    assert hits >= 0.9 * total


def test_recall_on_the_sample_table(spark):
    """Against brute force over the given embeddings, as registered."""
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = df.collect()
    x = np.array([r.embedding for r in rows], float)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    ids = [r.vec_id for r in rows]
    found = neighbours.nearest_neighbours(df, shard_rows=100).collect()
    hits = total = 0
    for n, i in enumerate(ids):
        if i % 50 == 0:
            s = u @ u[n]
            s[n] = -2
            kth = np.sort(s)[-5]
            own = [r.score for r in found if r.query_id == i]
            total, hits = total + 5, hits + sum(v >= kth - 1e-12 for v in own)
    assert len(found) == total and hits >= 0.9 * total


def test_recall_with_production_parameters(spark):
    """Brute force over the given embeddings and half as many near copies of one of them."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = df.orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], float)
    rng, n = np.random.default_rng(3), len(rows) // 2
    x = np.vstack([x, x[0] + rng.normal(size=(n, x.shape[1])) * 1e-3 * np.linalg.norm(x[0]) / np.sqrt(x.shape[1])])
    x = x.astype(np.float32).astype(float)
    ids = [r.vec_id for r in rows]
    ids += range(max(ids) + 1, max(ids) + 1 + n)
    whole = spark.createDataFrame(list(zip(ids, x.tolist())), df.schema).repartition(4)
    own = {}
    for r in neighbours.nearest_neighbours(whole).collect():
        own.setdefault(r.query_id, []).append(r.score)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    hits = total = 0
    for at, i in enumerate(ids):
        if i % 50 == 0:
            s = u @ u[at]
            s[at] = -2
            total, hits = total + 5, hits + sum(v >= np.sort(s)[-5] - 1e-12 for v in own[i])
    assert hits >= 0.9 * total


def test_search_of_odd_tables(spark):
    assert neighbours.nearest_neighbours(table(spark, [])).count() == 0
    found = neighbours.nearest_neighbours(table(spark, [[1.0, 0.0], [1.0, 0.0], [1.0, 0.0], [0.0, 1.0]], ids=[50, 3, 3, None]))
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()] == [(50, 1, 3, 1.0)]


def test_levels_are_navigable():
    """From the entry, the links of the lowest level reach every node."""
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(200, 6)), np.repeat(rng.normal(size=(4, 6)), 25, 0) + rng.normal(size=(100, 6)) * 1e-3])
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = neighbours.build_index(x, width=16, ef=32)
    links = index["neighbours"][:len(x) * 16].reshape(len(x), 16)
    reached, todo = {0}, [0]
    while todo:
        for n in links[todo.pop()].tolist():
            if n >= 0 and n not in reached:
                reached.add(n)
                todo.append(n)
    assert len(reached) >= 0.98 * len(x)


def test_extreme_components(spark):
    """Cosines don't change with a vector's size, however large or small its doubles are."""
    base = [(1.0, 1.0, 0.0), (1.0, 0.95, 0.05), (-1.0, 2.0, 0.5), (0.0, 0.0, 3.0)]
    rows = [(i * 10 + j, [c * f for c in v]) for j, v in enumerate(base) for i, f in enumerate((1.0, 1e200, 1e-200, 1e300, 1e-300))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    groups = {r.vec_id: r.component_id for r in embedding_dedup.embedding_groups(df).collect()}
    assert all(groups[i * 10 + j] == (0, 0, 2, 3)[j] for j in range(4) for i in range(5))
    found = neighbours.nearest_neighbours(df, F.col("vec_id") >= 0).collect()
    assert len(found) == 100 and all(0 <= abs(r.score) <= 1 + 1e-9 for r in found)
    assert all(r.score == pytest.approx(1.0) and r.vec_id % 10 == r.query_id % 10 for r in found if r["rank"] <= 4)


def test_one_vector_in_very_many_rows(spark):
    df = spark.range(4_000).selectExpr("7L AS vec_id", "array(1D, 2D) AS embedding").unionByName(
        spark.createDataFrame([(8, [2.0, 1.0])], "vec_id long, embedding array<double>"))
    rows = neighbours.nearest_neighbours(df, F.col("vec_id") >= 0).collect()
    assert sorted((r.query_id, r.vec_id) for r in rows) == [(7, 8), (8, 7)]
