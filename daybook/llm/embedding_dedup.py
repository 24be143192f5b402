"""Embedding near-duplicates by PCA-ordered tiled comparison (operator 7).

Equal vectors are one class.  The classes' unit vectors are rotated to the
principal axes of the table, which puts most of a dot product into the leading
dimensions.  Classes are cut along the first axis into blocks of about
``block_rows``; a pair of blocks is compared only if their ranges on that axis
come close enough for the threshold.  Inside a pair, tiles accumulate leading
dimensions first; the product of the suffix norms bounds what the rest can
add, and pairs that cannot reach the threshold are left out.  Survivors are
decided by the cosine of the original vectors in double precision.

A pair of blocks returns, per class, its number of links and one link into its
part of the graph, never the pairs: a dense group costs rows in proportion to
its classes.

Defined results: null, empty or zero vectors and those with null or non-finite
components link with nothing (0 links, a component of their own); vectors of
different lengths never link; repeated rows are vectors of their own that
share a class; a null id is carried through and names no component; an empty
table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Scratch
from daybook.llm.components import connected_components
from daybook.llm.vectors import cosines, keyed_vectors, matrix

_SLACK = 1e-9                       # for rounding in bounds; survivors are decided exactly


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)          # no overflow in the norm
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def principal_axes(classes: DataFrame, dim: int) -> np.ndarray:
    """Orthonormal axes (columns) by falling second moment; the sums are dim x dim numbers."""
    def moments(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            u = _unit(matrix(batch.column(0)))
            total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], ["cell", "s"])

    cells = (classes.select("vec").mapInArrow(moments, "cell bigint, s double")
             .groupBy("cell").agg(F.sum("s").alias("s")).toPandas())
    total = np.zeros(dim * dim)
    total[cells["cell"].to_numpy()] = cells["s"].to_numpy()
    _, axes = np.linalg.eigh(total.reshape(dim, dim))
    return axes[:, ::-1].copy()


def _suffix_norms(u: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Norm of what follows each cut, a column per cut."""
    tail = np.cumsum((u * u)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.stack([tail[:, c] if c < u.shape[1] else np.zeros(len(u)) for c in cuts], axis=1))


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float, tile: int = 512):
    """Index pairs whose rotated unit vectors may reach the threshold, tile by tile."""
    dim = a.shape[1]
    cuts = sorted({min(dim, c) for c in (8, 16, 32, dim)})
    rest_a, rest_b = _suffix_norms(a, cuts), _suffix_norms(b, cuts)
    for i in range(0, len(a), tile):
        for j in range(0, len(b), tile):
            x, y = a[i:i + tile], b[j:j + tile]
            done, dots, at = 0, np.zeros((len(x), len(y))), None
            for k, cut in enumerate(cuts):
                if at is None:
                    dots += x[:, done:cut] @ y[:, done:cut].T
                    alive = dots + rest_a[i:i + tile, k, None] * rest_b[j:j + tile, k] >= threshold - _SLACK
                    n = np.count_nonzero(alive)
                    if n * 16 < alive.size or cut == dim:       # few left: pairs instead of the tile
                        at = np.nonzero(alive)
                        sums = dots[at]
                else:
                    sums = sums + np.einsum("ij,ij->i", x[at[0], done:cut], y[at[1], done:cut])
                    keep = sums + rest_a[i + at[0], k] * rest_b[j + at[1], k] >= threshold - _SLACK
                    at, sums = (at[0][keep], at[1][keep]), sums[keep]
                done = cut
                if at is not None and not len(at[0]):
                    break
            if len(at[0]):
                yield i + at[0], j + at[1]


class _Forest:
    """Smallest linked index of each row, over links that come in parts."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            if (a == b).all():
                return
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while (self.root != self.root[self.root]).any():
                self.root = self.root[self.root]


def compare_blocks(rows: pd.DataFrame, same: bool, axes: np.ndarray, threshold: float) -> pd.DataFrame:
    """Links within a pair of blocks: ``node, links, root`` for linked classes."""
    rows = rows.sort_values("node", ignore_index=True)
    x = np.stack(rows["vec"].to_numpy())
    u = _unit(x) @ axes
    node, n = rows["node"].to_numpy(), rows["n"].to_numpy()
    left = np.flatnonzero(rows["own"].to_numpy() == rows["a"].to_numpy())
    right = left if same else np.flatnonzero(rows["own"].to_numpy() != rows["a"].to_numpy())
    links, forest = np.zeros(len(rows), np.int64), _Forest(len(rows))
    for i, j in linked_pairs(u[left], u[right], threshold):
        i, j = left[i], right[j]
        if same:
            i, j = i[i < j], j[i < j]
        ok = cosines(x[i], x[j]) >= threshold
        i, j = i[ok], j[ok]
        np.add.at(links, i, n[j])
        np.add.at(links, j, n[i])
        forest.link(i, j)
    some = links > 0
    return pd.DataFrame({"node": node[some], "links": links[some], "root": node[forest.root[some]]})


def _reach(splits: list[float], threshold: float) -> list[int]:
    """For each block along the first axis, the last block that can hold a partner."""
    gap = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-5
    low, high = [-math.inf, *splits], [*splits, math.inf]
    return [max(b for b in range(len(low)) if low[b] - high[a] <= gap) for a in range(len(low))]


def _compare_all(classes: DataFrame, dim: int, threshold: float, block_rows: int, scratch: Scratch) -> DataFrame:
    """``node, links, root`` rows of all block pairs, for classes of one vector length."""
    axes = principal_axes(classes, dim)
    # shares of the largest component: no overflow in the norm; it is no part of a lambda, so it is found once a vector
    largest = F.array_max(F.transform("vec", F.abs))
    shares = F.zip_with("vec", F.array_repeat(largest, F.size("vec")), lambda v, m: v / m)
    unit = F.aggregate(shares, F.lit(0.0), lambda s, v: s + v * v, lambda s: F.sqrt(s))
    first = F.aggregate(F.zip_with(shares, F.array(*[F.lit(float(v)) for v in axes[:, 0]]), lambda v, w: v * w),
                        F.lit(0.0), lambda s, v: s + v)
    # ties, which scaled copies are, spread by a jitter far below the slack of _reach
    jitter = F.pmod(F.xxhash64("node"), F.lit(1000)) * 1e-9
    placed = classes.withColumn("pc1", first / unit + jitter)
    blocks = max(1, -(-classes.count() // block_rows))
    splits = sorted(set(placed.approxQuantile("pc1", [i / blocks for i in range(1, blocks)], 0.1 / blocks))) if blocks > 1 else []
    reach = _reach(splits, threshold)
    own = F.lit(0)
    if splits:
        own = F.size(F.filter(F.array(*map(F.lit, splits)), lambda s: s < F.col("pc1")))
    lows = [min(a for a in range(len(reach)) if reach[a] >= b) for b in range(len(reach))]
    placed = placed.withColumn("own", own)
    at = F.col("own") + 1
    partners = F.sequence(F.element_at(F.array(*map(F.lit, lows)), at), F.element_at(F.array(*map(F.lit, reach)), at))
    met = (placed.withColumn("other", F.explode(partners))
           .select("node", "n", "vec", "own", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")))

    def compare(key, rows):
        return compare_blocks(rows, bool(key[0] == key[1]), axes, threshold)

    return scratch.table(met.groupBy("a", "b").applyInPandas(compare, "node bigint, links bigint, root bigint"))


def embedding_groups(vectors: DataFrame, threshold: float = 0.9, block_rows: int = 4096, id_col: str = "vec_id",
                     vec_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per vector."""
    scratch = Scratch(vectors.sparkSession, "embeddings")
    rows = scratch.table(keyed_vectors(vectors, id_col, vec_col))
    # a class is named by a number; component ids are the smallest vec_id later
    classes = scratch.table(rows.where("k1 IS NOT NULL").groupBy("k1", "k2")
                            .agg(F.count("*").alias("n"), F.min("vec_id").alias("vec_id"), F.first("vec").alias("vec"))
                            .withColumn("node", F.xxhash64("k1", "k2")))
    dims = [r[0] for r in classes.select(F.size("vec")).distinct().collect()]
    parts = [_compare_all(classes.where(F.size("vec") == d), d, threshold, block_rows, scratch) for d in sorted(dims)]
    if parts:
        found = parts[0]
        for p in parts[1:]:
            found = found.unionByName(p)
    else:
        found = classes.select("node", F.col("n").alias("links"), F.col("node").alias("root"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), scratch)
    named = (classes.select("k1", "k2", "n", "vec_id", "node").join(links, "node", "left")
             .join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    smallest = named.groupBy("label").agg(F.min("vec_id").alias("component_id"))
    by_key = named.join(smallest, "label").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "k1", "k2").join(by_key, ["k1", "k2"], "left")
    component = F.when(F.col("k1").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE list_count(embedding) = len(embedding) AND list_bool_and(list_transform(embedding, lambda c: isfinite(c)))
    AND list_bool_or(list_transform(embedding, lambda c: c <> 0))
),
l AS (SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
r AS (SELECT u, w FROM l UNION SELECT r.u, l.w FROM r JOIN l ON r.w = l.u),
c AS (SELECT u, least(u, min(w)) AS component_id FROM r GROUP BY u),
n AS (SELECT u, count(*) AS n_links FROM l GROUP BY u)
SELECT e.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
       e.vec_id = coalesce(c.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN c ON e.vec_id = c.u LEFT JOIN n ON e.vec_id = n.u"""
