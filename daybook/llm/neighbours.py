"""Approximate nearest neighbours by sharded HNSW graphs (operator 3).

Equal vectors are one entry with its smallest ids, so a vector that a third of
all rows hold is one node.  Entries are dealt by hash to shards of about
``shard_rows``; each shard builds a hierarchical navigable small-world graph
and stores it as one row of flat arrays: entries, vectors, levels, and per
level the neighbours in a fixed-width array.  Nodes are inserted in turn; a
node's candidates are the nearest earlier ones of its level, found exactly
as shards are bounded, thinned by the usual rule that a neighbour must be
nearer to the node than to those already chosen, and linked both ways.

Queries travel in blocks; each block meets each shard's row once, walks its
graph from the top level down, and returns the best entries.  Scores are the
cosines of the original vectors in double precision; the shards' results
merge per query.

Defined results: null, empty or zero vectors and those with null or non-finite
components neither ask nor answer; vectors of another length than the query's
don't answer; a query's own id is never an answer, copies under other ids are;
rows repeated with their id count once; a null id takes no part; an empty
table gives no rows.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import Scratch
from daybook.llm.vectors import cosines, keyed_vectors, scaled

INDEX = ("shard int, dim int, n int, vectors binary, ids binary, id_offsets binary, levels binary, "
         "level_sizes binary, nodes binary, neighbours binary")


def _spread(candidates: np.ndarray, sims: np.ndarray, between: np.ndarray, width: int) -> np.ndarray:
    """Of candidates from the nearest on, those nearer to the node than to any chosen one.

    If that leaves room, the nearest of the others fill it.
    """
    chosen: list[int] = []
    closest = np.full(len(candidates), -np.inf)             # similarity to the nearest chosen one
    for c in range(len(candidates)):
        if sims[c] > closest[c] or not chosen:
            chosen.append(c)
            if len(chosen) == width:
                break
            np.maximum(closest, between[c], out=closest)
    if len(chosen) < width:
        chosen += [c for c in range(len(candidates)) if c not in set(chosen)][:width - len(chosen)]
    return candidates[chosen]


def build_level(x: np.ndarray, width: int, ef: int) -> np.ndarray:
    """Neighbours of each of a level's nodes: row numbers, -1 where there is none."""
    n = len(x)
    links = np.full((n, width), -1, np.int32)
    degree = np.zeros(n, np.int64)

    def thin(node: int, candidates: np.ndarray, room: int) -> np.ndarray:
        sims = x[candidates] @ x[node]
        order = np.argsort(-sims, kind="stable")
        candidates, sims = candidates[order], sims[order]
        near = x[candidates]
        return _spread(candidates, sims, near @ near.T, room)

    for node in range(1, n):
        sims = x[:node] @ x[node]
        near = np.argpartition(-sims, ef)[:ef] if node > ef else np.arange(node)
        own = thin(node, near, width // 2)
        links[node, :len(own)], degree[node] = own, len(own)
        for other in own.tolist():
            if degree[other] < width:
                links[other, degree[other]] = node
                degree[other] += 1
            else:
                kept = thin(other, np.append(links[other], node), width)
                links[other, :] = -1
                links[other, :len(kept)], degree[other] = kept, len(kept)
    return links


def build_index(vectors: np.ndarray, width: int = 32, ef: int = 48, seed: int = 7) -> dict:
    """Flat arrays of one shard's graph over unit vectors; row 0 is on the top level."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    levels = np.minimum((-np.log(1 - rng.random(n)) / math.log(width / 2)).astype(np.int32), 8)
    levels = np.sort(levels)[::-1].copy()        # rows are in hash order, so this draws at random
    nodes, neighbours, sizes = [], [], []
    for level in range(int(levels[0]) + 1 if n else 0):
        count = int(np.searchsorted(-levels, -level, "right"))       # rows 0..count-1 reach this level
        neighbours.append(build_level(vectors[:count], width if level == 0 else width // 2, ef))
        nodes.append(count)
        sizes.append(neighbours[-1].shape[1])
    return {"levels": levels, "level_sizes": np.array(sizes, np.int32), "nodes": np.array(nodes, np.int32),
            "neighbours": np.concatenate([a.ravel() for a in neighbours]) if n else np.zeros(0, np.int32)}


class Graph:
    """A stored shard, ready to search."""

    def __init__(self, row: pd.Series):
        self.x = np.frombuffer(row["vectors"], np.float64).reshape(row["n"], row["dim"])
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.id_offsets = np.frombuffer(row["id_offsets"], np.int64)
        x = scaled(self.x)
        self.unit = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
        flat, at, self.links = np.frombuffer(row["neighbours"], np.int32), 0, []
        for count, width in zip(np.frombuffer(row["nodes"], np.int32).tolist(),
                                np.frombuffer(row["level_sizes"], np.int32).tolist()):
            self.links.append(flat[at:at + count * width].reshape(count, width))
            at += count * width

    def _walk(self, q: np.ndarray, start: list[tuple[float, int]], links: np.ndarray, ef: int):
        """Best-first search of one level; (similarity, row) of the ef best."""
        seen = np.zeros(len(links), bool)
        for _, node in start:
            seen[node] = True
        best = list(start)
        heapq.heapify(best)                                  # worst first
        todo = [(-s, node) for s, node in start]
        heapq.heapify(todo)
        while todo:
            s, node = heapq.heappop(todo)
            if len(best) >= ef and -s < best[0][0]:
                break
            near = links[node]
            near = near[near >= 0]
            near = near[~seen[near]]
            if not len(near):
                continue
            seen[near] = True
            for sim, other in zip((self.unit[near] @ q).tolist(), near.tolist()):
                if len(best) < ef:
                    heapq.heappush(best, (sim, other))
                elif sim > best[0][0]:
                    heapq.heapreplace(best, (sim, other))
                else:
                    continue
                heapq.heappush(todo, (-sim, other))
        return best

    def search(self, q: np.ndarray, k: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of about the k nearest entries, nearest first."""
        unit = scaled(q[None])[0]
        unit = unit / np.sqrt(unit @ unit)
        best = [(float(self.unit[0] @ unit), 0)]
        for links in self.links[:0:-1]:
            best = [max(self._walk(unit, best, links, 1))]
        rows = np.array(sorted(n for _, n in self._walk(unit, best, self.links[0], max(ef, k))))
        scores = cosines(self.x[rows], np.broadcast_to(q, (len(rows), len(q))))
        order = np.lexsort((self.ids[self.id_offsets[rows]], -scores))[:k]
        return rows[order], scores[order]

    def answers(self, query_id: int, q: np.ndarray, k: int, ef: int) -> list[tuple[int, int, float]]:
        """(query, id, score) of the k nearest ids that aren't the query's own."""
        rows, scores = self.search(q, k + 1, ef)
        found = [(-s, i) for r, s in zip(rows, scores.tolist())
                 for i in self.ids[self.id_offsets[r]:self.id_offsets[r + 1]].tolist() if i != query_id]
        return [(query_id, i, -s) for s, i in sorted(found)[:k]]


def _pack(group: pd.DataFrame, width: int, ef: int) -> pd.DataFrame:
    group = group.sort_values(["k1", "k2"], ignore_index=True)
    x = np.stack(group["vec"].to_numpy())
    unit = scaled(x)
    unit = unit / np.sqrt(np.einsum("ij,ij->i", unit, unit))[:, None]
    flat = {k: v.tobytes() for k, v in build_index(unit, width, ef).items()}
    ids = group["ids"].to_numpy()
    return pd.DataFrame([{"shard": group["shard"][0], "dim": x.shape[1], "n": len(x), "vectors": x.tobytes(),
                          "ids": np.concatenate(ids).astype(np.int64).tobytes(),
                          "id_offsets": np.cumsum([0, *map(len, ids)]).astype(np.int64).tobytes(), **flat}])


def build_shards(vectors: DataFrame, k: int, shard_rows: int, width: int, ef: int, scratch: Scratch) -> DataFrame:
    """One row per shard and vector length, stored in the shared folder.

    Of the ids of equal vectors the k + 1 smallest are kept: more can never be
    among a query's k answers.  The limit applies before the shuffle, too.
    """
    order = Window.partitionBy("k1", "k2").orderBy("vec_id")
    few = (vectors.where("k1 IS NOT NULL AND vec_id IS NOT NULL").dropDuplicates(["vec_id", "k1", "k2"])
           .withColumn("nth", F.row_number().over(order))
           .where(F.col("nth") <= k + 1))
    entries = scratch.table(few.groupBy("k1", "k2").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"),
                                                        F.first("vec").alias("vec")))
    shards = max(1, -(-entries.count() // shard_rows))
    dealt = entries.withColumns({"shard": F.pmod("k2", F.lit(shards)).cast("int"), "dim": F.size("vec")})
    return scratch.table(dealt.groupBy("shard", "dim").applyInPandas(lambda g: _pack(g, width, ef), INDEX))


def nearest_neighbours(vectors: DataFrame, is_query: Column | None = None, k: int = 5, shard_rows: int = 4096,
                       width: int = 32, ef: int = 48, ef_search: int = 64, block_rows: int = 2048,
                       id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows that ``is_query`` (on ``vec_id``) picks."""
    scratch = Scratch(vectors.sparkSession, "neighbours")
    rows = keyed_vectors(vectors, id_col, vec_col).where("k1 IS NOT NULL AND vec_id IS NOT NULL")
    index = build_shards(rows, k, shard_rows, width, ef, scratch)
    queries = rows.where(F.col("vec_id") % 50 == 0 if is_query is None else is_query)
    queries = scratch.table(queries.dropDuplicates(["vec_id", "k1", "k2"]).select("vec_id", "vec", F.size("vec").alias("dim")))
    blocks = max(1, -(-queries.count() // block_rows))
    shards = F.lit(index.agg(F.max("shard")).first()[0] or 0)
    asked = queries.select("vec_id", "vec", "dim", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
                           F.explode(F.sequence(F.lit(0), shards)).alias("shard"))
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(graphs: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(graphs) and len(block):
            graph = Graph(graphs.iloc[0])
            for query_id, vec in zip(block["vec_id"], block["vec"]):
                found += graph.answers(int(query_id), np.asarray(vec, np.float64), k, ef_search)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    by = ["shard", "block", "dim"]
    found = held.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(
        search, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
