"""Line deduplication by distinct-site spread (operator 2).

A line is boilerplate if it stands on ``min_sites`` or more distinct sites.
HyperLogLog sketches of the sites, one per line hash, merge by aggregation;
map-side combining leaves a line that a third of all documents carry as one
sketch per task.  Lines whose estimate is well away from the threshold are
decided by it, those near it get an exact distinct count.  The first place of
a boilerplate line, by document id and line number, keeps it, so one
document of a group of copies stays whole; all others lose it.

Lines are known by a 128-bit hash; texts travel once, to take the lines out.

Defined results: null or empty text is one blank line; lines of spaces only
are never boilerplate; a null site is one unnamed site; null ids come first
among places; rows repeated with their id share their places, so they keep
the same lines; every document stays, if need be with an empty text.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Scratch, held, slices, text_column, text_key

MIN_SITES = 16
_UNNAMED = "\x00"


def _rows(docs: DataFrame, id_col: str, site_col: str, text_col: str, carry: tuple[str, ...]) -> DataFrame:
    """``doc_id, site, text``, the text's key and the struct of carried columns."""
    carried = F.struct(*carry) if carry else F.lit(None).cast("struct<none: boolean>")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(site_col).cast("string"), F.lit(_UNNAMED)).alias("site"),
                        text_column(text_col), carried.alias("carried"))
            .withColumns(text_key()))


def _lines(rows: DataFrame) -> DataFrame:
    """One row per line that isn't blank, without its text."""
    each = rows.select("doc_id", "site", "k1", "k2", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    return each.where(F.trim("line") != "").select(
        "doc_id", "site", "k1", "k2", "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2"))


def boilerplate(lines: DataFrame, scratch: Scratch, min_sites: int = MIN_SITES, lg_k: int = 12) -> DataFrame:
    """``h1, h2`` of the lines on ``min_sites`` or more sites, with their first place."""
    spread = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_agg("site", lg_k).alias("sketch"), F.min(F.struct("doc_id", "at")).alias("first"))
    # six standard errors of the sketch, and one for its rounding
    near = 1 + math.ceil(6 * 1.04 / math.sqrt(2 ** lg_k) * min_sites)
    estimated = scratch.table(spread.select("h1", "h2", "first", F.hll_sketch_estimate("sketch").alias("estimate"))
                              .where(F.col("estimate") >= min_sites - near))
    close = estimated.where(F.col("estimate") <= min_sites + near)
    exact = (lines.join(close.select("h1", "h2"), ["h1", "h2"]).select("h1", "h2", "site").distinct()
             .groupBy("h1", "h2").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites))
    return (estimated.where(F.col("estimate") > min_sites + near).select("h1", "h2", "first")
            .unionByName(close.join(exact, ["h1", "h2"]).select("h1", "h2", "first")))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = 12, id_col: str = "doc_id",
                       site_col: str = "source", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_lines, n_removed, text`` (the remaining lines), one row per document.

    ``carry`` names columns of ``docs`` to return as the struct ``carried``.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    rows = _rows(docs, id_col, site_col, text_col, carry)
    lines = _lines(rows)
    common = scratch.table(boilerplate(lines, scratch, min_sites, lg_k))
    gone = (lines.join(common, ["h1", "h2"]).where(~F.struct("doc_id", "at").eqNullSafe(F.col("first")))
            .groupBy("doc_id", "k1", "k2").agg(F.sort_array(F.collect_set("at")).alias("gone")))
    marked = rows.alias("r").join(
        gone.alias("g"), F.col("r.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("r.k1") == F.col("g.k1"))
        & (F.col("r.k2") == F.col("g.k2")), "left").select("r.doc_id", "r.text", "g.gone", "r.carried")
    kind = marked.schema["carried"].dataType.simpleString()

    def take_out(batches):
        held("lines")
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                kept, n_lines, n_gone = [], [], []
                for text, gone in zip(part.column("text").to_pylist(), part.column("gone")):
                    own = text.split("\n")
                    n_lines.append(len(own))
                    n_gone.append(len(gone) if gone.is_valid else 0)
                    if n_gone[-1]:
                        keep = np.ones(len(own), bool)
                        keep[gone.values.to_numpy()] = False
                        text = "\n".join(own[i] for i in np.flatnonzero(keep).tolist())
                    kept.append(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_gone, pa.int64()),
                     pa.array(kept, pa.string()), part.column("carried")],
                    ["doc_id", "n_lines", "n_removed", "text", "carried"])

    return marked.mapInArrow(take_out, f"doc_id bigint, n_lines bigint, n_removed bigint, text string, carried {kind}")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(source, chr(0)) AS site, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
),
z AS (SELECT doc_id, site, unnest(list_zip(ls, range(len(ls)))) AS z FROM d),
l AS (SELECT doc_id, site, z[1] AS line, z[2] AS pos FROM z),
b AS (
  SELECT line, min(row(doc_id, pos)) AS place FROM l
  WHERE trim(line, ' ') <> '' GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES}
),
m AS (
  SELECT l.doc_id, l.line, l.pos, b.line IS NOT NULL AND row(l.doc_id, l.pos) <> b.place AS gone
  FROM l LEFT JOIN b ON l.line = b.line
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
FROM m GROUP BY doc_id"""
