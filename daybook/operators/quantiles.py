"""Quantiles from mergeable sketches (Q3 when the exact way costs too much).

``quality.purchase_amount_stats`` counts every distinct amount, which is exact but
shuffles as many rows as there are amounts.  A KLL sketch of a group holds
a few times ``k`` values whatever the group's size; sketches are built by
map-side combined aggregation, so a group that is a third of the input travels as
one sketch per task, and stored sketches of days or files merge into those of
longer ranges without reading the events again.

The quantile a sketch gives for p is a data value; its rank is p up to
``rank_error(k)`` of the group's size, at 99 % confidence.  A group of at most ``k``
values is exact.  Nulls and NaN are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Values a sketch keeps per level.
K = 1024
SKETCH = "sketch"


def rank_error(k: int = K) -> float:
    """Greatest distance between a quantile's rank and p, as a share of the group, in 99 of 100 sketches.

    The published error of KLL sketches.
    """
    return 2.296 / k ** 0.9723


def _number(col: str) -> Column:
    v = F.col(col).cast(T.DoubleType())
    return F.when(~F.isnan(v), v)


def build_sketches(df: DataFrame, col: str, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """``by, n, sketch``: one sketch of ``col`` per group, to be stored or merged; groups without values have none."""
    values = df.select(*by, _number(col).alias("v")).where("v IS NOT NULL")
    return values.groupBy(*by).agg(F.count("v").alias("n"), F.kll_sketch_agg_double("v", F.lit(k)).alias(SKETCH)).where("n > 0")


def merge_sketches(sketches: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """``by, n, sketch``: sketches of the same ``k`` merged into one per (wider) group."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double(SKETCH, F.lit(k)).alias(SKETCH)).where("n > 0")


def sketch_quantiles(sketches: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by, n, p, value``: each sketch's value for each p (the smallest with at least that rank)."""
    rows = [F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double(SKETCH, F.lit(float(p))).alias("value"))
            for p in probabilities]
    return sketches.select(*by, "n", F.inline(F.array(*rows)))


def quantiles(df: DataFrame, col: str, probabilities: Sequence[float], by: Sequence[str] = (), k: int = K) -> DataFrame:
    """``by, n, p, value`` of the groups of ``df``."""
    return sketch_quantiles(build_sketches(df, col, by, k), probabilities, by)


def rank_distances(df: DataFrame, col: str, found: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``found`` (rows with ``p`` and ``value``) and ``distance``: how far each value's true rank in its group is from p.

    The true rank of a value is the range between the shares of smaller
    values and of values up to it.  ``found`` is read once, as sketches may
    answer differently when computed again; its rows, at most one per group and p,
    meet the events as one array a group, and the counts combine map-side.
    Rows of groups without events are left out.
    """
    rest = [c for c in found.columns if c not in by]
    listed = F.collect_list(F.struct(*rest))
    values = df.select(*by, _number(col).alias("_v")).where("_v IS NOT NULL")
    if by:
        asked = found.groupBy(*by).agg(listed.alias("_asked"))
        met = values.join(asked, [*by]).select(*by, "_v", F.inline("_asked"))
    else:
        met = df.sparkSession.sql("SELECT _v, inline((SELECT _asked FROM {asked})) FROM {values}",
                                  asked=found.agg(listed.alias("_asked")), values=values)
    counts = met.groupBy(*by, *rest).agg(F.avg((F.col("_v") < F.col("value")).cast("int")).alias("_below"),
                                         F.avg((F.col("_v") <= F.col("value")).cast("int")).alias("_upto"))
    away = F.greatest(F.lit(0.0), F.col("_below") - F.col("p"), F.col("p") - F.col("_upto"))
    return counts.select(*found.columns, away.alias("distance"))
