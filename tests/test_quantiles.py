"""Quantile sketches against true ranks and the exact median."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from daybook.operators import quality as Q
from daybook.operators import quantiles as K

PS = (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)


def frame(spark, values, group="a"):
    return spark.createDataFrame([(group, v) for v in values], "g string, v double")


def plain_quantile(values, p):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return kept[max(1, math.ceil(p * len(kept) - 1e-9)) - 1]


def test_small_groups_are_exact(spark):
    rng = random.Random(2)
    values = [rng.choice([None, math.nan, -0.0, 5.0, rng.gauss(0, 9)]) for _ in range(150)]
    df = frame(spark, values).unionByName(frame(spark, [None, math.nan], "none")).unionByName(frame(spark, [7.0], "one"))
    found = {(r.g, r.p): r.value for r in K.quantiles(df, "v", PS, ["g"], k=200).collect()}
    assert {g for g, _ in found} == {"a", "one"} and {found["one", p] for p in PS} == {7.0}
    assert all(found["a", p] == plain_quantile(values, p) for p in PS)


@pytest.mark.parametrize("k", [64, 256, 1024])
@pytest.mark.parametrize("shape", ["round(exp(randn(5)) * 40, 2)", "CAST(id % 3 AS DOUBLE)", "-CAST(id AS DOUBLE)"])
def test_ranks_are_within_the_stated_error(spark, k, shape):
    df = spark.range(0, 60_000, 1, 6).select(F.expr(shape).alias("v")).persist()
    found = K.quantiles(df, "v", (0.01, 0.25, 0.5, 0.75, 0.99), k=k).persist()
    rows = K.rank_distances(df, "v", found).collect()
    values = sorted(r.v for r in df.collect())
    for r in rows:
        below, upto = sum(v < r.value for v in values) / len(values), sum(v <= r.value for v in values) / len(values)
        assert r.distance == pytest.approx(max(0, below - r.p, r.p - upto), abs=1e-9)
        assert r.distance <= 3 * K.rank_error(k)
    assert len(rows) == 5
    found.unpersist()
    df.unpersist()


def test_merged_sketches_answer_like_one_of_all(spark):
    df = spark.range(0, 40_000, 1, 4).select((F.col("id") % 30).alias("day"), F.expr("exp(randn(8))").alias("v")).persist()
    days = K.build_sketches(df, "v", ["day"], k=512)
    whole = K.merge_sketches(days, k=512)
    assert whole.first().n == 40_000
    found = K.sketch_quantiles(whole, (0.1, 0.5, 0.9)).persist()
    assert all(r.distance <= 3 * K.rank_error(512) for r in K.rank_distances(df, "v", found).collect())
    found.unpersist()
    df.unpersist()


def test_error_shrinks_with_k():
    assert K.rank_error(2048) < K.rank_error(1024) < K.rank_error(200) < 0.0134


def test_sketched_stats_beside_the_exact_ones(spark):
    df = spark.range(0, 30_000, 1, 5).select(F.expr("IF(id % 4 = 0, 'signup', 'purchase')").alias("event_type"),
                                             F.expr("IF(id % 11 = 0, null, round(exp(randn(4)) * 30, 2))").alias("amount")).persist()
    sketched, exact = Q.purchase_amount_sketch(df, k=512).first(), Q.purchase_amount_stats(df).first()
    assert [sketched[c] for c in ("purchases", "min_amount", "mean_amount", "max_amount")] == \
        [exact[c] for c in ("purchases", "min_amount", "mean_amount", "max_amount")]
    assert sketched.median_rank_error == K.rank_error(512)
    values = sorted(r.amount for r in df.where("event_type = 'purchase' AND amount IS NOT NULL").collect())
    share = sum(v <= sketched.median_amount for v in values) / len(values)
    assert abs(share - 0.5) <= 3 * K.rank_error(512) + 1 / len(values)
    df.unpersist()


def test_sketched_stats_of_few_or_no_purchases(make_raw):
    row = Q.purchase_amount_sketch(make_raw([{"event_type": "purchase", "amount": a} for a in (3.0, 1.0, 2.0, None)])).first()
    assert (row.purchases, row.median_amount, row.median_rank_error) == (4, 2.0, 0.0)
    none = Q.purchase_amount_sketch(make_raw([{}])).first()
    assert (none.purchases, none.median_amount, none.median_rank_error) == (0, None, None)


def test_sketch_is_combined_map_side(spark):
    plan = K.build_sketches(spark.range(9).select(F.lit("hot").alias("g"), F.col("id").alias("v")), "v", ["g"])
    assert "partial_kll_sketch_agg_double" in plan._jdf.queryExecution().executedPlan().toString()
