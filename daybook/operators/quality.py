"""Data-quality checks over raw events (Q1–Q4).

The reference prints these as a dataset profile; here each is an ordinary
distributed aggregate returning a small DataFrame.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.expressions import (
    amounts_close,
    money,
    parse_utc_timestamp_sql,
    round_half_even,
    round_half_even_sql,
    utc_date_sql,
)
from daybook.operators import quantiles
from daybook.operators.asof import latest_before
from daybook.schema import AMOUNT_ATOL, AMOUNT_RTOL, SENTINEL_YEAR, VALID_EVENT_TYPES
from daybook.session import checkpoint_root, delete_folder


def _pct(part: Column, whole: Column) -> Column:
    return round_half_even(part.cast("double") * F.lit(100.0) / whole.cast("double"), 2)


# ---------------------------------------------------------------------------
# Q1 — event-type distribution
# ---------------------------------------------------------------------------

def event_type_distribution(raw: DataFrame) -> DataFrame:
    """(event_type, events, pct): value counts including nulls, largest first.

    The per-type counts are partially aggregated map-side.  The type is raw
    text, so there may be many; the grand total is a scalar subquery, and the
    counts stay spread.
    """
    pct = round_half_even_sql("events * 100D / (SELECT sum(events) FROM c)", 2)
    return raw.sparkSession.sql(
        "WITH c AS (SELECT event_type, count(1) AS events FROM {raw} GROUP BY event_type) "
        f"SELECT event_type, events, {pct} AS pct FROM c "
        "ORDER BY events DESC, event_type ASC NULLS LAST", raw=raw)


# ---------------------------------------------------------------------------
# Q2 — dirty-data profile
# ---------------------------------------------------------------------------

def dirty_profile(raw: DataFrame) -> DataFrame:
    """One row of independent (not sequential) dirt counts and shares.

    sentinel_ts: year ≥ 2099; unparseable_ts: missing or not a timestamp;
    empty_country: missing or ''; unknown_type: outside the allowlist (or
    missing); unique_ids: distinct event ids; duplicate_ids: rows − those.
    """
    ts = parse_utc_timestamp_sql("ts", raw.schema["ts"].dataType)
    good_type = F.coalesce(F.col("event_type").isin(*VALID_EVENT_TYPES), F.lit(False))
    agg = raw.select("event_id", "country", "event_type", F.expr(utc_date_sql(ts)).alias("day")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.year(F.col("day")) >= SENTINEL_YEAR).alias("sentinel_ts"),
        F.count_if(F.col("day").isNull()).alias("unparseable_ts"),
        F.count_if(F.col("country").isNull() | (F.col("country") == "")).alias("empty_country"),
        F.count_if(~good_type).alias("unknown_type"),
        F.count_distinct("event_id").alias("unique_ids"),
    )
    counts = ["sentinel_ts", "unparseable_ts", "empty_country", "unknown_type"]
    dup = (F.col("rows") - F.col("unique_ids")).alias("duplicate_ids")
    return agg.select(
        "rows", *counts, "unique_ids", dup,
        *[_pct(F.col(c), F.col("rows")).alias(f"{c}_pct") for c in counts],
        _pct(F.col("rows") - F.col("unique_ids"), F.col("rows")).alias("duplicate_ids_pct"),
    )


# ---------------------------------------------------------------------------
# Q3 — purchase-amount statistics (exact median)
# ---------------------------------------------------------------------------

def value_counts(df: DataFrame, col: str) -> tuple[DataFrame, str]:
    """Distinct values with their counts, range-partitioned and stored.

    The one pass over ``df``: columns ``v`` (null for null and NaN), ``c`` and
    ``part``, where the values of a part lie between those of its neighbours.
    Also the folder in the shared checkpoint directory.
    """
    spark = df.sparkSession
    v = F.col(col).cast(T.DoubleType())
    counts = (df.select(F.when(~F.isnan(v), v).alias("v"))
              .groupBy("v").agg(F.count(F.lit(1)).alias("c")))
    parts = counts.repartitionByRange("v").withColumn("part", F.spark_partition_id())
    folder = f"{checkpoint_root(spark)}/daybook/value_counts/{uuid.uuid4().hex}"
    parts.write.parquet(folder)
    return spark.read.schema(parts.schema).parquet(folder), folder


def median_of_counts(counts: DataFrame) -> float | None:
    """Exact median (mean of the two middle values for an even count).

    Only the totals of the range parts reach the driver.  They tell which
    part holds a middle rank; cumulative counts within such a part, a
    window over one part's distinct values, give the value.
    """
    counts = counts.where(F.col("v").isNotNull())
    totals = counts.groupBy("part").agg(F.sum("c").alias("c"), F.min("v").alias("lo")).collect()
    totals.sort(key=lambda r: r["lo"])
    n = sum(r["c"] for r in totals)
    if not n:
        return None
    before, picked = 0, {}
    for r in totals:
        own = [k for k in {(n - 1) // 2, n // 2} if before <= k < before + r["c"]]
        if own:
            upto = F.sum("c").over(Window.partitionBy("part").orderBy("v"))
            ranked = counts.where(F.col("part") == r["part"]).select(
                "v", (upto - F.col("c") + before).alias("start"), (upto + before).alias("stop"))
            hit = [(F.col("start") <= k) & (F.col("stop") > k) for k in own]
            for row in ranked.where(reduce(or_, hit)).collect():
                picked.update((k, row["v"]) for k in own if row["start"] <= k < row["stop"])
        before += r["c"]
    low, high = picked[(n - 1) // 2], picked[n // 2]
    # halves first only where the sum would overflow
    return (low + high) / 2 if math.isfinite(low + high) or low != low else low / 2 + high / 2


def exact_median(df: DataFrame, col: str) -> float | None:
    """Exact median of a numeric column; nulls and NaN are left out."""
    counts, folder = value_counts(df, col)
    try:
        return median_of_counts(counts)
    finally:
        delete_folder(df.sparkSession, folder)


def purchase_amount_stats(raw: DataFrame, amount_col: str = "amount",
                          type_col: str = "event_type") -> DataFrame:
    """One row (purchases, min, median, mean, max) over raw purchase rows.

    min/max/median are data values; mean is reported to cents.  One pass over
    the events counts the distinct amounts when this is called; everything
    else, the median too, reads those counts.
    """
    spark = raw.sparkSession
    counts, folder = value_counts(raw.where(F.col(type_col) == "purchase"), amount_col)
    try:
        total = F.sum(F.col("v") * F.col("c")) / F.sum(F.when(F.col("v").isNotNull(), F.col("c")))
        row = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.min("v").alias("lo"),
                         money(total).alias("mean"), F.max("v").alias("hi")).first()
        stats = (row["n"], row["lo"], median_of_counts(counts), row["mean"], row["hi"])
    finally:
        delete_folder(spark, folder)
    return spark.createDataFrame([stats], "purchases bigint, min_amount double, median_amount double, "
                                          "mean_amount double, max_amount double")


def purchase_amount_sketch(raw: DataFrame, amount_col: str = "amount", type_col: str = "event_type",
                           k: int = quantiles.K) -> DataFrame:
    """``purchase_amount_stats`` with the median from a sketch, for when distinct amounts are too many.

    The same columns and, as ``median_rank_error``, how far the median's rank may be
    from one half (99 % confidence; 0 for at most ``k`` amounts).  One map-side
    combined aggregate, a sketch per task; nothing is stored.  The median is a
    data value: the lower middle one where the exact way takes the mean of two.
    """
    v = F.col(amount_col).cast(T.DoubleType())
    v = F.when(~F.isnan(v), v)
    row = raw.where(F.col(type_col) == "purchase").agg(
        F.count(F.lit(1)).alias("purchases"), F.count(v).alias("n"), F.min(v).alias("min_amount"), F.max(v).alias("max_amount"),
        money(F.avg(v)).alias("mean_amount"), F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"))
    some = F.col("n") > 0
    error = F.when(F.col("n") <= k, F.lit(0.0)).otherwise(F.lit(quantiles.rank_error(k)))
    return row.select(
        "purchases", "min_amount",
        F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5))).alias("median_amount"), "mean_amount", "max_amount",
        F.when(some, error).alias("median_rank_error"))


# ---------------------------------------------------------------------------
# Q4 — refund integrity
# ---------------------------------------------------------------------------

LINKED = "linked"
NO_PURCHASE = "no_purchase"
AMOUNT_MISMATCH = "amount_mismatch"
BAD_TIME = "bad_time"
TOO_LATE = "too_late"
STATUSES = (LINKED, NO_PURCHASE, AMOUNT_MISMATCH, BAD_TIME, TOO_LATE)

# A refund comes at most this long after its purchase.
MAX_REFUND_DAYS = 30

# Amounts within the tolerance differ by at most _AMOUNT_STEP on the scale of
# ``_scaled``; buckets are wider, so few amounts fall near two of them.
_AMOUNT_STEP = 1.1 * AMOUNT_RTOL
_AMOUNT_BUCKET = 10 * AMOUNT_RTOL


def _scaled(x: Column) -> Column:
    """A scale on which the isclose tolerance is the same length everywhere.

    atol + rtol |x| = rtol (atol / rtol + |x|), which is the step of
    sign(x) log(1 + |x| rtol / atol).
    """
    return F.signum(x) * F.log1p(F.abs(x) * F.lit(AMOUNT_RTOL / AMOUNT_ATOL))


def _bucket(scaled: Column) -> Column:
    return F.floor(scaled / F.lit(_AMOUNT_BUCKET))


def _dated_events(raw: DataFrame) -> DataFrame:
    """The columns that refund checks read, of rows with a timestamp before the sentinel year."""
    ts = parse_utc_timestamp_sql("ts", raw.schema["ts"].dataType)
    amount = F.col("amount").cast(T.DoubleType())
    finite = F.when(~F.isnan(amount) & (F.abs(amount) < F.lit(float("inf"))), amount)
    return (raw.select("event_id", "user_id", "session_id", "event_type",
                       finite.alias("amount"), F.expr(ts).alias("ts"))
            .where(F.col("ts").isNotNull() & (F.expr(f"year({utc_date_sql('ts')})") < SENTINEL_YEAR)))


def refund_links(raw: DataFrame, max_days: int = MAX_REFUND_DAYS) -> DataFrame:
    """Classify every refund against the purchases it could belong to.

    A refund is ``linked`` when some purchase of the same user and session
    has amount ≈ −refund (numpy.isclose, atol 1e-4, rtol 1e-5) and an
    earlier timestamp, by ``max_days`` days at most; ``too_late`` when such
    purchases are all older; ``bad_time`` when amounts match but no purchase
    is earlier; ``amount_mismatch`` when the user/session has purchases but
    none with the amount; ``no_purchase`` otherwise, as for refunds without
    a user or session.  Rows whose timestamp is unparseable or in the
    sentinel year are left out; non-finite amounts count as missing.
    Identical refund rows are classified once and carry their multiplicity
    in ``copies``.

    No refund is paired with every purchase of its session.  Purchases are
    collapsed per (user, session, amount) to their first time, and per
    window of ``max_days`` to their first and last.  A refund looks up its
    amount's bucket, and the next one if the tolerance reaches it, in three
    windows: any time, its own and the one before.  Inside its own window
    only the first purchase matters, in the one before only the last.  A
    hot session spreads over its amounts and windows; a key that is hot
    still has one purchase row, so it is a plain skewed join side.
    """
    events = _dated_events(raw)
    pair = ["user_id", "session_id"]
    keyed = F.col("user_id").isNotNull() & F.col("session_id").isNotNull()
    span = max_days * 86_400_000_000
    window = F.floor(F.unix_micros("ts") / F.lit(span))

    purchases = events.where((F.col("event_type") == "purchase") & keyed)
    sessions = purchases.select(*pair).distinct().withColumn("has_purchase", F.lit(True))
    # window null: any time
    filed = (purchases.where(F.col("amount").isNotNull())
             .select(*pair, F.col("amount").alias("p_amount"), _bucket(_scaled(F.col("amount"))).alias("bucket"),
                     F.explode(F.array(F.lit(-1), window)).alias("win"), "ts")
             .groupBy(*pair, "bucket", "win", "p_amount")
             .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")))

    key = ["event_id", *pair, "amount", "ts"]
    refunds = (events.where(F.col("event_type") == "refund")
               .groupBy(*key).agg(F.count(F.lit(1)).alias("copies")))
    target = _scaled(-F.col("amount"))
    buckets = F.array_distinct(F.array(_bucket(target - _AMOUNT_STEP), _bucket(target + _AMOUNT_STEP)))
    probes = (refunds.where(keyed & F.col("amount").isNotNull())
              .select(*key, window.alias("own"), F.explode(buckets).alias("bucket"))
              .select(*key, "own", "bucket", F.explode(F.array(F.lit(-1), F.col("own"), F.col("own") - 1)).alias("win")))
    within = (F.when(F.col("win") == F.col("own"), F.col("first_ts") < F.col("ts"))
              .when(F.col("win") == F.col("own") - 1,
                    F.unix_micros("last_ts") >= F.unix_micros("ts") - F.lit(span)))
    found = (probes.join(filed, [*pair, "bucket", "win"])
             .where(amounts_close(F.col("amount"), -F.col("p_amount")))
             .groupBy(*key)
             .agg(F.min("first_ts").alias("match_first_ts"),
                  F.max(F.coalesce(within, F.lit(False)) & (F.col("win") != -1)).alias("in_time")))
    status = (F.when(F.col("has_purchase").isNull(), F.lit(NO_PURCHASE))
              .when(F.col("match_first_ts").isNull(), F.lit(AMOUNT_MISMATCH))
              .when(F.col("in_time"), F.lit(LINKED))
              .when(F.col("match_first_ts") < F.col("ts"), F.lit(TOO_LATE))
              .otherwise(F.lit(BAD_TIME)))
    # refunds without a key or amount have nothing to find and skip the joins
    open_refunds = refunds.where(keyed)
    same = [open_refunds[c].eqNullSafe(found[c]) if c == "event_id" else open_refunds[c] == found[c] for c in key]
    classified = (open_refunds.join(found, reduce(and_, same), "left")
                  .select(*[open_refunds[c] for c in key], "copies", "match_first_ts", "in_time")
                  .join(sessions, pair, "left").select(*key, "copies", status.alias("status")))
    return classified.unionByName(refunds.where(~keyed).withColumn("status", F.lit(NO_PURCHASE)))


def refund_integrity(raw: DataFrame, max_days: int = MAX_REFUND_DAYS) -> DataFrame:
    """(status, refunds): how many refunds fall in each class."""
    return (refund_links(raw, max_days).groupBy("status")
            .agg(F.sum("copies").cast("long").alias("refunds")))


def refund_witnesses(raw: DataFrame, max_days: int = MAX_REFUND_DAYS, parts: int | None = None,
                     stored: list[str] | None = None) -> DataFrame:
    """Which purchase each refund belongs to: its latest earlier one within ``max_days`` days.

    One row per distinct refund row, with its multiplicity ``copies``:
    ``purchase_id``, ``purchase_ts`` and ``purchase_amount`` of the latest
    purchase of the same user and session whose amount is isclose to -refund and
    whose time is earlier, by ``max_days`` days at most (equal times: the smaller
    id), and ``lag_seconds`` between them; null where there is none, which is
    every refund that ``refund_links`` doesn't call ``linked``.  Rows are read as
    there.

    A refund first meets the distinct amounts of its session near its own, then
    looks up each of them by time (``asof.latest_before``), so it is never
    paired with a session's purchases, and a session with one amount spreads
    over its times.  Amounts are money: few distinct ones are within a tolerance.
    ``parts`` and ``stored`` are those of ``latest_before``.
    """
    events = _dated_events(raw)
    pair = ["user_id", "session_id"]
    keyed = reduce(and_, [F.col(c).isNotNull() for c in [*pair, "amount"]])
    purchases = (events.where((F.col("event_type") == "purchase") & keyed)
                 .select(*pair, F.col("amount").alias("p_amount"), "ts", "event_id"))
    key = ["event_id", *pair, "amount", "ts"]
    refunds = (events.where(F.col("event_type") == "refund")
               .groupBy(*key).agg(F.count(F.lit(1)).alias("copies")))

    amounts = purchases.select(*pair, _bucket(_scaled(F.col("p_amount"))).alias("bucket"), "p_amount").distinct()
    target = _scaled(-F.col("amount"))
    buckets = F.array_distinct(F.array(_bucket(target - _AMOUNT_STEP), _bucket(target + _AMOUNT_STEP)))
    probes = (refunds.where(keyed).select("*", F.explode(buckets).alias("bucket"))
              .join(amounts, [*pair, "bucket"]).where(amounts_close(F.col("amount"), -F.col("p_amount")))
              .select(*key, "copies", "p_amount"))
    recent = F.unix_micros("purchase_ts") >= F.unix_micros("ts") - F.lit(max_days * 86_400_000_000)
    found = latest_before(probes, purchases, [*pair, "p_amount"], "ts", "event_id",
                          {"event_id": "purchase_id", "ts": "purchase_ts"}, recent, parts, stored)
    none = [F.lit(None).cast(found.schema[c].dataType).alias(c) for c in ("p_amount", "purchase_id", "purchase_ts")]
    # every refund once more, so that those without a probe stay
    both = found.unionByName(refunds.select("*", *none))
    order = F.when(F.col("purchase_ts").isNotNull(), F.struct(
        F.col("purchase_ts"), F.col("purchase_id").isNotNull(), -F.col("purchase_id").cast("decimal(20, 0)"), F.col("p_amount")))
    best = both.groupBy(*key).agg(F.max("copies").alias("copies"),
                                  F.max_by(F.struct("purchase_id", "purchase_ts", "p_amount"), order).alias("w"))
    lag = F.floor((F.unix_micros("w.purchase_ts") - F.unix_micros("ts")) / F.lit(-1_000_000))
    return best.select(*key, "copies", "w.purchase_id", "w.purchase_ts", F.col("w.p_amount").alias("purchase_amount"),
                       lag.alias("lag_seconds"))
