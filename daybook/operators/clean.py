"""Cleaning rules D1–D5 and the drop accounting.

Plan shape
----------
raw scan → one narrow projection that parses, normalises and tags each row
with the first rule that drops it → ONE aggregate keyed by ``event_id``.

That aggregate does double duty:

* rule D4 (keep the first surviving copy in input order) is
  ``min(struct(ord, ...))`` over the surviving copies, and
* the per-rule drop counts ride along as ``count_if`` columns, so the raw
  data is scanned and shuffled exactly once for both the clean rows and the
  counts.

It is a declarative aggregate, so Spark combines copies map-side before the
exchange: an ``event_id`` repeated across a third of the input still
reaches the reducer as one partial row per map task, never as one huge
group.  (A ``row_number()`` window would sort the whole hot group in one
task.)  Column pruning can't see into that struct, so callers name the
columns they read and only those travel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.expressions import (
    normalise_country_sql,
    parse_utc_timestamp_sql,
    sql_text,
    utc_date_sql,
)
from daybook.schema import (
    CLEAN_COLUMNS,
    REVENUE_EVENT_TYPES,
    RULE_DUPLICATE,
    RULE_INVALID_ETYPE,
    RULE_INVALID_TS,
    RULE_MALFORMED,
    SENTINEL_YEAR,
    VALID_EVENT_TYPES,
)

ORD = "ord"
RULE = "rule"
FIRST = "first"

# Columns every clean-event consumer may ask for (besides event_id).
_PAYLOAD = tuple(c for c in CLEAN_COLUMNS if c != "event_id")


def _in(values) -> str:
    return ", ".join(sql_text(v) for v in values)


def _input_order(raw: DataFrame) -> str:
    """Row order that decides "first seen" for rule D4.

    File sources attach ``ord`` at the scan (see ``daybook.sources``).  For a
    DataFrame without it — e.g. one built with ``createDataFrame`` — its
    partition order is its row order, which ``monotonically_increasing_id``
    preserves.
    """
    return ORD if ORD in raw.columns else "monotonically_increasing_id()"


def tag_rules(raw: DataFrame) -> DataFrame:
    """Rules D1, D2, D3, D5 as one projection, plus the dropping rule.

    Output columns: ``ord``, the clean columns, and ``rule`` — null for rows
    that survive D1 and D3, else the first rule that drops the row
    (``invalid_ts`` before ``invalid_etype``; attribution is sequential).
    NaN amounts become null (pandas' missing value, skipped by sums); a null
    ``event_type`` is not in the allowlist (``coalesce`` because
    ``x IN (...)`` is null for a null x).  Rows that a scan kept apart as
    malformed (a column ``malformed`` that isn't null) are dropped before all else.
    """
    ts = parse_utc_timestamp_sql("ts", raw.schema["ts"].dataType)
    day = utc_date_sql("_ts")
    apart = f"WHEN {RULE_MALFORMED} IS NOT NULL THEN {sql_text(RULE_MALFORMED)} " if RULE_MALFORMED in raw.columns else ""
    rule = (f"CASE {apart}WHEN _ts IS NULL OR year({day}) >= {SENTINEL_YEAR} "
            f"THEN {sql_text(RULE_INVALID_TS)} "
            f"WHEN NOT coalesce(event_type IN ({_in(VALID_EVENT_TYPES)}), false) "
            f"THEN {sql_text(RULE_INVALID_ETYPE)} END")
    return raw.selectExpr("*", f"{ts} AS _ts").selectExpr(
        f"{_input_order(raw)} AS {ORD}",
        "CAST(event_id AS BIGINT) AS event_id",
        "CAST(user_id AS BIGINT) AS user_id",
        "_ts AS ts",
        f"{day} AS date",
        "event_type",
        f"CASE WHEN event_type IN ({_in(REVENUE_EVENT_TYPES)}) "
        "THEN nanvl(CAST(amount AS DOUBLE), CAST(NULL AS DOUBLE)) ELSE 0D END AS amount",
        f"{normalise_country_sql('country')} AS country",
        "CAST(device AS STRING) AS device",
        "CAST(session_id AS BIGINT) AS session_id",
        f"{rule} AS {RULE}",
    )


def per_event(tagged: DataFrame, columns: tuple[str, ...] = _PAYLOAD, malformed: bool = False) -> DataFrame:
    """One row per ``event_id``: the first surviving copy and copy counts.

    ``first`` is a struct of ``columns`` (null when no copy survived D1/D3);
    ``n_ok``, ``n_ts``, ``n_etype`` count the copies that survived, failed
    D1 and failed D3, ``n_missing_id`` those without a user or session id
    (integers the reference's loader requires; counting them also makes the
    CSV reader parse — and FAILFAST-check — ``session_id``, which no metric
    reads).  Only ``columns`` travel through the shuffle.  ``malformed``
    adds ``n_malformed``, the copies that a scan kept apart.
    """
    counts = [
        F.expr(f"count_if({RULE} IS NULL)").alias("n_ok"),
        F.expr(f"count_if({RULE} = {sql_text(RULE_INVALID_TS)})").alias("n_ts"),
        F.expr(f"count_if({RULE} = {sql_text(RULE_INVALID_ETYPE)})").alias("n_etype"),
        F.expr(f"count_if((user_id IS NULL OR session_id IS NULL) AND NOT {RULE} <=> {sql_text(RULE_MALFORMED)})")
         .alias("n_missing_id"),
    ]
    if malformed:
        counts.append(F.expr(f"count_if({RULE} = {sql_text(RULE_MALFORMED)})").alias("n_malformed"))
    if columns:
        payload = ", ".join([ORD, *columns])
        return tagged.groupBy("event_id").agg(
            F.expr(f"min(CASE WHEN {RULE} IS NULL THEN struct({payload}) END)").alias(FIRST),
            *counts)
    # Only the first copy's order is wanted: min(ord) itself, which is a
    # hash aggregate whenever ord is a plain number; same output shape.
    agg = tagged.groupBy("event_id").agg(
        F.expr(f"min(CASE WHEN {RULE} IS NULL THEN {ORD} END)").alias("_first_ord"), *counts)
    first = F.when(F.col("_first_ord").isNotNull(), F.struct(F.col("_first_ord").alias(ORD)))
    return agg.withColumn(FIRST, first).drop("_first_ord")


def clean_from_per_event(events: DataFrame, columns: tuple[str, ...] = _PAYLOAD) -> DataFrame:
    """Rule D4's survivors, flattened back to clean-event columns."""
    return (events.where(F.col(FIRST).isNotNull())
            .select("event_id", *[F.col(f"{FIRST}.{c}").alias(c) for c in columns]))


def counts_from_per_event(events: DataFrame) -> DataFrame:
    """The drop accounting as a one-row DataFrame.

    raw_rows, valid_rows, dropped_rows = raw − valid, null_id_rows (rows
    whose event_id, user_id or session_id is missing — a load error in the
    reference),
    and ``breakdown`` with one count per rule.  Where malformed rows were kept
    apart, ``malformed_rows`` counts them: raw = valid + dropped + malformed.
    """
    n_copies = F.col("n_ok") + F.col("n_ts") + F.col("n_etype")
    apart = "n_malformed" in events.columns
    n_malformed = F.coalesce(F.sum("n_malformed"), F.lit(0)).cast("long") if apart else F.lit(0).cast("long")
    agg = events.agg(
        F.coalesce(F.sum(n_copies), F.lit(0)).cast("long").alias("raw_rows"),
        # an id is valid when a copy survived D1/D3 (n_ok > 0, i.e. `first`
        # is set); counting it this way lets a counts-only query drop the
        # struct-valued min and plan a hash aggregate
        F.count_if(F.col("n_ok") > 0).cast("long").alias("valid_rows"),
        F.coalesce(F.sum("n_ts"), F.lit(0)).cast("long").alias(RULE_INVALID_TS),
        F.coalesce(F.sum("n_etype"), F.lit(0)).cast("long").alias(RULE_INVALID_ETYPE),
        F.coalesce(F.sum("n_ok"), F.lit(0)).cast("long").alias("survivors"),
        F.coalesce(F.sum(F.when(F.col("event_id").isNull(), n_copies)
                         .otherwise(F.col("n_missing_id"))), F.lit(0))
         .cast("long").alias("null_id_rows"),
        n_malformed.alias("malformed_rows"),
    )
    return agg.select(
        (F.col("raw_rows") + F.col("malformed_rows")).alias("raw_rows"),
        "valid_rows",
        (F.col("raw_rows") - F.col("valid_rows")).alias("dropped_rows"),
        F.struct(
            F.col(RULE_INVALID_TS),
            F.col(RULE_INVALID_ETYPE),
            (F.col("survivors") - F.col("valid_rows")).alias(RULE_DUPLICATE),
        ).alias("breakdown"),
        "null_id_rows",
        *(["malformed_rows"] if apart else []),
    )


def clean_with_counts(raw: DataFrame, columns: tuple[str, ...] = _PAYLOAD
                      ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean events and their counts from one per-event aggregate.

    Returns ``(clean, counts, events)``; ``events`` is the aggregate that
    both derive from.
    """
    events = per_event(tag_rules(raw), columns, RULE_MALFORMED in raw.columns)
    return clean_from_per_event(events, columns), counts_from_per_event(events), events


def clean_events(raw: DataFrame, columns: tuple[str, ...] = _PAYLOAD) -> DataFrame:
    """Rules D1–D5: ``event_id`` (unique) and the named clean columns.

    Only these columns go through the dedup shuffle; a metric passes what it
    reads (``metrics.READS``).
    """
    unknown = set(columns) - set(_PAYLOAD)
    if unknown:
        raise ValueError(f"not clean-event columns: {sorted(unknown)}")
    return clean_from_per_event(per_event(tag_rules(raw), tuple(columns)), tuple(columns))


def clean_counts(raw: DataFrame) -> DataFrame:
    """Rule accounting only (one row)."""
    return counts_from_per_event(per_event(tag_rules(raw), (), RULE_MALFORMED in raw.columns))
