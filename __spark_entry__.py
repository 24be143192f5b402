"""

Every query reads the driver's tables (or views Spark derives from them with
the FIXTURES.md expressions) in full; none filters ids, samples or caps rows
except where a limit is the feature (top-N countries).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import clean as C
from daybook.operators import metrics as M
from daybook.operators import quality as Q
from daybook.operators import quantiles as K
from daybook.operators.staged import stage_events
from daybook.plans.incremental import ReportHistory, list_files
from daybook.plans.report import build_report, document_values
from daybook.plans.snapshot import (
    publish,
    read_marker,
    snapshot_report,
    source_fingerprint,
)
from daybook.session import checkpoint_root, use_utc
from daybook.sources.files import quarantine, read_events, read_events_csv
from daybook.sources.fixtures import (
    dirty_events,
    order_activity,
    order_revenue_daily,
    refund_events,
    table,
)
from daybook.sources.sinks import write_events_csv

SMOKE_DIR = "/root/testdata/sf0.001"


def _ntz(col: str) -> F.Column:
    """Timestamps leave as UTC wall-clock TIMESTAMP_NTZ (DuckDB's TIMESTAMP)."""
    return F.col(col).cast("timestamp_ntz").alias(col)


def _f1_tables(sf: str) -> list[str]:
    """The files behind the F1 view."""
    return [f"{sf.rstrip('/')}/{t}.parquet" for t in ("events", "nation")]


def _f1(spark: SparkSession, sf: str) -> DataFrame:
    use_utc(spark)
    return dirty_events(spark, sf)


def _clean(spark: SparkSession, sf: str, metric: str) -> DataFrame:
    """The clean columns that a metric reads."""
    return C.clean_events(_f1(spark, sf), M.READS[metric])


# ---------------------------------------------------------------------------
# Per-rule queries (C1–C7)
# ---------------------------------------------------------------------------

def q_d1_valid_ts(spark, sf):
    t = C.tag_rules(_f1(spark, sf))
    return (t.where(F.coalesce(F.col("rule"), F.lit("")) != "invalid_ts")
            .select("ord", "event_id", _ntz("ts"), "date"))


def q_d2_country_norm(spark, sf):
    return C.tag_rules(_f1(spark, sf)).select("ord", "country")


def q_d3_event_type_filter(spark, sf):
    t = C.tag_rules(_f1(spark, sf))
    return t.where(F.col("rule").isNull()).select("ord", "event_id", "event_type")


def q_d4_dedup_first(spark, sf):
    e = C.per_event(C.tag_rules(_f1(spark, sf)), ())
    return e.where(F.col("first").isNotNull()).select("event_id", F.col("first.ord").alias("ord"))


def q_d5_zero_amount(spark, sf):
    t = C.tag_rules(_f1(spark, sf))
    return t.where(F.col("rule").isNull()).select("ord", "event_type", "amount")


def q_clean_events(spark, sf):
    c = C.clean_events(_f1(spark, sf))
    return c.select(*[(_ntz(x) if x == "ts" else F.col(x)) for x in c.columns])


def _flat_counts(counts: DataFrame) -> DataFrame:
    return counts.select("raw_rows", "valid_rows", "dropped_rows", "breakdown.*")


def q_clean_counts(spark, sf):
    return _flat_counts(C.clean_counts(_f1(spark, sf)))


def q_date_range(spark, sf):
    return M.date_range(_clean(spark, sf, "date_range"))


# ---------------------------------------------------------------------------
# Metrics (M1–M6)
# ---------------------------------------------------------------------------

def q_dau(spark, sf):
    return M.dau(_clean(spark, sf, "dau"))


def q_funnel_daily(spark, sf):
    return M.funnel_daily(_clean(spark, sf, "funnel_daily"))


def q_revenue_daily(spark, sf):
    r = M.revenue_daily(_clean(spark, sf, "revenue_daily"))
    return r.select("date", F.round("net_revenue", 2).alias("net_revenue"))


def q_top_countries(spark, sf):
    return M.top_countries(_clean(spark, sf, "top_countries"))


def q_revenue_anomalies(spark, sf):
    use_utc(spark)
    return M.anomalies(order_revenue_daily(spark, sf))


def q_clean_revenue_anomalies(spark, sf):
    """Clean events → daily revenue → z-scores; a low threshold, so that rows come out."""
    return M.anomalies(M.revenue_daily(_clean(spark, sf, "revenue_daily")), threshold=1.0)


def q_retention_d1(spark, sf):
    return M.retention_d1(_clean(spark, sf, "retention_d1"))


def q_retention_d1_orders(spark, sf):
    use_utc(spark)
    return M.retention_d1(order_activity(spark, sf))


# ---------------------------------------------------------------------------
# Data quality (Q1–Q4)
# ---------------------------------------------------------------------------

def _events(spark, sf):
    use_utc(spark)
    return table(spark, sf, "events")


def q_dq_event_types(spark, sf):
    return Q.event_type_distribution(_events(spark, sf))


def q_dq_dirty_profile(spark, sf):
    return Q.dirty_profile(_f1(spark, sf))


def q_dq_purchase_stats(spark, sf):
    return Q.purchase_amount_stats(_events(spark, sf), amount_col="value")


# The quantiles of the sketch query, and how many rank errors (99 % each) its gate allows.
_PROBABILITIES = (0.01, 0.25, 0.5, 0.75, 0.99)
_SLACK = 3


def q_dq_purchase_quantiles(spark, sf):
    """Daily sketches of purchase amounts, and all days' merged from them, held against true ranks.

    A group of at most K amounts is exact, so its values are returned, too.
    """
    bought = _events(spark, sf).where("event_type = 'purchase'").select(F.to_date("ts").alias("day"), "value")
    days = K.build_sketches(bought, "value", ["day"])
    per_day = K.sketch_quantiles(days, _PROBABILITIES, ["day"])
    whole = K.sketch_quantiles(K.merge_sketches(days), _PROBABILITIES)
    per_day = K.rank_distances(bought, "value", per_day, ["day"])
    whole = K.rank_distances(bought, "value", whole).select(F.lit(None).cast("date").alias("day"), "*")
    found = per_day.unionByName(whole)
    return found.select("day", "p", F.col("n").alias("purchases"), F.when(F.col("n") <= K.K, F.col("value")).alias("value"),
                        (F.col("distance") <= _SLACK * K.rank_error()).alias("within"))


def q_dq_purchase_sketch(spark, sf):
    """The one-pass form of dq_purchase_stats; the median's rank is held against the data."""
    raw = _events(spark, sf)
    row = Q.purchase_amount_sketch(raw, amount_col="value")
    found = row.select(F.col("purchases").alias("n"), F.lit(0.5).alias("p"), F.col("median_amount").alias("value"),
                       "purchases", "min_amount", "mean_amount", "max_amount")
    checked = K.rank_distances(raw.where("event_type = 'purchase'"), "value", found)
    return checked.select("purchases", "min_amount", "mean_amount", "max_amount",
                          (F.col("distance") <= _SLACK * K.rank_error()).alias("median_within"))


def q_refund_links(spark, sf):
    use_utc(spark)
    links = Q.refund_links(refund_events(spark, sf))
    return links.select(*[(_ntz(x) if x == "ts" else F.col(x)) for x in links.columns])


def q_refund_witnesses(spark, sf):
    use_utc(spark)
    found = Q.refund_witnesses(refund_events(spark, sf))
    return found.select(*[(_ntz(x) if x.endswith("ts") else F.col(x)) for x in found.columns])


def q_refund_integrity(spark, sf):
    use_utc(spark)
    return Q.refund_integrity(refund_events(spark, sf))


# ---------------------------------------------------------------------------
# Report, snapshot, CSV round trip (M7, S1–S6, Q5)
# ---------------------------------------------------------------------------

def q_report_document(spark, sf):
    report = build_report(_f1(spark, sf))
    return report.document()


def q_report_snapshot(spark, sf):
    report, _ = snapshot_report(_f1(spark, sf), _f1_tables(sf))
    return report.document()


def q_report_sections(spark, sf):
    """Every value of the parsed document with its section, place and field."""
    return document_values(q_report_document(spark, sf))


def q_report_snapshot_sections(spark, sf):
    """The same through a snapshot that is read back."""
    snapshot_report(_f1(spark, sf), _f1_tables(sf))
    report, reused = snapshot_report(_f1(spark, sf), _f1_tables(sf))
    if not reused:
        raise RuntimeError("the snapshot just written was not found")
    return document_values(report.document())


def q_report_incremental_sections(spark, sf):
    """The report over F1's CSV files as they arrive, the last in order first.

    Each step reads its new files only; earlier copies of known events come with
    later steps, so first copies change places.
    """
    files = sorted(r["path"] for r in list_files(spark, _f1_csv(spark, sf, files=4)).collect())
    history = ReportHistory(spark, f"{checkpoint_root(spark)}/daybook/histories/{uuid.uuid4().hex}")
    known = len(files)
    for first in (len(files) // 2, 1, 0):
        report, done = history.update(files[first:])
        if done.files_read != known - first:
            raise RuntimeError(f"{done.files_read} files read, {known - first} are new")
        known = first
    return document_values(report.document())


# Version of the stored inputs' formats; part of their keys.
_CSV_FORMAT = 4
# Rows of one stored file where a least number of files is given.
_FILE_ROWS = 100_000


def _stored_input(spark, sf, name: str, write: Callable[[DataFrame, str], None]) -> str:
    """A folder made from F1 by ``write`` in the shared folder, once per input.

    It is named by the input fingerprint (files and plan); a half-written one
    stays invisible until it is published.
    """
    f1 = _f1(spark, sf)
    key = source_fingerprint(f1, _f1_tables(sf))
    base = f"{checkpoint_root(spark)}/daybook/fixtures/{name}_v{_CSV_FORMAT}_{key}"
    folder = read_marker(spark, base)
    if folder is None:
        folder = f"{base}/{uuid.uuid4().hex}"
        write(f1, folder)
        folder = publish(spark, base, folder)
    return folder


def _in_order(f1: DataFrame, files: int | None = None) -> DataFrame:
    """Rows dealt over files in input order, so that files and lines follow it.

    ``files`` is their least number; it grows with the rows, so that a file's
    sort and the reading of a few files stay bounded.
    """
    if files:
        files = max(files, -(-f1.count() // _FILE_ROWS))
    dealt = f1.repartitionByRange(files, "ord") if files else f1.repartitionByRange("ord")
    return dealt.sortWithinPartitions("ord").drop("ord")


def _f1_csv(spark, sf, files: int | None = None) -> str:
    """F1 as header CSV (S6), in ``files`` files or more if given."""
    return _stored_input(spark, sf, f"f1_csv_{files or 'any'}", lambda f1, folder: write_events_csv(_in_order(f1, files), folder))


def q_csv_staged_clean_events(spark, sf):
    """First copies by hash aggregate and join, from a staged copy; many splits, in a session of its own."""
    folder = _f1_csv(spark, sf)
    split = spark.newSession()
    use_utc(split)
    split.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    c = stage_events(read_events_csv(split, folder)).clean()
    return c.select(*[(_ntz(x) if x == "ts" else F.col(x)) for x in c.columns])


def q_csv_staged_clean_counts(spark, sf):
    counts = stage_events(_broken_csv(spark, sf), ()).counts()
    return counts.select("raw_rows", "valid_rows", "dropped_rows", "malformed_rows", "breakdown.*")


def _f1_tokens(f1: DataFrame) -> DataFrame:
    """F1 with missing amounts spelt out, and a country that is spelt like them."""
    amount, country = F.col("amount").cast("string"), F.col("country")
    return (f1.withColumn("amount", F.when(F.col("ord") % 13 == 0, "NA").when(F.col("ord") % 17 == 0, "null").otherwise(amount))
            .withColumn("country", F.when(F.col("ord") % 19 == 0, "NA").otherwise(country)))


def q_csv_null_tokens_events(spark, sf):
    folder = _stored_input(spark, sf, "f1_tokens", lambda f1, to: write_events_csv(_in_order(_f1_tokens(f1)), to))
    c = C.clean_events(read_events_csv(spark, folder))
    return c.select(*[(_ntz(x) if x == "ts" else F.col(x)) for x in c.columns])


def _write_broken_lines(f1: DataFrame, folder: str) -> None:
    """F1 as CSV lines, some with a wrong number, some with a field too few or too many."""
    n = F.col("ord")
    fields = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in f1.columns if c != "ord"}
    fields["amount"] = F.when(n % 23 == 0, F.concat(F.lit("x"), fields["amount"])).otherwise(fields["amount"])
    fields["session_id"] = F.when(n % 29 == 0, F.lit("oops")).otherwise(fields["session_id"])
    names = list(fields)
    line = (F.when(n % 31 == 0, F.concat_ws(",", *[fields[c] for c in names[:5]]))
            .when(n % 37 == 0, F.concat_ws(",", *fields.values(), F.lit("more"))).otherwise(F.concat_ws(",", *fields.values())))
    lines = f1.select("ord", line.alias(",".join(names)))
    # one column whose name is the header; a separator that doesn't occur
    (_in_order(lines).write.option("header", True).option("sep", "\u0001").option("quote", "\u0000")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder))


def _broken_csv(spark, sf) -> DataFrame:
    return read_events_csv(spark, _stored_input(spark, sf, "f1_broken", _write_broken_lines), failfast=False)


def q_csv_quarantine_counts(spark, sf):
    counts = C.clean_counts(_broken_csv(spark, sf))
    return counts.select("raw_rows", "valid_rows", "dropped_rows", "malformed_rows", "breakdown.*")


def q_csv_quarantine_rows(spark, sf):
    rows = quarantine(_broken_csv(spark, sf))
    return rows.select(F.split("line", ",")[0].cast("long").alias("event_id"), "malformed")


def q_union_in_order_events(spark, sf):
    """Every third event once more with other values, as CSV, listed before the parquet input: its copies come first."""
    first = _stored_input(spark, sf, "f1_thirds", lambda f1, to: write_events_csv(_in_order(
        f1.where("ord % 3 = 0").withColumn("user_id", F.col("user_id") + 1).withColumn("country", F.lit(" zz"))), to))
    whole = _stored_input(spark, sf, "f1_parquet", lambda f1, to: _in_order(f1, 3).write.parquet(f"{to}/a.parquet"))
    c = C.clean_events(read_events(spark, [first, f"{whole}/a.parquet"]))
    return c.select(*[(_ntz(x) if x == "ts" else F.col(x)) for x in c.columns])


def q_csv_clean_counts(spark, sf):
    return _flat_counts(C.clean_counts(read_events_csv(spark, _f1_csv(spark, sf))))


def q_csv_clean_events(spark, sf):
    c = C.clean_events(read_events_csv(spark, _f1_csv(spark, sf)))
    return c.select(*[(_ntz(x) if x == "ts" else F.col(x)) for x in c.columns])


def q_csv_split_clean_events(spark, sf):
    """The same over files that are read in many splits, in a session of its own."""
    folder = _f1_csv(spark, sf)
    split = spark.newSession()
    use_utc(split)
    split.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    c = C.clean_events(read_events_csv(split, folder))
    return c.select(*[(_ntz(x) if x == "ts" else F.col(x)) for x in c.columns])


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "d1_valid_ts": q_d1_valid_ts,
    "d2_country_norm": q_d2_country_norm,
    "d3_event_type_filter": q_d3_event_type_filter,
    "d4_dedup_first": q_d4_dedup_first,
    "d5_zero_amount": q_d5_zero_amount,
    "clean_events": q_clean_events,
    "clean_counts": q_clean_counts,
    "date_range": q_date_range,
    "dau": q_dau,
    "funnel_daily": q_funnel_daily,
    "revenue_daily": q_revenue_daily,
    "top_countries": q_top_countries,
    "revenue_anomalies": q_revenue_anomalies,
    "clean_revenue_anomalies": q_clean_revenue_anomalies,
    "retention_d1": q_retention_d1,
    "retention_d1_orders": q_retention_d1_orders,
    "dq_event_types": q_dq_event_types,
    "dq_dirty_profile": q_dq_dirty_profile,
    "dq_purchase_stats": q_dq_purchase_stats,
    "dq_purchase_quantiles": q_dq_purchase_quantiles,
    "dq_purchase_sketch": q_dq_purchase_sketch,
    "refund_links": q_refund_links,
    "refund_witnesses": q_refund_witnesses,
    "refund_integrity": q_refund_integrity,
    "csv_clean_counts": q_csv_clean_counts,
    "csv_clean_events": q_csv_clean_events,
    "csv_split_clean_events": q_csv_split_clean_events,
    "csv_staged_clean_events": q_csv_staged_clean_events,
    "csv_staged_clean_counts": q_csv_staged_clean_counts,
    "csv_null_tokens_events": q_csv_null_tokens_events,
    "csv_quarantine_counts": q_csv_quarantine_counts,
    "csv_quarantine_rows": q_csv_quarantine_rows,
    "union_in_order_events": q_union_in_order_events,
    "report_document": q_report_document,
    "report_snapshot": q_report_snapshot,
    "report_sections": q_report_sections,
    "report_snapshot_sections": q_report_snapshot_sections,
    "report_incremental_sections": q_report_incremental_sections,
}


try:                                  # the corpus operators are optional
    from daybook.llm import registry as _llm
except ImportError as missing:
    if missing.name != "daybook.llm":
        raise
    _llm = None

try:
    import corpus_pipeline as _pipeline
except ImportError as missing:
    if missing.name not in ("corpus_pipeline", "daybook.llm"):
        raise
    _pipeline = None


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the full report over the sf0.001 dirty-event view."""
    return q_report_document(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    more = dict(_llm.QUERIES) if _llm else {}
    if _pipeline:
        more["pipeline"] = _pipeline.run
    return _QUERIES | more


# ---------------------------------------------------------------------------
# DuckDB oracles (same expressions, written independently in SQL)
# ---------------------------------------------------------------------------

_F1 = """
f1 AS (
  SELECT e.event_id AS ord,
         CASE WHEN e.event_id % 100 = 7 THEN e.event_id - 1 ELSE e.event_id END AS event_id,
         e.user_id AS user_id,
         CASE WHEN e.event_id % 200 = 0 THEN '2099-01-01 00:00:00'
              WHEN e.event_id % 200 = 50 THEN 'not-a-date'
              WHEN e.event_id % 200 = 100 THEN strftime(e.ts, '%H:%M:%S')
              ELSE strftime(e.ts, '%Y-%m-%d %H:%M:%S') END AS ts,
         CASE WHEN e.event_type = 'view' THEN 'page_view'
              WHEN e.event_type = 'error' THEN 'refund'
              ELSE e.event_type END AS event_type,
         CASE WHEN e.event_type = 'error' THEN -e.value ELSE e.value END AS amount,
         CASE WHEN e.event_id % 50 = 1 THEN NULL
              WHEN e.event_id % 50 = 2 THEN ''
              WHEN e.event_id % 50 = 3 THEN '  ' || lower(n.n_name)
              ELSE n.n_name END AS country,
         CASE e.event_id % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' ELSE 'web' END AS device,
         e.user_id * 1000 + e.event_id % 1000 AS session_id
  FROM events e LEFT JOIN nation n ON n.n_nationkey = e.user_id % 25
),
parsed AS (
  SELECT *, CASE WHEN ts LIKE '____-%' THEN try_cast(ts AS TIMESTAMP) END AS t FROM f1
),
tagged AS (
  SELECT ord, event_id, user_id, t AS ts, CAST(t AS DATE) AS date, event_type,
         CASE WHEN event_type IN ('purchase', 'refund') THEN amount ELSE CAST(0 AS DOUBLE) END AS amount,
         trim(upper(coalesce(nullif(country, ''), 'UNK'))) AS country,
         device, session_id,
         CASE WHEN t IS NULL OR year(t) >= 2099 THEN 'invalid_ts'
              WHEN NOT coalesce(event_type IN ('page_view', 'signup', 'purchase', 'refund'), false)
                THEN 'invalid_etype' END AS rule
  FROM parsed
),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ord) AS rn
  FROM tagged WHERE rule IS NULL
),
clean AS (
  SELECT event_id, user_id, ts, date, event_type, amount, country, device, session_id
  FROM firsts WHERE rn = 1
)"""

_F2 = """
p AS (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id,
         CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id * 1000 + event_id % 1000 END AS session_id,
         ts, 'purchase' AS event_type, value AS amount
  FROM events WHERE event_type = 'purchase'
),
r AS (
  SELECT event_id + 10000000 AS event_id, user_id,
         CASE WHEN event_id % 65 = 0 THEN NULL WHEN event_id % 70 = 0 THEN session_id + 1
              ELSE session_id END AS session_id,
         CASE WHEN event_id % 50 = 0 THEN ts - INTERVAL 2 HOUR
              WHEN event_id % 55 = 0 THEN ts + INTERVAL 45 DAY
              ELSE ts + (1 + event_id % 700) * INTERVAL 1 HOUR END AS ts,
         'refund' AS event_type,
         CASE WHEN event_id % 30 = 0 THEN -amount - 1 ELSE -amount END AS amount
  FROM p WHERE event_id % 5 = 0
),
f2 AS (SELECT * FROM p UNION ALL SELECT * FROM r),
ok AS (SELECT * FROM f2 WHERE ts IS NOT NULL AND year(ts) < 2099),
pur AS (SELECT * FROM ok WHERE event_type = 'purchase'),
ref AS (
  SELECT event_id, user_id, session_id, amount, ts, count(*) AS copies
  FROM ok WHERE event_type = 'refund'
  GROUP BY event_id, user_id, session_id, amount, ts
),
met AS (
  SELECT ref.event_id, bool_or(pur.ts < ref.ts) AS earlier,
         bool_or(pur.ts < ref.ts AND pur.ts >= ref.ts - INTERVAL 30 DAY) AS in_time
  FROM ref JOIN pur ON pur.user_id = ref.user_id AND pur.session_id = ref.session_id
   AND abs(ref.amount + pur.amount) <= 1e-4 + 1e-5 * abs(pur.amount)
  GROUP BY ref.event_id
),
links AS (
  SELECT ref.*,
    CASE
      WHEN NOT EXISTS (SELECT 1 FROM pur WHERE pur.user_id = ref.user_id
                       AND pur.session_id = ref.session_id) THEN 'no_purchase'
      WHEN met.event_id IS NULL THEN 'amount_mismatch'
      WHEN met.in_time THEN 'linked'
      WHEN met.earlier THEN 'too_late'
      ELSE 'bad_time' END AS status
  FROM ref LEFT JOIN met ON met.event_id = ref.event_id
)"""

_COUNTS = """
SELECT CAST(count(*) AS BIGINT) AS raw_rows,
       CAST((SELECT count(*) FROM clean) AS BIGINT) AS valid_rows,
       CAST(count(*) - (SELECT count(*) FROM clean) AS BIGINT) AS dropped_rows,
       CAST(count(*) FILTER (WHERE rule = 'invalid_ts') AS BIGINT) AS invalid_ts,
       CAST(count(*) FILTER (WHERE rule = 'invalid_etype') AS BIGINT) AS invalid_etype,
       CAST(count(*) FILTER (WHERE rule IS NULL) - (SELECT count(*) FROM clean) AS BIGINT)
         AS duplicate_event_id
FROM tagged"""

_CLEAN_ROWS = "SELECT event_id, user_id, ts, date, event_type, amount, country, device, session_id FROM clean"

# The first thing that doesn't fit in a broken line.
_BROKEN = """CASE WHEN ord % 31 = 0 OR ord % 37 = 0 THEN 'columns' WHEN ord % 23 = 0 THEN 'amount'
                  WHEN ord % 29 = 0 THEN 'session_id' END"""

_BROKEN_COUNTS = f"""
      s AS (SELECT *, ({_BROKEN}) IS NOT NULL AS apart FROM tagged),
      v AS (SELECT count(DISTINCT event_id) AS n FROM s WHERE rule IS NULL AND NOT apart)
      SELECT CAST(count(*) AS BIGINT) AS raw_rows, CAST((SELECT n FROM v) AS BIGINT) AS valid_rows,
             CAST(count(*) FILTER (WHERE NOT apart) - (SELECT n FROM v) AS BIGINT) AS dropped_rows,
             CAST(count(*) FILTER (WHERE apart) AS BIGINT) AS malformed_rows,
             CAST(count(*) FILTER (WHERE NOT apart AND rule = 'invalid_ts') AS BIGINT) AS invalid_ts,
             CAST(count(*) FILTER (WHERE NOT apart AND rule = 'invalid_etype') AS BIGINT) AS invalid_etype,
             CAST(count(*) FILTER (WHERE NOT apart AND rule IS NULL) - (SELECT n FROM v) AS BIGINT) AS duplicate_event_id
      FROM s"""

_RETENTION = """
c AS (
  SELECT user_id, date, min(date) OVER (PARTITION BY user_id) AS cohort_date FROM pairs
),
agg AS (
  SELECT cohort_date,
         CAST(count(*) FILTER (WHERE date = cohort_date) AS BIGINT) AS users,
         CAST(count(*) FILTER (WHERE date = cohort_date + 1) AS BIGINT) AS retained
  FROM c GROUP BY cohort_date
)
SELECT cohort_date, users, retained,
       CASE WHEN users > 0 THEN round_even(CAST(retained AS DOUBLE) / users, 4) ELSE 0.0 END AS rate
FROM agg WHERE cohort_date < (SELECT max(date) FROM pairs)"""

_REVENUE_Z = """
rev AS (SELECT date, sum(amount) AS net_revenue FROM clean
        WHERE event_type IN ('purchase', 'refund') GROUP BY date),
zs AS (SELECT date, net_revenue, count(*) OVER () AS n, stddev_pop(net_revenue) OVER () AS sd,
              (net_revenue - avg(net_revenue) OVER ()) / nullif(stddev_pop(net_revenue) OVER (), 0) AS z FROM rev)"""


def _entries(section: str, source: str, order: str, key: str, fields: dict[str, str]) -> str:
    """Long rows of one list section, numbered in the document's order."""
    numbered = f"(SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS position FROM ({source}))"
    return "\n  UNION ALL ".join(
        f"SELECT '{section}' AS section, CAST(position AS INTEGER) AS position, CAST({key} AS VARCHAR) AS key, "
        f"'{name}' AS field, CAST({value} AS DOUBLE) AS value FROM {numbered}" for name, value in fields.items())


def _ratio(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN round_even(CAST({num} AS DOUBLE) / {den}, 4) ELSE 0.0 END"


_SECTIONS = f"""{_REVENUE_Z},
k AS ({_COUNTS}),
pairs AS (SELECT DISTINCT user_id, date FROM clean),
cohorts AS (SELECT user_id, date, min(date) OVER (PARTITION BY user_id) AS cohort_date FROM pairs),
ret AS (SELECT cohort_date, count(*) FILTER (WHERE date = cohort_date) AS users,
               count(*) FILTER (WHERE date = cohort_date + 1) AS retained FROM cohorts GROUP BY cohort_date),
fun AS (SELECT date, count(*) FILTER (WHERE event_type = 'page_view') AS pv,
               count(*) FILTER (WHERE event_type = 'signup') AS signup,
               count(*) FILTER (WHERE event_type = 'purchase') AS purchase
        FROM clean WHERE event_type IN ('page_view', 'signup', 'purchase') GROUP BY date)
  SELECT 'range' AS section, 0 AS position, CAST(min(date) AS VARCHAR) AS key, 'start' AS field,
         CAST(NULL AS DOUBLE) AS value FROM clean
  UNION ALL SELECT 'range', 0, CAST(max(date) AS VARCHAR), 'end', NULL FROM clean
  UNION ALL SELECT 'counts', 0, NULL, 'raw_rows', CAST(raw_rows AS DOUBLE) FROM k
  UNION ALL SELECT 'counts', 0, NULL, 'valid_rows', CAST(valid_rows AS DOUBLE) FROM k
  UNION ALL SELECT 'counts', 0, NULL, 'dropped_rows', CAST(dropped_rows AS DOUBLE) FROM k
  UNION ALL SELECT 'counts', 0, NULL, 'breakdown.invalid_ts', CAST(invalid_ts AS DOUBLE) FROM k
  UNION ALL SELECT 'counts', 0, NULL, 'breakdown.invalid_etype', CAST(invalid_etype AS DOUBLE) FROM k
  UNION ALL SELECT 'counts', 0, NULL, 'breakdown.duplicate_event_id', CAST(duplicate_event_id AS DOUBLE) FROM k
  UNION ALL {_entries("dau", "SELECT date, count(*) AS dau FROM pairs WHERE user_id IS NOT NULL GROUP BY date", "date", "date", {"dau": "dau"})}
  UNION ALL {_entries("funnel", "SELECT * FROM fun", "date", "date", {"pv": "pv", "signup": "signup", "purchase": "purchase", "pv_to_signup": _ratio("signup", "pv"), "signup_to_purchase": _ratio("purchase", "signup")})}
  UNION ALL {_entries("revenue_daily", "SELECT * FROM rev", "date", "date", {"net_revenue": "round(net_revenue, 2)"})}
  UNION ALL {_entries("top_countries", "SELECT country, sum(amount) AS total FROM clean WHERE event_type IN ('purchase', 'refund') GROUP BY country ORDER BY total DESC, country LIMIT 10", "total DESC, country", "country", {"net_revenue": "round(total, 2)"})}
  UNION ALL {_entries("anomalies", "SELECT * FROM zs WHERE n >= 2 AND sd > 0 AND z > 3", "round_even(z, 4) DESC, date", "date", {"net_revenue": "round(net_revenue, 2)", "z": "round_even(z, 4)"})}
  UNION ALL {_entries("retention_d1", "SELECT * FROM ret WHERE cohort_date < (SELECT max(date) FROM pairs)", "cohort_date", "cohort_date", {"users": "users", "retained": "retained", "rate": _ratio("retained", "users")})}"""

_ORACLE: dict[str, str] = {
    "d1_valid_ts": f"WITH {_F1} SELECT ord, event_id, ts, date FROM tagged "
                   "WHERE coalesce(rule, '') <> 'invalid_ts'",
    "d2_country_norm": f"WITH {_F1} SELECT ord, country FROM tagged",
    "d3_event_type_filter": f"WITH {_F1} SELECT ord, event_id, event_type FROM tagged "
                            "WHERE rule IS NULL",
    "d4_dedup_first": f"WITH {_F1} SELECT event_id, ord FROM firsts WHERE rn = 1",
    "d5_zero_amount": f"WITH {_F1} SELECT ord, event_type, amount FROM tagged WHERE rule IS NULL",
    "clean_events": f"WITH {_F1} {_CLEAN_ROWS}",
    "clean_counts": f"WITH {_F1} {_COUNTS}",
    "date_range": f"WITH {_F1} SELECT min(date) AS start, max(date) AS \"end\" FROM clean",
    "dau": f"WITH {_F1} SELECT date, CAST(count(DISTINCT user_id) AS BIGINT) AS dau "
           "FROM clean GROUP BY date",
    "funnel_daily": f"""WITH {_F1},
      d AS (
        SELECT date,
               CAST(count(*) FILTER (WHERE event_type = 'page_view') AS BIGINT) AS pv,
               CAST(count(*) FILTER (WHERE event_type = 'signup') AS BIGINT) AS signup,
               CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchase
        FROM clean WHERE event_type IN ('page_view', 'signup', 'purchase') GROUP BY date
      )
      SELECT date, pv, signup, purchase,
             CASE WHEN pv > 0 THEN round_even(CAST(signup AS DOUBLE) / pv, 4) ELSE 0.0 END
               AS pv_to_signup,
             CASE WHEN signup > 0 THEN round_even(CAST(purchase AS DOUBLE) / signup, 4)
               ELSE 0.0 END AS signup_to_purchase
      FROM d""",
    "revenue_daily": f"WITH {_F1} SELECT date, round(sum(amount), 2) AS net_revenue FROM clean "
                     "WHERE event_type IN ('purchase', 'refund') GROUP BY date",
    "top_countries": f"""WITH {_F1},
      t AS (SELECT country, sum(amount) AS total FROM clean
            WHERE event_type IN ('purchase', 'refund') GROUP BY country)
      SELECT CAST(row_number() OVER (ORDER BY total DESC, country) AS INTEGER) AS rank,
             country, round(total, 2) AS net_revenue
      FROM t ORDER BY total DESC, country LIMIT 10""",
    "revenue_anomalies": """WITH
      rev AS (SELECT CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS net_revenue
              FROM orders GROUP BY 1),
      st AS (SELECT count(*) AS n, avg(net_revenue) AS mu, stddev_pop(net_revenue) AS sd FROM rev)
      SELECT date, round(net_revenue, 2) AS net_revenue,
             round_even((net_revenue - mu) / sd, 4) AS z
      FROM rev, st WHERE n >= 2 AND sd > 0 AND (net_revenue - mu) / sd > 3""",
    "clean_revenue_anomalies": f"WITH {_F1}, {_REVENUE_Z} SELECT date, round(net_revenue, 2) AS net_revenue, "
                               "round_even(z, 4) AS z FROM zs WHERE n >= 2 AND sd > 0 AND z > 1",
    "retention_d1": f"WITH {_F1}, pairs AS (SELECT DISTINCT user_id, date FROM clean), {_RETENTION}",
    "retention_d1_orders": "WITH pairs AS (SELECT DISTINCT o_custkey AS user_id, "
                           "CAST(o_orderdate AS DATE) AS date FROM orders), " + _RETENTION,
    "dq_event_types": """SELECT event_type, CAST(count(*) AS BIGINT) AS events,
        round_even(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (), 2) AS pct
      FROM events GROUP BY event_type""",
    "dq_dirty_profile": f"""WITH {_F1},
      a AS (
        SELECT count(*) AS rows,
               count(*) FILTER (WHERE year(t) >= 2099) AS sentinel_ts,
               count(*) FILTER (WHERE t IS NULL) AS unparseable_ts,
               count(*) FILTER (WHERE country IS NULL OR country = '') AS empty_country,
               count(*) FILTER (WHERE NOT coalesce(event_type IN
                 ('page_view', 'signup', 'purchase', 'refund'), false)) AS unknown_type,
               count(DISTINCT event_id) AS unique_ids,
               count(*) - count(DISTINCT event_id) AS duplicate_ids
        FROM parsed
      )
      SELECT CAST(rows AS BIGINT) AS rows, CAST(sentinel_ts AS BIGINT) AS sentinel_ts,
             CAST(unparseable_ts AS BIGINT) AS unparseable_ts,
             CAST(empty_country AS BIGINT) AS empty_country,
             CAST(unknown_type AS BIGINT) AS unknown_type,
             CAST(unique_ids AS BIGINT) AS unique_ids,
             CAST(duplicate_ids AS BIGINT) AS duplicate_ids,
             round_even(CAST(sentinel_ts AS DOUBLE) * 100 / rows, 2) AS sentinel_ts_pct,
             round_even(CAST(unparseable_ts AS DOUBLE) * 100 / rows, 2) AS unparseable_ts_pct,
             round_even(CAST(empty_country AS DOUBLE) * 100 / rows, 2) AS empty_country_pct,
             round_even(CAST(unknown_type AS DOUBLE) * 100 / rows, 2) AS unknown_type_pct,
             round_even(CAST(duplicate_ids AS DOUBLE) * 100 / rows, 2) AS duplicate_ids_pct
      FROM a""",
    "dq_purchase_stats": """WITH
      v AS (SELECT value FROM events WHERE event_type = 'purchase'),
      ranked AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS rk,
                        count(*) OVER () AS n FROM v WHERE value IS NOT NULL AND NOT isnan(value))
      SELECT CAST(count(*) AS BIGINT) AS purchases, min(value) AS min_amount,
             (SELECT avg(value) FROM ranked WHERE rk IN ((n - 1) // 2, n // 2)) AS median_amount,
             round(avg(value), 2) AS mean_amount, max(value) AS max_amount
      FROM v""",
    "dq_purchase_quantiles": f"""WITH
      v AS (SELECT CAST(ts AS DATE) AS day, value FROM events
            WHERE event_type = 'purchase' AND value IS NOT NULL AND NOT isnan(value)),
      g AS (SELECT day, value FROM v UNION ALL SELECT NULL, value FROM v),
      r AS (SELECT day, value, row_number() OVER (PARTITION BY day ORDER BY value) AS rk,
                   count(*) OVER (PARTITION BY day) AS n FROM g),
      q AS (SELECT unnest([{", ".join(map(str, _PROBABILITIES))}]) AS p)
      SELECT day, CAST(p AS DOUBLE) AS p, CAST(n AS BIGINT) AS purchases,
             CASE WHEN n <= {K.K} THEN value END AS value, true AS within
      FROM r, q WHERE rk = greatest(1, ceil(p * n - 1e-9))""",
    "dq_purchase_sketch": """SELECT CAST(count(*) AS BIGINT) AS purchases, min(value) AS min_amount,
        round(avg(value), 2) AS mean_amount, max(value) AS max_amount, true AS median_within
      FROM events WHERE event_type = 'purchase'""",
    "refund_links": f"WITH {_F2} SELECT event_id, user_id, session_id, amount, ts, "
                    "CAST(copies AS BIGINT) AS copies, status FROM links",
    "refund_witnesses": f"""WITH {_F2},
      w AS (
        SELECT ref.event_id, pur.event_id AS purchase_id, pur.ts AS purchase_ts, pur.amount AS purchase_amount,
               row_number() OVER (PARTITION BY ref.event_id ORDER BY pur.ts DESC, pur.event_id) AS rn
        FROM ref JOIN pur ON pur.user_id = ref.user_id AND pur.session_id = ref.session_id
         AND abs(ref.amount + pur.amount) <= 1e-4 + 1e-5 * abs(pur.amount)
         AND pur.ts < ref.ts AND pur.ts >= ref.ts - INTERVAL 30 DAY
      )
      SELECT ref.event_id, user_id, session_id, amount, ref.ts, CAST(copies AS BIGINT) AS copies,
             purchase_id, purchase_ts, purchase_amount,
             CAST(floor(epoch_us(ref.ts - purchase_ts) / 1000000) AS BIGINT) AS lag_seconds
      FROM ref LEFT JOIN w ON w.event_id = ref.event_id AND rn = 1""",
    "refund_integrity": f"WITH {_F2} SELECT status, CAST(sum(copies) AS BIGINT) AS refunds "
                        "FROM links GROUP BY status",
    "csv_clean_counts": f"WITH {_F1} {_COUNTS}",
    "csv_clean_events": f"WITH {_F1} {_CLEAN_ROWS}",
    "csv_split_clean_events": f"WITH {_F1} {_CLEAN_ROWS}",
    "csv_staged_clean_events": f"WITH {_F1} {_CLEAN_ROWS}",
    "csv_staged_clean_counts": f"WITH {_F1}, {_BROKEN_COUNTS}",
    "csv_null_tokens_events": f"""WITH {_F1}
      SELECT event_id, user_id, ts, date, event_type,
             CASE WHEN event_type IN ('purchase', 'refund') AND (ord % 13 = 0 OR ord % 17 = 0) THEN NULL ELSE amount END AS amount,
             CASE WHEN ord % 19 = 0 THEN 'NA' ELSE country END AS country, device, session_id
      FROM firsts WHERE rn = 1""",
    "csv_quarantine_counts": f"WITH {_F1}, {_BROKEN_COUNTS}",
    "csv_quarantine_rows": f"""WITH {_F1}
      SELECT event_id, {_BROKEN} AS malformed FROM tagged WHERE ({_BROKEN}) IS NOT NULL""",
    "union_in_order_events": f"""WITH {_F1},
      u AS (
        SELECT 0 AS src, ord, event_id, user_id + 1 AS user_id, ts, date, event_type, amount, 'ZZ' AS country, device, session_id
        FROM tagged WHERE rule IS NULL AND ord % 3 = 0
        UNION ALL
        SELECT 1, ord, event_id, user_id, ts, date, event_type, amount, country, device, session_id
        FROM tagged WHERE rule IS NULL
      ),
      f AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY src, ord) AS rn FROM u)
      SELECT event_id, user_id, ts, date, event_type, amount, country, device, session_id FROM f WHERE rn = 1""",
    "report_sections": f"WITH {_F1}, {_SECTIONS}",
    "report_snapshot_sections": f"WITH {_F1}, {_SECTIONS}",
    "report_incremental_sections": f"WITH {_F1}, {_SECTIONS}",
}


def oracle_sql() -> dict[str, str]:
    more = dict(_llm.ORACLE) if _llm else {}
    if _pipeline and _pipeline.ORACLE_SQL:
        more["pipeline"] = _pipeline.ORACLE_SQL
    return _ORACLE | more
