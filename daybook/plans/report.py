"""The analytics report (M7): raw events → clean → six metrics → one document.

Plan shape::

    raw scan ─ tag (narrow, codegen) ─ parquet: the staged events, parsed once (lineage cut here)
      ├─ place, rule ─ partial min(place) ─ Exchange(event_id) ─ events with several copies ─ parquet
      └─ first copies (join with those) ─ Expand into grouping sets {day, country, user-day}
           ─ partial agg ─ Exchange ─ final agg, and the row of counts
           = the rollup: 1 counts row + 1 row per day + per country + per user-day,
             written once as parquet under spark.checkpoint.dir, partitioned by
             set (lineage cut here, and the staged events removed)

    rollup table ─┬─ set=all:      counts
                  ├─ set=day:      range, funnel, revenue, anomalies (day-sized)
                  ├─ set=country:  top countries (TakeOrderedAndProject)
                  └─ set=user_day ─┬─ dau: groupBy(date) partial count
                                   └─ retention: Exchange(user_id) window min → groupBy(cohort)

Nothing event-sized is sorted (``operators.staged``).  The dedup's exchange
carries an id, a place and a count; the rollup's is partially aggregated per task
(one row per day/country/user-day per task).  After the rollup, the user-day
part is users x days and is read by DAU and retention; the other parts are
day- or country-sized.  Each section reads only its own partition, and the document is
one SQL statement — the metric templates as CTEs — run on the executors.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.expressions import sql_text
from daybook.operators import metrics as M
from daybook.operators.clean import per_event, tag_rules
from daybook.operators.staged import StagedEvents, stage_events
from daybook.schema import (
    ANOMALY_Z,
    FUNNEL_STEPS,
    RETENTION_DAY_OFFSET,
    RULE_DUPLICATE,
    RULE_INVALID_ETYPE,
    RULE_INVALID_TS,
    RULES,
    TOP_N,
)
from daybook.session import checkpoint_root, delete_folder
from daybook.sources.sinks import write_report_json, write_tables

# Version of the stored rollup's layout and meaning; part of every snapshot
# key, so a snapshot written by another version is never reused.
ROLLUP_FORMAT = 3

# Columns of the clean table the metrics read; nothing else is shuffled.
METRIC_COLUMNS = ("user_id", "date", "event_type", "amount", "country")

SECTIONS = ("range", "counts", "dau", "funnel", "revenue_daily",
            "top_countries", "anomalies", "retention_d1")


# Parts of the stored rollup table that the sections read.  Groups no
# section needs — invalid events (null date/country), countries without
# revenue rows — are dropped here; `set` is the partition column, so each
# part reads only its own folder.
def _rollup_parts(rollup: str) -> list[tuple[str, str]]:
    return [
        ("r_counts", f"""
SELECT CAST(coalesce(raw_rows, 0) AS BIGINT) AS raw_rows,
       CAST(coalesce(valid_rows, 0) AS BIGINT) AS valid_rows,
       CAST(coalesce(raw_rows, 0) - coalesce(valid_rows, 0) AS BIGINT) AS dropped_rows,
       named_struct(
         'invalid_ts', CAST(coalesce(invalid_ts, 0) AS BIGINT),
         'invalid_etype', CAST(coalesce(invalid_etype, 0) AS BIGINT),
         'duplicate_event_id', CAST(coalesce(survivors, 0) - coalesce(valid_rows, 0) AS BIGINT)
       ) AS breakdown,
       CAST(coalesce(null_id_rows, 0) AS BIGINT) AS null_id_rows
FROM {rollup} WHERE `set` = 'all'"""),
        ("r_facts", "SELECT date, valid_rows AS events, pv, signup, purchase, revenue_events, "
                    f"net_revenue FROM {rollup} WHERE `set` = 'day' AND date IS NOT NULL"),
        ("r_totals", f"SELECT country, net_revenue AS total FROM {rollup} "
                     "WHERE `set` = 'country' AND country IS NOT NULL AND revenue_events > 0"),
        ("r_pairs", f"SELECT user_id, date FROM {rollup} "
                    "WHERE `set` = 'user_day' AND user_id IS NOT NULL AND date IS NOT NULL"),
    ]


def _section_ctes(top_n: int, threshold: float, offset_days: int) -> list[tuple[str, str]]:
    """Every section as a CTE: the metric templates applied to rollup parts."""
    return _rollup_parts("{rollup}") + [
        ("s_range", M.date_range_sql("r_facts")),
        ("s_counts", "SELECT * FROM r_counts"),
        ("s_dau", M.dau_sql("r_pairs")),
        ("s_funnel", M.funnel_sql("r_facts")),
        ("s_revenue_daily", M.revenue_sql("r_facts")),
        ("s_top_countries", M.top_countries_sql(top_n, "r_totals")),
        ("s_anomalies", M.anomalies_sql(threshold, "net_revenue", "s_revenue_daily")),
        ("s_retention_d1", M.retention_sql(offset_days, "r_pairs")),
    ]


# The reference's order of each list section (sorting day-sized tables).
_SECTION_ORDER = {"dau": "date", "funnel": "date", "revenue_daily": "date",
                  "top_countries": "rank", "anomalies": "z DESC, date",
                  "retention_d1": "cohort_date"}


def _with(ctes: list[tuple[str, str]]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({query})" for name, query in ctes) + "\n"


def _listed(name: str, sort_key: str, fields: str) -> str:
    return (f"""'"{name}":' || (SELECT to_json(transform(sort_array(collect_list(
      named_struct('k', {sort_key}, 'v', named_struct({fields})))), x -> x.v)) FROM s_{name})""")


def _iso(c: str) -> str:
    return f"'{c}', date_format({c}, 'yyyy-MM-dd')"


# The report document over the section CTEs (braces doubled: the text is a
# spark.sql template whose only input is {rollup}).
_DOCUMENT_SELECT = "SELECT concat('{{', array_join(array(" + ",\n".join([
    """'"range":' || (SELECT to_json(named_struct('start', date_format(start, 'yyyy-MM-dd'),
      'end', date_format(`end`, 'yyyy-MM-dd'))) FROM s_range)""",
    """'"counts":' || coalesce((SELECT to_json(named_struct('raw_rows', raw_rows, 'valid_rows',
      valid_rows, 'dropped_rows', dropped_rows, 'breakdown', breakdown)) FROM s_counts), 'null')""",
    _listed("dau", "date", _iso("date") + ", 'dau', dau"),
    _listed("funnel", "date",
            _iso("date") + ", 'pv', pv, 'signup', signup, 'purchase', purchase, "
            "'pv_to_signup', pv_to_signup, 'signup_to_purchase', signup_to_purchase"),
    _listed("revenue_daily", "date", _iso("date") + ", 'net_revenue', round(net_revenue, 2)"),
    _listed("top_countries", "rank", "'country', country, 'net_revenue', net_revenue"),
    _listed("anomalies", "named_struct('z', -z, 'date', date)",
            _iso("date") + ", 'net_revenue', net_revenue, 'z', z"),
    _listed("retention_d1", "cohort_date",
            _iso("cohort_date") + ", 'users', users, 'retained', retained, 'rate', rate"),
]) + "), ','), '}}') AS report"


# Fields of each section's entries in the document: the entry's name (null
# where it has none) and its numbers.
_ENTRIES = {
    "dau": ("date", ("dau",)),
    "funnel": ("date", ("pv", "signup", "purchase", "pv_to_signup", "signup_to_purchase")),
    "revenue_daily": ("date", ("net_revenue",)),
    "top_countries": ("country", ("net_revenue",)),
    "anomalies": ("date", ("net_revenue", "z")),
    "retention_d1": ("cohort_date", ("users", "retained", "rate")),
}
_COUNTS = ("raw_rows", "valid_rows", "dropped_rows", *(f"breakdown.{r}" for r in RULES))


def _document_schema() -> str:
    lists = ", ".join(f"{name}: array<struct<{key}: string, " + ", ".join(f"{f}: double" for f in fields) + ">>"
                      for name, (key, fields) in _ENTRIES.items())
    breakdown = ", ".join(f"{r}: double" for r in RULES)
    return ("struct<range: struct<start: string, `end`: string>, counts: struct<raw_rows: double, valid_rows: double, "
            f"dropped_rows: double, breakdown: struct<{breakdown}>>, {lists}>")


def document_values(document: DataFrame) -> DataFrame:
    """``section, position, key, field, value`` for every value in the parsed document.

    Positions count a section's entries from 0 in the document's order.
    ``range`` has its dates as keys and no value.
    """
    doc = document.select(F.from_json("report", _document_schema()).alias("d"))

    def single(section: str, names, key, value):
        rows = F.array(*[F.struct(F.lit(section).alias("section"), F.lit(0).alias("position"),
                                  key(n).cast("string").alias("key"), F.lit(n).alias("field"),
                                  value(n).cast("double").alias("value")) for n in names])
        return doc.select(F.inline(rows))

    out = single("range", ("start", "end"), lambda n: F.col("d.range")[n], lambda n: F.lit(None))
    out = out.unionByName(single("counts", _COUNTS, lambda n: F.lit(None), lambda n: F.col(f"d.counts.{n}")))
    for section, (key, fields) in _ENTRIES.items():
        each = doc.select(F.posexplode(f"d.{section}").alias("position", "e"))
        rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col("e")[f].alias("value")) for f in fields])
        out = out.unionByName(each.select(F.lit(section).alias("section"), "position", F.col("e")[key].alias("key"),
                                          F.inline(rows)))
    return out


@dataclass
class Report:
    """The report over its stored rollup table.

    Sections are properties — small DataFrames with the reference's field
    names (``range`` and ``counts`` one row; the others one row per day,
    country or cohort), each built from the rollup on first use.
    ``revenue_daily`` keeps unrounded revenue (the anomaly input); the
    document rounds it to cents.  ``document()`` renders everything in one
    SQL statement without building the section DataFrames at all.
    """

    rollup: DataFrame
    top_n: int = TOP_N
    threshold: float = ANOMALY_Z
    offset_days: int = RETENTION_DAY_OFFSET
    _scratch: str | None = field(default=None, repr=False)

    def _ctes(self) -> list[tuple[str, str]]:
        return _section_ctes(self.top_n, self.threshold, self.offset_days)

    def _section(self, name: str) -> DataFrame:
        order = _SECTION_ORDER.get(name)
        return self.rollup.sparkSession.sql(
            _with(self._ctes()) + f"SELECT * FROM s_{name}" + (f" ORDER BY {order}" if order else ""),
            rollup=self.rollup)

    range = property(lambda self: self._section("range"))
    counts = property(lambda self: self._section("counts"))
    dau = property(lambda self: self._section("dau"))
    funnel = property(lambda self: self._section("funnel"))
    revenue_daily = property(lambda self: self._section("revenue_daily"))
    top_countries = property(lambda self: self._section("top_countries"))
    anomalies = property(lambda self: self._section("anomalies"))
    retention_d1 = property(lambda self: self._section("retention_d1"))

    def sections(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in SECTIONS}

    def document(self) -> DataFrame:
        """One row, one column ``report``: the report as JSON text.

        Each section is one scalar subquery that gathers its (day-, country-
        or cohort-sized) rows with ``collect_list``, sorts them in the
        reference's order and renders JSON; dates become ISO text only here.
        """
        return self.rollup.sparkSession.sql(_with(self._ctes()) + _DOCUMENT_SELECT,
                                            rollup=self.rollup)

    def write_json(self, path: str) -> None:
        """The document as one JSON text file under ``path`` (any Hadoop path)."""
        write_report_json(self.document(), path)

    def write_tables(self, root: str) -> None:
        """Each section as a parquet table under ``root`` (dates stay dates)."""
        write_tables(self.sections(), root)

    def to_dict(self) -> dict:
        """The report as a Python dict (collects only the document row)."""
        return json.loads(self.document().first()["report"])

    def counts_row(self):
        """The drop accounting as a Row (includes ``null_id_rows``)."""
        return self.counts.first()

    def release(self) -> None:
        """Remove this report's scratch rollup, wherever it is stored."""
        if self._scratch:
            delete_folder(self.rollup.sparkSession, self._scratch)
        self._scratch = None




# GROUPING SETS plan as one Expand (codegen'd) under one partial aggregate.
# Groups that no section reads — invalid events (null date/country),
# countries without revenue rows — are dropped when the table is read.
_ROLLUP_SQL = f"""
SELECT CASE WHEN grouping(country) = 0 THEN 'country'
            WHEN grouping(user_id) = 0 THEN 'user_day'
            WHEN grouping(date) = 0 THEN 'day'
            ELSE 'all' END AS `set`,
  date, country, user_id,
  sum(n_ok + n_ts + n_etype) AS raw_rows,
  count_if(valid) AS valid_rows,
  sum(n_ts) AS invalid_ts,
  sum(n_etype) AS invalid_etype,
  sum(n_ok) AS survivors,
  sum(CASE WHEN event_id IS NULL THEN n_ok + n_ts + n_etype ELSE n_missing_id END) AS null_id_rows,
  {", ".join(f"count_if(valid AND event_type = {sql_text(t)}) AS {n}" for t, n in FUNNEL_STEPS)},
  count_if(revenue) AS revenue_events,
  coalesce(sum(CASE WHEN revenue THEN amount END), 0D) AS net_revenue
FROM (
  SELECT event_id, first.user_id AS user_id, first.date AS date,
         first.event_type AS event_type, first.amount AS amount, first.country AS country,
         first IS NOT NULL AS valid,
         coalesce(first.{M.REVENUE}, false) AS revenue,
         n_ok, n_ts, n_etype, n_missing_id
  FROM {{events}}
)
GROUP BY GROUPING SETS ((), (date), (country), (user_id, date))
"""


def report_rollup(raw: DataFrame) -> DataFrame:
    """Everything the report needs from the events, in one lazy pass; ``build_report`` stages them instead.

    raw → tag → Exchange(event_id) → per-event first copy → Expand into the
    grouping sets (), (date), (country), (user_id, date) → partial aggregate
    → ONE exchange → final aggregate.  The result holds the drop counts and
    one row per day, per country and per active user-day, tagged by ``set``;
    nothing event-sized is cached or scanned twice.

    Callers write it out before reading it more than once (``build_report``
    does): Spark 4.1 does not match a *cached* Expand plan when one query
    reads it twice, which would silently rescan the events.
    """
    return rollup_of_events(per_event(tag_rules(raw), METRIC_COLUMNS))


def rollup_of_events(events: DataFrame) -> DataFrame:
    """The rollup of a per-event table (``clean.per_event`` with ``METRIC_COLUMNS``)."""
    return events.sparkSession.sql(_ROLLUP_SQL, events=events)


# The same rollup from clean events and their counts: every group is of valid rows,
# and the row of all events is the drop accounting.
_CLEAN_ROLLUP_SQL = f"""
SELECT CASE WHEN grouping(country) = 0 THEN 'country'
            WHEN grouping(user_id) = 0 THEN 'user_day'
            ELSE 'day' END AS `set`,
  date, country, user_id,
  CAST(NULL AS BIGINT) AS raw_rows, count(1) AS valid_rows, CAST(NULL AS BIGINT) AS invalid_ts,
  CAST(NULL AS BIGINT) AS invalid_etype, CAST(NULL AS BIGINT) AS survivors, CAST(NULL AS BIGINT) AS null_id_rows,
  {", ".join(f"count_if(event_type = {sql_text(t)}) AS {n}" for t, n in FUNNEL_STEPS)},
  count_if({M.REVENUE}) AS revenue_events,
  coalesce(sum(CASE WHEN {M.REVENUE} THEN amount END), 0D) AS net_revenue
FROM {{clean}}
GROUP BY GROUPING SETS ((date), (country), (user_id, date))
UNION ALL
SELECT 'all', CAST(NULL AS DATE), CAST(NULL AS STRING), CAST(NULL AS BIGINT),
  raw_rows - malformed_rows, valid_rows, breakdown.{RULE_INVALID_TS}, breakdown.{RULE_INVALID_ETYPE},
  valid_rows + breakdown.{RULE_DUPLICATE}, null_id_rows,
  {", ".join("0" for _ in FUNNEL_STEPS)}, 0, 0D
FROM {{counts}} WHERE raw_rows > malformed_rows
"""


def rollup_of_staged(staged: StagedEvents) -> DataFrame:
    """The rollup of a staged copy of the events (``staged.stage_events`` with ``METRIC_COLUMNS``)."""
    return staged.rows.sparkSession.sql(_CLEAN_ROLLUP_SQL, clean=staged.clean(METRIC_COLUMNS), counts=staged.counts())


def build_problem(report: Report) -> str | None:
    """What stands against a report over its counts: no clean event, or missing ids."""
    row = report.counts_row()
    if row is None or not row["valid_rows"]:
        return "No valid rows: the cleaning rules drop every event, so there is nothing to report"
    if row["null_id_rows"]:
        return f"{row['null_id_rows']} rows miss an event_id, user_id or session_id"
    return None


def build_report(raw: DataFrame, top_n: int = TOP_N, threshold: float = ANOMALY_Z,
                 offset_days: int = RETENTION_DAY_OFFSET, check: bool = True,
                 store: str | None = None) -> Report:
    """Clean ``raw`` and compute every report section.

    The events are staged (``staged.stage_events``) and their rollup is written
    once as a parquet table in the shared checkpoint folder — or at ``store``; the
    staged copy is then removed, and every section is derived from the rollup:
    the lineage is cut (an executor lost later costs a re-read, not a
    rescan), and later plans stay small.

    With ``check`` (the default) the drop accounting is read first and, as
    in the reference, missing ids or an empty clean set raise ``ValueError``.
    """
    spark = raw.sparkSession
    scratch = None
    if store is None:
        store = scratch = f"{checkpoint_root(spark)}/daybook/rollups/{uuid.uuid4().hex}"
    staged = stage_events(raw, METRIC_COLUMNS)
    rollup = rollup_of_staged(staged)
    # Partitioned by `set`: each section then reads only its own folder —
    # the day, country and counts sections never touch the user-day rows.
    # Rebalanced by it, a set is a few files of the advisory size instead of
    # one from every task, and a large set (user-days) is split.
    (rollup.hint("rebalance", "set").write.mode("overwrite").partitionBy("set").parquet(store))
    staged.release()
    # The schema is known: no footer-reading job to infer it again.
    stored = spark.read.schema(rollup.schema).parquet(store)
    report = report_from_rollup(stored, top_n, threshold, offset_days)
    report._scratch = scratch
    if check:
        problem = build_problem(report)
        if problem:
            report.release()
            raise ValueError(problem)
    return report


def report_from_rollup(rollup: DataFrame, top_n: int = TOP_N, threshold: float = ANOMALY_Z,
                       offset_days: int = RETENTION_DAY_OFFSET) -> Report:
    """The report over a (stored) rollup table."""
    return Report(rollup, top_n, threshold, offset_days)
