"""The six report metrics over clean events.

Each metric is one Spark SQL statement run with ``spark.sql(query,
**dataframes)``: Catalyst plans it exactly like the DataFrame API would,
and the plan is parsed and analysed once instead of operator by operator.

Shared building blocks keep the number of shuffles small:

* ``daily_facts`` — one ``GROUP BY date`` with conditional counts and the
  revenue sum; feeds the funnel (M2), daily revenue (M3), the anomaly
  population (M5) and the date range.  Partial aggregation collapses every
  map task to one row per day before the exchange.
* ``user_days`` — distinct ``(user_id, date)`` pairs; feeds DAU (M1) and
  retention (M6).  Exact distinct counting reduces to this one shuffle on
  ``(user_id, date)``, which spreads well even when one user or one day is
  hot; the per-day count afterwards is a tiny partial-count exchange.

Every output is day-, country- or cohort-sized.  Scalars (mean, std, last
day) are whole-table windows over those small tables, never over events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.expressions import round_half_even_sql, safe_ratio_sql, sql_text
from daybook.schema import (
    ANOMALY_Z,
    FUNNEL_STEPS,
    RETENTION_DAY_OFFSET,
    REVENUE_EVENT_TYPES,
    TOP_N,
)


# What each metric reads of the clean events, besides event_id.
READS = {
    "dau": ("user_id", "date"),
    "funnel_daily": ("event_type", "amount", "date"),
    "revenue_daily": ("event_type", "amount", "date"),
    "top_countries": ("event_type", "amount", "country"),
    "retention_d1": ("user_id", "date"),
    "date_range": ("date",),
}


def _run(query: str, **frames: DataFrame) -> DataFrame:
    spark = next(iter(frames.values())).sparkSession
    return spark.sql(query, **frames)


# The one definition of a revenue row.
REVENUE = f"event_type IN ({', '.join(map(sql_text, REVENUE_EVENT_TYPES))})"

# Each metric is a SQL template over named inputs.  The DataFrame functions
# below run a template with ``spark.sql(template, name=df)`` (the default
# arguments are ``{name}`` placeholders); the report composes the same
# templates as CTEs of one statement by passing CTE names instead.


def daily_facts_sql(clean: str = "{clean}") -> str:
    steps = "".join(f"count_if(event_type = '{etype}') AS {name}, "
                    for etype, name in FUNNEL_STEPS)
    # pandas sums an all-missing group to 0.0; Spark would give null.
    return (f"SELECT date, count(1) AS events, {steps}"
            f"count_if({REVENUE}) AS revenue_events, "
            f"coalesce(sum(CASE WHEN {REVENUE} THEN amount END), 0D) AS net_revenue "
            f"FROM {clean} GROUP BY date")


def user_days_sql(clean: str = "{clean}") -> str:
    return f"SELECT DISTINCT user_id, date FROM {clean} WHERE user_id IS NOT NULL"


def dau_sql(pairs: str = "{pairs}") -> str:
    return f"SELECT date, count(1) AS dau FROM {pairs} GROUP BY date"


def funnel_sql(facts: str = "{facts}") -> str:
    return (f"SELECT date, pv, signup, purchase, "
            f"{safe_ratio_sql('signup', 'pv')} AS pv_to_signup, "
            f"{safe_ratio_sql('purchase', 'signup')} AS signup_to_purchase "
            f"FROM {facts} WHERE pv + signup + purchase > 0")


def revenue_sql(facts: str = "{facts}") -> str:
    return f"SELECT date, net_revenue FROM {facts} WHERE revenue_events > 0"


def country_totals_sql(clean: str = "{clean}") -> str:
    return (f"SELECT country, coalesce(sum(amount), 0D) AS total FROM {clean} "
            f"WHERE {REVENUE} GROUP BY country")


def top_countries_sql(n: int = TOP_N, totals: str = "{totals}") -> str:
    return ("SELECT row_number() OVER (ORDER BY total DESC, country) AS rank, country, "
            "round(total, 2) AS net_revenue "
            f"FROM (SELECT country, total FROM {totals} ORDER BY total DESC, country "
            f"LIMIT {int(n)})")


def anomalies_sql(threshold: float = ANOMALY_Z, value_col: str = "net_revenue",
                  revenue: str = "{revenue}") -> str:
    col = f"`{value_col}`"
    z = round_half_even_sql("(v - mu) / sd", 4)
    return (f"SELECT date, round(v, 2) AS {col}, {z} AS z FROM ("
            f"SELECT date, {col} AS v, count(1) OVER () AS n, avg({col}) OVER () AS mu, "
            f"stddev_pop({col}) OVER () AS sd FROM {revenue}) "
            f"WHERE n >= 2 AND sd > 0 AND (v - mu) / sd > {float(threshold)!r}D")


def retention_sql(offset_days: int = RETENTION_DAY_OFFSET, pairs: str = "{pairs}") -> str:
    return (f"SELECT cohort_date, users, retained, {safe_ratio_sql('retained', 'users')} AS rate "
            "FROM (SELECT *, max(last_seen) OVER () AS last_day FROM ("
            "SELECT cohort_date, count_if(date = cohort_date) AS users, "
            f"count_if(date = date_add(cohort_date, {int(offset_days)})) AS retained, "
            "max(date) AS last_seen FROM ("
            "SELECT user_id, date, min(date) OVER (PARTITION BY user_id) AS cohort_date "
            f"FROM {pairs}) GROUP BY cohort_date)) "
            "WHERE cohort_date < last_day")


def date_range_sql(src: str = "{src}") -> str:
    return f"SELECT min(date) AS start, max(date) AS `end` FROM {src}"


def daily_facts(clean: DataFrame) -> DataFrame:
    """Per day: all events, funnel step counts, revenue rows and net revenue."""
    return _run(daily_facts_sql(), clean=clean)


def user_days(clean: DataFrame) -> DataFrame:
    """Distinct (user_id, date) activity pairs (any event type).

    A missing user id is not a user (pandas ``nunique`` skips it).
    """
    return _run(user_days_sql(), clean=clean)


# ---------------------------------------------------------------------------
# M1 — daily active users
# ---------------------------------------------------------------------------

def dau(clean: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """Exact distinct users per day; only days with events; (date, dau)."""
    pairs = pairs if pairs is not None else user_days(clean)
    return _run(dau_sql(), pairs=pairs)


# ---------------------------------------------------------------------------
# M2 — daily conversion funnel
# ---------------------------------------------------------------------------

def funnel_daily(clean: DataFrame | None = None, facts: DataFrame | None = None) -> DataFrame:
    """(date, pv, signup, purchase, pv_to_signup, signup_to_purchase).

    Only days with at least one funnel event appear (a refund-only day does
    not); rates are half-even to 4 dp and 0.0 on a zero denominator.
    """
    facts = facts if facts is not None else daily_facts(clean)
    return _run(funnel_sql(), facts=facts)


# ---------------------------------------------------------------------------
# M3 — daily net revenue
# ---------------------------------------------------------------------------

def revenue_daily(clean: DataFrame | None = None, facts: DataFrame | None = None) -> DataFrame:
    """(date, net_revenue) unrounded; days with ≥1 purchase or refund row.

    Unrounded because the anomaly z-scores are computed from it; round to
    cents at the report edge.
    """
    facts = facts if facts is not None else daily_facts(clean)
    return _run(revenue_sql(), facts=facts)


# ---------------------------------------------------------------------------
# M4 — top countries by net revenue
# ---------------------------------------------------------------------------

def country_totals(clean: DataFrame) -> DataFrame:
    """(country, total): unrounded net revenue of countries with revenue rows."""
    return _run(country_totals_sql(), clean=clean)


def top_countries(clean: DataFrame | None = None, n: int = TOP_N,
                  totals: DataFrame | None = None) -> DataFrame:
    """(rank, country, net_revenue) for the n largest net revenues.

    Ranking uses the unrounded sum, ties broken by country name; the output
    is rounded to cents.  The country grouping is partially aggregated
    before its exchange, so a dominant country costs nothing extra;
    ``ORDER BY … LIMIT`` plans as a TakeOrderedAndProject over a
    country-sized input, and ``rank`` (which keeps the order even where
    rounding makes sums look tied) is a window over the n rows left.
    """
    totals = totals if totals is not None else country_totals(clean)
    return _run(top_countries_sql(n), totals=totals)


# ---------------------------------------------------------------------------
# M5 — revenue anomalies
# ---------------------------------------------------------------------------

def anomalies(revenue: DataFrame, threshold: float = ANOMALY_Z,
              value_col: str = "net_revenue") -> DataFrame:
    """Days whose population z-score of revenue exceeds ``threshold``.

    Fewer than two days or zero spread → empty.  Upper tail only, strict
    ``>``.  Output (date, net_revenue rounded to cents, z half-even to 4 dp);
    ``order_anomalies`` gives the report order.

    ``revenue`` is day-sized, so the mean and spread are whole-table window
    aggregates over at most one row per calendar day — one pass, and no
    self-join (which would also defeat caching of the input).
    """
    return _run(anomalies_sql(threshold, value_col), revenue=revenue)


def order_anomalies(df: DataFrame) -> DataFrame:
    """The reference's report order for anomalies: z desc, then date."""
    return df.orderBy(F.desc("z"), F.asc("date"))


# ---------------------------------------------------------------------------
# M6 — day-one retention
# ---------------------------------------------------------------------------

def retention_d1(clean: DataFrame | None = None, pairs: DataFrame | None = None,
                 offset_days: int = RETENTION_DAY_OFFSET) -> DataFrame:
    """(cohort_date, users, retained, rate) per first-seen day.

    A user's cohort is their first active day; they are retained when active
    exactly ``offset_days`` later.  Cohorts on or after the last active day
    of the whole data set are right-censored (dropped).  Any event type
    counts as activity.

    The cohort is a window minimum over each user's distinct active days, so
    a partition holds at most one row per day per user — bounded by the
    calendar, however many events a user has.  Pairs are distinct, so plain
    conditional counts per cohort are exact distinct-user counts.  The data
    set's last day is the max over cohorts of their last active day: a
    window over the cohort-sized table, no second pass over the pairs.
    """
    pairs = pairs if pairs is not None else user_days(clean)
    return _run(retention_sql(offset_days), pairs=pairs)


def date_range(clean: DataFrame | None = None, facts: DataFrame | None = None) -> DataFrame:
    """One row (start, end): first and last day with clean events."""
    src = facts if facts is not None else clean
    return _run(date_range_sql(), src=src)
