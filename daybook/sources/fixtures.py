"""Event views over the driver's TPC-H-style tables.

The driver's ``events`` table has no refunds, countries, sessions or dirt,
so two deterministic views supply them (the same expressions are written in
DuckDB SQL for the oracle):

* ``dirty_events`` (F1) — raw events with every kind of dirt the cleaning
  rules handle;
* ``refund_events`` (F2) — purchases plus derived refunds with deliberate
  integrity faults.

``orders`` is also reshaped into a daily revenue series and into
(user, day) activity, which give the anomaly and retention operators a
larger population.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Fixed values of the F1 view (see FIXTURES.md): the nation count the
# user ids wrap around, and the device by event_id % 3.
N_NATIONS = 25
DEVICES = ("ios", "android", "web")


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw events (ord, event_id, user_id, ts text, event_type, amount,
    country, device, session_id) with duplicates, bad timestamps, unknown
    types and messy countries.

    Some timestamps hold a time of day only.  An event whose user has no
    nation keeps a null country.

    ``nation`` is a 25-row dimension: the join is planned from file
    statistics (broadcast below ``spark.sql.autoBroadcastJoinThreshold``,
    a shuffle join above it) — no forced hint.
    """
    e = table(spark, sf_dir, "events")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = e.join(n, n.n_nationkey == e.user_id % N_NATIONS, "left")
    return j.selectExpr(
        "event_id AS ord",
        "CASE WHEN event_id % 100 = 7 THEN event_id - 1 ELSE event_id END AS event_id",
        "user_id",
        "CASE WHEN event_id % 200 = 0 THEN '2099-01-01 00:00:00' "
        "WHEN event_id % 200 = 50 THEN 'not-a-date' "
        "WHEN event_id % 200 = 100 THEN date_format(ts, 'HH:mm:ss') "
        "ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS ts",
        "CASE WHEN event_type = 'view' THEN 'page_view' "
        "WHEN event_type = 'error' THEN 'refund' ELSE event_type END AS event_type",
        "CASE WHEN event_type = 'error' THEN -value ELSE value END AS amount",
        "CASE WHEN event_id % 50 = 1 THEN CAST(NULL AS STRING) WHEN event_id % 50 = 2 THEN '' "
        "WHEN event_id % 50 = 3 THEN concat('  ', lower(n_name)) ELSE n_name END AS country",
        f"CASE event_id % 3 WHEN 0 THEN '{DEVICES[0]}' WHEN 1 THEN '{DEVICES[1]}' "
        f"ELSE '{DEVICES[2]}' END AS device",
        "user_id * 1000 + event_id % 1000 AS session_id",
    )


# Fixed values of the F2 view: refund id offset, and the user and session of
# every third purchase, which make one hot session.
REFUND_ID_OFFSET = 10_000_000
HOT_KEY = 7


def refund_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """purchases of ``events`` and refunds derived from every fifth one.

    Every third purchase (event_id % 3 = 0) belongs to one hot session.
    Refund = purchase with event_id + 10 000 000, amount negated, ts moved
    1 + event_id % 700 hours later; faults: event_id % 70 = 0 → session + 1,
    % 50 = 0 → ts 2 hours *before* the purchase, % 55 = 0 → 45 days later,
    % 65 = 0 → no session, % 30 = 0 → amount − 1.
    Columns: event_id, user_id, session_id, ts (timestamp), event_type, amount.
    """
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    eid = F.col("event_id")
    hot = eid % 3 == 0
    p = e.select(
        eid,
        F.when(hot, F.lit(HOT_KEY)).otherwise(F.col("user_id")).alias("user_id"),
        F.when(hot, F.lit(HOT_KEY)).otherwise(F.col("user_id") * 1000 + eid % 1000).alias("session_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("purchase").alias("event_type"),
        F.col("value").alias("amount"),
    )
    hours_later = F.make_dt_interval(hours=(F.lit(1) + eid % 700).cast("int"))
    r = p.where(eid % 5 == 0).select(
        (eid + REFUND_ID_OFFSET).alias("event_id"),
        F.col("user_id"),
        F.when(eid % 65 == 0, F.lit(None)).when(eid % 70 == 0, F.col("session_id") + 1)
         .otherwise(F.col("session_id")).alias("session_id"),
        F.when(eid % 50 == 0, F.col("ts") - F.make_dt_interval(hours=F.lit(2)))
         .when(eid % 55 == 0, F.col("ts") + F.make_dt_interval(days=F.lit(45)))
         .otherwise(F.col("ts") + hours_later).alias("ts"),
        F.lit("refund").alias("event_type"),
        F.when(eid % 30 == 0, -F.col("amount") - 1)
         .otherwise(-F.col("amount")).alias("amount"),
    )
    return p.unionByName(r)


def order_revenue_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, net_revenue): total order price per order day."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.to_date("o_orderdate").alias("date"))
            .agg(F.sum("o_totalprice").alias("net_revenue")))


def order_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, date): customers active on an order day."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("user_id"),
                    F.to_date("o_orderdate").alias("date"))
