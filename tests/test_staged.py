"""The staged dedup against the one-pass one, and its plan."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from daybook.operators import clean as C
from daybook.operators.staged import stage_events
from daybook.plans.report import build_report, report_from_rollup, report_rollup
from daybook.sources.files import read_events, read_events_csv, read_events_parquet
from daybook.sources.fixtures import dirty_events
from daybook.sources.sinks import write_events_csv


def rows(df):
    return sorted(map(str, df.collect()))


def assert_same(raw):
    staged = stage_events(raw)
    try:
        assert rows(staged.clean().select(*C.clean_events(raw).columns)) == rows(C.clean_events(raw))
        want = C.clean_counts(raw).first().asDict(recursive=True)
        got = staged.counts().first().asDict(recursive=True)
        assert got == {"malformed_rows": 0} | want
    finally:
        staged.release()


def test_equals_the_one_pass_dedup(spark, make_raw):
    assert_same(dirty_events(spark, SF01))
    rng = random.Random(3)
    kinds = ["page_view", "signup", "purchase", "refund", "click", None]
    assert_same(make_raw([{"event_id": rng.choice([None, 7, *range(90)]), "event_type": rng.choice(kinds), "amount": float(i),
                           "user_id": rng.choice([None, 1, 2]), "ts": rng.choice(["2021-03-04 05:00:00", "2099-01-01", "x", None])}
                          for i in range(500)]))
    assert_same(make_raw([{}]).limit(0))


@pytest.mark.parametrize("split", ["64k", "128m"])
def test_file_order_in_splits(spark, tmp_path, split):
    """Copies of every event lie in several files and blocks; paths and list order decide."""
    raw = dirty_events(spark, SF01).drop("ord").where("event_id % 3 = 0")
    a, b = str(tmp_path / "a_csv"), str(tmp_path / "b.parquet")
    write_events_csv(raw.unionByName(raw.withColumn("user_id", F.col("user_id") + 1)).repartition(3), a)
    raw.withColumn("user_id", F.col("user_id") + 2).repartition(2).write.parquet(b)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert_same(read_events_csv(spark, a))
        assert_same(read_events_parquet(spark, b))
        assert_same(read_events(spark, [b, a]))
        assert_same(read_events(spark, [a, b]))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_malformed_rows_are_dropped_and_counted(spark, tmp_path):
    path = tmp_path / "e.csv"
    path.write_text("event_id,user_id,ts,event_type,amount,country,device,session_id\n"
                    "1,5,2023-01-01 00:00:00,purchase,x,US,web,1\n1,5,2023-01-01 00:00:00,purchase,2,US,web,1\n"
                    "1,6,2023-01-01 00:00:00,purchase,3,US,web,1\nq,,2023-01-01 00:00:00,purchase,3,US,web,1\n")
    raw = read_events_csv(spark, str(path), failfast=False)
    assert_same(raw)
    staged = stage_events(raw, ("amount",))
    assert [tuple(r) for r in staged.clean().collect()] == [(1, 2.0)]
    counts = staged.counts().first()
    assert (counts.raw_rows, counts.valid_rows, counts.dropped_rows, counts.malformed_rows) == (4, 1, 1, 2)
    staged.release()


def test_unknown_columns_are_errors(make_raw):
    with pytest.raises(ValueError, match="not clean-event columns"):
        stage_events(make_raw([{}]), ("nope",))
    staged = stage_events(make_raw([{}]), ("date",))
    with pytest.raises(ValueError, match="not staged"):
        staged.clean(("amount",))
    staged.release()


def test_no_sort_of_events(spark, tmp_path):
    """Hash plans only, whether the repeated events are broadcast or not; the rows are shuffled only if not."""
    src = str(tmp_path / "e_csv")
    write_events_csv(dirty_events(spark, SF01).drop("ord"), src)
    staged = stage_events(read_events_csv(spark, src))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        small = staged.clean()._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        large = staged.clean()._jdf.queryExecution().executedPlan().toString()
        copies = staged.rows.groupBy("event_id").agg(F.min("place"), F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
        staged.release()
    for plan in (small, large, copies):
        assert "Sort" not in plan.replace("SortMerge", "")
    assert "ShuffledHashJoin" in large and "HashAggregate" in copies
    assert "BroadcastHashJoin" in small and "Exchange hashpartitioning" not in small


def test_report_of_staged_events_equals_the_one_pass_report(spark):
    raw = dirty_events(spark, SF01)
    report = build_report(raw)
    try:
        one = report_from_rollup(report_rollup(raw))
        assert report.to_dict() == one.to_dict()
        assert report.counts_row() == one.counts_row()
    finally:
        report.release()
