"""Plan shapes the scale design depends on (checked on the physical plan)."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as E
from conftest import SF001, SF01
from daybook.operators import metrics as M
from daybook.operators import quality as Q
from daybook.plans.report import report_rollup
from daybook.sources.files import read_events_csv
from daybook.sources.fixtures import dirty_events, refund_events
from daybook.sources.sinks import write_events_csv


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_no_cross_joins(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.fixture(scope="module")
def many_split_csv(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("csv") / "events")
    write_events_csv(dirty_events(spark, SF01).drop("ord").coalesce(1), path)
    return path


def test_large_input_combines_map_side_before_one_event_shuffle(spark, many_split_csv):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        raw = read_events_csv(spark, many_split_csv)
        assert raw.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        plan = _plan(report_rollup(raw))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)", plan)
    # one shuffle keyed by event_id (the dedup) and one for the rollup groups
    assert len(exchanges) == 2
    assert sum(e.startswith("event_id") for e in exchanges) == 1
    # the dedup aggregate is partial on the map side (hot ids collapse there)
    assert "partial_min" in plan
    # the rollup is one Expand under a partial aggregate
    assert plan.count("Expand") == 1


@pytest.mark.parametrize("metric", sorted(M.READS))
def test_metrics_shuffle_only_what_they_read(spark, metric):
    plan = _plan(E.queries()[metric](spark, SF001))
    (payload,) = set(re.findall(r"partial_min\(CASE WHEN isnull\(rule#\d+\) THEN struct\(([^)]*)\)", plan))
    fields = re.findall(r"(\w+), \1#", payload)
    assert set(fields) == {"ord", *M.READS[metric]}


def test_one_shuffle_more_or_less_whatever_the_splits(spark):
    """The plan has no branch on the input's size: few splits, same two exchanges."""
    plan = _plan(report_rollup(dirty_events(spark, SF001)))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)", plan)
    assert len(exchanges) == 2 and sum(e.startswith("event_id") for e in exchanges) == 1


STORING = {"report_document", "report_snapshot", "report_sections", "report_snapshot_sections",
           "report_incremental_sections", "dq_purchase_stats", "refund_witnesses", "union_in_order_events"}


@pytest.mark.parametrize("name", sorted(set(E._QUERIES) - STORING - {n for n in E._QUERIES if n.startswith("csv")}))
def test_building_a_plan_starts_no_job(spark, name):
    """Only queries that store a rollup, counts or the CSV copy run anything while being built."""
    spark.read.parquet(f"{SF001}/events.parquet").schema       # file listing is warm
    sc = spark.sparkContext
    sc.setJobGroup(f"plan-{name}", "planning")
    try:
        E.queries()[name](spark, SF001)
        jobs = [j for j in sc.statusTracker().getJobIdsForGroup(f"plan-{name}")
                if any((s := sc.statusTracker().getStageInfo(i)) and s.numTasks and s.name and "parquet" not in s.name
                       for i in sc.statusTracker().getJobInfo(j).stageIds)]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs == []


def test_scans_read_only_needed_columns(spark):
    plan = _plan(report_rollup(dirty_events(spark, SF001)))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and all("props" not in s for s in schemas)


def test_event_type_filters_reach_the_scan(spark):
    plan = _plan(Q.refund_links(refund_events(spark, SF001)))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert pushed and all("EqualTo(event_type,purchase)" in p for p in pushed)


def test_small_sections_read_only_their_rollup_partition(spark):
    from daybook.plans.report import build_report
    report = build_report(dirty_events(spark, SF001))
    try:
        for name, part in [("funnel", "day"), ("top_countries", "country"), ("counts", "all"),
                           ("retention_d1", "user_day")]:
            plan = _plan(getattr(report, name))
            filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
            assert filters and all(f"= {part})" in f for f in filters), (name, filters)
    finally:
        report.release()


def test_stored_files_grow_with_the_rows(spark):
    """A least number of files, and more of them rather than larger ones."""
    few = E._in_order(spark.range(9).selectExpr("id AS ord", "id AS n"), 3)
    assert few.rdd.getNumPartitions() == 3
    many = E._in_order(spark.range(1_000_000).selectExpr("999999 - id AS ord", "999999 - id AS n"), 3)
    files = many.rdd.mapPartitions(lambda rows: [[r.n for r in rows]]).collect()
    assert len(files) >= 10 and max(map(len, files)) < 150_000
    assert [n for own in files for n in own] == list(range(1_000_000))
