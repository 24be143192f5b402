"""The report kept up to date file by file (Q5).

``snapshot_report`` builds anew whenever the file set changes.  Here the state
behind the report is kept, so that a new file costs a scan of that file only:

* ``files``    the input files the state covers (path, size, modification time);
* ``events``   runs of the per-event table of ``clean.per_event``: each event's first
  surviving copy and its counts of copies by rule.  A run's row replaces the
  event's rows in earlier runs.  Runs are sorted by event id, so that a lookup
  of a range of ids skips the files and row groups outside it;
* ``rollups``  runs of the report's rollup, which add up.

New files are cleaned and aggregated per event.  Their events' earlier
rows are looked up and merged: the first copy is the smaller in input order, which
is by file path, so a file that sorts before older ones may change what came
first; counts add.  The rollup of the merged rows, less that of the rows they
replace, is the new run of rollups: of the old input neither files nor
other events are read, and the sections, computed from the sum, equal a full build's.

A changed or removed file can't be subtracted; it starts a new state.  Runs are
merged into one when there are more than ``max_runs``.  A state comes into force by
a numbered commit file that only one of several writers can create; a
writer that comes second starts again from the winner's state.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.clean import FIRST, per_event, tag_rules
from daybook.plans.report import (
    METRIC_COLUMNS,
    ROLLUP_FORMAT,
    Report,
    build_problem,
    report_from_rollup,
    rollup_of_events,
)
from daybook.schema import ANOMALY_Z, RETENTION_DAY_OFFSET, TOP_N
from daybook.session import checkpoint_root, delete_folder
from daybook.sources.commit import names, put_if_absent, read_text
from daybook.sources.files import read_events_csv

MAX_RUNS = 16

_GROUP = ["set", "date", "country", "user_id"]
_COUNTS = ["n_ok", "n_ts", "n_etype", "n_missing_id"]
_FILE = ["path", "length", "modificationTime"]


@dataclass(frozen=True)
class Update:
    """What a call did: the state's version, how many files it read, and whether it began anew."""

    version: int
    files_read: int
    rebuilt: bool


@dataclass(frozen=True)
class _State:
    version: int
    files: str
    events: list[str]
    rollups: list[str]

    @classmethod
    def latest(cls, spark: SparkSession, root: str) -> _State | None:
        commits = [n for n in names(spark, f"{root}/commits") if n.isdigit()]
        if not commits:
            return None
        return cls(int(commits[-1]), **json.loads(read_text(spark, f"{root}/commits/{commits[-1]}")))

    def put(self, spark: SparkSession, root: str) -> bool:
        text = json.dumps({"files": self.files, "events": self.events, "rollups": self.rollups})
        return put_if_absent(spark, f"{root}/commits/{self.version:010d}", text)


def list_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path, length, modificationTime`` of the input files; their content isn't read."""
    return spark.read.format("binaryFile").load(paths).select(*_FILE)


def _literal(path: str) -> str:
    """A path that means itself where patterns are understood."""
    return "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in path)


def _merge_copies(events: DataFrame) -> DataFrame:
    """Rows of the same event as one: the first surviving copy in input order, and all counts."""
    return events.groupBy("event_id").agg(F.min(FIRST).alias(FIRST), *[F.sum(c).alias(c) for c in _COUNTS])


def _newest(runs: list[DataFrame]) -> DataFrame:
    """Each event's row of the latest run that has it."""
    numbered = [r.withColumn("run", F.lit(i)) for i, r in enumerate(runs)]
    row = F.struct(FIRST, *_COUNTS)
    return (reduce(DataFrame.unionByName, numbered).groupBy("event_id").agg(F.max_by(row, "run").alias("row"))
            .select("event_id", "row.*"))


def _earlier_rows(delta: DataFrame, runs: list[DataFrame]) -> DataFrame:
    """The state's rows of the events in ``delta``."""
    lo, hi = delta.agg(F.min("event_id"), F.max("event_id")).first()
    near = F.col("event_id").isNull()
    if lo is not None:
        near = near | F.col("event_id").between(lo, hi)
    ids = delta.select(F.col("event_id").alias("id"))
    return _newest([r.where(near).join(ids, F.col("event_id").eqNullSafe(F.col("id")), "left_semi") for r in runs])


def _add_rollups(parts: list[DataFrame]) -> DataFrame:
    total = reduce(DataFrame.unionByName, parts)
    numbers = [c for c in total.columns if c not in _GROUP]
    return total.groupBy(*_GROUP).agg(*[F.sum(c).alias(c) for c in numbers])


def _negative(rollup: DataFrame) -> DataFrame:
    return rollup.select(*_GROUP, *[(-F.col(c)).alias(c) for c in rollup.columns if c not in _GROUP])


class ReportHistory:
    """The report over a growing set of files, with its state under ``root``.

    ``reader(spark, paths)`` reads raw events from files, with their input order by path.
    """

    def __init__(self, spark: SparkSession, root: str | None = None,
                 reader: Callable[[SparkSession, list[str]], DataFrame] = read_events_csv, max_runs: int = MAX_RUNS):
        self._spark, self._reader, self._max_runs = spark, reader, max_runs
        root = root or f"{checkpoint_root(spark)}/daybook/report_history"
        self._root = f"{root.rstrip('/')}/v{ROLLUP_FORMAT}"

    def _new_folder(self, kind: str) -> str:
        return f"{self._root}/{kind}/{uuid.uuid4().hex}"

    def _stored(self, df: DataFrame, folder: str, **by) -> DataFrame:
        writer = df.write.partitionBy(by["set"]) if by else df.write
        writer.parquet(folder)
        return self._spark.read.schema(df.schema).parquet(folder)

    def _read(self, folders: list[str]) -> list[DataFrame]:
        return [self._spark.read.parquet(f) for f in folders]

    def _store_events(self, events: DataFrame, folder: str) -> DataFrame:
        return self._stored(events.repartitionByRange("event_id").sortWithinPartitions("event_id"), folder)

    def _store_rollup(self, rollup: DataFrame, folder: str) -> DataFrame:
        return self._stored(rollup.hint("rebalance", "set"), folder, set="set")

    def _unknown_files(self, state: _State | None, now: DataFrame) -> tuple[_State | None, list[str]]:
        """The state to go on from, if its files are all still there as they were, and the files it lacks."""
        if state is not None:
            known = self._spark.read.parquet(state.files)
            if known.join(now, _FILE, "left_anti").isEmpty():
                return state, [r["path"] for r in now.join(known, _FILE, "left_anti").select("path").collect()]
        return None, [r["path"] for r in now.select("path").collect()]

    def _next(self, state: _State | None, version: int, now: DataFrame, new: list[str], built: list[str]) -> _State:
        """Writes the state that covers ``now``; every folder written is added to ``built``."""
        files, run, sums, raw = (self._new_folder(k) for k in ("files", "events", "rollups", "raw"))
        built += [files, run, sums, raw]
        self._stored(now, files)
        delta = per_event(tag_rules(self._reader(self._spark, [_literal(p) for p in new])), METRIC_COLUMNS)
        if state is None:
            self._store_rollup(rollup_of_events(self._store_events(delta, run)), sums)
            delete_folder(self._spark, raw)
            return _State(version, files, [run], [sums])
        delta = self._stored(delta, raw)
        earlier = _earlier_rows(delta, self._read(state.events))
        earlier_folder = self._new_folder("raw")
        built.append(earlier_folder)
        earlier = self._stored(earlier, earlier_folder)
        merged = self._store_events(_merge_copies(delta.unionByName(earlier)), run)
        self._store_rollup(_add_rollups([rollup_of_events(merged), _negative(rollup_of_events(earlier))]), sums)
        for folder in (raw, earlier_folder):
            delete_folder(self._spark, folder)
        return self._compacted(_State(version, files, [*state.events, run], [*state.rollups, sums]), built)

    def _compacted(self, state: _State, built: list[str]) -> _State:
        if len(state.events) <= self._max_runs:
            return state
        run, sums = self._new_folder("events"), self._new_folder("rollups")
        built += [run, sums]
        self._store_events(_newest(self._read(state.events)), run)
        self._store_rollup(_add_rollups(self._read(state.rollups)), sums)
        return _State(state.version, state.files, [run], [sums])

    def rollup(self, state: _State) -> DataFrame:
        """The sum of the state's rollups, without groups whose events have all moved elsewhere."""
        return _add_rollups(self._read(state.rollups)).where("`set` = 'all' OR valid_rows > 0")

    def update(self, paths: str | list[str], top_n: int = TOP_N, threshold: float = ANOMALY_Z,
               offset_days: int = RETENTION_DAY_OFFSET) -> tuple[Report, Update]:
        """The report over ``paths``, reading only files that the state doesn't cover yet.

        Missing ids or an empty clean set raise ``ValueError``, as in
        ``build_report``; the state then stays as it was.
        """
        while True:
            before = _State.latest(self._spark, self._root)
            now_folder = self._new_folder("listing")
            now = self._stored(list_files(self._spark, paths), now_folder)
            try:
                state, new = self._unknown_files(before, now)
                if state is not None and not new:
                    return self._report(state, top_n, threshold, offset_days), Update(state.version, 0, False)
                built: list[str] = []
                after = self._next(state, before.version + 1 if before else 0, now, new, built)
                report = self._report(after, top_n, threshold, offset_days)
                problem = build_problem(report)
                if problem is None and after.put(self._spark, self._root):
                    return report, Update(after.version, len(new), state is None)
                for folder in built:
                    delete_folder(self._spark, folder)
                if problem:
                    raise ValueError(problem)
            finally:
                delete_folder(self._spark, now_folder)

    def _report(self, state: _State, top_n: int, threshold: float, offset_days: int) -> Report:
        return report_from_rollup(self.rollup(state), top_n, threshold, offset_days)

    def expire(self) -> list[str]:
        """Removes commits but the last one, and every folder it doesn't name; returns what went.

        Not while another writer is at work: its unfinished folders go, too.
        """
        state = _State.latest(self._spark, self._root)
        if state is None:
            return []
        kept = {state.files, *state.events, *state.rollups}
        gone = [f"{self._root}/{kind}/{n}" for kind in ("files", "events", "rollups", "raw", "listing")
                for n in names(self._spark, f"{self._root}/{kind}")]
        gone = [f for f in gone if f not in kept]
        gone += [f"{self._root}/commits/{n}" for n in names(self._spark, f"{self._root}/commits")
                 if n != f"{state.version:010d}"]
        for folder in gone:
            delete_folder(self._spark, folder)
        return gone
