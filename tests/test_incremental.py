"""Commit files and the report kept up to date file by file."""

from __future__ import annotations

import os
import random
import threading
import time

import pytest

from daybook.plans.incremental import ReportHistory, list_files
from daybook.plans.report import build_report
from daybook.plans.snapshot import publish, read_marker, snapshot_report
from daybook.sources import commit
from daybook.sources.files import read_events_csv

HEADER = "event_id,user_id,ts,event_type,amount,country,device,session_id"


def write_csv(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    lines = [",".join("" if r[c] is None else str(r[c]) for c in HEADER.split(",")) for r in rows]
    path = os.path.join(str(folder), name)
    with open(path, "w") as fh:
        fh.write("\n".join([HEADER, *lines]) + "\n")
    return path


def random_rows(rng, n, ids):
    return [{"event_id": rng.choice(ids), "user_id": rng.randrange(9), "session_id": 4,
             "ts": rng.choice(["2021-03-%02dT05:00:00Z" % rng.randrange(1, 9), "2099-01-01T00:00:00Z", "nonsense"][:rng.choice([1, 1, 3])]),
             "event_type": rng.choice(["page_view", "signup", "purchase", "refund", "click"]),
             "amount": rng.randrange(100) / 4, "country": rng.choice(["se", " NO ", "", "DK"]), "device": "ios"} for _ in range(n)]


def full(spark, folder):
    report = build_report(read_events_csv(spark, str(folder)))
    try:
        return report.to_dict()
    finally:
        report.release()


def test_each_new_file_is_read_alone(spark, tmp_path):
    """What was read before may become unreadable, as long as it looks the same."""
    rng, src, copy = random.Random(6), tmp_path / "in", tmp_path / "copy"
    history = ReportHistory(spark, str(tmp_path / "state"))
    for i, name in enumerate(["m.csv", "c.csv"]):
        rows = random_rows(rng, 60, range(500, 580))
        path = write_csv(src, name, rows)
        write_csv(copy, name, rows)
        report, done = history.update(str(src))
        assert (done.version, done.files_read, done.rebuilt) == (i, 1, i == 0)
        assert report.to_dict() == full(spark, copy)
        stat, size = os.stat(path), os.path.getsize(path)
        with open(path, "wb") as fh:
            fh.write(b"\x00" * size)
        os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    report, done = history.update(str(src))
    assert done.files_read == 0 and report.to_dict() == full(spark, copy)


def test_many_files_with_compaction_equal_a_full_build(spark, tmp_path):
    rng, src = random.Random(7), tmp_path / "in"
    history = ReportHistory(spark, str(tmp_path / "state"), max_runs=2)
    for i, name in enumerate(["m.csv", "t.csv", "c.csv", "a.csv", "z.csv"]):
        write_csv(src, name, random_rows(rng, 60, range(500, 580)))
        report, done = history.update(str(src))
        assert (done.version, done.files_read, done.rebuilt) == (i, 1, i == 0)
        assert report.to_dict() == full(spark, src)
    history.expire()
    report, done = history.update(str(src))
    assert done.files_read == 0 and report.to_dict() == full(spark, src)


def test_changed_or_removed_files_start_anew(spark, tmp_path):
    rng, src = random.Random(8), tmp_path / "in"
    for name in ("a.csv", "b.csv"):
        write_csv(src, name, random_rows(rng, 30, range(40)))
    history = ReportHistory(spark, str(tmp_path / "state"))
    history.update(str(src))
    write_csv(src, "b.csv", random_rows(rng, 31, range(40)))
    report, done = history.update(str(src))
    assert done.rebuilt and done.files_read == 2 and report.to_dict() == full(spark, src)
    os.remove(src / "a.csv")
    report, done = history.update(str(src))
    assert done.rebuilt and done.files_read == 1 and report.to_dict() == full(spark, src)


def test_bad_input_leaves_the_state_alone(spark, tmp_path):
    rng, src = random.Random(9), tmp_path / "in"
    write_csv(src, "a.csv", random_rows(rng, 30, range(40)))
    history = ReportHistory(spark, str(tmp_path / "state"))
    report, _ = history.update(str(src))
    want = report.to_dict()
    bad = write_csv(src, "b.csv", [random_rows(rng, 1, [1])[0] | {"user_id": None}])
    with pytest.raises(ValueError, match="1 rows miss"):
        history.update(str(src))
    os.remove(bad)
    report, done = history.update(str(src))
    assert done.files_read == 0 and report.to_dict() == want


def test_second_writer_starts_from_the_winners_state(spark, tmp_path, monkeypatch):
    rng, src = random.Random(10), tmp_path / "in"
    write_csv(src, "a.csv", random_rows(rng, 30, range(40)))
    root = str(tmp_path / "state")
    ReportHistory(spark, root).update(str(src))
    write_csv(src, "b.csv", random_rows(rng, 30, range(40)))
    slow, results = ReportHistory(spark, root), []
    build = slow._next

    def overtaken(*args):
        after = build(*args)
        monkeypatch.setattr(slow, "_next", build)
        results.append(ReportHistory(spark, root).update(str(src))[1])
        return after

    monkeypatch.setattr(slow, "_next", overtaken)
    report, done = slow.update(str(src))
    assert results[0].files_read == 1 and (done.version, done.files_read) == (results[0].version, 0)
    assert report.to_dict() == full(spark, src)


def test_listing_reads_no_content(spark, tmp_path):
    path = write_csv(tmp_path / "odd [1] *", "a{b}.csv", random_rows(random.Random(1), 3, range(5)))
    (row,) = list_files(spark, str(tmp_path).replace("[", "\\[") + "/odd*").collect()
    assert row.length == os.path.getsize(path)
    report, done = ReportHistory(spark, str(tmp_path / "s")).update(str(tmp_path) + "/odd*")
    assert done.files_read == 1


# --- commit files -----------------------------------------------------------

def test_one_of_many_writers_creates_the_file(spark, tmp_path):
    target, won = f"file:{tmp_path}/x/COMMIT", []

    def write(i):
        if commit.put_if_absent(spark, target, f"writer {i}\n" * 500):
            won.append(i)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and commit.read_text(spark, target) == f"writer {won[0]}\n" * 500
    assert commit.names(spark, f"{tmp_path}/x") == ["COMMIT"]
    assert commit.read_text(spark, f"{target}s") is None and commit.names(spark, f"{tmp_path}/none") == []


def test_rename_that_replaces_nothing(spark, tmp_path, monkeypatch):
    """The way for other file systems, tried on the local one."""
    target = f"{tmp_path}/COMMIT"
    assert commit.put_if_absent(spark, target, "a")
    fs = commit._file_system(spark, target)

    class Remote:
        def __getattr__(self, name):
            return (lambda *_: False) if name == "exists" else (lambda: "other") if name == "getScheme" else getattr(fs, name)

    monkeypatch.setattr(commit, "_file_system", lambda *_: Remote())
    assert not commit.put_if_absent(spark, target, "b")
    assert commit.put_if_absent(spark, f"{tmp_path}/NEW", "c")
    monkeypatch.undo()
    assert (commit.read_text(spark, target), commit.read_text(spark, f"{tmp_path}/NEW")) == ("a", "c")
    assert commit.names(spark, str(tmp_path)) == ["COMMIT", "NEW"]


def test_replaced_text_is_never_missing(spark, tmp_path):
    target, seen, stop = f"{tmp_path}/doc.json", set(), threading.Event()
    commit.replace_text(spark, target, "0" * 2000)

    def read():
        while not stop.is_set():
            seen.add(open(target).read() if os.path.exists(target) else None)

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(1, 6):
        commit.replace_text(spark, target, str(i) * 2000)
    stop.set()
    reader.join()
    assert seen <= {str(i) * 2000 for i in range(6)}


def test_two_builders_publish_one_folder(spark, make_raw, tmp_path):
    """A reader sees nothing, then the winner's folder, and never another or a gap."""
    base, seen, stop = str(tmp_path / "base"), [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(read_marker(spark, base))
            time.sleep(0.002)

    reader = threading.Thread(target=read)
    reader.start()
    folders, results = [f"{base}/{i}" for i in range(6)], []
    for f in folders:
        os.makedirs(f)
    threads = [threading.Thread(target=lambda f=f: results.append(publish(spark, base, f))) for f in folders]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    time.sleep(0.05)
    stop.set()
    reader.join()
    assert len(set(results)) == 1 and os.path.isdir(results[0])
    assert [os.path.isdir(f) for f in folders].count(True) == 1
    first = next(i for i, s in enumerate(seen) if s is not None)
    assert set(seen[:first]) <= {None} and set(seen[first:]) == {results[0]}


def test_concurrent_snapshots_agree(spark, tmp_path):
    src = tmp_path / "in"
    write_csv(src, "a.csv", random_rows(random.Random(3), 40, range(30)))
    reports = []

    def build():
        reports.append(snapshot_report(read_events_csv(spark, str(src)), str(src), root=str(tmp_path / "snap"))[0].to_dict())

    threads = [threading.Thread(target=build) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(reports) == 2 and reports[0] == reports[1] == full(spark, src)
