"""Sources and the command line."""

from __future__ import annotations

import json

import pytest

from conftest import SF01
from daybook.__main__ import main
from daybook.operators import clean as C
from daybook.sources.files import (
    quarantine,
    read_events,
    read_events_csv,
    read_events_parquet,
    union_in_order,
)
from daybook.sources.fixtures import dirty_events
from daybook.sources.sinks import write_events_csv


def dated(ts: str) -> bool:
    """Whether F1's timestamp text starts with a year before the sentinel."""
    return ts[:4].isdigit() and ts[:4] < "2099"


def test_parquet_source_orders_by_file_and_row(spark, tmp_path):
    raw = dirty_events(spark, SF01)
    path = str(tmp_path / "events_parquet")
    raw.drop("ord").repartition(4).write.parquet(path)
    df = read_events_parquet(spark, path)
    assert "ord" in df.columns and set(df.schema["ord"].dataType.names) == {"file", "block", "row"}
    counts = C.clean_counts(df).first()
    assert (counts["raw_rows"], counts["valid_rows"]) == (10_000, 7_803)
    # first-seen follows (file, row): compare with a sequential reading
    ordered = df.orderBy("ord").collect()
    seen, firsts = set(), {}
    for r in ordered:
        ok = r["event_type"] in ("page_view", "signup", "purchase", "refund") and dated(r["ts"])
        if ok and r["event_id"] not in seen:
            seen.add(r["event_id"])
            firsts[r["event_id"]] = r["user_id"]
    got = {r["event_id"]: r["user_id"] for r in C.clean_events(df).collect()}
    assert got == firsts


def test_existing_ord_column_is_kept(spark, tmp_path):
    path = str(tmp_path / "with_ord")
    dirty_events(spark, SF01).write.parquet(path)
    df = read_events_parquet(spark, path)
    assert dict(df.dtypes)["ord"] == "bigint"


def test_csv_failfast_on_bad_number(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("event_id,user_id,ts,event_type,amount,country,device,session_id\n"
                    "1,5,2023-01-01 00:00:00,page_view,0.0,US,web,1\n"
                    "x,5,2023-01-01 00:00:00,page_view,0.0,US,web,1\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        read_events_csv(spark, str(path)).collect()


def test_read_events_dispatch(spark, make_raw, tmp_path):
    csv = str(tmp_path / "e_csv")
    write_events_csv(make_raw([{}]).drop("ord"), csv)
    assert read_events(spark, csv).count() == 1
    pq = str(tmp_path / "e.parquet")
    make_raw([{}, {}]).drop("ord").write.parquet(pq)
    assert read_events(spark, pq).count() == 2
    with pytest.raises(ValueError):
        read_events(spark, pq, "json")
    csv2 = str(tmp_path / "e2_csv")
    write_events_csv(make_raw([{"event_id": 5}, {"event_id": 6}]).drop("ord"), csv2)
    assert read_events(spark, [csv, csv2]).count() == 3


def test_cli_writes_report(spark, make_raw, tmp_path):
    src = str(tmp_path / "events")
    write_events_csv(make_raw([{"event_type": "purchase", "amount": 9.5}, {}]).drop("ord"), src)
    out = tmp_path / "out" / "report.json"
    tables = str(tmp_path / "tables")
    assert main([src, "--out", str(out), "--tables", tables]) == 0
    doc = json.loads(out.read_text())
    assert doc["counts"]["raw_rows"] == 2 and doc["revenue_daily"][0]["net_revenue"] == 9.5
    assert spark.read.parquet(f"{tables}/dau").first()["dau"] == 1


def test_cli_exit_codes(spark, make_raw, tmp_path):
    assert main([str(tmp_path / "missing.csv"), "--out", str(tmp_path / "r.json")]) == 1
    bad = tmp_path / "malformed.csv"
    bad.write_text("event_id,user_id,ts,event_type,amount,country,device,session_id\n"
                   "1,x,2023-01-01 00:00:00,page_view,0.0,US,web,1\n")
    assert main([str(bad), "--out", str(tmp_path / "r.json")]) == 1
    src = str(tmp_path / "bad_only")
    write_events_csv(make_raw([{"event_type": "???"}]).drop("ord"), src)
    assert main([src, "--out", str(tmp_path / "r.json")]) == 1


def test_csv_header_must_match_the_schema(spark, tmp_path):
    path = tmp_path / "reordered.csv"
    path.write_text("user_id,event_id,ts,event_type,amount,country,device,session_id\n"
                    "5,1,2023-01-01 00:00:00,page_view,0.0,US,web,1\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_events_csv(spark, str(path)).collect()


def test_multi_file_order_follows_paths_then_rows(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    raw = dirty_events(spark, SF01)
    path = str(tmp_path / "multi")
    raw.drop("ord").repartition(5).write.parquet(path)
    got = {r["event_id"]: r["user_id"] for r in C.clean_events(read_events_parquet(spark, path)).collect()}
    valid_types = {"page_view", "signup", "purchase", "refund"}
    want = {}
    for f in sorted(glob.glob(f"{path}/*.parquet")):            # path order, then row order
        for r in pq.read_table(f).to_pylist():
            if not dated(r["ts"]) or r["event_type"] not in valid_types:
                continue
            want.setdefault(r["event_id"], r["user_id"])
    assert got == want
    assert dict(read_events_parquet(spark, path).select("ord.*").dtypes) == \
        {"file": "string", "block": "bigint", "row": "bigint"}


def test_multi_file_csv_order_follows_paths_then_lines(spark, tmp_path):
    import csv
    import glob

    raw = dirty_events(spark, SF01)
    path = str(tmp_path / "multi_csv")
    write_events_csv(raw.drop("ord").repartition(3), path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(96 * 1024))     # several splits per file
    try:
        df = read_events_csv(spark, path)
        got = {r["event_id"]: r["user_id"] for r in C.clean_events(df).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    valid_types = {"page_view", "signup", "purchase", "refund"}
    want = {}
    for f in sorted(glob.glob(f"{path}/*.csv")):                 # path order, then line order
        with open(f, newline="") as fh:
            for r in csv.DictReader(fh):
                if not dated(r["ts"]) or r["event_type"] not in valid_types:
                    continue
                want.setdefault(int(r["event_id"]), int(r["user_id"]))
    assert got == want


def test_malformed_session_id_fails_the_report(spark, tmp_path):
    # No metric reads session_id, yet a malformed one is a load error.
    from daybook.plans.report import build_report
    path = tmp_path / "bad_session.csv"
    path.write_text("event_id,user_id,ts,event_type,amount,country,device,session_id\n"
                    "1,5,2023-01-01 00:00:00,page_view,0.0,US,web,1\n"
                    "2,5,2023-01-01 00:00:00,page_view,0.0,US,web,oops\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        build_report(read_events_csv(spark, str(path)))


HEADER = "event_id,user_id,ts,event_type,amount,country,device,session_id\n"


def csv_file(path, *lines):
    path.write_text(HEADER + "".join(f"{line}\n" for line in lines))
    return str(path)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_missing_numbers_by_column(spark, tmp_path, ansi):
    path = csv_file(tmp_path / "e.csv", "1,5,2023-01-01 00:00:00,purchase,NA,NA,web,1",
                    "2,5,2023-01-01 00:00:00,purchase,null,null,web,1", '3,5,2023-01-01 00:00:00,purchase,"",x,web,1',
                    "4,5,2023-01-01 00:00:00,purchase,-1e3,x,web,1", "5,5,2023-01-01 00:00:00,purchase,nan,x,web,1")
    was = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = {r.event_id: r for r in read_events_csv(spark, path).collect()}
        assert [rows[i].country for i in (1, 2)] == ["NA", "null"]
        assert [rows[i].amount for i in (1, 2, 3, 4)] == [None, None, None, -1000.0]
        assert {r.event_id: r.amount for r in C.clean_events(read_events_csv(spark, path)).collect()}[5] is None
        # only what a column names is missing there; all else is an error, whatever the session does with casts
        with pytest.raises(Exception, match="MALFORMED event field amount: null"):
            read_events_csv(spark, path, null_tokens={"amount": ("NA",)}).collect()
        some = read_events_csv(spark, path, null_tokens={"amount": ("NA", "null", "nan"), "country": ("NA", "x")})
        assert {r.event_id: r.country for r in some.collect()} == {1: None, 2: "null", 3: None, 4: None, 5: None}
        bad = csv_file(tmp_path / "bad.csv", "NA,5,2023-01-01 00:00:00,purchase,x,US,web,1")
        assert read_events_csv(spark, bad).select("event_id", "country").first().event_id is None
        with pytest.raises(Exception, match="MALFORMED event field amount: x"):
            read_events_csv(spark, bad).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", was)


def test_malformed_rows_are_kept_apart_and_counted(spark, tmp_path):
    path = csv_file(tmp_path / "e.csv", "1,5,2023-01-01 00:00:00,page_view,0.0,US,web,1", "2,5,2023-01-01 00:00:00,signup,x9,US,web,1",
                    "3,5,2023-01-01 00:00:00,purchase,1.5", "4,5,2023-01-01 00:00:00,purchase,1.5,US,web,1,77",
                    "q,5,2023-01-01 00:00:00,purchase,1.5,US,web,1", "1,5,2023-01-01 00:00:00,signup,0.0,US,web,oops",
                    "1,5,2023-01-01 00:00:00,signup,0.0,US,web,1", "6,5,2099-01-01 00:00:00,signup,0.0,US,web,1",
                    "7,5,2023-01-01 00:00:00,click,0.0,US,web,NA")
    raw = read_events_csv(spark, path, failfast=False)
    counts = C.clean_counts(raw).first()
    assert (counts.raw_rows, counts.valid_rows, counts.dropped_rows, counts.malformed_rows) == (9, 1, 3, 5)
    assert tuple(counts.breakdown) == (1, 1, 1) and counts.null_id_rows == 1
    assert counts.raw_rows == counts.valid_rows + counts.dropped_rows + counts.malformed_rows
    apart = quarantine(raw).orderBy("ord").collect()
    assert [(r.malformed, r.line.split(",")[0]) for r in apart] == \
        [("amount", "2"), ("columns", "3"), ("columns", "4"), ("event_id", "q"), ("session_id", "1")]
    assert apart[2].line == "4,5,2023-01-01 00:00:00,purchase,1.5,US,web,1,77"
    assert [r.event_type for r in C.clean_events(raw).collect()] == ["page_view"]
    # the reason doesn't depend on which columns a query reads
    assert raw.select("country", "malformed").where("malformed = 'columns'").count() == 2
    clean, both, _ = C.clean_with_counts(raw)
    assert clean.count() == 1 and both.first().malformed_rows == 5


def test_list_order_decides_first_copies(spark, make_raw, tmp_path):
    """Paths sort the other way round than the list; formats are mixed."""
    a, b = str(tmp_path / "a.parquet"), str(tmp_path / "b_csv")
    make_raw([{"event_id": 1, "country": "A"}, {"event_id": 2, "country": "A"}]).drop("ord").write.parquet(a)
    write_events_csv(make_raw([{"event_id": 2, "country": "B"}, {"event_id": 3, "country": "B"}]).drop("ord"), b)

    def countries(paths):
        return {r.event_id: r.country for r in C.clean_events(read_events(spark, paths)).collect()}

    assert countries([b, a]) == {1: "A", 2: "B", 3: "B"}
    assert countries([a, b]) == {1: "A", 2: "A", 3: "B"}
    assert countries([b, a, b]) == countries([b, a])
    assert C.clean_counts(read_events(spark, [b, a, b])).first().raw_rows == 6
    with pytest.raises(ValueError, match="no path"):
        read_events(spark, [])


def test_inputs_of_other_types_become_raw_events(spark, make_raw):
    """Timestamps become text in UTC whatever the session's zone; an input's own order is kept."""
    typed = spark.sql("SELECT 10L - id AS ord, id AS event_id, 5 AS user_id, timestamp'2021-03-04 23:30:00Z' AS ts, 'signup' AS event_type, "
                      "CAST(id AS FLOAT) AS amount, 'SE' AS country, 'ios' AS device, 7L AS session_id, 'x' AS other FROM range(3)")
    plain = spark.sql("SELECT 1 AS ord, 9L AS event_id, 5 AS user_id, timestamp_ntz'2021-03-04 23:30:00.25' AS ts, 'signup' AS event_type, "
                      "1D AS amount, 'SE' AS country, 'ios' AS device, 7L AS session_id")
    was = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        rows = union_in_order([typed, plain]).orderBy("ord").collect()
        assert [r.event_id for r in rows] == [2, 1, 0, 9]
        assert [r.ts for r in rows[2:]] == ["2021-03-04 23:30:00.000000Z", "2021-03-04 23:30:00.250000Z"]
        assert {str(r.date) for r in C.clean_events(union_in_order([typed, plain])).collect()} == {"2021-03-04"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", was)
    with pytest.raises(ValueError, match="no column amount"):
        union_in_order([plain.drop("amount")])
    with pytest.raises(ValueError, match="ord"):
        union_in_order([plain.drop("ord")])
