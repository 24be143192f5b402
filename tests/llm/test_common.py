"""What the operators share."""

from __future__ import annotations

import pyarrow as pa

from daybook.llm import common


def test_worker_keeps_tables_of_one_operator(monkeypatch):
    monkeypatch.setattr(common, "_HELD", {})
    first = common.held("a", 1, list)
    assert common.held("a", 1, list) is first and common.held("a", 2, dict) == {}
    assert common.held("a", 1, list) is first
    assert common.held("b") is None and list(common._HELD) == [("b", None)]
    assert common.held("a", 1, list) is not first


def test_batches_to_workers_are_bounded(spark):
    """Long texts go in small batches, whatever the number of rows; a text over the limit goes alone."""
    common.Scratch(spark, "test")
    texts = spark.range(3_000, numPartitions=1).selectExpr("repeat('x', IF(id = 7, 9000000, 20000)) AS text")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    found = texts.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r.rows for r in found) == 3_000
    assert sorted(r.bytes for r in found)[-2] < 8 << 20 and len(found) >= 8
