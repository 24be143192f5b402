"""The corpus pipeline's stages on their own input."""

from __future__ import annotations

import corpus_pipeline as P
import pytest
from conftest import SF001

from daybook.llm import lines, packing, repeats, simhash, toxicity


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output, written and read again as the driver does."""
    root = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{SF001}/documents.parquet"), {}
    for name, stage in P.STAGES:
        path = str(root / name)
        stage(spark, docs, SF001).write.parquet(path)
        done = spark.read.parquet(path)
        out[name] = (docs, done)
        docs = done
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_in_order(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    for name in list(stages)[:-1]:
        before, after = stages[name]
        assert after.columns == P.COLUMNS
        assert all(r.n_chars == len(r.text) for r in after.collect()) and after.count() <= before.count()


def test_toxic_documents_go_and_others_stay(spark, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    bad = {r.doc_id for r in toxicity.score_toxicity(before, labels).where("predicted = 1").collect()}
    assert texts(after) == {i: t for i, t in texts(before).items() if i not in bad}


def test_lines_are_taken_out(stages):
    before, after = stages["line_dedup"]
    want = {r.doc_id: r.text for r in lines.remove_boilerplate(before).collect()}
    assert texts(after) == want and len(want) == before.count()


def test_one_of_each_group_stays(stages):
    before, after = stages["simhash_near_dedup"]
    groups = simhash.simhash_groups(before).collect()
    assert {r.doc_id for r in groups if r.doc_id == r.component_id} == set(texts(after))


def test_group_without_ids_keeps_one_row(spark):
    rows = [(None, "same text here now", "en", "s", 1), (None, "same text here now", "en", "s", 1), (None, "quite other words follow", "en", "s", 1),
            (4, "same text here now", "en", "s", 1), (5, None, None, None, None), (5, None, None, None, None), (6, "", "en", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = P.keep_one_of_each_group(spark, df, SF001).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, "quite other words follow"), (4, "same text here now"), (5, "")]


def test_passages_are_cut_at_characters(stages):
    before, after = stages["suffix_array_dedup"]
    want = {r.doc_id: bytes(r.kept).decode() for r in repeats.remove_repeats(before, whole_characters=True).collect()}
    assert texts(after) == want


def test_packing_covers_every_document(stages):
    before, after = stages["best_fit_packing"]
    want = packing.cut_documents(before).toPandas()
    got = after.toPandas()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got[columns].to_numpy().tolist())) == sorted(map(tuple, want[columns].to_numpy().tolist()))
    assert got.groupby("sequence_id").length.sum().max() <= 4096


def test_run_equals_the_stages(spark, stages):
    rows = P.run(spark, SF001)
    _, done = stages["best_fit_packing"]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, rows.select(columns).collect())) == sorted(map(tuple, done.select(columns).collect()))


def test_stages_on_awkward_rows(spark, awkward, tmp_path):
    """Nulls in any column, empty and long texts, repeated rows, and extra columns whose names occur in the operators."""
    docs, before = awkward, awkward.count()
    for name, stage in P.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF001).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != P.STAGES[-1][0]:
            assert docs.columns == P.COLUMNS and 0 < docs.count() <= before
            assert docs.where("text IS NULL OR n_chars <> length(text)").count() == 0
            before = docs.count()
    pieces = docs.toPandas()
    assert pieces.groupby("sequence_id").length.sum().max() <= 4096 and len(pieces) >= before


def test_stages_on_an_empty_table(spark, nothing, tmp_path):
    docs = nothing
    for name, stage in P.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF001).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.count() == 0
