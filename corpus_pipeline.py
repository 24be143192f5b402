"""The corpus pipeline: documents in, packed training sequences out.

STAGES, in order: toxicity, line dedup, SimHash near-dedup, suffix-array
dedup, best-fit packing.  Each stage takes all that its predecessor kept, as a
table, and returns one: the first four a table with the columns of
``documents``, the last one its packed pieces.  Stages write no files of
their own but the operators' intermediate tables in spark.checkpoint.dir.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import Scratch, share_package, table, text_key
from daybook.llm.lines import remove_boilerplate
from daybook.llm.packing import pack_documents
from daybook.llm.repeats import remove_repeats
from daybook.llm.simhash import simhash_groups
from daybook.llm.toxicity import score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# What operators pass through; the text comes from them and gives n_chars.
CARRIED = ("doc_id", "lang", "source")


def _documents(rows: DataFrame, text) -> DataFrame:
    """The documents' columns back from ``carried``, with a new text and its length."""
    carried = [F.col(f"carried.{c}").alias(c) for c in CARRIED]
    out = rows.select(text.alias("text"), *carried)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity operator predicts toxic; null texts come back empty."""
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"), carry=CARRIED, with_text=True)
    return _documents(scored.where("predicted = 0"), F.col("text"))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that stand on many sites; every document stays."""
    return _documents(remove_boilerplate(docs, carry=CARRIED), F.col("text"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies; of rows repeated whole, one."""
    # plain equal keys, so that the join's partitions also serve dropDuplicates
    own = {"id": F.coalesce("doc_id", F.lit(0)), "missing": F.col("doc_id").isNull()}
    keys = [*own, "k1", "k2"]
    chosen = simhash_groups(docs).where("kept").withColumns(own).select(*keys).distinct()
    keyed = docs.withColumn("whole", F.coalesce("text", F.lit(""))).withColumns(own | text_key("whole"))
    return keyed.drop("whole").join(chosen, keys, "left_semi").dropDuplicates(keys).select(*COLUMNS)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts byte strings that occur again, at character boundaries; every document stays."""
    cut = remove_repeats(docs, whole_characters=True, carry=CARRIED)
    return _documents(cut, F.decode("kept", "UTF-8"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("simhash_near_dedup", keep_one_of_each_group),
    ("suffix_array_dedup", cut_repeated_passages),
    ("best_fit_packing", pack_sequences),
]

# Fingerprints, suffixes and packings have no SQL form; the stages are tested
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each one's rows are written and read again."""
    share_package(spark)
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
