"""The operators' queries over the given tables, and their DuckDB oracles."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import functions as F

from daybook.llm import divergence, embedding_dedup, lines
from daybook.llm.common import share_package, table


def _query(run):
    """A registered query: (spark, sf_dir) -> DataFrame."""
    @wraps(run)
    def query(spark, sf_dir):
        share_package(spark)
        return run(spark, sf_dir)
    return query


@_query
def op1_license_scan(spark, sf_dir):
    from daybook.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


@_query
def op2_line_dedup(spark, sf_dir):
    return lines.remove_boilerplate(table(spark, sf_dir, "documents")).drop("carried")


@_query
def op3_nearest_neighbours(spark, sf_dir):
    from daybook.llm.neighbours import nearest_neighbours

    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


@_query
def op4_simhash_near_dedup(spark, sf_dir):
    from daybook.llm.simhash import simhash_groups

    return simhash_groups(table(spark, sf_dir, "documents"))


@_query
def op5_suffix_array_dedup(spark, sf_dir):
    from daybook.llm.repeats import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op6_toxicity(spark, sf_dir):
    from daybook.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("carried")


@_query
def op7_embedding_near_dedup(spark, sf_dir):
    return embedding_dedup.embedding_groups(table(spark, sf_dir, "embeddings"))


@_query
def op8_best_fit_packing(spark, sf_dir):
    from daybook.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


@_query
def op9_byte_bpe(spark, sf_dir):
    from daybook.llm.bpe import decode_documents, encode_documents

    coded = decode_documents(encode_documents(table(spark, sf_dir, "documents")))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@_query
def op10_chat_format(spark, sf_dir):
    from daybook.llm.chat import TOOLS, as_tool_dialogue, format_chats

    return format_chats(as_tool_dialogue(table(spark, sf_dir, "conversations")), TOOLS)


@_query
def op11_source_divergence(spark, sf_dir):
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


@_query
def op12_quality_classifier(spark, sf_dir):
    from daybook.llm.quality import score_quality

    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op13_periodic_runs(spark, sf_dir):
    from daybook.llm.periodic import longest_run, periodic_runs, run_lines

    found = periodic_runs(table(spark, sf_dir, "documents"), plant=True).withColumn("top", longest_run())
    top = {c: F.col(f"top.{c}") for c in ("start", "length", "period")}
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[c.alias(name) for name, c in top.items()],
        F.expr("top.length * 1000 div top.period").alias("exponent_milli"),
        F.sha2(run_lines(), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_line_dedup": op2_line_dedup,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_chat_format": op10_chat_format,
    "op11_source_divergence": op11_source_divergence,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op2_line_dedup": lines.ORACLE,
    "op7_embedding_near_dedup": embedding_dedup.ORACLE,
    "op11_source_divergence": divergence.ORACLE,
}
