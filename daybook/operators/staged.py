"""Rules D1–D5 over a staged copy of the events, without sorting them.

``clean.per_event`` keeps an event's first copy as ``min(struct(ord, columns))``: one pass
and one shuffle, but a struct has no hash aggregate, so the events are sorted
before and after that shuffle.  Here the tagged events are written once as
parquet, narrow and columnar, and read twice:

1. ``place``, the input order as one number, and the rule are all that the
   dedup reads.  ``min(place)`` and the count of copies per event are a hash
   aggregate, combined map-side.  Only events with several surviving copies
   are kept: ``repeated``, with their first copy's place.
2. A surviving row stays unless its event is in ``repeated`` with another
   place.  ``repeated`` is a stored table of a known size: up to the session's
   limit it is broadcast and the rows aren't shuffled at all; beyond, they
   meet it in a shuffled hash join.  An event with very many copies is
   one row of ``repeated`` either way.

The staged copy also cuts the lineage: text is parsed once, and losing an
executor later costs a re-read.

Order.  ``ord`` is a whole number or the file scans' struct (…, file, block,
row).  The files seen are numbered in order (``sources`` keeps a list's order
before the path's), and a row's place is its file's number and ``block + row``
within it.  In a text file, a block's rows are numbered from the
start of the task that reads it, and a task reads no more bytes than a
block's size, so ``block + row`` stays below the next block's start; a parquet file
has fewer than 2^33 rows.  More than 2^21 files, or a file beyond 2^42, is an error.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.clean import ORD, RULE, tag_rules
from daybook.schema import (
    CLEAN_COLUMNS,
    RULE_DUPLICATE,
    RULE_INVALID_ETYPE,
    RULE_INVALID_TS,
    RULE_MALFORMED,
)
from daybook.session import checkpoint_root, delete_folder

FILE_BITS, PLACE_BITS = 21, 42

_PAYLOAD = tuple(c for c in CLEAN_COLUMNS if c != "event_id")
_MISSING = "missing_id"


def _limited(value: str, bits: int, what: str) -> str:
    return (f"CASE WHEN {value} < {1 << bits} THEN {value} "
            f"ELSE CAST(raise_error('{what} is beyond 2^{bits}') AS BIGINT) END")


@dataclass
class StagedEvents:
    """Tagged events in a folder of the shared checkpoint directory.

    ``rows`` has ``event_id``, ``place``, the rule that drops a row (null: none),
    whether an id is missing, and the staged clean columns; ``repeated`` has ``event_id``,
    ``first`` and ``copies`` of the events with several surviving rows.
    """

    rows: DataFrame
    repeated: DataFrame
    columns: tuple[str, ...]
    folder: str = field(repr=False)

    def clean(self, columns: tuple[str, ...] | None = None) -> DataFrame:
        """``event_id`` (unique) and the named clean columns of the first surviving copies."""
        columns = self.columns if columns is None else tuple(columns)
        if unknown := set(columns) - set(self.columns):
            raise ValueError(f"not staged: {sorted(unknown)}")
        kept = self.rows.where(F.col(RULE).isNull()).select("event_id", "place", *columns)
        again = _join_side(self.repeated.select(F.col("event_id").alias("_id"), "first"))
        return (kept.join(again, F.col("event_id").eqNullSafe(F.col("_id")), "left")
                .where(F.col("first").isNull() | (F.col("place") == F.col("first"))).select("event_id", *columns))

    def counts(self) -> DataFrame:
        """The drop accounting as one row (as ``clean.clean_counts``, with ``malformed_rows``)."""
        again = self.repeated.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n"))
        rows = self.rows.agg(
            F.count(F.lit(1)).alias("raw_rows"), F.count_if(F.col(RULE).isNull()).alias("survivors"),
            *[F.count_if(F.col(RULE) == r).alias(r) for r in (RULE_INVALID_TS, RULE_INVALID_ETYPE)],
            F.count_if(F.col(RULE) == RULE_MALFORMED).alias("malformed_rows"),
            F.count_if(F.col(_MISSING) & ~F.col(RULE).eqNullSafe(RULE_MALFORMED)).alias("null_id_rows"))
        return self.rows.sparkSession.sql(
            "SELECT raw_rows, survivors - again AS valid_rows, raw_rows - malformed_rows - survivors + again AS dropped_rows, "
            f"named_struct('{RULE_INVALID_TS}', {RULE_INVALID_TS}, '{RULE_INVALID_ETYPE}', {RULE_INVALID_ETYPE}, "
            f"'{RULE_DUPLICATE}', again) AS breakdown, null_id_rows, malformed_rows "
            "FROM (SELECT *, (SELECT n FROM {again}) AS again FROM {rows})", again=again, rows=rows)

    def release(self) -> None:
        """Removes the staged copy; what was derived from it must not be read any more."""
        delete_folder(self.rows.sparkSession, self.folder)


def _join_side(stored: DataFrame) -> DataFrame:
    """A stored table as a join side that needs no sort: broadcast up to the session's limit, else hashed after a shuffle."""
    size = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    limit = stored.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return F.broadcast(stored) if size <= limit else stored.hint("shuffle_hash")


def _stored(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _with_place(staged: DataFrame, head: list[str], folder: str) -> DataFrame:
    """``place`` instead of the order columns: the number of the file, then the place in it."""
    seen = staged.select(*head).distinct()
    number = F.row_number().over(Window.orderBy(*head)) - 1
    files = _stored(seen.withColumn("_number", number.cast("long")), f"{folder}/files")
    n = files.count()
    if n > 1 << FILE_BITS:
        raise ValueError(f"{n} files are more than 2^{FILE_BITS}")
    inside = _limited("(_block + _row)", PLACE_BITS, "a place in a file")
    joined = staged.join(_join_side(files), head)
    return joined.withColumn("place", F.expr(f"shiftleft(_number, {PLACE_BITS}) + {inside}")).drop(*head, "_number", "_block", "_row")


def stage_events(raw: DataFrame, columns: tuple[str, ...] = _PAYLOAD, folder: str | None = None) -> StagedEvents:
    """Cleans ``raw`` by rows, writes the result under ``folder``, and finds the events' first copies.

    ``folder`` is by default a new one in the shared checkpoint directory.
    Without ``ord``, the order is that of the partitions, as in ``clean``.
    """
    columns = tuple(columns)
    if unknown := set(columns) - set(_PAYLOAD):
        raise ValueError(f"not clean-event columns: {sorted(unknown)}")
    spark = raw.sparkSession
    folder = folder or f"{checkpoint_root(spark)}/daybook/staged/{uuid.uuid4().hex}"
    tagged = tag_rules(raw)
    kind = tagged.schema[ORD].dataType
    head: list[str] = []
    if isinstance(kind, T.StructType):
        head = [f"_{f}" for f in kind.names if f not in ("block", "row")]
        order = [F.col(f"{ORD}.{f[1:]}").alias(f) for f in head]
        # a text scan's row numbers begin anew in each task
        order += [F.col(f"{ORD}.block").alias("_block"), F.expr(f"{ORD}.row & {(1 << 33) - 1}").alias("_row")]
    else:
        order = [F.col(ORD).cast("long").alias("place")]
    missing = F.expr("event_id IS NULL OR user_id IS NULL OR session_id IS NULL").alias(_MISSING)
    rows = _stored(tagged.select("event_id", RULE, missing, *order, *columns), f"{folder}/rows")
    if head:
        rows = _with_place(rows, head, folder)
    copies = rows.where(F.col(RULE).isNull()).groupBy("event_id").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("copies"))
    repeated = _stored(copies.where("copies > 1"), f"{folder}/repeated")
    return StagedEvents(rows, repeated, columns, folder)
