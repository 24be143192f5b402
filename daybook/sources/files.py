"""File scans of raw events (S1–S4).

Rule D4 keeps the *first-seen* copy of an event, so the scan must carry the
input order.  Spark has no row order of its own: files are split and the
splits packed into tasks largest-first.  The order is therefore attached at
the scan as ``ord = struct(file path, split start, position)``; it sorts
exactly like "file by file, top to bottom" however the files are split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.expressions import sql_text
from daybook.schema import NULL_TOKENS, RAW_COLUMNS, RAW_EVENT_SCHEMA, RULE_MALFORMED

ORD = "ord"
# Columns of a scan that keeps malformed rows: what doesn't fit, and the line.
MALFORMED = RULE_MALFORMED
LINE = "line"
_NO_RECORD = "__record"


def with_file_order(df: DataFrame, row_index: bool = False) -> DataFrame:
    """Attach ``ord`` = struct(file, block, row) from the scan's ``_metadata``.

    Parquet exposes a per-file ``row_index``.  Text formats do not; there the
    split start plus ``monotonically_increasing_id`` (increasing within each
    task, and a split is read by one task top to bottom) orders the rows.

    ``file`` is the file's path, whatever the number of files; files follow
    each other in the lexical order of their paths (``part-100000`` comes
    before ``part-99999``).
    """
    block = F.lit(0).cast("long") if row_index else F.col("_metadata.file_block_start")
    row = F.col("_metadata.row_index") if row_index else F.monotonically_increasing_id()
    order = F.struct(F.col("_metadata.file_path").alias("file"), block.alias("block"),
                     row.alias("row"))
    return df.select(order.alias(ORD), *df.columns)


def _number(field: T.StructField, tokens: Sequence[str]) -> tuple[str, str]:
    """A field's text as its type, null where it can't be, and whether it can't though it isn't missing."""
    name = f"`{field.name}`"
    missing = " OR ".join([f"{name} IS NULL", *([f"{name} IN ({', '.join(map(sql_text, tokens))})"] if tokens else [])])
    typed = f"try_cast({name} AS {field.dataType.simpleString()})"
    return typed, f"({typed} IS NULL AND NOT ({missing}))"


def _strict(field: T.StructField, tokens: Sequence[str]) -> str:
    """A field's text as its type; text that is neither a value nor missing is an error in any session."""
    typed, bad = _number(field, tokens)
    kind = field.dataType.simpleString()
    error = f"raise_error(concat('MALFORMED event field {field.name}: ', `{field.name}`))"
    return f"coalesce({typed}, CASE WHEN {bad} THEN CAST({error} AS {kind}) END)"


def read_events_csv(spark: SparkSession, path: str | list[str], failfast: bool = True,
                    null_tokens: Mapping[str, Sequence[str]] = NULL_TOKENS) -> DataFrame:
    """S1–S3: header CSV with the fixed raw schema — no inference.

    Large inputs are read as many splits (``spark.sql.files.maxPartitionBytes``),
    which replaces the reference's chunked reader.  Empty fields are null, and
    so are the texts that ``null_tokens`` names for a column: by default the usual
    spellings of a missing number, in numeric columns only, as ``NA`` is a
    country code.  Leading and trailing blanks are kept, as the country rule
    depends on them.  A header that does not name the expected columns in order
    is an error.

    Other text in a numeric column is an error when a query reads the column, and
    so is a line with too few or too many fields when one reads all columns.  With ``failfast=False`` such rows
    are kept apart instead: the column ``malformed`` names the field that
    doesn't fit (``columns``: their number) and ``line`` holds the line, both null in
    other rows.  The cleaning rules drop malformed rows and count them
    (``clean.clean_counts``); ``quarantine`` returns them.
    """
    fields = [T.StructField(f.name, T.StringType()) for f in RAW_EVENT_SCHEMA]
    reader = (spark.read.option("header", True)
              # check the header against the schema instead of silently
              # assigning columns by position
              .option("enforceSchema", False)
              .option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False))
    numeric = [f for f in RAW_EVENT_SCHEMA if isinstance(f.dataType, T.NumericType)]
    tokens = {f.name: null_tokens.get(f.name, ()) for f in RAW_EVENT_SCHEMA}
    if failfast:
        typed = {f.name: _strict(f, tokens[f.name]) for f in numeric}
        raw = reader.schema(T.StructType(fields)).option("mode", "FAILFAST").csv(path)
    else:
        typed = {f.name: _number(f, tokens[f.name])[0] for f in numeric}
        raw = (reader.schema(T.StructType([*fields, T.StructField(_NO_RECORD, T.StringType())]))
               .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _NO_RECORD)
               # all fields are parsed, so that their number is checked whatever is read
               .option("columnPruning", False).csv(path))
    texts = {f.name: f"CASE WHEN `{f.name}` NOT IN ({', '.join(map(sql_text, tokens[f.name]))}) THEN `{f.name}` END"
             for f in RAW_EVENT_SCHEMA if f not in numeric and tokens[f.name]}
    columns = [f"{(typed | texts).get(c, f'`{c}`')} AS `{c}`" for c in RAW_COLUMNS]
    if not failfast:
        bad = " ".join(f"WHEN {_number(f, tokens[f.name])[1]} THEN {sql_text(f.name)}" for f in numeric)
        reason = f"CASE WHEN {_NO_RECORD} IS NOT NULL THEN 'columns' {bad} END"
        whole = f"coalesce({_NO_RECORD}, concat_ws(',', {', '.join(f'`{c}`' for c in RAW_COLUMNS)}))"
        columns += [f"{reason} AS {MALFORMED}", f"CASE WHEN {reason} IS NOT NULL THEN {whole} END AS {LINE}"]
    return with_file_order(raw).selectExpr(ORD, *columns)


def quarantine(raw: DataFrame) -> DataFrame:
    """``ord, malformed, line`` of the rows that a scan with ``failfast=False`` kept apart."""
    return raw.where(F.col(MALFORMED).isNotNull()).select(ORD, MALFORMED, LINE)


def read_events_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw events stored as parquet; keeps an existing ``ord`` column."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    if ORD in df.columns:
        return df
    return with_file_order(df, row_index=True)


def _format_of(path: str, fmt: str | None) -> str:
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unsupported event format: {fmt}")
    return fmt


def read_events(spark: SparkSession, path: str | Sequence[str], fmt: str | None = None) -> DataFrame:
    """Raw events from a path, or from several in the order of the list (U1).

    The format is inferred from each path (a ``.parquet`` suffix, else CSV)
    unless given, so a list may mix formats.  Of several inputs the first listed
    comes first: ``ord`` gets the path's place in the list, ``source``, before
    the order of files and rows within it, and the raw columns take their raw types.
    """
    if isinstance(path, str):
        return read_events_csv(spark, path) if _format_of(path, fmt) == "csv" else read_events_parquet(spark, path)
    formats = [_format_of(p, fmt) for p in path]
    if not formats:
        raise ValueError("no path given")
    return union_in_order([read_events_csv(spark, p) if f == "csv" else read_events_parquet(spark, p)
                           for p, f in zip(path, formats)])


def _raw_column(df: DataFrame, field: T.StructField):
    """A raw column in its raw type; a timestamp becomes the text it was read from, in UTC."""
    if field.name not in df.columns:
        raise ValueError(f"an input has no column {field.name}")
    kind, c = df.schema[field.name].dataType, F.col(field.name)
    if isinstance(kind, T.TimestampType):
        c = F.expr(f"timestampadd(MICROSECOND, unix_micros(`{field.name}`), timestamp_ntz'1970-01-01')")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        c = F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("Z"))
    return c.cast(field.dataType).alias(field.name)


def union_in_order(inputs: Sequence[DataFrame]) -> DataFrame:
    """One input whose rows follow each other as ``inputs`` do, and within each by its ``ord``.

    An input's ``ord`` is that of a file scan or a whole number; one without
    has no order of its own that would survive.
    """
    parts = []
    for source, df in enumerate(inputs):
        if ORD not in df.columns:
            raise ValueError("every input needs an ord column")
        if isinstance(df.schema[ORD].dataType, T.StructType):
            place = [F.col(f"{ORD}.file").alias("file"), F.col(f"{ORD}.block").alias("block"), F.col(f"{ORD}.row").alias("row")]
        else:
            place = [F.lit("").alias("file"), F.lit(0).cast("long").alias("block"), F.col(ORD).cast("long").alias("row")]
        parts.append(df.select(F.struct(F.lit(source).alias("source"), *place).alias(ORD),
                               *[_raw_column(df, f) for f in RAW_EVENT_SCHEMA]))
    return reduce(DataFrame.unionByName, parts)
