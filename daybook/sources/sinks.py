"""Sinks: the JSON report (S5), CSV events (S6) and metric tables."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.sources.commit import replace_text


def write_report_json(document: DataFrame, path: str) -> None:
    """Write the one-row report document as a JSON text file set.

    ``document`` has a single string column holding the JSON; one row means
    one output file.  Works for any Hadoop-compatible path.
    """
    document.coalesce(1).write.mode("overwrite").text(path)


def save_document(document: DataFrame, target: str) -> None:
    """The report document as one indented JSON file ``target``.

    A target without a scheme is a file of the driver's machine.  A reader
    finds the earlier file or the new one, never a part of it.
    """
    parsed = json.loads(document.first()[0])
    where = target if "://" in target or target.startswith("file:") else f"file://{os.path.abspath(target)}"
    replace_text(document.sparkSession, where, json.dumps(parsed, ensure_ascii=False, indent=2) + "\n")


def write_events_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S6: events as header CSV that reads back to the same values.

    Timestamps are written as ISO text with offset; blanks are preserved
    (Spark's writer trims by default, which would turn ``"  us "`` into
    ``us`` and a blank value into null on re-read); strings are quoted.
    """
    cols = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ssxxx")
        elif isinstance(field.dataType, T.TimestampNTZType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(field.name))
    (df.select(*cols).write.mode(mode)
     .option("header", True)
     .option("quoteAll", True)
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_tables(tables: dict[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    """Persist named (small) tables as parquet folders under ``root``."""
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{root.rstrip('/')}/{name}")
