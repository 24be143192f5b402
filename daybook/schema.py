"""Schemas and fixed values of the event model."""

from __future__ import annotations

import sys

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
# The event-type allowlist (rule D3).
VALID_EVENT_TYPES = ("page_view", "signup", "purchase", "refund")
# Event types that carry money (rule D5, revenue metrics).
REVENUE_EVENT_TYPES = ("purchase", "refund")
# Funnel steps, in order, and their output column names.
FUNNEL_STEPS = (("page_view", "pv"), ("signup", "signup"), ("purchase", "purchase"))
# Sentinel year: timestamps in this year or later are injector artefacts (rule D1).
SENTINEL_YEAR = 2099
# Replacement for a missing country (rule D2).
UNKNOWN_COUNTRY = "UNK"
# Default parameters of the metrics.
TOP_N = 10
ANOMALY_Z = 3.0
RETENTION_DAY_OFFSET = 1
# Refund integrity tolerance, as numpy.isclose(refund, -purchase, atol=1e-4)
# with numpy's default rtol.
AMOUNT_ATOL = 1e-4
AMOUNT_RTOL = 1e-5
# Texts that stand for a missing number in a CSV field.
MISSING_NUMBER = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                  "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
# Breakdown keys of the drop accounting, in rule order.
RULE_INVALID_TS = "invalid_ts"
RULE_INVALID_ETYPE = "invalid_etype"
RULE_DUPLICATE = "duplicate_event_id"
RULES = (RULE_INVALID_TS, RULE_INVALID_ETYPE, RULE_DUPLICATE)
# ---------------------------------------------------------------------------

# A row whose text doesn't fit the schema, where such rows are kept apart.
RULE_MALFORMED = "malformed"

# Characters Python's str.strip() removes (all Unicode whitespace), built by
# rule rather than listed.
WHITESPACE = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())

# Raw event as it arrives from CSV: timestamps are still text.
RAW_EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("ts", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("device", T.StringType()),
    T.StructField("session_id", T.LongType()),
])

RAW_COLUMNS = tuple(f.name for f in RAW_EVENT_SCHEMA.fields)

# Clean event: ts is a UTC instant and `date` its UTC calendar day.
CLEAN_EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("date", T.DateType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("device", T.StringType()),
    T.StructField("session_id", T.LongType()),
])

# The raw columns that hold numbers, and what stands for a missing value in each.
NULL_TOKENS = {f.name: MISSING_NUMBER for f in RAW_EVENT_SCHEMA.fields if isinstance(f.dataType, T.NumericType)}

CLEAN_COLUMNS = tuple(f.name for f in CLEAN_EVENT_SCHEMA.fields)
