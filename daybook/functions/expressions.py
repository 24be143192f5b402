"""Scalar expressions, as Spark SQL text and as ``Column`` objects.

The cleaning projection is written as SQL text (``selectExpr``): it is one
parse instead of hundreds of client round trips, and the expressions still
compile into one whole-stage-codegen span.  The ``Column`` helpers wrap the
same text with ``F.expr`` so every rule has one definition.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.schema import AMOUNT_ATOL, AMOUNT_RTOL, UNKNOWN_COUNTRY, WHITESPACE


def sql_text(value: str) -> str:
    """A Spark SQL string literal for any text.

    Printable ASCII is written as is; quotes, backslashes and every other
    character are ``\\uXXXX`` escapes, so control and Unicode whitespace
    survive the SQL parser intact.
    """
    def esc(c: str) -> str:
        return c if (" " <= c <= "~" and c not in "'\\") else f"\\u{ord(c):04x}"
    return "'" + "".join(esc(c) for c in value) + "'"


# A calendar month or day, alone or followed by a time of day, and the zones
# that may end a time.
_DATE = r"[0-9]{4}-[0-9]{1,2}(-[0-9]{1,2})?"
_ZONE = r"(Z|UTC|GMT|[+-][0-9]{1,2}(:?[0-9]{2}){0,2})"


def parse_utc_timestamp_sql(col: str, source_type: T.DataType) -> str:
    """Rule D1a: text → UTC instant; anything unparseable becomes null.

    A text must start with a year and month: a time of day alone, which a
    cast would complete with today's date, and a bare number such as
    ``2023`` are not timestamps.  Texts without a zone are UTC; the zone is
    spelled out before the cast, so the session's zone has no part in it.
    ``try_cast`` never throws under ANSI mode.
    """
    if isinstance(source_type, T.TimestampType):
        return col
    text = f"trim(CAST({col} AS STRING))"
    # a cast takes a zone after seconds only
    whole = f"regexp_replace({text}, {sql_text(f'([ T][0-9]{{1,2}}:[0-9]{{1,2}})({_ZONE})?$')}, '$1:00$2')"
    date, timed, zoned = (sql_text(f"^{_DATE}{rest}$") for rest in ("", "[ T].*", f"[ T].*{_ZONE}"))
    whole = (f"CASE WHEN {text} RLIKE {date} THEN "
             f"{text} || CASE WHEN length({text}) < 8 THEN '-01' ELSE '' END || ' 00:00:00Z' "
             f"WHEN {text} RLIKE {zoned} THEN {whole} "
             f"WHEN {text} RLIKE {timed} THEN {whole} || 'Z' END")
    return f"try_cast({whole} AS TIMESTAMP)"


def utc_date_sql(ts: str) -> str:
    """The UTC calendar day of an instant, whatever the session's zone."""
    return f"date_from_unix_date(CAST(floor(unix_micros({ts}) / 86400000000) AS INT))"


def parse_utc_timestamp(col: str, source_type: T.DataType) -> Column:
    return F.expr(parse_utc_timestamp_sql(col, source_type))


def normalise_country_sql(col: str) -> str:
    """Rule D2: missing → UNK, then upper-case, then strip all whitespace.

    Empty text counts as missing (CSV reads it as null), so parquet and CSV
    inputs agree.  A whitespace-only value becomes '' — the fill happens
    before the strip, as in the reference.  "Whitespace" is every character
    Python's ``str.strip`` removes.
    """
    return (f"btrim(upper(coalesce(nullif({col}, ''), {sql_text(UNKNOWN_COUNTRY)})), "
            f"{sql_text(WHITESPACE)})")


def normalise_country(col: str) -> Column:
    return F.expr(normalise_country_sql(col))


def round_half_even(x: Column, digits: int) -> Column:
    """numpy.round semantics: scale, round half to even, unscale."""
    scale = float(10 ** digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def round_half_even_sql(x: str, digits: int) -> str:
    """numpy.round semantics in SQL text (the double literal keeps it double)."""
    return f"rint({x} * 1e{digits}) / 1e{digits}"


def safe_ratio_sql(num: str, den: str, digits: int = 4) -> str:
    """num/den rounded half-even; 0.0 unless the denominator is positive."""
    ratio = round_half_even_sql(f"CAST({num} AS DOUBLE) / {den}", digits)
    return f"CASE WHEN {den} > 0 THEN {ratio} ELSE 0D END"


def money(x: Column) -> Column:
    """Money is reported with two decimals."""
    return F.round(x, 2)


def amounts_close(a: Column, b: Column) -> Column:
    """numpy.isclose(a, b, atol=1e-4): |a - b| <= atol + rtol * |b|."""
    return F.abs(a - b) <= F.lit(AMOUNT_ATOL) + F.lit(AMOUNT_RTOL) * F.abs(b)
