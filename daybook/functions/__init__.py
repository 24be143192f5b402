"""Column expressions shared by the operators (all built-in, JVM-side)."""

from daybook.functions.expressions import (
    amounts_close,
    money,
    normalise_country,
    normalise_country_sql,
    parse_utc_timestamp,
    parse_utc_timestamp_sql,
    round_half_even,
    round_half_even_sql,
    safe_ratio_sql,
    sql_text,
)

__all__ = [
    "amounts_close",
    "money",
    "normalise_country",
    "normalise_country_sql",
    "parse_utc_timestamp",
    "parse_utc_timestamp_sql",
    "round_half_even",
    "round_half_even_sql",
    "safe_ratio_sql",
    "sql_text",
]
