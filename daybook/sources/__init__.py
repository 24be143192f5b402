"""Event sources (CSV, parquet, driver fixtures) and sinks."""

from daybook.sources.files import (
    quarantine,
    read_events,
    read_events_csv,
    read_events_parquet,
    union_in_order,
    with_file_order,
)
from daybook.sources.sinks import save_document, write_events_csv, write_report_json

__all__ = [
    "quarantine",
    "read_events",
    "read_events_csv",
    "read_events_parquet",
    "save_document",
    "union_in_order",
    "with_file_order",
    "write_events_csv",
    "write_report_json",
]
