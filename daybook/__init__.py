"""daybook — a Spark-first engine for cleaning event logs and reporting daily metrics.

Every operator is a DataFrame/SQL transform that Catalyst plans; only day-,
country- or cohort-sized results ever leave the executors.
"""

from daybook.operators.clean import clean_counts, clean_events, clean_with_counts, tag_rules
from daybook.operators.metrics import (
    anomalies,
    daily_facts,
    dau,
    funnel_daily,
    retention_d1,
    revenue_daily,
    top_countries,
    user_days,
)
from daybook.operators.quality import (
    dirty_profile,
    event_type_distribution,
    exact_median,
    purchase_amount_sketch,
    purchase_amount_stats,
    refund_integrity,
    refund_links,
    refund_witnesses,
)
from daybook.operators.staged import stage_events
from daybook.plans.incremental import ReportHistory
from daybook.plans.report import Report, build_report
from daybook.plans.snapshot import snapshot_report
from daybook.session import checkpoint_root, get_session, use_utc
from daybook.sources.files import quarantine, read_events, read_events_csv, read_events_parquet

__all__ = [
    "Report",
    "ReportHistory",
    "anomalies",
    "build_report",
    "checkpoint_root",
    "clean_counts",
    "clean_events",
    "clean_with_counts",
    "daily_facts",
    "dau",
    "dirty_profile",
    "event_type_distribution",
    "exact_median",
    "funnel_daily",
    "get_session",
    "purchase_amount_sketch",
    "purchase_amount_stats",
    "quarantine",
    "read_events",
    "read_events_csv",
    "read_events_parquet",
    "refund_integrity",
    "refund_links",
    "refund_witnesses",
    "retention_d1",
    "revenue_daily",
    "snapshot_report",
    "stage_events",
    "tag_rules",
    "top_countries",
    "use_utc",
    "user_days",
]
