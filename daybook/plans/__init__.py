"""Multi-operator plans: the report (M7) and its snapshots (Q5)."""

from daybook.plans.incremental import ReportHistory, Update
from daybook.plans.report import Report, build_report, report_from_rollup, report_rollup
from daybook.plans.snapshot import snapshot_report, source_fingerprint

__all__ = ["Report", "ReportHistory", "Update", "build_report", "report_from_rollup", "report_rollup", "snapshot_report",
           "source_fingerprint"]
