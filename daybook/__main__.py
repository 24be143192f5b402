"""Command line: build the report for an events file or folder.

    python -m daybook events.csv                  # → report.json
    python -m daybook events/ --out my.json
    python -m daybook events.parquet --format parquet
    python -m daybook events.csv --tables s3a://bucket/report_tables/

Exit code 1 when the input does not exist, holds a malformed or missing id,
or leaves no valid row, as the reference's command line does.  ``--chunksize`` is accepted for
compatibility and ignored: Spark reads large inputs as splits anyway
(``spark.sql.files.maxPartitionBytes``).
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.errors import AnalysisException

log = logging.getLogger("daybook")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m daybook",
                                description="Build the analytics report from raw events")
    p.add_argument("events", help="events file or folder (CSV or parquet)")
    p.add_argument("--out", default="report.json", help="local JSON output path [report.json]")
    p.add_argument("--format", choices=["csv", "parquet"], default=None,
                   help="input format (default: from the suffix, else csv)")
    p.add_argument("--chunksize", type=int, default=None, help="ignored (splits are automatic)")
    p.add_argument("--tables", default=None,
                   help="also write every section as a parquet table under this folder")
    p.add_argument("--master", default=None, help="Spark master (default: spark-submit's)")
    p.add_argument("--log-level", default="INFO", choices=["DEBUG", "INFO", "WARNING", "ERROR"],
                   help="logging verbosity [INFO]")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    logging.basicConfig(level=args.log_level, format="%(asctime)s %(levelname)s %(message)s")
    from daybook.plans.report import build_report
    from daybook.session import get_session
    from daybook.sources.files import read_events
    from daybook.sources.sinks import save_document

    spark = get_session(args.master)
    try:
        report = build_report(read_events(spark, args.events, args.format))
        save_document(report.document(), args.out)
        if args.tables:
            report.write_tables(args.tables)
        report.release()
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            log.error("events not found: %s", args.events)
            return 1
        raise
    except ValueError as exc:
        log.error("report error: %s", exc)
        return 1
    except Exception as exc:            # a FAILFAST parse error: malformed input
        if "MALFORMED" not in str(exc).upper():
            raise
        log.error("malformed input: %s", str(exc).splitlines()[0])
        return 1
    log.info("report written to %s", args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
