"""Command-line job: hit files in, dated revenue report out.

    spark-submit refyield/job.py --input s3a://bucket/hits/ --output s3a://bucket/reports/ \\
        [--run-date 2024-03-05] [--format tab|parquet] [--session-keys ip,user_agent] \\
        [--no-lookahead] [--coupled] [--strict-header] [--strict-host] [--strict-revenue] \\
        [--money double|decimal] [--top-k 100] [--single-file] [--replace] [--escapes] \\
        [--state s3a://bucket/session-state/] \\
        [--quarantine s3a://bucket/bad-lines/] [--drop-malformed]

``--strict`` is the three strict switches at once. ``--output`` and
``--log-level`` default to the environment's OUTPUT_DIR and LOG_LEVEL.
Arguments that a launcher adds and the job does not know are ignored.

``--state`` names a folder that keeps what is known of each session: the input is
then the hits of ``--run-date``, added once, and the report is that of all days added.
``--replace`` keeps the report of the same name until the new one is written.

``--quarantine`` writes a copy of the lines that do not fit the schema and leaves
the report as it is; ``--drop-malformed`` keeps those lines out of the report.

Exits 0 on success, also when no purchase is credited (the report is then
empty), and 1 on any failure, so schedulers see failed runs.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Observation, SparkSession  # noqa: E402

from refyield.operators.days import SessionDays  # noqa: E402
from refyield.operators.report import keyword_revenue, ranked  # noqa: E402
from refyield.session import get_spark  # noqa: E402
from refyield.sinks.report import default_run_date, write_report  # noqa: E402
from refyield.sources.hits import read_hits, split_corrupt  # noqa: E402

log = logging.getLogger("refyield.job")


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Revenue per search engine and keyword")
    p.add_argument("--input", required=True, nargs="+", help="hit files, directories or globs")
    p.add_argument("--output", default=os.environ.get("OUTPUT_DIR", "output/"), help="output directory (any Hadoop file system)")
    p.add_argument("--run-date", default=None, help="YYYY-mm-dd for the report name (default: today, UTC)")
    p.add_argument("--format", choices=("tab", "parquet"), default="tab")
    p.add_argument("--session-keys", default="ip", help="comma-separated session key columns")
    p.add_argument("--no-lookahead", action="store_true", help="credit only purchases after the first search")
    p.add_argument("--coupled", action="store_true", help="take engine and keyword from the same hit")
    p.add_argument("--strict", action="store_true", help="all three strict switches")
    p.add_argument("--strict-header", action="store_true", help="fail on a file whose header differs from the schema")
    p.add_argument("--strict-host", action="store_true", help="drop only one www. before the engine")
    p.add_argument("--strict-revenue", action="store_true", help="plain numbers only")
    p.add_argument("--money", choices=("double", "decimal"), default="double", help="decimal: exact cents")
    p.add_argument("--top-k", type=int, default=None, help="keep only the k best rows")
    p.add_argument("--single-file", action="store_true", help="one part file (bounded reports only)")
    p.add_argument("--replace", action="store_true", help="write beside the report of the same name, then switch over (tab)")
    p.add_argument("--escapes", action="store_true", help="keep line breaks of keywords escaped on one line (tab)")
    p.add_argument("--state", default=None, help="folder of session states: add the input as the day --run-date, report all days")
    p.add_argument("--quarantine", default=None, help="write a copy of the lines that do not fit the schema here")
    p.add_argument("--drop-malformed", action="store_true", help="keep those lines out of the report")
    p.add_argument("--log-level", default=os.environ.get("LOG_LEVEL", "INFO").upper())
    return p.parse_known_args(argv)[0]


def observed(seen: Observation) -> dict:
    """The observed counts; zeros where Spark reports none (an empty result)."""
    try:
        counts = seen.get
    except Exception:
        log.debug("no observed counts", exc_info=True)
        counts = {}
    return {k: counts.get(k) or 0 for k in ("attributed_sessions", "attributed_purchases")}


def run(spark: SparkSession, args: argparse.Namespace) -> str:
    """Build and write the report; return the written path."""
    keys = tuple(k.strip() for k in args.session_keys.split(",") if k.strip())
    strict_header = args.strict or args.strict_header
    hits = read_hits(spark, args.input, strict=strict_header, keep_corrupt=args.drop_malformed)
    if args.drop_malformed:
        hits, _ = split_corrupt(hits)
    if args.quarantine:
        _, bad = split_corrupt(read_hits(spark, args.input, strict=strict_header, keep_corrupt=True))
        bad.write.mode("overwrite").options(sep="\t", header="true", escape='"').csv(args.quarantine)
    rules = {
        "lookahead": not args.no_lookahead,
        "coupled": args.coupled,
        "strict": args.strict or args.strict_host,
        "strict_revenue": args.strict or args.strict_revenue,
        "money": args.money,
    }
    seen = Observation("attribution")
    if args.state:
        days = SessionDays(spark, args.state, keys, **rules)
        if not days.add(args.run_date or default_run_date(), hits):
            log.warning("the day is already in %s and was not added again", args.state)
        report = days.report()
    else:
        report = keyword_revenue(hits, keys, observation=seen, **rules)
    path = write_report(
        ranked(report, args.top_k),
        args.output,
        run_date=args.run_date,
        fmt=args.format,
        single_file=args.single_file,
        mode="replace" if args.replace else "overwrite",
        escapes=args.escapes,
    )
    log.info("report written to %s; %s", path, f"days {days.days()}" if args.state else observed(seen))
    return path


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    logging.basicConfig(level=args.log_level, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    own = SparkSession.getActiveSession() is None
    spark = get_spark(app_name="refyield-report")
    try:
        run(spark, args)
        return 0
    except Exception:
        log.exception("report failed")
        return 1
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    sys.exit(main())
