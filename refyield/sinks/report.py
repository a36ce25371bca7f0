"""Write the revenue report as tab-separated text or partitioned Parquet.

One Spark writer serves every scheme (local, ``hdfs://``, ``s3a://``,
``gs://``...); nothing is collected to the driver. The tab-separated form is
a directory named ``YYYY-mm-dd_SearchKeywordPerformance.tab`` holding part
files with a header line each; ``single_file=True`` coalesces to one part
file (the final stage then runs in one task, so keep it for reports whose
size is bounded, such as a top-k).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from refyield.functions.escapes import escape, unescape
from refyield.operators.report import HEADINGS, with_headings
from refyield.sinks.versions import current_folder, replace

# Fixed value: the report's name after its date.
REPORT_SUFFIX = "_SearchKeywordPerformance.tab"

REPORT_SCHEMA = StructType(
    [
        StructField("Search Engine Domain", StringType(), True),
        StructField("Search Keyword", StringType(), True),
        StructField("Revenue", DoubleType(), True),
    ]
)

_TSV = {
    "sep": "\t",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    # Spark's writer strips blanks at both ends unless told not to
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


_TEXTS = (HEADINGS[0][1], HEADINGS[1][1])
_RANK = (HEADINGS[2][1], HEADINGS[0][1], HEADINGS[1][1])


def default_run_date() -> str:
    """Today's date in UTC, ``YYYY-mm-dd``."""
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d")


def report_path(out_dir: str, run_date: str | None = None) -> str:
    return f"{out_dir.rstrip('/')}/{run_date or default_run_date()}{REPORT_SUFFIX}"


def write_report(
    report: DataFrame,
    out_dir: str,
    *,
    run_date: str | None = None,
    fmt: str = "tab",
    single_file: bool = False,
    mode: str = "overwrite",
    escapes: bool = False,
) -> str:
    """Write ``report`` (``search_domain, search_keyword, revenue``); return the path.

    ``fmt="tab"``: published headings, tab-separated, ``"`` quoting with
    doubled quotes (reads back with ``read_report``). ``fmt="parquet"``: a
    ``run_date`` partition below ``out_dir``; only that date's partition is
    replaced on overwrite, when all files are written.

    ``mode="replace"`` (tab) writes to a new folder below the report's and then names
    it in a manifest: a run that fails leaves the report before it, which
    ``read_report`` goes on reading. ``escapes=True`` keeps a keyword with line
    breaks on one line, so that readers can split the files.
    """
    run_date = run_date or default_run_date()
    if fmt == "tab":
        path = report_path(out_dir, run_date)
        out = with_headings(report)
        if single_file:
            # coalesce promises no order among the partitions it merges
            out = out.coalesce(1).sortWithinPartitions(*[F.col(f"`{c}`").desc_nulls_last() if c == HEADINGS[2][1] else F.col(f"`{c}`").asc_nulls_first() for c in _RANK])
        if escapes:
            out = out.withColumns({c: escape(F.col(f"`{c}`")) for c in _TEXTS})
        if mode == "replace":
            replace(report.sparkSession, path, lambda folder: out.write.options(**_TSV).csv(folder))
        else:
            out.write.mode(mode).options(**_TSV).csv(path)
        return path
    if fmt == "parquet":
        out = report.withColumn("run_date", F.lit(run_date))
        (
            out.write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_date")
            .parquet(out_dir)
        )
        return f"{out_dir.rstrip('/')}/run_date={run_date}"
    raise ValueError(f"unknown report format: {fmt!r}")


def read_report(spark: SparkSession, path: str, *, escapes: bool = False) -> DataFrame:
    """Read a tab-separated report back, with its published headings.

    Keywords may hold line breaks, so records may span lines (``multiLine``: a
    report file is read by one task). Reports written with ``escapes`` do not, and
    their files are split among tasks. Of a report that was replaced, the newest
    version is read.
    """
    folder = current_folder(spark, path) or path
    report = spark.read.schema(REPORT_SCHEMA).options(**_TSV, multiLine=str(not escapes).lower()).csv(folder)
    return report.withColumns({c: unescape(F.col(f"`{c}`")) for c in _TEXTS}) if escapes else report


def read_report_plain(spark: SparkSession, path: str, *, escapes: bool = False) -> DataFrame:
    """Read a tab-separated report back with snake_case column names."""
    df = read_report(spark, path, escapes=escapes)
    return df.select(*[F.col(f"`{dst}`").alias(src) for src, dst in HEADINGS])
