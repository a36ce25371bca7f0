"""Write hit tables: tab-separated text, Parquet by day, Parquet by session."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refyield.functions.escapes import escape
from refyield.operators.ranking import PLACE, RANGE, sorted_ranges
from refyield.operators.sessions import TIME, key_columns, key_names, normalize_keys
from refyield.sinks.versions import replace
from refyield.sources.hits import FIRST_KEYS, HIT_COLUMNS, SESSION_RANGES

_TSV = {
    "sep": "\t",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# URLs drop line breaks when they are parsed; other texts keep a blank for them.
_URLS = ("page_url", "referrer")


def write_hits(hits: DataFrame, path: str, *, mode: str = "overwrite", escapes: bool = False) -> str:
    """Write the ``HIT_SCHEMA`` columns in schema order, one part file per task.

    Hit files hold one record a line, so that they stay splittable: line breaks
    inside a value are written as a blank (in URLs: dropped). With ``escapes``
    they, NULL and empty texts are written as in ``refyield.functions.escapes``,
    and ``read_hits(..., escapes=True)`` gives back every value as it was.
    """
    kinds = dict(hits.dtypes)

    def one_line(c: str) -> Column:
        return escape(c) if escapes else F.translate(c, "\r\n", "" if c in _URLS else "  ")

    hits.select(*[one_line(c).alias(c) if kinds[c] == "string" else F.col(c) for c in HIT_COLUMNS]).write.mode(mode).options(**_TSV).csv(path)
    return path


def utc_day(time: Column) -> Column:
    """The UTC day of seconds since 1970, whatever the session's time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(time / 86400).cast("int"))


def write_hits_by_date(hits: DataFrame, path: str, *, mode: str = "overwrite", rows_per_file: int = 1_000_000, files_per_date: int | None = None) -> str:
    """Write hits as Parquet partitioned by ``hit_date`` (UTC day of ``hit_time_gmt``).

    Readers that filter on ``hit_date`` then list and scan only those
    partitions (see ``read_hits_parquet``); hits without a time go to the
    null partition. The days are counted first (a scan of the times alone), and a
    day's rows are dealt by a hash to as many files, and tasks, as its count asks
    for. ``files_per_date`` sets one number for all days instead. Only the dates
    present in ``hits`` are replaced on overwrite.
    """
    dated = hits.select(*HIT_COLUMNS, utc_day(F.col("hit_time_gmt")).alias("hit_date"))
    files = F.ceil(F.count(F.lit(1)) / rows_per_file) if files_per_date is None else F.lit(files_per_date)
    counted = dated.groupBy(F.col("hit_date").alias("__date")).agg(files.alias("__files"))
    dealt = dated.join(F.broadcast(counted), F.col("hit_date").eqNullSafe(F.col("__date")))  # a row a day
    salt = F.pmod(F.xxhash64(*HIT_COLUMNS), F.col("__files"))
    (
        dealt.withColumn("__salt", salt)
        .repartition("hit_date", "__salt")
        .drop("__date", "__files", "__salt")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("hit_date")
        .parquet(path)
    )
    return path


def write_hits_by_session(hits: DataFrame, path: str, keys: str | Sequence[str] = ("ip",), *, rows_per_file: int = 1_000_000) -> str:
    """Write hits as Parquet in files of neighbouring sessions, for ``session_hits``.

    Hits are sorted by session and time over all files, each a range of its own; a
    hot session takes several. Beside them stands a row for each range with the key
    that it begins with, so that a reader opens only the ranges a session can be
    in; in these, Parquet's own statistics and Bloom filters leave off row groups.
    A table that is there is replaced whole (``refyield.sinks.versions``).
    """
    keys = normalize_keys(keys)
    names = key_names(keys)
    rows = hits.select(*HIT_COLUMNS, *key_columns(keys))
    ranges = max(1, math.ceil(hits.count() / rows_per_file))
    ordered = sorted_ranges(rows, [*map(F.col, names), F.col(TIME).asc_nulls_first()], ranges)

    def write(folder: str) -> None:
        out = ordered.withColumnRenamed(RANGE, "range").write.partitionBy("range")
        for k in keys:
            out = out.option(f"parquet.bloom.filter.enabled#{k}", "true")
        out.parquet(f"{folder}/{SESSION_RANGES}")
        schema = ordered.withColumnRenamed(RANGE, "range").schema
        written = hits.sparkSession.read.schema(schema).parquet(f"{folder}/{SESSION_RANGES}")
        written.filter(F.col(PLACE) == 0).select("range", *names).coalesce(1).write.parquet(f"{folder}/{FIRST_KEYS}")

    return replace(hits.sparkSession, path, write).rsplit("/", 1)[0]
