"""The rank of every row of a table, without a window over the whole table.

Rows are dealt into ranges of the order and each range is sorted by one task, as
for a global sort; a row's place in its range is then added to the number of
rows in the ranges before it. Those counts are a table of one row a range.

Rows that tie in the order are told apart by a number that is drawn once and
written with them, so that a third of all rows may tie and are still dealt over
ranges, and a task that runs again finds the same order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refyield.session import scratch_path

RANGE, PLACE = "__range", "__place"
_TIE, _BEFORE, _ROWS = "__tie", "__before", "__rows"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sorted_ranges(df: DataFrame, order: Sequence[Column], ranges: int | None = None, seed: int = 1) -> DataFrame:
    """``df`` dealt into ``ranges`` sorted ranges of ``order`` (by default as many as
    the session's shuffle partitions), plus the number of a row's range and its
    place in it, from 0. Both hold within one run alone: write them before use."""
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fixed = written(df.withColumn(_TIE, F.rand(seed)), "range-rows")
    dealt = fixed.repartitionByRange(ranges, *order, _TIE).sortWithinPartitions(*order, _TIE).drop(_TIE)
    # monotonically_increasing_id counts a task's rows in its lower 33 bits
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return dealt.withColumns({RANGE: F.spark_partition_id(), PLACE: place})


def by_ranges(df: DataFrame, order: Sequence[Column], ranges: int | None = None) -> DataFrame:
    """``sorted_ranges``, written."""
    return written(sorted_ranges(df, order, ranges), "ranges")


def with_rank(df: DataFrame, order: Sequence[Column], name: str = "rank", ranges: int | None = None) -> DataFrame:
    """``df`` plus the long ``name``: 1, 2, 3, ... by ``order``, ties in any order.

    Runs when called: ranks need the counts of all ranges.
    """
    placed = by_ranges(df, order, ranges)
    counts = placed.groupBy(RANGE).agg(F.count(F.lit(1)).alias(_ROWS))
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = counts.select(RANGE, F.coalesce(F.sum(_ROWS).over(before), F.lit(0)).alias(_BEFORE))
    ranked = placed.join(F.broadcast(offsets), RANGE)
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(_BEFORE) + F.col(PLACE) + 1).cast("long").alias(name))
