"""Comparing all rows of a group in bounded tasks.

A group is cut into blocks of rows; every pair of blocks is work of its own, so
that a group of any size is spread over the cluster and only the links
found (at most one a row and task) leave the workers, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refyield.llm.common import staged


def in_block_pairs(rows: DataFrame, group: str, order: str, block_rows: int, size: str | None = None, block_size: int = 1) -> DataFrame:
    """Rows of groups of two and more, once for each pair of blocks that their
    block is in: adds ``lo``, ``hi`` (the pair) and ``blk`` (the row's block).

    A group has as many blocks as it holds multiples of ``block_rows`` rows, and of
    ``block_size`` of ``size``; the hash of ``order`` deals its rows to them. The
    groups' sizes are written first, so that no task needs to see a whole group and
    adaptive execution can split a large one's rows in the join.
    """
    blocks = F.ceil(F.col("_n") / block_rows)
    if size:
        blocks = F.greatest(blocks, F.ceil(F.col("_size") / block_size))
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.sum(size if size else F.lit(0)).alias("_size")).filter("_n > 1")
    groups = staged(sizes.select(F.col(group).alias("_g"), blocks.cast("int").alias("_blocks")), "groups")
    placed = rows.join(groups, F.col(group) == F.col("_g")).withColumn("blk", F.pmod(F.xxhash64(order), F.col("_blocks")).cast("int"))
    other = placed.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return other.withColumns({"lo": F.least("blk", "_o").cast("int"), "hi": F.greatest("blk", "_o").cast("int")}).drop("_g", "_blocks", "_o")


def dealt(pairs: DataFrame, group: str) -> DataFrame:
    """Rows of a pair of blocks side by side in one partition."""
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(n, group, "lo", "hi").sortWithinPartitions(group, "lo", "hi", "blk")


def whole_groups(batches: Iterator[pa.RecordBatch], group: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete pairs of blocks, and where each begins."""
    held: pa.Table | None = None
    for batch in (b.slice(i, 2048) for b in batches for i in range(0, b.num_rows, 2048)):
        new = pa.Table.from_batches([batch])
        held = new if held is None else pa.concat_tables([held, new])
        starts = _starts(held, group)
        if len(starts) > 1:
            yield held.slice(0, int(starts[-1])).combine_chunks(), starts[:-1]
            held = held.slice(int(starts[-1])).combine_chunks()
    if held is not None:
        yield held.combine_chunks(), _starts(held, group)


def _starts(t: pa.Table, group: str) -> np.ndarray:
    changed = np.zeros(t.num_rows, bool)
    changed[0] = True
    for c in (group, "lo", "hi"):
        col = t.column(c).combine_chunks()
        changed[1:] |= pc.not_equal(col[1:], col[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(changed)


def row_pairs(starts: np.ndarray, blk: np.ndarray, lo: np.ndarray, hi: np.ndarray, most: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (l, r) to compare in each pair of blocks, some at a time: all
    pairs of one block, or each row of ``lo`` with each of ``hi``."""
    n = len(blk)
    ends = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    row = np.arange(n)
    same = lo == hi
    in_lo = blk == lo
    first_hi = np.repeat(starts + np.add.reduceat(in_lo.astype(np.int64), starts), np.diff(np.append(starts, n)))
    begin = np.where(same, row + 1, np.where(in_lo, first_hi, ends))
    counts = ends - begin
    upto = np.cumsum(counts)
    at = 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, "right")))
        c = counts[at:stop]
        left = np.repeat(row[at:stop], c)
        if len(left):
            shift = np.arange(len(left)) - np.repeat(np.cumsum(c) - c, c)
            yield left, np.repeat(begin[at:stop], c) + shift
        at = stop


def least_linked(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least row that each row is linked to, over any number of links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while (deeper := new[new]).tolist() != new.tolist():
            new = deeper
        if (new == label).all():
            return label
        label = new


def group_edges(keys: list, left: np.ndarray, right: np.ndarray) -> tuple[list, list]:
    """Links (a, b) that join the linked rows, at most one a row."""
    rows = np.unique(np.concatenate([left, right]))
    label = least_linked(len(rows), np.searchsorted(rows, left), np.searchsorted(rows, right))
    hung = np.flatnonzero(label != np.arange(len(rows)))
    return [keys[i] for i in rows[hung].tolist()], [keys[i] for i in rows[label[hung]].tolist()]


def columns(t: pa.Table, names: Sequence[str]) -> list[np.ndarray]:
    return [t.column(c).to_numpy() for c in names]
