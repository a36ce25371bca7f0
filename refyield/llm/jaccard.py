"""Operator 10: n-gram Jaccard join with Bayesian pruning.

Texts link if the sets of their five-word shingles have a Jaccard similarity of
0.8 or more.

1. Equal texts are one class (by the md5 of the text), represented once.
2. Each text has 160 MinHash values of 8 bits; 32 bands of 5 values bucket it. A
   pair at the threshold shares no bucket with probability 3e-6.
3. In each bucket pairs are compared 32 values at a time. After each step a pair
   is dropped if the probability that its similarity reaches the threshold, given
   the values that agree (uniform prior; two different shingles agree by chance
   once in 256), is below 1e-6. The pairs that remain join texts into clusters.
4. In each cluster all pairs are pruned the same way, on the values alone, and rows
   without a pair left are dropped from that pair of blocks. What remains is
   verified on the whole shingle sets. Links are counted where they are found, and
   classes are the components of the verified links. A cluster may be a chain of
   texts under the threshold; comparing values then costs it little, and its texts
   are not fetched.

Buckets and clusters are cut into blocks and every pair of blocks is work of its
own, so no group meets in one task and no pair leaves a worker. Only texts that
have a pair to verify move: a Bloom filter of their keys, of bounded size, picks
them where the table is read; they go once to their class and once more to each
pair of blocks that has such a pair.

Defined results: a null text links with nothing and is a class of its own row;
texts without words are linked with equal texts only; one to four words are one
shingle; repeated rows are copies of each other; a class without doc_ids has a
null id; an empty table gives an empty one. Only the key and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refyield.llm.blocks import columns, dealt, group_edges, in_block_pairs, row_pairs, whole_groups
from refyield.llm.common import map_arrow, one_of_each, row_keys, ship_package, staged, table
from refyield.llm.components import components
from refyield.llm.decontamination import bloom_filter, passes
from refyield.llm.shingles import MinHash, folded, shingle_set

THRESHOLD, TOLERANCE = 0.8, 1e-6
BANDS, BAND_ROWS, STEP, SEED = 32, 5, 32, 10
VALUES = BANDS * BAND_ROWS
#: Rows of a block in buckets and in clusters; characters of a block in clusters.
BUCKET_BLOCK, CLUSTER_BLOCK, CLUSTER_CHARS = 512, 256, 16_000_000
HASHER = MinHash(VALUES, SEED)


def needed_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """After each step of values: the fewest agreements with which the posterior
    probability of reaching the threshold is at least the tolerance."""
    t = threshold + (1 - threshold) / 256
    out = {}
    for n in range(STEP, VALUES + 1, STEP):
        tail = 0.0
        for m in range(n + 1):
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if tail >= tolerance:
                out[n] = m
                break
    return out


def surviving(signs: np.ndarray, left: np.ndarray, right: np.ndarray, needed: dict[int, int]) -> np.ndarray:
    """Which of the row pairs may still reach the threshold."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for n, least in needed.items():
        part = slice(n - STEP, n)
        matches[alive] += (signs[left[alive], part] == signs[right[alive], part]).sum(axis=1)
        alive = alive[matches[alive] >= least]
        if not len(alive):
            break
    return alive


def text_key(text: str = "text"):
    return F.unhex(F.md5(F.col(text)))


def signatures(texts: DataFrame) -> DataFrame:
    """(key, text) -> (key, sign, n_chars), one row a key, for texts with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bytes] = {}
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            out: tuple[list, list, list] = ([], [], [])
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key not in known:
                    if len(known) > 20_000:
                        known.clear()
                    low = HASHER.minima(text)
                    known[key] = folded(low, np.uint8).tobytes() if text.split(None, 1) else b""
                    if known[key]:
                        out[0].append(key)
                        out[1].append(known[key])
                        out[2].append(len(text))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int64())], names=["key", "sign", "n_chars"])

    signed = map_arrow(texts.select("key", "text"), run, "key binary, sign binary, n_chars long")
    return signed.groupBy("key").agg(F.first("sign").alias("sign"), F.first("n_chars").alias("n_chars"))


def _signs(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("sign").to_pylist()), np.uint8).reshape(-1, VALUES)


def candidate_edges(signs: DataFrame, needed: dict[int, int]) -> DataFrame:
    """(key, sign) -> (a, b): links that join the pairs which survive in buckets."""
    bands = [
        F.conv(F.hex(F.substring("sign", i * BAND_ROWS + 1, BAND_ROWS)), 16, 10).cast("long") + F.lit(i << 8 * BAND_ROWS) for i in range(BANDS)
    ]
    buckets = signs.select("key", F.explode(F.array(*bands)).alias("bucket"))
    members = in_block_pairs(buckets, "bucket", "key", BUCKET_BLOCK).join(signs.select("key", "sign"), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, "bucket"):
            keys, rows = t.column("key").to_pylist(), _signs(t)
            for left, right in row_pairs(starts, *columns(t, ["blk", "lo", "hi"])):
                alive = surviving(rows, left, right, needed)
                if len(alive):
                    a, b = group_edges(keys, left[alive], right[alive])
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return map_arrow(dealt(members, "bucket"), run, "a binary, b binary")


def pairs_left(members: DataFrame, needed: dict[int, int]) -> DataFrame:
    """(root, key, sign, n_chars) of clusters -> (root, lo, hi, blk, key): the rows of
    each pair of blocks with at least one pair that survives there."""
    placed = in_block_pairs(members.select("root", "key", "n_chars", "sign"), "root", "key", CLUSTER_BLOCK, "n_chars", CLUSTER_CHARS)
    names = ["root", "lo", "hi", "blk", "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, "root"):
            rows, kept = _signs(t), np.zeros(t.num_rows, bool)
            for left, right in row_pairs(starts, *columns(t, ["blk", "lo", "hi"])):
                alive = surviving(rows, left, right, needed)
                kept[left[alive]] = kept[right[alive]] = True
            if kept.any():
                yield from t.select(names).filter(pa.array(kept)).to_batches()

    return map_arrow(dealt(placed.select(*names, "sign"), "root"), run, "root binary, lo int, hi int, blk int, key binary")


def may_hold(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose key a Bloom filter of ``keys`` lets pass: all whose
    key is there, few others. Keys alone go to Python."""
    h = F.xxhash64("key")
    bloom = texts.sparkSession.sparkContext.broadcast(bloom_filter(keys.select(h.alias("fp")), keys.count()))
    ship_package(texts.sparkSession)

    @F.pandas_udf("boolean")
    def held(fp: pd.Series) -> pd.Series:
        return pd.Series(passes(bloom.value, fp.to_numpy().view(np.uint64)))

    return texts.filter(held(h))


def verified_links(members: DataFrame, texts: DataFrame, threshold: float, needed: dict[int, int]) -> DataFrame:
    """(root, key, sign, n_chars, copies) of clusters and (key, text) -> (key, peer,
    links): for each pair of blocks, the copies that a text links with and a text
    of its component there."""
    left_over = staged(pairs_left(members, needed), "jaccard-pairs-left")
    keys = left_over.select("key").distinct()
    once = may_hold(texts, keys).groupBy("key").agg(F.first("text").alias("text"))
    whole = members.select("key", "sign", "copies").join(keys, "key").join(once, "key")
    pairs = left_over.join(whole, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, "root"):
            for i, start in enumerate(starts):  # one pair of blocks at a time
                g = t.slice(start, (starts[i + 1] if i + 1 < len(starts) else t.num_rows) - start)
                keys, rows, copies = g.column("key").to_pylist(), _signs(g), g.column("copies").to_numpy()
                sets = None
                found = []
                for left, right in row_pairs(np.zeros(1, np.int64), *columns(g, ["blk", "lo", "hi"])):
                    alive = surviving(rows, left, right, needed)
                    if len(alive):
                        if sets is None:
                            sets = SetTable([shingle_set(x) for x in g.column("text").to_pylist()])
                        found.append(sets.linked(left[alive], right[alive], threshold))
                if not found:
                    continue
                left, right = (np.concatenate(x) for x in zip(*found, strict=True))
                if not len(left):
                    continue
                links = np.bincount(left, copies[right], len(keys)) + np.bincount(right, copies[left], len(keys))
                a, b = group_edges(keys, left, right)
                peer = dict(zip(a, b, strict=True))
                out = [(k, peer.get(k, k), int(n)) for k, n in zip(keys, links.tolist(), strict=True) if n]
                k, p, n = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.binary()), pa.array(p, pa.binary()), pa.array(n, pa.int64())], names=["key", "peer", "links"])

    return map_arrow(dealt(pairs, "root"), run, "key binary, peer binary, links long")


class SetTable:
    """Shingle sets of some texts, numbered for fast intersections."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        _, number = np.unique(np.concatenate(sets), return_inverse=True)
        self.sets = np.split(number, np.cumsum(self.sizes)[:-1])
        self.mark = np.zeros(int(number.max()) + 1, bool)

    def linked(self, left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """The row pairs whose Jaccard similarity reaches the threshold."""
        keep = np.zeros(len(left), bool)
        order = np.argsort(left, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(left[order])) + 1):
            own, others = self.sets[left[part[0]]], right[part]
            self.mark[own] = True
            joined = self.mark[np.concatenate([self.sets[j] for j in others.tolist()])]
            common = np.add.reduceat(joined.astype(np.int64), np.cumsum(self.sizes[others]) - self.sizes[others])
            self.mark[own] = False
            union = len(own) + self.sizes[others] - common
            keep[part] = common >= threshold * union - 1e-9
        return left[keep], right[keep]


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, text) -> (doc_id, key, class_id, n_links, kept): class_id is the
    least doc_id of the class, n_links counts the other rows that a row links
    with, kept marks the class's first row by (doc_id, key)."""
    needed = needed_matches(threshold, tolerance)
    keyed = docs.select("doc_id", text_key().alias("key"), "text")
    texts = keyed.filter("text IS NOT NULL")
    classes = staged(texts.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "jaccard-classes")
    signs = staged(signatures(texts), "jaccard-signs")
    clusters = components(candidate_edges(signs, needed))
    members = clusters.select(F.col("node").alias("key"), "root").join(signs, "key").join(classes.select("key", "copies"), "key")
    links = staged(verified_links(staged(members, "jaccard-clusters"), texts.select("key", "text"), threshold, needed), "jaccard-links")
    counts = links.groupBy("key").agg(F.sum("links").alias("links"))
    groups = components(links.select(F.col("key").alias("a"), F.col("peer").alias("b")))
    member = classes.join(groups.withColumnRenamed("node", "key"), "key", "left").join(counts, "key", "left")
    member = staged(member.withColumn("root", F.coalesce("root", "key")), "jaccard-members")
    firsts = staged(member.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull(), "rep", "key")).alias("first")), "jaccard-firsts")
    table_ = staged(
        member.join(firsts, "root").select("key", "first", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links")),
        "jaccard-table",
    ).withColumnRenamed("key", "_key")
    placed = keyed.select("doc_id", "key").join(table_, F.col("key") == F.col("_key"), "left")
    return placed.select(
        "doc_id",
        "key",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("first")["rep"]).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("key").isNull() | (F.col("doc_id").eqNullSafe(F.col("first")["rep"]) & (F.col("key") == F.col("first")["key"]))).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, one of each class (its first by doc_id); of repeated rows
    one stays. Null texts stay."""
    kept = jaccard_classes(docs).filter("kept AND key IS NOT NULL")
    kept = kept.select(row_keys()["_d"].alias("_d"), F.lower(F.hex("key")).alias("_k")).distinct()
    chosen = one_of_each(docs.filter("text IS NOT NULL"), docs.columns).join(kept, ["_d", "_k"], "left_semi")
    return chosen.select(*docs.columns).unionByName(docs.filter("text IS NULL"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: their classes and numbers of links."""
    return jaccard_classes(table(spark, sf_dir, "documents")).drop("key")
