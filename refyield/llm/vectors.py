"""Operator 1: embedding near-duplicates by cross-polytope hashing.

Vectors of one label link if their cosine is 0.98 or more.

1. Equal vectors of a label are one class, represented once.
2. A vector, padded to a power of two, is rotated by three rounds of random signs
   and a fast Hadamard transform; its hash is the signed axis it comes closest to.
   ``HASHES`` such hashes make a code, in each of ``TABLES`` tables. The vector
   stands under its code and the ``PROBES`` - 1 next best codes, which take the
   second or third closest axes for some of the hashes.
3. The pairs of a bucket are verified by cosine in double precision; those that
   reach the threshold join vectors into components.
4. In each component all pairs are compared once, which gives the exact numbers
   of links between vectors that are found linked.

Buckets and components are cut into blocks and every pair of blocks is work of
its own. More hashes a code keep buckets small as the rows grow; the table of
codes costs ``TABLES * PROBES`` numbers a vector, and only vectors that share a
bucket are moved to it.

Defined results: vectors that are null, zero or empty, or hold null or non-finite
components, and vectors with a null label link with nothing; vectors of different
lengths never link; repeated rows are linked copies (their cosine is 1); an empty
table gives an empty one. Only id, vector and label are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refyield.llm.blocks import columns, dealt, group_edges, in_block_pairs, whole_groups
from refyield.llm.common import map_arrow, staged, table
from refyield.llm.components import components

THRESHOLD = 0.98
TABLES, HASHES, PROBES, SEED = 10, 3, 6, 1
BLOCK = 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of each row (its length a power of two)."""
    x = x.copy()
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, -1, 2, step)
        first, second = y[:, :, 0], y[:, :, 1]
        total = first + second
        np.subtract(first, second, out=second)
        first[...] = total
        step *= 2
    return x


def closest_axes(y: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, closeness) of the ``most`` signed axes closest to each row, best
    first; axis i + d is the negative of axis i."""
    d = y.shape[1]
    if most > d:  # an axis and its negative may both be among them
        both = np.concatenate([y, -y], axis=1)
        best = np.argsort(-both, axis=1, kind="stable")[:, :most]
        return best, np.take_along_axis(both, best, 1)
    size = np.abs(y)
    best = np.argpartition(size, d - most, axis=1)[:, d - most :]
    order = np.argsort(-np.take_along_axis(size, best, 1), axis=1, kind="stable")
    best = np.take_along_axis(best, order, 1)
    return best + d * (np.take_along_axis(y, best, 1) < 0), np.take_along_axis(size, best, 1)


class CrossPolytope:
    """Codes of vectors of one length."""

    def __init__(self, dims: int, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES, seed: int = SEED):
        self.dims, self.tables, self.hashes, self.probes = dims, tables, hashes, probes
        self.size = 1 << max(0, dims - 1).bit_length()
        rng = np.random.default_rng([seed, dims])
        # codes are made in single precision; pairs are verified in doubles
        self.signs = rng.choice([-1.0, 1.0], (tables, hashes, 3, self.size)).astype(np.float32)
        self.choices = np.array(list(product(range(min(3, 2 * self.size)), repeat=hashes)))
        self.factors = rng.integers(1, 2**62, (tables, hashes), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def codes(self, unit: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """(n, tables * probes) bucket numbers; ``salt`` (the label) tells equal
        codes of different labels apart."""
        n = len(unit)
        padded = np.zeros((n, self.size), np.float32)
        padded[:, : self.dims] = unit
        out = np.empty((n, self.tables, self.probes), np.uint64)
        probes = min(self.probes, len(self.choices))
        for t in range(self.tables):
            cost = np.zeros((n, len(self.choices)))
            code = np.zeros((n, len(self.choices)), np.uint64)
            for h in range(self.hashes):
                y = padded
                for signs in self.signs[t, h]:
                    y = hadamard(y * signs)
                best, close = closest_axes(y, self.choices.max() + 1)
                close = close.astype(float) / self.size**1.5
                cost += (close[:, :1] - close)[:, self.choices[:, h]] ** 2
                code += (best.astype(np.uint64) * self.factors[t, h])[:, self.choices[:, h]]
            first = np.argsort(cost, axis=1, kind="stable")[:, :probes]
            first = np.pad(first, ((0, 0), (0, self.probes - probes)), mode="edge")
            out[:, t] = np.take_along_axis(code, first, 1) + np.uint64(t * 0x9E3779B97F4A7C15 & (2**64 - 1))
        mixed = out.reshape(n, -1) ^ (salt.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(self.dims))[:, None]
        mixed = (mixed ^ (mixed >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return (mixed ^ (mixed >> np.uint64(33))).view(np.int64)


MAY_LINK = """label IS NOT NULL AND size(v) > 0 AND exists(v, x -> x <> 0)
    AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"""


def _plain(vectors: DataFrame, id_col: str, vector: str, label: str) -> DataFrame:
    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))


def hashed(vectors: DataFrame, id_col: str, vector: str, label: str, hasher: type = CrossPolytope) -> DataFrame:
    """-> (id, label, key, unit, codes) for vectors that may link: the unit vector
    in doubles as binary, and the md5 of label and vector as key."""
    source = _plain(vectors, id_col, vector, label).filter(MAY_LINK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, CrossPolytope] = {}
        for batch in batches:
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                rows = batch.take(pa.array(np.flatnonzero(sizes == d)))
                x = rows.column(2).flatten().to_numpy().reshape(-1, d) + 0.0  # no negative zeros
                labels = rows.column(1).to_numpy()
                keys = [hashlib.md5(f"{a}:".encode() + v.tobytes()).digest() for a, v in zip(labels.tolist(), x, strict=True)]
                x = x / np.abs(x).max(axis=1, keepdims=True)
                unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                codes = made.setdefault(d, hasher(d)).codes(unit, labels)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(keys, pa.binary()), pa.array([u.tobytes() for u in unit], pa.binary()), pa.array(list(codes), pa.list_(pa.int64()))],
                    names=["id", "label", "key", "unit", "codes"],
                )

    return map_arrow(source, run, "id long, label long, key binary, unit binary, codes array<long>")


def _linked(t: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of one pair of blocks that link."""
    blk, lo, hi = columns(t, ["blk", "lo", "hi"])
    label = t.column("label").to_numpy()
    units = t.column("unit").to_pylist()
    sizes = np.array([len(u) for u in units])
    pairs = []
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        x = np.frombuffer(b"".join(units[i] for i in rows.tolist()), np.float64).reshape(len(rows), -1)
        one = lo[0] == hi[0]
        first, second = (rows, rows) if one else (rows[blk[rows] == lo[0]], rows[blk[rows] == hi[0]])
        a, b = (x, x) if one else (x[blk[rows] == lo[0]], x[blk[rows] == hi[0]])
        l, r = np.nonzero((a @ b.T >= threshold) & (label[first][:, None] == label[second][None, :]))
        keep = l < r if one else slice(None)
        pairs.append((first[l[keep]], second[r[keep]]))
    left, right = (np.concatenate(p) for p in zip(*pairs, strict=True))
    return left, right


def verified(members: DataFrame, group: str, whole: DataFrame, threshold: float) -> DataFrame:
    """(group, key) and (key, label, unit, copies) -> (key, peer, links), for each
    pair of blocks: the copies that a vector links with and one it is joined to."""
    pairs = in_block_pairs(members, group, "key", BLOCK).join(whole, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, group):
            out: tuple[list, list, list] = ([], [], [])
            stops = [*starts[1:].tolist(), t.num_rows]
            for start, stop in zip(starts.tolist(), stops, strict=True):
                g = t.slice(start, stop - start).combine_chunks()
                left, right = _linked(g, threshold)
                if not len(left):
                    continue
                keys, copies = g.column("key").to_pylist(), g.column("copies").to_numpy()
                links = np.bincount(left, copies[right], len(keys)) + np.bincount(right, copies[left], len(keys))
                peer = dict(zip(*group_edges(keys, left, right), strict=True))
                for k, n in zip(keys, links.tolist(), strict=True):
                    if n:
                        out[0].append(k)
                        out[1].append(peer.get(k, k))
                        out[2].append(int(n))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int64())], names=["key", "peer", "links"])

    return map_arrow(dealt(pairs, group), run, "key binary, peer binary, links long")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD, hasher: type = CrossPolytope) -> DataFrame:
    """One row a vector: id, n_links, component_id (least id reachable), kept."""
    rows = staged(hashed(vectors, id_col, vector, label, hasher), "vectors-hashed")
    classes = staged(rows.groupBy("key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("unit").alias("unit"), F.first("codes").alias("codes")), "vectors-classes")
    whole = classes.select("key", "label", "unit", "copies")
    buckets = classes.select("key", F.explode(F.array_distinct("codes")).alias("bucket"))
    found = verified(buckets, "bucket", whole, threshold)
    groups = components(found.select(F.col("key").alias("a"), F.col("peer").alias("b")))
    members = staged(groups.withColumnRenamed("node", "key"), "vectors-members")
    counts = verified(members, "root", whole, threshold).groupBy("key").agg(F.sum("links").alias("links"))
    known = classes.select("key", "rep", "copies").join(members, "key", "left").join(counts, "key", "left").withColumn("root", F.coalesce("root", "key"))
    known = staged(known, "vectors-known")
    least = staged(known.groupBy("root").agg(F.min("rep").alias("least")), "vectors-least")
    facts = staged(known.join(least, "root").select("key", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("links")), "vectors-facts")
    linked = rows.select("id", "key").join(facts, "key").select("id", "links", "least")
    rest = _plain(vectors, id_col, vector, label).filter(f"NOT coalesce({MAY_LINK}, false)")
    rest = rest.select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("least"))
    return linked.unionByName(rest).select(
        F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("least").alias("component_id"), F.col("id").eqNullSafe(F.col("least")).alias("kept")
    )


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings: links, components and the vector kept of each."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
