"""Operator 13: centroid clustering with a vantage-point tree over the centroids.

Vectors are turned into whole numbers, floor(scale * x), and all that follows is
exact. ``K`` centroids start as the vectors with the smallest hashes of their ids.
In each round the driver builds a vantage-point tree over the centroids and sends
it to the tasks. A task finds each vector's nearest centroid by best-first branch
and bound and adds vectors up by centroid; Spark adds up the tasks' sums, ``K`` x
dimensions numbers, from which the driver makes the next centroids.

The tree: a node holds a vantage point, and the centroids within the median
distance of it and those beyond, each side with its least and greatest distance.
A vector at distance d of the vantage point is no nearer to a side's centroids than
max(least - d, d - greatest). Each vector visits its nodes in the order of
that bound, and leaves off a node only if its bound, less a margin for rounded
roots, is beyond the best distance so far: a bound that equals it is followed, since
a centroid of a smaller number may be as near. Distances at nodes and leaves are
whole numbers; of equal ones the smaller number wins. Vectors of a batch take their
steps together, each at a node of its own.

Numbers are held in doubles where every square sum stays under 2^53, else as Python
integers; sums travel in limbs of 40 bits. So no size of component, no order of rows
and no number of tasks changes a result.

Defined results: vectors that are null, of another length, or hold null or non-finite
components (after scaling in doubles, too) are left out; repeated rows count each for
itself; of equal hashes the vector that comes first component by component starts the
smaller centroid; a null id is hashed as ``null``; with fewer than ``K`` vectors there
are as many centroids; a centroid that loses its vectors stays where it is;
distances and sums beyond a long are given as the greatest long; an empty table gives
an empty one. Only id and vector are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refyield.llm.common import map_arrow, staged, table

K, ROUNDS, DIMENSIONS, SCALE, SEED = 16, 3, 64, 64, 1
LEAF, LIMB, LONG = 2, 40, 2**63 - 1
#: Roots are rounded: bounds are taken this much lower.
MARGIN = 1e-9


def exact(rows: np.ndarray, largest: float) -> np.ndarray:
    """Whole numbers held in doubles, or as Python integers where sums of squared
    differences of numbers up to ``largest`` could pass 2^53."""
    if rows.shape[1] * (2 * largest) ** 2 < 2**53 or rows.dtype == object:
        return rows
    return np.array([[int(x) for x in r] for r in rows.tolist()], object).reshape(rows.shape)


def squares(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Squared distances of rows to a point."""
    d = rows - point
    return (d * d).sum(axis=1) if d.dtype == object else np.einsum("ij,ij->i", d, d)


def roots(x: np.ndarray) -> np.ndarray:
    return np.sqrt(x.astype(float))


class VantageTree:
    """Nearest of ``centroids`` (rows of Python integers)."""

    def __init__(self, centroids: list[list[int]]):
        self.largest = float(max((abs(x) for c in centroids for x in c), default=0))
        self.points = np.array(centroids, object)
        #: (centroids held, [(child, least, greatest root)])
        self.nodes: list[tuple[list[int], list[tuple[int, float, float]]]] = []
        if centroids:
            self._build(list(range(len(centroids))))

    def _build(self, members: list[int]) -> int:
        node = len(self.nodes)
        self.nodes.append((members, []))
        if len(members) <= LEAF:
            return node
        vantage, rest = members[0], np.array(members[1:])
        away = squares(self.points[rest], self.points[vantage])
        order = np.argsort(away, kind="stable")
        sides = []
        for side in np.array_split(order, 2):
            if len(side):
                far = roots(away[side])
                sides.append((self._build(rest[side].tolist()), float(far.min()), float(far.max())))
        self.nodes[node] = ([vantage], sides)
        return node

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance) of whole-number rows."""
        top = max(self.largest, float(np.abs(rows).max(initial=0)))
        x = exact(rows, top)
        points = self.points if x.dtype == object else self.points.astype(float)
        n = len(x)
        number = np.full(n, len(points))
        best = np.full(n, math.inf, x.dtype)
        bound = np.full((n, len(self.nodes)), np.inf)
        bound[:, 0] = 0.0
        active = np.arange(n)
        while len(active):
            node = bound[active].argmin(axis=1)
            low = bound[active, node]
            # inclusive: a bound that equals the best distance is followed
            go = np.isfinite(low) & (low * (1 - MARGIN) <= roots(best[active]))
            active, node, low = active[go], node[go], low[go]
            bound[active, node] = np.inf
            for k in np.unique(node).tolist():
                here = node == k
                who = active[here]
                held, sides = self.nodes[k]
                for c in held:
                    d = squares(x[who], points[c])
                    better = (d < best[who]) | ((d == best[who]) & (c < number[who]))
                    best[who[better]], number[who[better]] = d[better], c
                if sides:
                    far = roots(d)  # of the vantage point
                    for child, least, greatest in sides:
                        bound[who, child] = np.maximum(low[here], np.maximum(least - far, far - greatest) - MARGIN * (far + greatest))
        return number, best


def whole_numbers(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """-> (vec_id, v): floor(scale * x) of the vectors kept, as doubles."""

    def floored(x):
        y = x * F.lit(float(scale))
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)

    v = F.transform(F.col(vector).cast("array<double>"), floored)
    fits = f"size(v) = {dimensions} AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(fits)


def first_centroids(rows: DataFrame, k: int = K, seed: int = SEED) -> list[list[int]]:
    """The ``k`` vectors with the smallest hashes of their ids."""
    name = F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))
    chosen = rows.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), name), 256), "v").limit(k).collect()
    return [[int(x) for x in r.v] for r in chosen]


def _rows_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, limb) of a whole number; the last limb bears the sign."""
    place = 0
    while not -(1 << LIMB - 1) <= value < 1 << LIMB - 1:
        yield place, value & (1 << LIMB) - 1
        place, value = place + 1, value >> LIMB
    yield place, value


def moved(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round."""
    tree = rows.sparkSession.sparkContext.broadcast(VantageTree(centroids))
    k, dimensions = len(centroids), len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows_of(batch)
            number, _ = tree.value.nearest(x)
            x = exact(x, float(np.abs(x).max()))
            for c in np.unique(number).tolist():
                mine = x[number == c]
                total = np.array([int(s) for s in mine.sum(axis=0)] + [len(mine)], object)
                sums[c] = sums[c] + total if c in sums else total
        out = [(c, i, place, part) for c, total in sums.items() for i, s in enumerate(total) for place, part in limbs(s)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["cluster", "i", "place", "part"])

    parts = map_arrow(rows.select("vec_id", "v"), run, "cluster int, i int, place int, part long")
    totals = [[0] * (dimensions + 1) for _ in range(k)]
    # k x dimensions numbers, a few limbs each
    for r in parts.groupBy("cluster", "i", "place").agg(F.sum("part").alias("part")).collect():
        totals[r.cluster][r.i] += r.part << (LIMB * r.place)
    tree.destroy()
    return [[s // t[-1] for s in t[:-1]] if t[-1] else old for t, old in zip(totals, centroids, strict=True)]


def assigned(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """-> (vec_id, cluster, distance), the square of the distance."""
    tree = rows.sparkSession.sparkContext.broadcast(VantageTree(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                number, best = tree.value.nearest(_rows_of(batch))
                distance = pa.array([min(int(d), LONG) for d in best.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number, pa.int32()), distance], names=["vec_id", "cluster", "distance"])

    return map_arrow(rows.select("vec_id", "v"), run, "vec_id long, cluster int, distance long")


def clusters(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", *, k: int = K, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """-> (vec_id, cluster, distance) of the vectors kept, and the final centroids."""
    rows = staged(whole_numbers(vectors, id_col, vector, dimensions, scale), "clustering-vectors")
    centroids = first_centroids(rows, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(rows, centroids)
    if not centroids:
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    return staged(assigned(rows, centroids), "clustering-assigned"), centroids


def op13_vantage_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of 64 components: nearest of 16 centroids after three rounds."""
    found, centroids = clusters(table(spark, sf_dir, "embeddings"))
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()  # k rows
    inertia = {r.cluster: int(r.inertia) for r in sums}
    facts = [
        (c, min(inertia.get(c, 0), LONG), min(sum(inertia.values()), LONG), hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest())
        for c, centroid in enumerate(centroids)
    ]
    named = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _round_sql(r: int) -> str:
    """Assignment to the centroids ``c{r}`` and the centroids after it."""
    return f"""
a{r} AS MATERIALIZED (
  SELECT r, arg_min(c, d * {K} + c) AS c, min(d) AS d
  FROM (SELECT r, c, CAST(list_inner_product(v, v) - 2 * list_inner_product(v, m) + list_inner_product(m, m) AS HUGEINT) AS d FROM v, c{r})
  GROUP BY r),
s{r} AS (SELECT c, i, floor(sum(x) / count(*)) AS x FROM (SELECT c, unnest(v) AS x, unnest(range({DIMENSIONS})) AS i FROM v JOIN a{r} USING (r)) GROUP BY c, i),
c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(n.m, c{r}.m) AS m FROM c{r} LEFT JOIN (SELECT c, list(x ORDER BY i) AS m FROM s{r} GROUP BY c) n USING (c))"""


#: DuckDB: all distances of all rounds, without a tree. Whole numbers in doubles,
#: exact for components of the size that embeddings have.
OP13_SQL = f"""
WITH k AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}),
v AS MATERIALIZED (SELECT row_number() OVER () AS r, * FROM k),
c0 AS MATERIALIZED (
  SELECT c, v AS m FROM (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), 'null')), v) - 1 AS c, v FROM v) WHERE c < {K}),{','.join(map(_round_sql, range(ROUNDS + 1)))}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       (SELECT sha256(array_to_string(list_transform(m, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) FROM c{ROUNDS} o WHERE o.c = a{ROUNDS}.c) AS centroid_sha256
FROM a{ROUNDS} JOIN v USING (r)
"""
