"""Connected components of a link table, as Spark jobs.

Large star and small star alternate (each node links its larger neighbours, then
its smaller ones, to the least it knows) until nothing changes; the rounds grow
with the logarithm of the longest chain. The minima are written before they are
joined back, so that both sides of the join come from a shuffle of their own and
adaptive execution can split the rows of a node with very many links. Every
round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refyield.llm.common import staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(a, b) -> (node, root): the least node reachable from each linked node.

    Null ends and links of a node to itself are left out; a table without links
    gives no rows.
    """
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter(F.col("a") != F.col("b")).distinct()
    edges = staged(edges, "links")
    state = _summary(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = _star(both, F.col("b") > F.col("a"), keep_self=False)
        edges = staged(_star(edges, F.lit(True), keep_self=True).distinct(), "links")
        new = _summary(edges)
        if new == state:
            break
        state = new
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _summary(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, which, keep_self: bool) -> DataFrame:
    """Link the chosen neighbours ``b`` of each ``a`` to the least of all (with
    ``keep_self``: and ``a`` itself)."""
    least = staged(edges.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("_a"), F.least("a", "_m").alias("_m")), "least")
    hung = edges.filter(which).join(least, F.col("a") == F.col("_a")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
    if keep_self:
        hung = hung.unionByName(least.select(F.col("_a").alias("a"), F.col("_m").alias("b")))
    return hung.filter(F.col("a") != F.col("b"))
