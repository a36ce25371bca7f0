"""Operator 2: sharding by weighted rendezvous hashing (DataFrame functions only).

Each record key draws one hash per shard; the shard with the smallest
``-ln(u) / weight`` holds it. A key's choice among the old shards does not
depend on a new one, so a grown shard set takes records only into the shards
that were added, each in proportion to its weight.

Defined results: a null key is one key of its own; repeated keys share a
shard; a null text has size 1 and crc 0; an empty table gives an empty one.
Input columns other than the key and the text are not read, so clashing names
do no harm.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refyield.llm.common import table, text_or_empty

SEED = "shard"
SHARDS = 16
#: Hash blocks in each shard: slots are numbered block by block, so that no
#: task orders a whole shard. It bounds the offset table to shards x blocks rows.
BLOCKS = 256


def unit_hash(*parts: Column) -> Column:
    """A double in (0, 1) from 52 bits of the md5 of the joined parts."""
    head = F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double")
    return (head + F.lit(0.5)) / F.lit(float(2**52))


def key_text(key: Column) -> Column:
    return F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))


def rendezvous_shard(key: Column, weights: Sequence[float], seed: str = SEED) -> Column:
    """The shard (0 ..) of ``key`` among ``len(weights)`` shards, as an int column."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    draws = [
        F.struct((-F.log(unit_hash(F.lit(seed), F.lit(str(i)), key_text(key))) / F.lit(float(w))).alias("score"), F.lit(i).alias("shard"))
        for i, w in enumerate(weights)
    ]
    return F.array_min(F.array(*draws))["shard"]


def shard_slots(records: DataFrame, key: str, weights: Sequence[float], order: Sequence[str] = (), grown: Sequence[float] | None = None, seed: str = SEED, blocks: int = BLOCKS) -> DataFrame:
    """Add ``shard``, ``slot`` (gapless from 0 in each shard) and ``grown_shard``
    (the shard under the weights ``grown``; null without them).

    Slots run by hash block, then key, then the ``order`` columns. The counts of
    the blocks come from a scan of the key column alone.
    """
    k = F.col(key)
    block = F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.lit("block"), key_text(k))), 1, 8), 16, 10).cast("long"), F.lit(blocks)).cast("int")
    placed = records.withColumns({"shard": rendezvous_shard(k, weights, seed), "_block": block})
    counts = placed.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("shard", "_block").orderBy(k, *order)
    grown_col = F.lit(None).cast("int") if grown is None else rendezvous_shard(k, grown, seed)
    numbered = placed.withColumns({"_rank": F.row_number().over(inside) - 1, "grown_shard": grown_col})
    # at most shards x blocks rows
    return numbered.join(F.broadcast(offsets), ["shard", "_block"]).withColumn("slot", F.col("_first") + F.col("_rank")).drop("_first", "_rank", "_block")


def op2_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 15 by the law ``key``."""
    text = text_or_empty().cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text_or_empty()) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = shard_slots(docs, "doc_id", [1.0] * SHARDS, ["text_crc32", "size"], grown=[1.0] * (SHARDS + 1))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"
    )


def _shard_sql(n: int) -> str:
    draws = ", ".join(
        "struct_pack(score := -ln((CAST(CAST(concat('0x', substr(md5(concat('shard|', '" + str(i) + "|', k)), 1, 13)) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0), shard := " + str(i) + ")"
        for i in range(n)
    )
    return f"list_min([{draws}]).shard"


OP2_SQL = f"""
WITH RECURSIVE poly(i, j, c) AS (
  SELECT range::BIGINT, 0, range::BIGINT FROM range(256)
  UNION ALL
  SELECT i, j + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM poly WHERE j < 8),
lut AS (SELECT list(c ORDER BY i) AS t FROM poly WHERE j = 8),
d AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
         [4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
            lambda x: CAST(concat('0x', x) AS BIGINT)) AS b,
         coalesce('k' || CAST(doc_id AS VARCHAR), 'null') AS k
  FROM documents),
c AS (
  SELECT doc_id, size, k,
         xor(list_reduce(b, lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS BIGINT) + 1])), 4294967295) AS text_crc32
  FROM d, lut),
s AS (
  SELECT doc_id, size, text_crc32, {_shard_sql(SHARDS)} AS shard, {_shard_sql(SHARDS + 1)} AS grown_shard,
         CAST(concat('0x', substr(md5(concat('shard|block|', k)), 1, 8)) AS BIGINT) % {BLOCKS} AS block
  FROM c)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY block, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       grown_shard
FROM s
"""
