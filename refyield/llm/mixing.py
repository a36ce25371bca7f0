"""Operator 5: mixing sources to target weights by Sainte-Lague apportionment
(DataFrame functions only).

1. Each source's target: its weight's share of all words, at most ``max_repeat``
   times the source's own words; what a source cannot take is shared again by
   weight (one closed form over the sorted ratios cap / weight).
2. The mix is cut into blocks of ``block`` words. Blocks go to sources by the
   highest quotients ``target / (2 s + 1)``, then each source's blocks to its
   shards by the same rule, which gives integer quotas. All seats that any
   divisor close to the mean grants are granted at once; only the (at most two
   a party) seats between the two bounding divisors are ranked by quotient.
3. In a shard the documents stand in seeded order as one stream of words. Shard and
   order come from a hash of id and text, so that rows that share an id, or have
   none, are dealt and told apart; rows equal in both are interchangeable. A
   quota of q over N blocks takes q div N whole passes and a run of q mod N
   further blocks from a seeded start, round the end. A document takes the words
   of its own stretch of the stream that lie in chosen blocks: all or none, but
   for the documents at the run's ends. No join of documents and blocks is needed.

A source has as many shards as it has multiples of ``shard_rows`` rows, so a hot
source is dealt to as many more tasks. Defined results: a null or blank text
has size 0 and takes nothing; a null source is a source of its own, last in
order; repeated rows each count; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refyield.llm.common import staged, table, text_or_empty

#: Fixed value of the contract: what a word is.
WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 16
SHARD_ROWS = 2_000
MAX_REPEAT = 3
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sources: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size) -> and ``weight``, ``cap``, ``target``.

    One row per source; the window over them has no partition, as there are few
    sources beside the documents.
    """
    ranked = sources.withColumn("_pos", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = ranked.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_pos") % len(weights) + 1).cast("int"))
    ).withColumn("cap", F.lit(float(max_repeat)) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "_pos")
    all_rows = Window.partitionBy()
    level = (
        F.sum("source_size").over(all_rows).cast("double")
        - F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ) / F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # the first source, by ratio, whose cap lies above the level stops the filling
    found = weighed.withColumn("_level", level).withColumn("_open", F.col("cap") > F.col("_level") * F.col("weight"))
    final = F.min(F.when(F.col("_open"), F.struct(F.col("cap") / F.col("weight"), F.col("_pos"), F.col("_level")))).over(all_rows)
    return found.withColumn(
        "target", F.round(F.least(F.col("cap"), F.coalesce(final["_level"] * F.col("weight"), F.col("cap"))), 6)
    ).drop("_pos", "_level", "_open")


def apportion(parties: DataFrame, group: Sequence[str], party: Sequence[str], votes: str, seats: str, out: str) -> DataFrame:
    """Add ``out``: each party's seats of the ``seats`` of its group, by the
    highest quotients ``votes / (2 s + 1)`` (ties: by ``party`` order)."""
    g = Window.partitionBy(*group)
    v, n = F.col(votes).cast("double"), F.count(F.lit(1)).over(g)
    t = F.col(seats).cast("double")
    total = F.sum(F.col(votes).cast("double")).over(g)
    high = F.when(t - n / 2 > 0, total / (t - n / 2))
    sure = F.when((v > 0) & high.isNotNull(), F.floor(v / high + 0.5)).otherwise(F.lit(0))
    most = F.when(v > 0, F.floor(v * (t + n / 2) / total + 0.5) + 1).otherwise(F.lit(0))
    bounded = parties.withColumns({"_sure": sure.cast("long"), "_most": most.cast("long")})
    bounded = bounded.withColumn("_left", F.col(seats) - F.sum("_sure").over(g))
    seat = F.explode(F.expr("CASE WHEN _most > _sure THEN sequence(_sure, _most - 1) ELSE array() END"))
    open_seats = bounded.select(
        *group, *party, "_left", v.alias("_v"), seat.alias("_s")
    )
    best = Window.partitionBy(*group).orderBy((F.col("_v") / (2 * F.col("_s") + 1)).desc(), *[F.col(p).asc_nulls_last() for p in party])
    won = (
        open_seats.withColumn("_r", F.row_number().over(best))
        .filter(F.col("_r") <= F.col("_left"))
        .groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate([*group, *party])])
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*group, *party])]
    joined = bounded.join(won, same, "left")
    return joined.withColumn(out, F.col("_sure") + F.coalesce("_won", F.lit(0))).drop(
        "_sure", "_most", "_left", "_won", *[f"_k{i}" for i in range(len(same))]
    )


def hash_long(*parts: Column) -> Column:
    """52 bits of the md5 of the joined parts, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long")


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), block: int = BLOCK, shard_rows: int = SHARD_ROWS, max_repeat: int = MAX_REPEAT, seed: str = SEED, tie: str | None = None) -> DataFrame:
    """(doc_id, source, size) -> and source_size, target, taken.

    ``tie``: a string column that tells apart rows of one doc_id (a text's md5, say).

    ``docs`` is read three times, for the sums by source, by shard and for the
    stream of each shard, so it should be a table rather than a count over texts.
    """
    ties = [F.col(tie)] if tie else []
    doc_hash = hash_long(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), *ties)
    totals = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    shards = F.ceil(F.col("_rows") / shard_rows).cast("long")
    sources = targets(totals, weights, max_repeat).withColumn("_shards", shards)
    all_rows = Window.partitionBy()
    seats = F.floor(F.sum("source_size").over(all_rows) / block + 0.5).cast("long")
    sources = apportion(sources.withColumn("_seats", seats), [], ["source"], "target", "_seats", "_quota")
    # written, so that its size is known: broadcast if it is small, else a join
    # whose hot source adaptive execution can split
    facts = staged(sources.select(F.col("source").alias("_source"), "source_size", "target", "_shards", "_quota"), "mix-sources")

    placed = docs.withColumn("_hash", doc_hash).join(facts, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = placed.withColumn("_shard", F.col("_hash") % F.col("_shards"))
    sizes = placed.groupBy("source", "_shard").agg(F.sum("size").alias("_words"), F.first("_quota").alias("_quota"))
    quotas = apportion(sizes, ["source"], ["_shard"], "_words", "_quota", "_share")
    blocks = F.ceil(F.col("_words") / block).cast("long")
    quotas = quotas.select(
        F.col("source").alias("_s"), F.col("_shard").alias("_h"), blocks.alias("_n"), F.least(F.col("_share"), max_repeat * blocks).alias("_q")
    )
    order = Window.partitionBy("source", "_shard").orderBy("_hash", "doc_id", "size", *ties)
    stream = placed.withColumn("_end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    start = F.expr("pmod(_start_hash, greatest(_n, 1L))")
    chosen = stream.join(quotas, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("_h"))).withColumn(
        "_start_hash", hash_long(F.lit(seed), F.lit("start"), F.coalesce("source", F.lit("null")), F.col("_shard"))
    )
    chosen = chosen.withColumns({"_phase": start, "_r": F.expr("_q % greatest(_n, 1L)"), "_passes": F.expr("_q div greatest(_n, 1L)")})

    def below(x: str) -> Column:
        """Words before position ``x`` of the stream that lie in chosen blocks: a run
        of blocks from the phase on, and from the start where it passes the end."""
        return F.expr(
            f"""greatest(0L, least({x}, (_phase + _r) * {block}) - _phase * {block})
            + least({x}, greatest(0L, (_phase + _r - _n) * {block}))"""
        )

    taken = F.col("_passes") * F.col("size") + below("_end") - below("_end - size")
    return chosen.withColumn("taken", taken.cast("long")).drop(
        "_hash", "_shards", "_quota", "_shard", "_s", "_h", "_n", "_q", "_end", "_start_hash", "_phase", "_r", "_passes"
    )


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by the weights 1, 2, 3 (repeating) of their sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(text_or_empty()).alias("size"), F.md5(text_or_empty()).alias("_text"))
    return mix(staged(docs, "mix-sizes"), tie="_text").select("doc_id", "size", "source_size", "target", "taken")


def _apportion_sql(src: str, group: str, party: str, votes: str, seats: str) -> str:
    """Sainte-Lague by plain enumeration of the quotients."""
    part = f"PARTITION BY {group}" if group else ""
    on = " AND ".join(f"a.{c} IS NOT DISTINCT FROM w.{c}" for c in [*([group] if group else []), party])
    keys = ", ".join([*([group] if group else []), party])
    return f"""(SELECT a.*, coalesce(w.won, 0) AS quota FROM {src} a LEFT JOIN (
      SELECT {keys}, count(*) AS won FROM (
        SELECT {keys}, {seats} AS seats, row_number() OVER ({part} ORDER BY {votes} / (2 * s + 1) DESC, {party} NULLS LAST) AS r
        FROM (SELECT *, unnest(range(0, CASE WHEN {votes} > 0 THEN {seats} ELSE 0 END)) AS s FROM {src}))
      WHERE r <= seats GROUP BY {keys}) w ON {on})"""


_BELOW = "(greatest(0, least({x}, (phase + r) * {b}) - phase * {b}) + least({x}, greatest(0, (phase + r - n) * {b})))"


def _hash_sql(parts: str) -> str:
    return f"CAST(concat('0x', substr(md5(concat_ws('|', {parts})), 1, 13)) AS BIGINT)"


OP5_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(coalesce(text, '')) AS tie, {_hash_sql(f"'{SEED}', coalesce(CAST(doc_id AS VARCHAR), 'null'), md5(coalesce(text, ''))")} AS h
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_rows,
         1.0 * ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1) AS weight
  FROM d GROUP BY source),
-- words poured at the level of each source's ratio, then the rest above the last level reached
lvl AS (
  SELECT a.cap / a.weight AS lv, sum(least(b.cap, a.cap / a.weight * b.weight)) AS poured
  FROM (SELECT *, 3.0::DOUBLE * source_size AS cap FROM src) a, (SELECT *, 3.0::DOUBLE * source_size AS cap FROM src) b
  GROUP BY a.source, a.cap, a.weight),
base AS (SELECT coalesce(max(lv), 0) AS lv, coalesce(max(poured), 0) AS poured FROM lvl WHERE poured <= (SELECT sum(source_size) FROM src)),
tgt AS (
  SELECT source, round(least(3.0::DOUBLE * source_size, weight * (SELECT lv + coalesce(((SELECT sum(source_size) FROM src) - poured)
           / (SELECT nullif(sum(weight), 0) FROM src WHERE 3.0::DOUBLE * source_size / weight > lv), 0) FROM base)), 6) AS target
  FROM src),
s1 AS (
  SELECT src.source, source_size, target, CAST(ceil(n_rows / {SHARD_ROWS}) AS BIGINT) AS shards,
         CAST(floor((SELECT sum(size) FROM d) / {BLOCK} + 0.5) AS BIGINT) AS seats
  FROM src JOIN tgt ON src.source IS NOT DISTINCT FROM tgt.source),
s2 AS (SELECT * FROM {_apportion_sql("s1", "", "source", "target", "seats")}),
p AS (SELECT d.*, s2.source_size, s2.target, h % shards AS shard, s2.quota AS source_quota FROM d JOIN s2 ON d.source IS NOT DISTINCT FROM s2.source),
z1 AS (SELECT source, shard, sum(size)::BIGINT AS words, any_value(source_quota) AS source_quota FROM p GROUP BY source, shard),
z2 AS (SELECT * FROM {_apportion_sql("z1", "source", "shard", "words", "source_quota")}),
z3 AS (
  SELECT source, shard, CAST(ceil(words / {BLOCK}) AS BIGINT) AS n, least(quota, {MAX_REPEAT} * CAST(ceil(words / {BLOCK}) AS BIGINT)) AS q,
         {_hash_sql(f"'{SEED}', 'start', coalesce(source, 'null'), CAST(shard AS VARCHAR)")} AS start_hash
  FROM z2),
e AS (
  SELECT p.*, q % greatest(n, 1) AS r, q // greatest(n, 1) AS passes, start_hash % greatest(n, 1) AS phase, n,
         CAST(sum(size) OVER (PARTITION BY p.source, p.shard ORDER BY h, doc_id NULLS FIRST, size, tie ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop
  FROM p JOIN z3 ON p.source IS NOT DISTINCT FROM z3.source AND p.shard = z3.shard)
SELECT doc_id, size, source_size, target,
       CAST(passes * size + {_BELOW.format(x="stop", b=BLOCK)} - ({_BELOW.format(x="stop - size", b=BLOCK)}) AS BIGINT) AS taken
FROM e
"""
