"""Operator 12: benchmark decontamination by winnowing.

A window is ``SPAN`` (10) consecutive words of a benchmark item; an item of fewer
words is one window. A document word inside any occurrence of a window is hit.

1. Both sides are winnowed alike: of each run of ``SPAN`` words the smallest of
   its hashes of ``GRAM`` (5) words is kept, the last one in a tie. Two equal runs
   keep the same one at the same place, so every shared span of ``SPAN`` words or
   more has a common fingerprint. Windows of fewer words are kept whole, as one
   hash of that many words.
2. The benchmark's fingerprints, with the window that each stands for and its
   place in it, make a table of different windows. A Bloom filter of theirs, of
   ``FILTER_BITS`` at most, is made block by block by Spark and sent to the tasks.
3. One pass over the documents counts words and winnows; fingerprints that pass
   the filter are kept, with the words around them.
4. They are joined to the windows' fingerprints, and a hit is extended: the words
   around it must spell the window out. Filter and hashes decide nothing alone.
5. Hits of a document are merged to the words they cover, and its windows are
   joined to the items that hold them.

The filter keeps the join down to documents that share something with the
benchmark. Spark broadcasts the windows if it measures them to be small, else the
join shuffles and a fingerprint in a third of all documents is split by adaptive
execution. Documents are told apart by a row number, written once, so copies and
null ids meet in no group. Words are bytes: runs of digits, letters and characters
beyond ASCII with A-Z in lower case.

Defined results: a null or empty text has no words and no hits; an item without
words is in no document; items of one id are one item, a null id is named
``null``; repeated documents have a row each; empty tables on either side give
rows without hits, or none. Only ids and texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refyield.llm.common import map_arrow, staged, table
from refyield.llm.wordbytes import WORD_BYTES, WORDS_SQL, pieces, runs_of, texts_of, word_spans

SPAN, GRAM = 10, 5
#: Bits of the filter at most (16 MB) and for each fingerprint; bits of a block of it.
FILTER_BITS, BITS_EACH, BLOCK_BITS = 1 << 27, 32, 1 << 15
BYTES_AT_ONCE = 1 << 20
FACTOR, INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


@lru_cache(4)
def _powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words at ``starts`` to ``ends``: polynomials of their
    bytes, from one running sum over all bytes."""
    if not len(starts):
        return np.empty(0, np.uint64)
    size = 1 << int(len(text)).bit_length()
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _powers(FACTOR, size)[: len(text)], dtype=np.uint64)])
    return _mixed((sums[ends] - sums[starts]) * _powers(INVERSE, size)[starts])


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every ``n`` consecutive words."""
    out = np.full(max(0, len(words) - n + 1), n, np.uint64)
    for i in range(n):
        out = _mixed(out * np.uint64(FACTOR) + words[i : i + len(out)])
    return out


def least_places(grams: np.ndarray, n: int) -> np.ndarray:
    """For every ``n`` consecutive hashes the place of the smallest, the last in a tie."""
    count = max(0, len(grams) - n + 1)
    best, place = grams[:count].copy(), np.arange(count)
    for i in range(1, n):
        other = grams[i : i + count]
        less = other <= best
        best[less], place[less] = other[less], np.flatnonzero(less) + i
    return place


class Words:
    """Words of a run of texts (or of a piece of a long one): their places in the
    translated bytes, hashes, the text each belongs to and its number in it."""

    def __init__(self, joined: bytes, bounds: np.ndarray):
        self.text = joined
        data = np.frombuffer(joined, np.uint8)
        self.starts, self.ends = word_spans(data)
        self.hashes = word_hashes(data, self.starts, self.ends)
        self.owner = np.searchsorted(bounds, self.starts, side="right")
        self.n_words = np.bincount(self.owner, minlength=len(bounds))
        self.number = np.arange(len(self.starts)) - (np.cumsum(self.n_words) - self.n_words)[self.owner]

    def spell(self, start: int, stop: int) -> bytes:
        return b" ".join(self.text[a:b] for a, b in zip(self.starts[start:stop].tolist(), self.ends[start:stop].tolist(), strict=True))

    def inside(self, starts: np.ndarray, n: int) -> np.ndarray:
        """Which runs of ``n`` words lie in one text."""
        return self.owner[starts] == self.owner[starts + n - 1]

    def kept(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, fingerprint, place of the fingerprint) of all runs of ``n``
        words that lie in one text."""
        gram = GRAM if n == SPAN else n
        grams = gram_hashes(self.hashes, gram)
        places = least_places(grams, n - gram + 1)
        starts = np.arange(len(places))
        ok = self.inside(starts, n) if len(starts) else starts.astype(bool)
        return starts[ok], grams[places[ok]], places[ok]


def words_of(texts: list[bytes], size: int = BYTES_AT_ONCE) -> Iterator[tuple[int, int, Words, int]]:
    """(first text, first number, words, words seen before) of runs of texts; a long
    text comes in pieces that begin with the ``SPAN`` - 1 words before them."""
    for first, stop in runs_of(texts, size):
        if stop - first > 1:
            held = [t.translate(WORD_BYTES) for t in texts[first:stop]]
            yield first, 0, Words(b" ".join(held), np.cumsum([len(t) + 1 for t in held])), 0
            continue
        number, before = 0, b""
        for piece in pieces(texts[first].translate(WORD_BYTES), size):
            old = len(before.split())
            w = Words(before + b" " + piece, np.array([len(before) + len(piece) + 1]))
            yield first, number - old, w, old
            number += len(w.starts) - old
            before = w.spell(max(0, len(w.starts) - SPAN + 1), len(w.starts))


def windows(items: DataFrame, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """-> (item, fp, place, n, words): the windows of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.column(0), texts_of(batch.column(1))
            counted = np.array([len(t.translate(WORD_BYTES).split(None, SPAN)) for t in texts])
            for first, _, w, _ in words_of(texts):
                rows: list[tuple] = []
                for n in range(1, SPAN + 1):
                    starts, fps, places = w.kept(n)
                    # an item of fewer words is one window
                    whole = np.minimum(counted[first + w.owner[starts]], SPAN) == n
                    for s, fp, p in zip(starts[whole].tolist(), fps[whole].tolist(), places[whole].tolist(), strict=True):
                        rows.append((first + int(w.owner[s]), fp, p - s, n, w.spell(s, s + n)))
                if rows:
                    at, fp, place, n, spelt = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array(at)), pa.array(np.array(fp, np.uint64).view(np.int64)), pa.array(place, pa.int32()), pa.array(n, pa.int32()), pa.array(spelt, pa.binary())],
                        names=["item", "fp", "place", "n", "words"],
                    )

    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), F.col(text).alias("text"))
    return map_arrow(rows, run, "item string, fp long, place int, n int, words binary")


def _probes(fp: Column, bits: int) -> Column:
    """The filter's bits of a fingerprint, from 1 on."""
    return F.array(*[F.pmod(x, F.lit(bits)) + 1 for x in (fp, F.shiftright(fp, 20), F.shiftright(fp, 37))])


def bloom_filter(fps: DataFrame, count: int) -> np.ndarray:
    """The filter of the ``fp`` column as bits, at most ``FILTER_BITS``; made in
    blocks of ``BLOCK_BITS`` by Spark."""
    bits = min(FILTER_BITS, 1 << max(BLOCK_BITS.bit_length() - 1, (count * BITS_EACH).bit_length()))
    at = fps.select(F.explode(_probes(F.col("fp"), bits)).alias("bit"))
    blocks = at.groupBy(F.bitmap_bucket_number("bit").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    step = BLOCK_BITS // 8
    for r in blocks.collect():  # at most FILTER_BITS / BLOCK_BITS rows
        out[(r.block - 1) * step : r.block * step] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def passes(bloom: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """Which fingerprints may be among those of the filter."""
    ok, mask = np.ones(len(fps), bool), np.int64(len(bloom) * 8 - 1)
    for shift in (0, 20, 37):
        bit = (fps.view(np.int64) >> np.int64(shift)) & mask
        ok &= (bloom[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
    return ok


def winnowed(docs: DataFrame, bloom: np.ndarray, lengths: list[int], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """-> (row, doc_id, n_words, found): every document with its fingerprints that
    pass the filter, each with its length, its place, the words around it and its
    place among them. ``lengths``: the lengths of the benchmark's windows."""
    sent = docs.sparkSession.sparkContext.broadcast(bloom)
    item = pa.struct([("fp", pa.int64()), ("n", pa.int32()), ("at", pa.int64()), ("around", pa.binary()), ("lead", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            n_words = np.zeros(len(texts), np.int64)
            found: list[list] = [[] for _ in texts]
            for first, number, w, old in words_of(texts):
                n_words[first : first + len(w.n_words)] += w.n_words
                n_words[first] -= old
                lasts = np.cumsum(w.n_words)
                for n in lengths:
                    starts, fps, places = w.kept(n)
                    starts, fps, places = (x[starts + n > old] for x in (starts, fps, places))
                    if n == SPAN:  # one fingerprint stands for several runs
                        places, pick = np.unique(places, return_index=True)
                        fps = fps[pick]
                    ok = passes(sent.value, fps)
                    reach = SPAN - GRAM if n == SPAN else 0
                    for fp, p in zip(fps[ok].tolist(), places[ok].tolist(), strict=True):
                        d = int(w.owner[p])
                        begin = max(p - reach, int(lasts[d] - w.n_words[d]))
                        around = w.spell(begin, min(p + (SPAN if n == SPAN else n), int(lasts[d])))
                        found[first + d].append({"fp": fp - (1 << 64) if fp >> 63 else fp, "n": n, "at": number + int(w.number[p]), "around": around, "lead": p - begin})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), pa.array(found, pa.list_(item))], names=["doc_id", "n_words", "found"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kept = map_arrow(rows, run, "doc_id long, n_words long, found array<struct<fp:long,n:int,at:long,around:binary,lead:int>>")
    return kept.select(F.monotonically_increasing_id().alias("row"), "*")


def occurrences(found: DataFrame, index: DataFrame) -> DataFrame:
    """(row, found) and the windows' (fp, place, n, words, window) -> (row, start, n,
    window): the windows that the words around a fingerprint spell out."""
    each = found.select("row", F.explode("found").alias("f")).select("row", "f.fp", "f.n", "f.at", F.split(F.col("f.around").cast("string"), " ").alias("around"), "f.lead")
    met = each.join(index, ["fp", "n"]).filter("lead >= place")
    spelt = F.array_join(F.slice("around", F.col("lead") - F.col("place") + 1, F.col("n")), " ")
    return met.filter(spelt == F.col("words").cast("string")).select("row", (F.col("at") - F.col("place")).alias("start"), "n", "window")


def covered(hits: DataFrame) -> DataFrame:
    """(row, start, n) -> (row, start, stop): what each hit covers beyond those that
    begin before it; pieces are disjoint, and empty ones are left out."""
    longest = hits.groupBy("row", "start").agg(F.max(F.col("start") + F.col("n")).alias("stop"))
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("stop").over(before), F.lit(0))
    return longest.select("row", F.greatest("start", reached).alias("start"), "stop").filter("start < stop")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """-> documents (row, doc_id, n_words), their covered spans (row, start, stop; in
    words) and their items (row, item), both without repetitions."""
    # at most one row an item's word
    spelt = staged(windows(items, item_col, text).withColumn("window", F.md5("words")), "decontamination-windows")
    index = staged(spelt.groupBy("window", "n").agg(*[F.first(c).alias(c) for c in ("fp", "place", "words")]), "decontamination-index")
    lengths = sorted(r.n for r in index.select("n").distinct().collect())  # at most SPAN rows
    bloom = bloom_filter(index, index.count())
    rows = staged(winnowed(docs, bloom, lengths, id_col, text), "decontamination-rows")
    hits = staged(occurrences(rows, index), "decontamination-hits")
    of_window = spelt.select("window", "item").distinct()
    held = hits.select("row", "window").distinct().join(of_window, "window").select("row", "item").distinct()
    return rows.select("row", "doc_id", "n_words"), covered(hits), held


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: words hit by the benchmark's windows, and the items."""
    docs, spans, held = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = spans.groupBy("row").agg(F.sum(F.col("stop") - F.col("start")).alias("n_hit"))
    names = F.array_sort(F.collect_set("item"))
    items = held.groupBy("row").agg(F.count(F.lit(1)).alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"))
    facts = staged(n_hit.join(items, "row"), "decontamination-facts")
    joined = docs.join(facts, "row", "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


#: DuckDB: windows spelt out as texts and joined, without fingerprints.
OP12_SQL = f"""
WITH i AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
         {WORDS_SQL} AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS words
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM i WHERE len(w) > 0)),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
         {WORDS_SQL} AS w
  FROM documents),
each AS (SELECT r, len(w) AS m, unnest(range(1, len(w) + 1)) AS s, unnest(w) AS word FROM d),
runs AS (
  SELECT r, n, s, m, string_agg(word, ' ') OVER (PARTITION BY r, n ORDER BY s ROWS BETWEEN CURRENT ROW AND n - 1 FOLLOWING) AS words
  FROM each, (SELECT DISTINCT n FROM win)),
hits AS (SELECT r, s, runs.n, item FROM runs JOIN win ON runs.n = win.n AND runs.words = win.words WHERE s + runs.n <= m + 1),
cover AS (SELECT r, count(DISTINCT s + k) AS n_hit FROM (SELECT r, s, unnest(range(n)) AS k FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (r) LEFT JOIN named USING (r)
"""
