"""Operator 11: importance resampling towards a target, by bit-sliced aggregation.

Features of a text are all runs of 1 to 3 consecutive words, repeats counted; a
feature's bucket is the crc32 of its bytes modulo ``BUCKETS``. A bucket's gain is
the log of its smoothed share in the target over that in the source, in whole
thousandths, rounded down; a document's weight is the sum of the gains of its
features. Gumbel noise drawn from the document's id is added, and the documents
with the highest scores are drawn, without replacement.

1. One pass counts the features of each bucket, a vector of ``BUCKETS`` counts a
   task, added up by Spark. The driver holds the sums alone.
2. A second pass weighs each document. Its bucket counts are written as planes of
   ``BUCKETS`` bits, plane j holding bit j of every count; the gains' magnitudes
   likewise, positive and negative gains apart. The weight is the sum over pairs
   of planes of 2^(j + k) times the bits that both hold: whole numbers
   throughout, so it is exact and depends on no order.
3. Ranks come from ``with_rank``: ranges of the order, no window over all rows.

A crc32 is linear in its bits, so that of ``a b`` is found from those of ``a`` and
`` b`` by four table reads for the length of `` b``; longer words than the tables
have are read byte by byte.

Defined results: a null or empty text has no features and weight 0; a null id is
written ``null`` where the noise is drawn and comes after all others in a tie;
repeated rows are drawn each for itself, ties among them in any order; under 20
documents that are long enough nothing is drawn; an empty target has zero counts;
an empty table gives an empty one. Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refyield.llm.common import map_arrow, staged, table
from refyield.llm.wordbytes import WORD_BYTES, WORDS_SQL, pieces, runs_of, texts_of
from refyield.operators.ranking import with_rank

BUCKETS, RUN, MIN_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
#: Documents whose planes are made at once, bytes of text taken at once, and the
#: longest word, with the blank before it, that has a table.
DOCS_AT_ONCE, BYTES_AT_ONCE, TABLE_LENGTH = 64, 1 << 20, 64


def _shift_tables(longest: int) -> np.ndarray:
    """[n, k, b]: what n zero bytes make of the crc32 state whose byte k is b."""
    reach = np.empty((longest + 1, 32), np.uint32)
    reach[0] = np.uint32(1) << np.arange(32, dtype=np.uint32)
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1)
    for n in range(longest):
        reach[n + 1] = (reach[n] >> np.uint32(8)) ^ byte[reach[n] & 255]
    tables = np.zeros((longest + 1, 4, 256), np.uint32)
    for bit in range(32):
        holds = np.flatnonzero(np.arange(256) >> (bit % 8) & 1)
        tables[:, bit // 8, holds] ^= reach[:, bit, None]
    return tables


class FeatureHash:
    """Buckets of the features of texts."""

    def __init__(self, buckets: int = BUCKETS, longest: int = TABLE_LENGTH, piece: int = BYTES_AT_ONCE):
        self.buckets, self.longest, self.piece = buckets, longest, piece
        self.tables = _shift_tables(longest).reshape(-1)

    def _shifted(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        at = length << 10
        out = self.tables[at + (crc & 255)]
        for k, bits in ((256, 8), (512, 16), (768, 24)):
            out ^= self.tables[at + (k + (crc >> bits & 255))]
        return out

    def _runs(self, words: list[bytes], owner: np.ndarray, old: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(buckets, owners) of the runs of each length that end after the first
        ``old`` words; a run lies in one text."""
        n = len(words)
        own = np.fromiter(map(zlib.crc32, words), np.uint32, n)
        length = np.fromiter(map(len, words), np.int32, n) + 1
        wide = np.flatnonzero(length > self.longest).tolist()
        short = np.minimum(length, self.longest)
        follow = self._shifted(np.full(n, zlib.crc32(b" "), np.uint32), short - 1) ^ own  # crc32 of b" " + word
        runs = own
        for r in range(min(RUN, n)):
            if r:
                longer = self._shifted(runs[: n - r], short[r:]) ^ follow[r:]
                for w in wide:
                    if w >= r:
                        longer[w - r] = zlib.crc32(b" " + words[w], int(runs[w - r]))
                runs = longer
            first = max(0, old - r)
            inside = owner[first : n - r] == owner[first + r :]
            yield (runs[first:] % np.uint32(self.buckets))[inside], owner[first : n - r][inside]

    def __call__(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(bucket, number of the text) of every feature, and words of each text;
        one long text comes piece by piece, the words of its pieces add up."""
        split = [t.translate(WORD_BYTES).split() for t in texts] if sum(map(len, texts)) <= self.piece else None
        if split is not None:
            n_words = np.fromiter(map(len, split), np.int64, len(split))
            yield *self._joined(list(chain.from_iterable(split)), np.repeat(np.arange(len(split)), n_words), 0), n_words
            return
        for i, t in enumerate(texts):
            carried: list[bytes] = []
            for piece in pieces(t.translate(WORD_BYTES), self.piece):
                new = piece.split()
                words, n_words = carried + new, np.zeros(len(texts), np.int64)
                n_words[i] = len(new)
                yield *self._joined(words, np.full(len(words), i), len(carried)), n_words
                carried = words[1 - RUN :]

    def _joined(self, words: list[bytes], owner: np.ndarray, old: int) -> tuple[np.ndarray, np.ndarray]:
        found = list(self._runs(words, owner, old)) or [(np.empty(0, np.uint32), np.empty(0, np.int64))]
        return np.concatenate([b for b, _ in found]), np.concatenate([o for _, o in found])


def feature_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of the whole table fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = FeatureHash(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            texts = texts_of(batch.column(0))
            for start, stop in runs_of(texts, BYTES_AT_ONCE):
                for found, _, _ in features(texts[start:stop]):
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    sums = map_arrow(docs.select(F.col(text).alias("text")), run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for r in sums.collect():  # at most ``buckets`` rows
        counts[r.bucket] = r.n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's log share in the target over that in the source, in whole
    thousandths, rounded down."""
    all_s, all_t, buckets = float(source.sum()), float(target.sum()), len(source)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * (all_s + buckets) / ((s + 1.0) * (all_t + buckets)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    packed = np.packbits(bits, axis=1)
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


class GainPlanes:
    """The gains' bits as planes; weights as sums of powers of two."""

    def __init__(self, gain: np.ndarray):
        self.buckets = len(gain)
        self.planes = [
            (sign << k, _packed((size >> k & 1).astype(bool)[None])[0])
            for sign, size in ((1, np.maximum(gain, 0)), (-1, np.maximum(-gain, 0)))
            for k in range(int(size.max(initial=0)).bit_length())
        ]

    def weights(self, counts: np.ndarray) -> list[int]:
        """The sum of gains over each document's features; a row of counts each."""
        rows, buckets = np.nonzero(counts)
        held = counts[rows, buckets]
        out = [0] * len(counts)
        for j in range(int(held.max(initial=0)).bit_length()):
            on = held >> j & 1 == 1
            docs, row = np.unique(rows[on], return_inverse=True)  # few documents hold the high planes
            plane = np.zeros((len(docs), self.buckets), bool)
            plane[row, buckets[on]] = True
            bits = _packed(plane)
            total = np.zeros(len(docs), np.int64)
            for factor, gain in self.planes:
                total += factor * np.bitwise_count(bits & gain).sum(axis=1, dtype=np.int64)
            for i, w in zip(docs.tolist(), total.tolist(), strict=True):
                out[i] += w << j
        return out


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise of a document in whole thousandths, rounded down."""
    name = "null" if doc_id is None else doc_id
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """-> (doc_id, n_words, n_features, weight, score), a row for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, planes = FeatureHash(len(gain)), GainPlanes(gain)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
            n_words, n_features, weight = [], [], []
            for start, stop in runs_of(texts, BYTES_AT_ONCE, DOCS_AT_ONCE):
                counts = np.zeros((stop - start) * len(gain), np.int64)
                words = np.zeros(stop - start, np.int64)
                for found, owner, more in features(texts[start:stop]):
                    counts += np.bincount(owner * len(gain) + found, minlength=len(counts))
                    words += more
                counts = counts.reshape(stop - start, -1)
                n_words += words.tolist()
                n_features += counts.sum(axis=1).tolist()
                weight += planes.weights(counts)
            score = [w + noise(i) for w, i in zip(weight, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weight, score))], names=["doc_id", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_arrow(rows, run, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank (null: not
    drawn); ``percent`` of those with at least ``min_words`` words are drawn."""
    gain = gains(feature_counts(docs, text), feature_counts(target, text))
    rows = staged(weighed(docs, gain, id_col, text), "resample-weights")
    able = F.col("n_words") >= min_words
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranked = with_rank(rows.filter(able), order)
    drawn = percent * rows.filter(able).count() // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    chosen = ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return chosen.unionByName(rows.filter(~able).select(*columns, F.lit(None).cast("long").alias("rank")))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed towards the benchmark's texts, 5 in 100 drawn."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: DuckDB: crc32 byte by byte over the different features, sums without planes.
OP11_SQL = f"""
WITH RECURSIVE poly(i, j, c) AS (
  SELECT range::BIGINT, 0, range::BIGINT FROM range(256)
  UNION ALL
  SELECT i, j + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM poly WHERE j < 8),
lut AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM poly WHERE j = 8),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
f AS MATERIALIZED (
  SELECT r, f, count(*) AS n FROM (
    SELECT r, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                       || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS f
    FROM (SELECT r, w FROM d UNION ALL SELECT NULL, {WORDS_SQL} FROM benchmark)) GROUP BY r, f),
h AS MATERIALIZED (
  SELECT f, xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(f)), '..'), lambda x: CAST(concat('0x', x) AS BIGINT)),
           lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS BIGINT) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT f FROM f), lut),
b AS MATERIALIZED (SELECT r, bucket, CAST(sum(n) AS DOUBLE) AS n FROM f JOIN h USING (f) GROUP BY r, bucket),
g AS MATERIALIZED (
  SELECT bucket, floor(1000 * ln((t + 1) * (all_t0 + {BUCKETS}) / ((s + 1) * (all_t + {BUCKETS})))) AS gain
  FROM (SELECT bucket, coalesce(sum(n) FILTER (r IS NOT NULL), 0) AS s, coalesce(sum(n) FILTER (r IS NULL), 0) AS t FROM b GROUP BY bucket),
       (SELECT coalesce(sum(n) FILTER (r IS NOT NULL), 0) AS all_t0, coalesce(sum(n) FILTER (r IS NULL), 0) AS all_t FROM b)),
m AS (SELECT r, CAST(sum(n * gain) AS BIGINT) AS weight, CAST(sum(n) AS BIGINT) AS n_features FROM b JOIN g USING (bucket) WHERE r IS NOT NULL GROUP BY r),
x AS (
  SELECT doc_id, len(w) >= {MIN_WORDS} AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(concat('0x', substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN m USING (r)),
o AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST) AS place,
         {PERCENT} * count(*) FILTER (able) OVER () // 100 AS drawn
  FROM x)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= drawn THEN place END AS rank FROM o
"""
