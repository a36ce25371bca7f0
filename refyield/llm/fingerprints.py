"""Operator 8: MinHash fingerprints of documents.

A fingerprint is the minima of 64 universal hash permutations over a text's
shingles of five words, 16 bits each, as hexadecimal; the likeness of two is the
share of equal places, an estimate of the texts' Jaccard similarity. Equal texts
have equal fingerprints.

``fingerprint_chain`` also edits each text with the next document's start. The
documents are ranged and sorted by key once; each task reads its range in order
with one row in hand. Only the last row of a range waits for the first of the
next one, which a small join brings.

``near_representatives`` (no query runs it) joins the signatures' bands: all pairs
of a bucket, cut into blocks, are compared and those kept whose shingle sets reach
the threshold in Jaccard similarity.

Defined results: a null text is empty; a text without words has a fingerprint of
its own, like only that of other such texts; rows with one key follow in the order
of their texts' hashes, null keys last; a single row follows itself; an empty
table gives an empty one. Only the key and the text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refyield.llm.blocks import columns, dealt, in_block_pairs, row_pairs, whole_groups
from refyield.llm.common import map_arrow, partitions_for, staged, table, text_or_empty
from refyield.llm.shingles import MinHash, folded, shingle_set

PERMUTATIONS, SEED = 64, 8
BANDS, THRESHOLD = 16, 0.8
RANGE_BYTES = 1 << 30
#: Rows and characters of a block of a bucket.
BLOCK_ROWS, BLOCK_CHARS = 256, 16_000_000
HASHER = MinHash(PERMUTATIONS, SEED)


def signature(text: str) -> np.ndarray:
    return folded(HASHER.minima(text), np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last third of the characters replaced by the start of the next text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


CHAIN = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _finish(key: int | None, text: str, own: np.ndarray, next_text: str, next_own: np.ndarray) -> tuple:
    new = edited(text, next_text)
    changed = signature(new)
    return (
        key,
        len(text),
        hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
        own.tobytes(),
        changed.tobytes(),
        likeness(own, changed),
        likeness(own, next_own),
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)


_ROW = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def fingerprint_chain(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> n_chars, edited_sha256, fingerprint, edited_fingerprint
    (binary), near_edited, near_next; the next document by descending doc_id."""
    ranged = (
        docs.select("doc_id", text_or_empty().alias("text"))
        .withColumn("_h", F.xxhash64("text"))
        .repartitionByRange(partitions_for(docs, RANGE_BYTES), F.desc("doc_id"), F.col("_h"))
        .sortWithinPartitions(F.desc("doc_id"), "_h")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    schema = pa.schema([*_ROW, ("part", pa.int32()), ("first_text", pa.string()), ("waiting_text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        first = None
        for batch in batches:
            out = []
            for part, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = signature(text)
                if held is None:
                    first = text
                else:
                    out.append((*_finish(*held, text, own), part, first, None))
                    first = None
                held = (key, text, own)
            if out:
                yield _batch(out, schema)
        if held is not None:
            yield _batch([(held[0], None, None, held[2].tobytes(), None, None, None, part, first, held[1])], schema)

    rows = staged(map_arrow(ranged, run, f"{CHAIN}, part int, first_text string, waiting_text string"), "fingerprints")
    done = rows.filter("waiting_text IS NULL").select(*[n for n, _ in _ROW])
    ends = rows.filter("waiting_text IS NOT NULL").select("part", "doc_id", "waiting_text")
    starts = rows.filter("first_text IS NOT NULL").select(F.col("part").alias("next_part"), F.col("first_text").alias("next_text"))
    # a row for each range
    parts = Window.orderBy("part")
    following = F.coalesce(F.lead("part").over(parts), F.min("part").over(Window.partitionBy()))
    pairs = ends.join(ends.select("part", following.alias("next_part")), "part").join(starts, "next_part").select("doc_id", "waiting_text", "next_text")

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            out = [_finish(k, t, signature(t), n, signature(n)) for k, t, n in rows]
            yield _batch(out, pa.schema(_ROW))

    return done.unionByName(map_arrow(pairs, last, CHAIN))


def near_representatives(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS) -> DataFrame:
    """(doc_id, text) -> (doc_id, near_id, jaccard): the pairs of different texts
    that share a bucket and reach the threshold, the lesser doc_id (null last) as
    near_id. Equal texts count as one, under their least doc_id."""
    width = PERMUTATIONS // bands * 2
    texts = docs.filter("text IS NOT NULL").groupBy(F.unhex(F.md5("text")).alias("key")).agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
    texts = staged(texts, "near-texts")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, len(t), signature(t).tobytes()) for k, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) if t.split(None, 1)]
            split = [(k, bytes([i]) + s[i * width : (i + 1) * width], n) for k, n, s in rows for i in range(bands)]
            yield _batch(split, pa.schema([("key", pa.binary()), ("bucket", pa.binary()), ("n_chars", pa.int64())]))

    signed = staged(map_arrow(texts.select("key", "text"), sign, "key binary, bucket binary, n_chars long"), "near-bands")
    placed = in_block_pairs(signed, "bucket", "key", BLOCK_ROWS, "n_chars", BLOCK_CHARS).select("key", "bucket", "lo", "hi", "blk")
    found = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("a_id", pa.int64()), ("b_id", pa.int64()), ("jaccard", pa.float64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, "bucket"):
            for i, start in enumerate(starts):  # one pair of blocks at a time
                g = t.slice(start, (starts[i + 1] if i + 1 < len(starts) else t.num_rows) - start)
                keys, ids = g.column("key").to_pylist(), g.column("doc_id").to_pylist()
                sets = [shingle_set(x) for x in g.column("text").to_pylist()]
                for left, right in row_pairs(np.zeros(1, np.int64), *columns(g, ["blk", "lo", "hi"])):
                    out = []
                    for x, y in zip(left.tolist(), right.tolist(), strict=True):
                        common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                        j = common / (len(sets[x]) + len(sets[y]) - common)
                        if j >= threshold:
                            x, y = sorted((x, y), key=lambda r: (ids[r] is None, ids[r] or 0, keys[r]))
                            out.append((keys[x], keys[y], ids[x], ids[y], j))
                    yield _batch(out, found)

    pairs = map_arrow(dealt(placed.join(texts, "key"), "bucket"), verify, "a binary, b binary, a_id long, b_id long, jaccard double")
    return pairs.distinct().select(F.col("b_id").alias("doc_id"), F.col("a_id").alias("near_id"), "jaccard")


def op8_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    chain = fingerprint_chain(table(spark, sf_dir, "documents"))
    return chain.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})
