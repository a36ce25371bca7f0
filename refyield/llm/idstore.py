"""Operator 3: token ids as raw binary files with a minimal perfect hash index.

Documents are ranged by key and encoded; each task writes its range as a run of
file pairs in the shared folder:

* ``<name>.ids``: the raw ids of the documents in key order, 16 bits each where
  the vocabulary has at most 65,536 entries, else 32 bits, little-endian.
* ``<name>.idx``: a header, the keys in order, and a minimal perfect hash over
  them. Its levels are bit arrays in which a key owns its bit if no other key of
  that level fell on it; the number of owned bits before it is the key's slot.
  A slot holds a 32-bit fingerprint of the key and the document's offset and
  length, so that one key is found by a few bit tests and one read, and an
  absent key is told by its fingerprint (but for one in four thousand million).

Files are written under a name of their own and then moved into place, so that a
task that runs again leaves the same files. A table of the files (one row each:
range, documents, ids) is written by Spark, and the ids before each file are a
running sum over that table. ``directory`` adds the first and last key of each
file, read from its index's ends; ``lookup`` picks by them the files that may hold
the keys asked for and opens no other.

Defined results: a null or empty text has the end id alone; a null key is the
smallest key; a repeated key has an entry for each of its rows, numbered in the
order of the texts' hashes; an empty table gives no files and no rows. Only the
key and the text are read. Rows that share both key and text share a range;
others of one key are dealt over ranges.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refyield.llm.common import arrow_files, make_folder, map_arrow, partitions_for, put, staged, table, text_or_empty
from refyield.session import scratch_path

END_ID = 2
#: Bytes of ids and documents in a file at most, bytes of input in a range.
FILE_BYTES, FILE_DOCS, RANGE_BYTES = 32 << 20, 500_000, 1 << 30
GAMMA = 1.5
MAGIC = b"idstore1"
HEADER = struct.Struct("<8sIIQQI")
ENTRY = np.dtype([("fingerprint", "<u4"), ("length", "<u4"), ("offset", "<u8")])
KEY = np.dtype([("key", "<i8"), ("repeat", "<u4"), ("null", "<u4")])
NULL_KEY = np.iinfo(np.int64).min


def mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hashes of (key, repeat) under a salt."""
    with np.errstate(over="ignore"):
        x = keys["key"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= (keys["repeat"].astype(np.uint64) << np.uint64(1) | keys["null"]) * np.uint64(0xC2B2AE3D27D4EB4F)
        x += np.uint64((salt + 1) * 0x165667B19E3779F9 & (2**64 - 1))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct keys: slots 0 to n - 1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.cumsum([0, *(int(x.sum()) for x in levels)])
        self.ranks = [np.cumsum(x, dtype=np.int64) - x for x in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            if len(levels) >= 64:
                raise ValueError("keys are not distinct")
            size = max(64, int(GAMMA * len(keys)))
            at = (mixed(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            owned = np.bincount(at, minlength=size) == 1
            levels.append(owned)
            keys = keys[~owned[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level owns it."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for i, owned in enumerate(self.levels):
            at = (mixed(keys[open_], i) % np.uint64(len(owned))).astype(np.int64)
            hit = owned[at]
            out[open_[hit]] = self.before[i] + self.ranks[i][at[hit]]
            open_ = open_[~hit]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1000) >> np.uint64(32)).astype(np.uint32)


def index_bytes(keys: np.ndarray, lengths: np.ndarray, width: int) -> bytes:
    """The index file of documents with these keys, in order."""
    lengths = lengths.astype(np.int64)
    offsets = np.cumsum(lengths) - lengths
    hashed = PerfectHash.build(keys)
    entries = np.zeros(len(keys), ENTRY)
    at = hashed.slots(keys)
    entries["fingerprint"][at], entries["length"][at], entries["offset"][at] = fingerprints(keys), lengths, offsets
    sizes = np.array([len(x) for x in hashed.levels], "<u8")
    head = HEADER.pack(MAGIC, width, len(sizes), len(keys), int(lengths.sum()), 0)
    return b"".join([head, sizes.tobytes(), *(np.packbits(x).tobytes() for x in hashed.levels), entries.tobytes(), keys.tobytes()])


class IdFile:
    """A file pair, read back: constant-time access to a document's ids by key."""

    def __init__(self, index: bytes, payload: pa.NativeFile):
        magic, self.width, levels, n, self.total, _ = HEADER.unpack_from(index)
        if magic != MAGIC:
            raise ValueError("not an index of ids")
        at = HEADER.size
        sizes = np.frombuffer(index, "<u8", levels, at)
        at += sizes.nbytes
        bits = []
        for size in sizes.tolist():
            packed = np.frombuffer(index, np.uint8, -(-size // 8), at)
            bits.append(np.unpackbits(packed, count=size).astype(bool))
            at += packed.nbytes
        self.hash = PerfectHash(bits)
        self.entries = np.frombuffer(index, ENTRY, n, at)
        self.keys = np.frombuffer(index, KEY, n, at + self.entries.nbytes)
        self.payload = payload

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offset (in ids; -1 if the key is absent) and length of each key."""
        at = self.hash.slots(keys)
        if not len(self.entries):
            return np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        found = (at >= 0) & (self.entries["fingerprint"][at] == fingerprints(keys))
        return np.where(found, self.entries["offset"][at].astype(np.int64), -1), np.where(found, self.entries["length"][at], 0)

    def read(self, offset: int, length: int) -> np.ndarray:
        self.payload.seek(offset * self.width)
        return np.frombuffer(self.payload.read(length * self.width), f"<u{self.width}")


def make_keys(ids: list[int | None]) -> np.ndarray:
    """Keys of documents in order; rows of one key are numbered from 0."""
    out = np.zeros(len(ids), KEY)
    out["null"] = [i is None for i in ids]
    out["key"] = [NULL_KEY if i is None else i for i in ids]
    if len(ids):
        new = np.append(True, (out["key"][1:] != out["key"][:-1]) | (out["null"][1:] != out["null"][:-1]))
        at = np.arange(len(ids))
        out["repeat"] = at - np.maximum.accumulate(np.where(new, at, 0))
    return out


class WordEncoder(dict):
    """Ids of texts by a tokenizer whose matches never hold white space and whose
    letters are lowered: a text's ids are those of its parts between blanks, a
    closing point or comma after a Latin letter stands alone, and Latin parts are
    looked up in lower case. A worker keeps the ids of the parts it has met lately
    (two generations of about ``KEPT``)."""

    KEPT = 700_000

    def __init__(self, tokenizer_json: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json.decode())
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.older: dict[str, bytes] = {}
        self.end = self.plain([""], END_ID)[0]
        self.marks = dict(zip(".,", self.plain([".", ","]), strict=True))
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def plain(self, parts: list[str], *more: int) -> list[bytes]:
        """Ids by the library, with ``more`` after each part's."""
        found = [[*e.ids, *more] for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        stops = np.cumsum([len(x) for x in found]) * self.width
        flat = np.array([i for x in found for i in x], f"<u{self.width}").tobytes()
        return [flat[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)]

    def letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of Latin letters, each of which is one match of the split:
        many are given to the library in one line, and a word's ids end with the
        first that closes a word."""
        lines = [" ".join(words[i : i + 256]) for i in range(0, len(words), 256)]
        encoded = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.array([i for e in encoded for i in e.ids], f"<u{self.width}")
        stops = (np.flatnonzero(self.closes[ids]) + 1) * self.width
        if len(stops) != len(words):
            return self.plain(words)
        flat = ids.tobytes()
        return [flat[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)]

    def learn(self, parts: set[str]) -> None:
        older = self.older.get
        letters: list[str] = []
        others: list[str] = []
        derived: list[tuple[str, str, str]] = []  # part, what it is without case and mark, mark
        for part in parts:
            ids = older(part)
            if ids is not None:
                self[part] = ids
            elif part.isascii() or max(part) < "\u0100":
                if part.islower() and part.isalpha():
                    letters.append(part)
                elif "<|" in part:
                    others.append(part)
                elif part[-1:] in (".", ",") and part[-2:-1].isalpha():
                    derived.append((part, part[:-1].lower(), part[-1]))
                else:
                    derived.append((part, part.lower(), ""))
            else:
                others.append(part)
        for core in {c for _, c, _ in derived if c not in self and c not in self.older} - set(letters):
            (letters if core.isalpha() else others).append(core)
        if letters:
            self.update(zip(letters, self.letters(letters), strict=True))
        if others:
            self.update(zip(others, self.plain(others), strict=True))
        for part, core, mark in derived:
            ids = self.get(core) or older(core, b"")
            self[part] = ids + self.marks[mark] if mark else ids

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self) > self.KEPT:
            self.older = dict(self)
            self.clear()
        found = [list(map(self.get, words)) for words in split]
        gaps = []  # places of parts not met lately
        for words, ids in zip(split, found, strict=True):
            for _ in range(ids.count(None)):
                i = ids.index(None, i + 1 if gaps and gaps[-1][0] is ids else 0)
                gaps.append((ids, i, words[i]))
        self.learn({word for _, _, word in gaps})
        for ids, i, word in gaps:
            ids[i] = self[word]
        return [b"".join(ids) + self.end for ids in found]


@lru_cache(2)
def worker_encoder(tokenizer_json: bytes) -> WordEncoder:
    """The encoder of this Python worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(tokenizer_json)


def write_ids(docs: DataFrame, tokenizer_json: bytes, folder: str) -> DataFrame:
    """(doc_id, text) -> the files in ``folder``, and the table of them: part,
    name, n_docs, n_ids, first_id (the ids in the files before)."""
    make_folder(folder)
    ranged = (
        docs.select("doc_id", text_or_empty().alias("text"))
        .withColumn("_h", F.xxhash64("text"))
        .repartitionByRange(partitions_for(docs, RANGE_BYTES), "doc_id", "_h")
        .sortWithinPartitions("doc_id", "_h")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_json)
        run_no, part = 0, -1
        ids: list[int | None] = []
        data: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            name = f"{part:06d}-{run_no:05d}"
            lengths = np.array([len(d) // encoder.width for d in data], np.int64)
            put(folder, f"{name}.ids", data)
            put(folder, f"{name}.idx", [index_bytes(make_keys(ids), lengths, encoder.width)])
            row = [[part], [name], [len(ids)], [int(lengths.sum())]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["part", "name", "n_docs", "n_ids"])

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                rows = batch.slice(i, 256)
                part = rows.column(0)[0].as_py()
                encoded = encoder.encode(rows.column(2).to_pylist())
                for key, d in zip(rows.column(1).to_pylist(), encoded, strict=True):
                    ids.append(key)
                    data.append(d)
                    held += len(d)
                    if held >= FILE_BYTES or len(ids) >= FILE_DOCS:
                        yield flush()
                        run_no, held = run_no + 1, 0
                        ids.clear()
                        data.clear()
        if ids:
            yield flush()

    files = staged(map_arrow(ranged, run, "part int, name string, n_docs long, n_ids long"), "ids-files")
    before = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


@contextmanager
def open_ids(folder: str, name: str) -> Iterator[IdFile]:
    """A file pair of the shared folder, open for access by key."""
    store, root = arrow_files(folder)
    with store.open_input_stream(f"{root}/{name}.idx") as f:
        index = f.read()
    with store.open_input_file(f"{root}/{name}.ids") as payload:
        yield IdFile(index, payload)


def read_documents(files: DataFrame, folder: str) -> DataFrame:
    """Every document of the files, found by its key: doc_id, start, n_tokens,
    ids_crc32 (of 32-bit ids), file name and the offset in it."""
    spread = files.repartition(max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            for name, first in zip(batch.column("name").to_pylist(), batch.column("first_id").to_pylist(), strict=True):
                with open_ids(folder, name) as file:
                    offsets, lengths = file.find(file.keys)
                    if (offsets < 0).any():
                        raise ValueError(f"{name}: a key of the file is not in its index")
                    crc = [zlib.crc32(file.read(o, n).astype("<u4").tobytes()) for o, n in zip(offsets.tolist(), lengths.tolist(), strict=True)]
                columns = [
                    pa.array(file.keys["key"], mask=file.keys["null"] == 1),
                    pa.array(offsets + first),
                    pa.array(lengths.astype(np.int64)),
                    pa.array(crc, pa.int64()),
                    pa.array([name] * len(crc), pa.string()),
                    pa.array(offsets),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "file", "file_offset"])

    return map_arrow(spread, run, "doc_id long, start long, n_tokens long, ids_crc32 long, file string, file_offset long")


def end_keys(index: pa.NativeFile) -> tuple[int, int]:
    """First and last key of an index file, without reading the rest."""
    n = HEADER.unpack(index.read(HEADER.size))[3]
    found = []
    for from_end in (n, 1):
        index.seek(index.size() - from_end * KEY.itemsize)
        found.append(int(np.frombuffer(index.read(KEY.itemsize), KEY)["key"][0]))
    return found[0], found[1]


def directory(files: DataFrame, folder: str) -> DataFrame:
    """The table of files with the first and last key of each (a null key as the
    least long), written once for any number of lookups."""
    spread = files.select("name", "first_id").repartition(max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = arrow_files(folder)
        for batch in batches:
            ends = []
            for name in batch.column("name").to_pylist():
                with store.open_input_file(f"{root}/{name}.idx") as f:
                    ends.append(end_keys(f))
            low, high = zip(*ends, strict=True) if ends else ((), ())
            added = [pa.array(np.array(x, np.int64)) for x in (low, high)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=["name", "first_id", "first_key", "last_key"])

    return staged(map_arrow(spread, run, "name string, first_id long, first_key long, last_key long"), "ids-directory")


def lookup(where: DataFrame, folder: str, keys: Sequence[int | None]) -> DataFrame:
    """The documents with these keys: doc_id, start, ids, one row for each of a key's
    rows; absent keys have none. ``where`` is the ``directory`` of the folder; only
    files whose keys range over one of those asked for are opened, and there each
    key is found by its hash."""
    asked = make_keys(sorted(set(keys), key=lambda k: (k is not None, k or 0)))
    longs = F.from_json(F.lit(str(asked["key"].tolist())), "array<long>")
    may_hold = where.filter(F.exists(longs, lambda k: k.between(F.col("first_key"), F.col("last_key"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                wanted = asked[(asked["key"] >= row["first_key"]) & (asked["key"] <= row["last_key"])].copy()
                out: list[tuple] = []
                with open_ids(folder, row["name"]) as file:
                    while len(wanted):  # the rows of a key are numbered from 0
                        offsets, lengths = file.find(wanted)
                        for k, at, n in zip(wanted, offsets.tolist(), lengths.tolist(), strict=True):
                            if at >= 0:
                                out.append((None if k["null"] else int(k["key"]), row["first_id"] + at, file.read(at, n).tolist()))
                        wanted = wanted[offsets >= 0]
                        wanted["repeat"] += 1
                columns = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int64())))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "ids"])

    return map_arrow(may_hold, run, "doc_id long, start long, ids array<long>")


def op3_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written to files and read back by key."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        tokenizer = f.read()  # about 2 MB, sent with the tasks
    folder = scratch_path(spark, "ids")
    return read_documents(write_ids(table(spark, sf_dir, "documents"), tokenizer, folder), folder)
