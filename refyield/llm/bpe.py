"""Operator 6: byte-level BPE encoding and decoding by segment trees.

Each pattern match of a text is encoded separately. A segment tree over the
match's byte positions holds, for each live position, the rank of the pair that
starts there; its root is the lowest rank, leftmost first. A merge gives the
position a new id, unlinks its right neighbour and updates three leaves, each
up one path of the tree: the merged pair, the pair before it, the dead position.

Matches of up to 64 bytes are encoded many at a time, one tree a row of a numpy
array; longer ones have a tree of their own. Every Python worker keeps the
matches it has seen. Nothing is shuffled.

Defined results: a null or empty text has no ids and decodes to no bytes;
repeated rows are each encoded; an empty table gives an empty one; only the key
and the text are read, so other columns do no harm. A text over a million
characters is encoded piece by piece.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refyield.llm.common import map_arrow, table, text_or_empty

NONE = np.iinfo(np.int64).max
#: Tree sizes that are encoded many at a time, and rows a time.
WIDTHS, ROWS = (8, 16, 32, 64), 8192
#: Matches that a worker keeps, and characters of text that it takes at a time.
KEPT, CHARS = 200_000, 1_000_000


def read_ranks(rank_file: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}


@lru_cache(2)
def token_bytes(rank_file: bytes) -> list[bytes]:
    """The bytes of each id."""
    ranks = read_ranks(rank_file)
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def decoded(ids: bytes, tokens: list[bytes]) -> bytes:
    """The bytes of little-endian 32-bit ids."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class RankBPE:
    """Encoder for one rank file and split pattern."""

    def __init__(self, rank_file: bytes, pattern: str):
        import regex

        self.split = regex.compile(pattern)
        self.ranks = read_ranks(rank_file)
        self.base = max(self.ranks.values()) + 1
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        keys, ranks = [], []
        for t, r in self.ranks.items():
            for i in range(1, len(t)):
                a, b = self.ranks.get(t[:i]), self.ranks.get(t[i:])
                if a is not None and b is not None:
                    keys.append(a * self.base + b)
                    ranks.append(r)
        order = np.argsort(keys)
        self.pair_keys = np.array(keys, dtype=np.int64)[order]
        self.pair_ranks = np.array(ranks, dtype=np.int64)[order]
        self.seen: dict[str, bytes] = {}

    @cached_property
    def pairs(self) -> dict[int, int]:
        """Ranks by pair, for words that have a tree of their own."""
        return dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist(), strict=True))

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.base + b
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        if not len(self.pair_keys):
            return np.full(len(key), NONE)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def merge_rows(self, words: list[bytes], width: int) -> list[bytes]:
        """Ids (little-endian 32-bit) of words of at most ``width`` bytes."""
        n, shift = len(words), np.int64(width.bit_length())
        lengths = np.fromiter(map(len, words), np.int64, n)
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        ids = np.zeros((n, width + 1), np.int64)
        ids[:, :width] = self.byte_id[raw]
        nxt = np.tile(np.arange(1, width + 2), (n, 1))
        nxt[np.arange(n), lengths - 1] = width
        prv = np.tile(np.arange(-1, width), (n, 1))
        tree = np.full((n, 2 * width), NONE)

        def leaf(rank: np.ndarray, pos: np.ndarray) -> np.ndarray:
            return np.where(rank == NONE, NONE, (np.minimum(rank, 1 << 40) << shift) | pos)

        pos = np.arange(width - 1)
        first = self.pair_rank(ids[:, : width - 1].ravel(), ids[:, 1:width].ravel()).reshape(n, width - 1)
        first[pos[None, :] + 1 >= lengths[:, None]] = NONE
        tree[:, width : 2 * width - 1] = leaf(first, pos[None, :])
        for i in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1], out=tree[:, i])

        def update(rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            i = at + width
            tree[rows, i] = value
            while width > 1 and i[0] > 1:
                i = i >> 1
                tree[rows, i] = np.minimum(tree[rows, 2 * i], tree[rows, 2 * i + 1])

        rows = np.flatnonzero(tree[:, 1] != NONE)
        while len(rows):
            root = tree[rows, 1]
            at = root & ((1 << int(shift)) - 1)
            ids[rows, at] = root >> shift
            right = nxt[rows, at]
            after = nxt[rows, right]
            nxt[rows, at] = after
            ids[rows, right] = -1
            inside = after < width
            prv[rows[inside], after[inside]] = at[inside]
            update(rows, right, np.full(len(rows), NONE))
            rank = np.where(inside, self.pair_rank(ids[rows, at], ids[rows, after]), NONE)
            update(rows, at, leaf(rank, at))
            before = prv[rows, at]
            has = before >= 0
            if has.any():
                r, b = rows[has], before[has]
                update(r, b, leaf(self.pair_rank(ids[r, b], ids[r, at[has]]), b))
            rows = rows[tree[rows, 1] != NONE]
        live = (ids[:, :width] >= 0) & (np.arange(width)[None, :] < lengths[:, None])
        flat = ids[:, :width][live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(1)) * 4
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def merge_one(self, word: bytes) -> bytes:
        """Ids of one word of any length."""
        n, base, pairs = len(word), self.base, self.pairs
        width = 1 << (n - 1).bit_length()
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        none = int(NONE)
        tree = [none] * (2 * width)
        for i in range(n - 1):
            r = pairs.get(ids[i] * base + ids[i + 1])
            if r is not None:
                tree[width + i] = r * width + i
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def update(at: int, rank: int | None) -> None:
            i = width + at
            tree[i] = none if rank is None else rank * width + at
            while i > 1:
                i >>= 1
                low = min(tree[2 * i], tree[2 * i + 1])
                if tree[i] == low:
                    break
                tree[i] = low

        while tree[1] != none:
            rank, at = divmod(tree[1], width)
            right = nxt[at]
            after = nxt[right]
            ids[at], ids[right], nxt[at] = rank, -1, after
            update(right, None)
            if after < n:
                prv[after] = at
            update(at, pairs.get(rank * base + ids[after]) if after < n else None)
            if prv[at] >= 0:
                update(prv[at], pairs.get(ids[prv[at]] * base + rank))
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def learn(self, matches: set[str]) -> None:
        """Encode matches that the worker has not seen."""
        if len(self.seen) > KEPT:
            self.seen.clear()
        sized: dict[int, list[tuple[str, bytes]]] = {}
        for m in matches:
            word = m.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(word)
            if whole is not None:
                self.seen[m] = whole.to_bytes(4, "little")
            elif len(word) > WIDTHS[-1]:
                self.seen[m] = self.merge_one(word)
            else:
                sized.setdefault(next(w for w in WIDTHS if len(word) <= w), []).append((m, word))
        for width, found in sized.items():
            for i in range(0, len(found), ROWS):
                part = found[i : i + ROWS]
                self.seen.update(zip((m for m, _ in part), self.merge_rows([w for _, w in part], width), strict=True))

    def encode_matches(self, groups: list[list[str]]) -> list[bytes]:
        missing = {m for g in groups for m in g if m not in self.seen}
        if missing:
            if len(self.seen) + len(missing) > KEPT:
                self.seen.clear()
                missing = {m for g in groups for m in g}
            self.learn(missing)
        get = self.seen.__getitem__
        return [b"".join(map(get, g)) for g in groups]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        out: list[bytes] = []
        group: list[list[str]] = []
        chars = 0
        for text in texts:
            if len(text) > CHARS:
                out += self.encode_matches(group)
                found, pieces = (m.group() for m in self.split.finditer(text)), []
                while part := list(islice(found, 100_000)):
                    pieces += self.encode_matches([part])
                out.append(b"".join(pieces))
                group, chars = [], 0
                continue
            group.append(self.split.findall(text))
            chars += len(text)
            if chars > CHARS:
                out += self.encode_matches(group)
                group, chars = [], 0
        return out + self.encode_matches(group)


@lru_cache(2)
def worker_bpe(rank_file: bytes, pattern: str) -> RankBPE:
    """The encoder of this Python worker."""
    return RankBPE(rank_file, pattern)


def encode(docs: DataFrame, rank_file: bytes, pattern: str, text: str = "text", round_trip: bool = False) -> DataFrame:
    """Replace the column ``text`` by ``ids``, a binary of little-endian 32-bit ids;
    with ``round_trip`` also ``decoded``, the bytes that these ids decode to."""
    others = [c for c in docs.columns if c != text]
    source = docs.select(*others, text_or_empty(text).alias(text))
    binary = F.lit(b"").cast("binary")
    schema = source.select(*others, binary.alias("ids"), *([binary.alias("decoded")] if round_trip else [])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, tokens = worker_bpe(rank_file, pattern), token_bytes(rank_file)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                ids = bpe.encode_texts(part.column(part.num_columns - 1).to_pylist())
                made = [pa.array(ids, pa.binary())]
                if round_trip:
                    made.append(pa.array([decoded(x, tokens) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=schema.names)

    return map_arrow(source, run, schema)


def decode(encoded: DataFrame, rank_file: bytes, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the bytes of the column ``ids``."""
    source = encoded.select(*[c for c in encoded.columns if c != ids], ids)
    schema = source.select("*", F.lit(b"").cast("binary").alias("decoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_bytes(rank_file)
        for batch in batches:
            back = [decoded(x, tokens) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(back, pa.binary())], names=schema.names)

    return map_arrow(source, run, schema)


def multi_rank_file() -> tuple[bytes, str]:
    """The public rank file for many languages, read on the driver (about 1 MB)
    and sent with the tasks, and its split pattern."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def round_trip(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, n_tokens and the digests of ids and decoded bytes."""
    rank_file, pattern = multi_rank_file()
    both = encode(docs.select("doc_id", "text"), rank_file, pattern, round_trip=True)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, then decoded."""
    return round_trip(table(spark, sf_dir, "documents"))
