"""Operator 7: token counts by a finite-state tokenizer.

Two deterministic transducers are compiled from the tokenizer's JSON file, and
their transitions carry the number of tokens they emit.

* The split pattern: eight states over nine symbols (a character's class, with
  the one or two characters of context that the pattern looks at). A chunk of
  characters is a map from states to states; the maps of the chunks are composed
  by a parallel prefix scan in numpy, which gives the state at every chunk's
  start, and each chunk then marks where its matches begin.
* The merges, over the bytes of a match. A state holds, for each place where a
  token that is still open may have begun, the node of the vocabulary's tree, the
  last token before that place and the tokens counted since. A token extends the
  encoding if and only if it may follow that last token (the pair encodes to
  itself), so exactly one open token closes at each byte and the transition's
  count is known. States are compiled as texts first reach them, and a match's
  count, once known, is kept by the worker.

Special strings inside a text are found first and count one token each, as the
library does by default. Nothing is shuffled.

Defined results: a null or empty text has no bytes and no tokens; repeated rows
are each counted; an empty table gives an empty one; only the key and the text
are read. A text over a million characters is counted piece by piece, each cut
where a match begins.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refyield.llm.common import map_arrow, table, text_or_empty

LIMIT = 1024
#: Characters in a chunk of the scan, characters taken at a time, matches and
#: transitions kept by a worker.
CHUNK, CHARS, KEPT, COMPILED = 64, 1_000_000, 400_000, 500_000

# Symbols of the split transducer: letter, number, other, apostrophe that opens
# a contraction of two or three characters, last blank of a run before a visible
# character (space or other), any other blank, end of text.
LETTER, NUMBER, OTHER, SHORT, LONG, LAST_SPACE, LAST_BLANK, BLANK, END = range(9)
# States: between matches, in letters, numbers, others or blanks, after the space
# that opens a match, one or two characters before a contraction's end.
FREE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANKS, AFTER_SPACE, ONE_MORE, TWO_MORE = range(8)
STATES = 8

# The characters with Unicode's White_Space property.
WHITE_SPACE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def _split_transducer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and 'a match begins here' by symbol and state."""
    nxt = np.zeros((9, STATES), np.uint8)
    begins = np.ones((9, STATES), bool)
    joins = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}
    for symbol, state in joins.items():
        nxt[symbol] = state
        begins[symbol, [state, AFTER_SPACE]] = False
    for symbol, state in ((SHORT, ONE_MORE), (LONG, TWO_MORE)):
        nxt[symbol] = state
        nxt[symbol, [IN_OTHERS, AFTER_SPACE]] = IN_OTHERS
        begins[symbol, [IN_OTHERS, AFTER_SPACE]] = False
    nxt[LAST_SPACE], nxt[LAST_BLANK], nxt[BLANK], nxt[END] = AFTER_SPACE, FREE, IN_BLANKS, FREE
    begins[BLANK, IN_BLANKS] = False
    # the letters of a contraction
    nxt[LETTER, ONE_MORE], nxt[LETTER, TWO_MORE] = FREE, ONE_MORE
    begins[LETTER, [ONE_MORE, TWO_MORE]] = False
    return nxt, begins


NEXT, BEGINS = _split_transducer()


@lru_cache(1)
def char_classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or BLANK of each code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[list(WHITE_SPACE)] = BLANK
    return out


def symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols of code points; ``ends`` are the places of ends of text."""
    kind = char_classes()[points]
    kind[ends] = END
    after = np.append(kind[1:], END)
    visible = (after != BLANK) & (after != END)
    out = kind.copy()
    blank = kind == BLANK
    out[blank & visible] = LAST_BLANK
    out[blank & visible & (points == 32)] = LAST_SPACE
    quotes = np.flatnonzero((points == 39) & (kind != END))
    if len(quotes):
        padded = np.append(points, [0, 0])
        one, two = padded[quotes + 1], padded[quotes + 2]
        ended = np.append(kind, [END, END])
        one = np.where(ended[quotes + 1] == END, 0, one)
        two = np.where(ended[quotes + 2] == END, 0, two)
        out[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
        long = (one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        out[quotes[long]] = LONG
    return out


def scan(symbol: np.ndarray) -> np.ndarray:
    """Where matches begin (bool), from the state between matches."""
    n = len(symbol)
    chunks = -(-n // CHUNK)
    grid = np.full(chunks * CHUNK, END, np.uint8)
    grid[:n] = symbol
    grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T)
    step = NEXT.ravel()
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (chunks, 1))
    for row in grid:
        maps = step[row[:, None].astype(np.uint16) * STATES + maps]
    reach = 1
    while reach < chunks:  # every map with the one that ends where it starts
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), 1)
        reach *= 2
    state = np.append(np.uint8(FREE), maps[:-1, FREE])
    found = np.empty(grid.shape, bool)
    begins = BEGINS.ravel()
    for k, row in enumerate(grid):
        at = row.astype(np.uint16) * STATES + state
        found[k] = begins[at]
        state = step[at]
    return found.T.ravel()[:n]


class MergeTransducer:
    """Counts the tokens of a match, one byte at a time."""

    def __init__(self, model: dict):
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = dict(zip(printable, map(chr, printable), strict=True))
        shown |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
        self.byte_of = {c: b for b, c in shown.items()}
        as_bytes = lambda s: bytes(self.byte_of[c] for c in s)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {(as_bytes(a), as_bytes(b)): rank for rank, (a, b) in enumerate(pairs)}
        self.follows: dict[tuple[bytes | None, bytes], bool] = {}
        self.child: dict[int, int] = {}
        self.token: list[bytes | None] = [None]
        self.inner = [True]
        reachable = {bytes([b]) for b in range(256)} | {a + b for a, b in self.merges}
        for t in reachable:
            node = 0
            for b in t:
                self.inner[node] = True
                node = self.child.setdefault(node << 8 | b, len(self.token))
                if node == len(self.token):
                    self.token.append(None)
                    self.inner.append(False)
            self.token[node] = t
        self.reset()

    def reset(self) -> None:
        start = ((0, None, 0),)
        self.states, self.number, self.moves = [start], {start: 0}, {}

    def encoded(self, word: bytes) -> list[bytes]:
        """The tokens of a short word, merge by merge."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while True:
            ranked = [(self.merges[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in self.merges]
            if not ranked:
                return parts
            pair = tuple(parts[(i := min(ranked)[1]) : i + 2])
            out, i = [], 0
            while i < len(parts):
                joined = tuple(parts[i : i + 2]) == pair
                out.append(parts[i] + parts[i + 1] if joined else parts[i])
                i += 1 + joined
            parts = out

    def may_follow(self, last: bytes | None, token: bytes) -> bool:
        known = self.follows.get((last, token))
        if known is None:
            if len(self.follows) > COMPILED:
                self.follows.clear()
            known = self.encoded((last or b"") + token) == ([token] if last is None else [last, token])
            self.follows[last, token] = known
        return known

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """The next state and the tokens that the transition emits."""
        open_, closed, gained = [], None, 0
        for node, last, count in self.states[state]:
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            token = self.token[node]
            if token is not None and closed is None and self.may_follow(last, token):
                closed, gained = token, count + 1
            if self.inner[node]:
                open_.append((node, last, count))
        key = (*((n, t, c - gained) for n, t, c in open_), (0, closed, 0))
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
        move = self.moves[state << 8 | byte] = self.number[key], gained
        return move

    def count(self, word: bytes) -> int:
        if len(self.moves) > COMPILED:
            self.reset()
        state, total, moves = 0, 0, self.moves.get
        for b in word:
            move = moves(state << 8 | b) or self.compile(state, b)
            state = move[0]
            total += move[1]
        return total


class TokenCounter(dict):
    """Counts by match; a missing one is run through the merge transducer."""

    def __init__(self, tokenizer_json: bytes):
        spec = json.loads(tokenizer_json)
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("only byte-level tokenizers with the standard split are compiled")
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.merger = MergeTransducer(spec["model"])

    def __missing__(self, word: str) -> int:
        n = self.merger.count(word.encode("utf-8", "surrogatepass"))
        if len(self) >= KEPT:
            self.clear()
        self[word] = n
        return n

    def count_plain(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text, without regard to special strings."""
        joined = "\0".join([*texts, ""])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
        begins = scan(symbols(points, ends))
        begins[ends] = True
        at = np.flatnonzero(begins)
        is_end = np.zeros(len(points), bool)
        is_end[ends] = True
        word = ~is_end[at]
        stops = np.append(at[1:], len(points))
        counts = map(self.__getitem__, [joined[a:b] for a, b in zip(at[word].tolist(), stops[word].tolist(), strict=True)])
        running = np.append(0, np.cumsum(np.fromiter(counts, np.int64, int(word.sum()))))
        upto = running[np.searchsorted(at[word], ends)]
        return np.diff(upto, prepend=0)

    def count_long(self, text: str) -> int:
        """A long text piece by piece; a piece ends where its last match begins."""
        total, take = 0, CHARS
        while len(text) > take:
            head = text[: take + 4]
            points = np.frombuffer(head.encode("utf-32-le", "surrogatepass"), "<u4")
            at = np.flatnonzero(scan(symbols(points, np.zeros(0, np.int64)))[:take])
            if at[-1] == 0:  # one match so far
                take *= 2
                continue
            total += int(self.count_plain([text[: at[-1]]])[0])
            text, take = text[at[-1] :], CHARS
        return total + int(self.count_plain([text])[0])

    def count_texts(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        parts: list[str] = []
        owners: list[int] = []
        held = 0

        def flush() -> None:
            if parts:
                for k, n in zip(owners, self.count_plain(parts).tolist(), strict=True):
                    out[k] += n
                parts.clear()
                owners.clear()

        for k, text in enumerate(texts):
            pieces = [text]
            for special in self.specials:
                pieces = [p for piece in pieces for p in piece.split(special)]
            out[k] += len(pieces) - 1
            for p in pieces:
                if len(p) > CHARS:
                    out[k] += self.count_long(p)
                    continue
                parts.append(p)
                owners.append(k)
                held += len(p)
            if held > CHARS:
                flush()
                held = 0
        flush()
        return out


@lru_cache(2)
def worker_counter(tokenizer_json: bytes) -> TokenCounter:
    """The counter of this Python worker."""
    return TokenCounter(tokenizer_json)


def token_counts(docs: DataFrame, tokenizer_json: bytes, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Replace the column ``text`` by its token count ``out``."""
    others = [c for c in docs.columns if c != text]
    source = docs.select(*others, text_or_empty(text).alias(text))
    schema = source.select(*others, F.lit(0).cast("long").alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(tokenizer_json)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                counts = counter.count_texts(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(counts, pa.int64())], names=schema.names)

    return map_arrow(source, run, schema)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the public byte-level vocabulary."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        tokenizer = f.read()  # about 2 MB, sent with the tasks
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length(text_or_empty()).cast("long").alias("n_bytes"), "text")
    return token_counts(docs, tokenizer).withColumn("over_limit", F.col("n_tokens") > LIMIT)
