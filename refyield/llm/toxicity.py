"""Operator 9: toxicity by a bidirectional gated recurrent network in numpy.

A word's input is a learned vector of its own and the mean of learned vectors of its
byte 4-grams, so that unseen forms of a known stem are recognised. Words and 4-grams
have vectors if ``MIN_TEXTS`` of the texts fitted on hold them (half, of very few);
all others have zeros, so that what is told of one text alone is not learnt. Two gated
recurrent units read a window of 32 words in both directions; attention over
their states pools the window, which gets one logit. Windows start every 16 words
and the last ends with the text, so that all of a text is read by overlapping
windows; its score is that of its highest window.

The network is fitted on the driver on at most ``FIT_TOXIC`` + ``FIT_CLEAN``
labelled rows (those with a text whose ids have the least hashes, a text of each),
a fifth of which is held back. Texts are fitted on whole: each step draws
``FIT_WINDOWS`` windows from all of a text, and leaves out four in ten words. Every
text is then read whole by the tasks, each of which gets the weights (some MB); the
input gates of a word are computed once a worker. The logits are shifted so that 0.7 is the score with the
best F1 on all labelled rows, of any length, that were neither held out nor fitted on.

Defined results: a null or empty text is one empty window and gets its score;
without labelled rows of both kinds that have a text every score is 0; repeated rows are each
scored; repeated labels of a row count as the highest; an empty table gives an
empty one. The label tables' and documents' other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refyield.llm.common import map_arrow, staged, table
from refyield.llm.shingles import _pieces

WINDOW, STRIDE, PIECE = 32, 16, 32
WORD_DIMS, GRAM_DIMS, HIDDEN, GRAM = 8, 12, 8, 4
INPUTS = WORD_DIMS + GRAM_DIMS
FIT_TOXIC, FIT_CLEAN = 1000, 2000
#: Windows of a text that a step of the fit reads, drawn anew each time.
FIT_WINDOWS = 32
STEPS, RATE, SEED = 300, 0.01, 9
DROPOUT, KEEP_WORD, DECAY = 0.3, 0.6, 0.1
#: Words and 4-grams in fewer of the texts fitted on have a vector of zeros.
MIN_TEXTS = 4
#: Of the soft maximum over a text's windows.
SHARPNESS = 2
THRESHOLD = 0.7
#: Steps of a logit that count as one in placing the threshold.
BINS = 256
#: Words whose gates a worker keeps, and windows it scores at a time.
KEPT, WINDOWS = 100_000, 1024


def cut_words(words: list[str]) -> list[str]:
    """Words of at most ``PIECE`` characters; longer ones in pieces."""
    if any(len(w) > PIECE for w in words):
        return [w[i : i + PIECE] for w in words for i in range(0, len(w), PIECE)]
    return words


def split_words(text: str) -> list[str]:
    return cut_words(text.split())


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words; their 4-grams, and where each word's begin."""
    plain = [w.lower().strip(".,;:!?\"'()[]") for w in words]
    rows = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))  for w in plain), np.uint64, len(words))
    framed = [b"\x02" + w.encode("utf-8", "surrogatepass") + b"\x03\x03\x03" for w in plain]
    sizes = np.fromiter(map(len, framed), np.int64, len(framed))
    raw = np.frombuffer(b"".join(framed) + b"\0" * GRAM, np.uint8).astype(np.uint64)
    n = len(raw) - GRAM
    code = sum(raw[k : k + n] << np.uint64(8 * k) for k in range(GRAM))
    ends = np.cumsum(sizes)
    begins = ends - sizes
    inside = np.arange(n) < np.repeat(ends - GRAM + 1, sizes)  # one at least, as the frame has four bytes
    counts = np.add.reduceat(inside, begins) if len(words) else np.zeros(0, np.int64)
    return rows, code[inside], np.cumsum(counts) - counts


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def windows_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of so many words, laid end to end: each window's first word and
    end of text, and each text's first window."""
    first, stop, begin, n = [], [], [], 0
    at = np.cumsum(lengths) - lengths
    for a, size in zip(at.tolist(), lengths.tolist(), strict=True):
        begin.append(n)
        last = max(0, size - WINDOW)
        starts = [*range(0, last, STRIDE), last]
        first += [a + s for s in starts]
        stop += [a + size] * len(starts)
        n += len(starts)
    return np.array(first, np.int64), np.array(stop, np.int64), np.array(begin, np.int64)


def drawn(rng: np.random.Generator, begin: np.ndarray, stop: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``FIT_WINDOWS`` windows of each text, any of them, in order; all of a text with fewer."""
    sizes = np.diff(np.append(texts, len(begin)))
    order = np.lexsort((rng.random(len(begin)), np.repeat(np.arange(len(sizes)), sizes)))
    kept = np.sort(order[np.arange(len(begin)) - np.repeat(texts, sizes) < FIT_WINDOWS])
    sizes = np.minimum(sizes, FIT_WINDOWS)
    return begin[kept], stop[kept], np.cumsum(sizes) - sizes


def shared(texts: list[np.ndarray], every: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes and the 4-grams, in order, that ``MIN_TEXTS`` of the texts (of
    word numbers) hold, or half of them if that is fewer."""
    parts = [[np.unique(f) for f in taken(every, np.unique(t))[:2]] for t in texts]
    out = []
    for found in zip(*parts, strict=True):
        values, counts = np.unique(np.concatenate(found), return_counts=True)
        out.append(values[counts >= min(MIN_TEXTS, len(texts) // 2)])
    return out[0], out[1]


def taken(every: tuple[np.ndarray, np.ndarray, np.ndarray], words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of some of the words."""
    rows, grams, begins = every
    counts = np.diff(np.append(begins, len(grams)))[words]
    ends = np.cumsum(counts)
    shift = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
    return rows[words], grams[np.repeat(begins[words], counts) + shift], ends - counts


class GatedPair:
    """The network: parameters, training and window logits."""

    def __init__(self, seed: int = SEED, known: tuple[np.ndarray, np.ndarray] | None = None):
        rng = np.random.default_rng(seed)
        d, h = INPUTS, HIDDEN
        draw = lambda *s, scale=0.1: rng.normal(0, scale, s).astype(np.float32)
        #: Word hashes and 4-grams that have a vector, in order; the last row of a table is that of all others.
        self.known = known or (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        self.p = {"word": draw(len(self.known[0]) + 1, WORD_DIMS), "gram": draw(len(self.known[1]) + 1, GRAM_DIMS), "attend": draw(2 * h, scale=0.5), "out": draw(2 * h, scale=0.5), "bias": np.zeros(1, np.float32)}
        self.p["word"][-1] = self.p["gram"][-1] = 0
        for k in "fb":
            self.p |= {f"W{k}": draw(d, 3 * h, scale=0.4), f"c{k}": np.zeros(3 * h, np.float32), f"U{k}": draw(h, 3 * h, scale=0.3)}

    def rows(self, features: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes and 4-grams as rows of the tables."""
        found = []
        for values, known in zip(features[:2], self.known, strict=True):
            at = np.searchsorted(known, values)
            held = at < len(known)
            held[held] = known[at[held]] == values[held]
            found.append(np.where(held, at, len(known)))
        return found[0], found[1], features[2]

    def inputs(self, features: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Of words, by rows of the tables."""
        rows, grams, begins = features
        if not len(rows):
            return np.zeros((0, INPUTS), np.float32)
        counts = np.diff(np.append(begins, len(grams)))[:, None].astype(np.float32)
        return np.hstack([self.p["word"][rows], np.add.reduceat(self.p["gram"][grams], begins) / counts])

    def gates(self, x: np.ndarray) -> np.ndarray:
        """Input gates of both directions, side by side."""
        return np.hstack([x @ self.p["Wf"] + self.p["cf"], x @ self.p["Wb"] + self.p["cb"]])

    def states(self, gates: np.ndarray, words: np.ndarray, mask: np.ndarray, kept: list | None = None) -> np.ndarray:
        """(T, N, 2H) states; ``kept`` collects what training needs."""
        n, steps = words.shape
        h3, h = 3 * HIDDEN, HIDDEN
        out = np.zeros((steps, n, 2 * h), np.float32)
        for k, (name, order) in enumerate((("f", range(steps)), ("b", range(steps - 1, -1, -1)))):
            U = self.p[f"U{name}"]
            own = np.ascontiguousarray(gates[:, k * h3 : (k + 1) * h3])
            now = np.zeros((n, h), np.float32)
            for t in order:
                g, a = own[words[:, t]], now @ U
                zr = sigmoid(g[:, : 2 * h] + a[:, : 2 * h])
                z, r, q = zr[:, :h], zr[:, h:], a[:, 2 * h :]
                new = np.tanh(g[:, 2 * h :] + r * q)
                if kept is not None:
                    kept.append((k, t, now, z, r, q, new))
                now = (new + z * (now - new)) * mask[:, t, None]
                out[t, :, k * h : (k + 1) * h] = now
        return out

    def pooled(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Attention weights (T, N), pooled states and logits of windows."""
        e = np.where(mask.T > 0, states @ self.p["attend"], -30)
        w = np.exp(e - e.max(axis=0)) * mask.T
        w = w / np.maximum(w.sum(axis=0), 1e-9)
        c = np.einsum("tn,tnh->nh", w, states)
        return w, c, c @ self.p["out"] + self.p["bias"][0]

    def logits(self, gates: np.ndarray, words: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return self.pooled(self.states(gates, words, mask), mask)[2]

    def gradients(self, features, words: np.ndarray, mask: np.ndarray, texts: np.ndarray, labels: np.ndarray, seen: np.ndarray) -> dict:
        """Of the mean log loss of texts, whose logit is the soft maximum over
        their windows (``texts``: each text's first window). ``seen`` scales the
        inputs of each word (dropout). Windows are read ``WINDOWS`` at a time, so
        that a text of any length needs the memory of that many."""
        p = self.p
        x = self.inputs(features) * seen
        gates = self.gates(x)
        parts = [slice(i, i + WINDOWS) for i in range(0, len(words), WINDOWS)]
        s = np.concatenate([self.logits(gates, words[part], mask[part]) for part in parts])
        sizes = np.diff(np.append(texts, len(s)))
        top = np.repeat(np.maximum.reduceat(s, texts), sizes)
        share = np.exp(SHARPNESS * (s - top))
        share /= np.repeat(np.add.reduceat(share, texts), sizes)
        loss = sigmoid(np.add.reduceat(share * s, texts)) - labels
        ds = (share * np.repeat(loss / len(labels), sizes)).astype(np.float32)
        g = {k: np.zeros_like(p[k]) for k in ("out", "bias", "attend", "Uf", "Ub")}
        dgates = np.zeros((len(x), 6 * HIDDEN), np.float32)
        for part in parts:
            self._back(gates, words[part], mask[part], ds[part], g, dgates)
        dgates[0] = 0  # the padding word
        dx = 0
        for name, d in zip("fb", np.split(dgates, 2, axis=1), strict=True):
            g |= {f"W{name}": x.T @ d, f"c{name}": d.sum(axis=0)}
            dx = dx + d @ p[f"W{name}"].T * seen
        rows, grams, begins = features
        counts = np.diff(np.append(begins, len(grams)))
        g["word"] = np.stack([np.bincount(rows, col, len(p["word"])).astype(np.float32) for col in dx[:, :WORD_DIMS].T], axis=1)
        spread = np.repeat(dx[:, WORD_DIMS:] / counts[:, None], counts, axis=0)
        g["gram"] = np.stack([np.bincount(grams, col, len(p["gram"])).astype(np.float32) for col in spread.T], axis=1)
        g["word"][-1] = g["gram"][-1] = 0
        return g

    def _back(self, gates: np.ndarray, words: np.ndarray, mask: np.ndarray, ds: np.ndarray, g: dict, dgates: np.ndarray) -> None:
        """Add the gradients of some windows, ``ds`` those of their logits, to ``g``
        and to ``dgates``, those of the words' input gates."""
        p, h, h3 = self.p, HIDDEN, 3 * HIDDEN
        kept: list = []
        states = self.states(gates, words, mask, kept)
        w, c, _ = self.pooled(states, mask)
        g["out"] += c.T @ ds
        g["bias"] += ds.sum(keepdims=True)
        dc = ds[:, None] * p["out"]
        dw = np.einsum("tnh,nh->tn", states, dc)
        de = w * (dw - (w * dw).sum(axis=0))
        g["attend"] += np.einsum("tn,tnh->h", de, states)
        dstates = w[:, :, None] * dc + de[:, :, None] * p["attend"]
        own = np.zeros((words.shape[1], len(words), 2 * h3), np.float32)
        back = [np.zeros((len(words), h), np.float32) for _ in "fb"]
        for k, t, before, z, r, q, new in reversed(kept):
            U = "fb"[k]
            d = (dstates[t, :, k * h : (k + 1) * h] + back[k]) * mask[:, t, None]
            dnew = d * (1 - z) * (1 - new * new)
            dz = d * (before - new) * z * (1 - z)
            dr = dnew * q * r * (1 - r)
            da = np.hstack([dz, dr, dnew * r])
            own[t, :, k * h3 : (k + 1) * h3] = np.hstack([dz, dr, dnew])
            g[f"U{U}"] += before.T @ da
            back[k] = d * z + da @ p[f"U{U}"].T
        flat = words.T.ravel()
        dgates += np.stack([np.bincount(flat, col, len(dgates)) for col in own.reshape(len(flat), -1).T], axis=1).astype(np.float32)

    @classmethod
    def fitted(cls, toxic: list[str], clean: list[str], steps: int = STEPS, seed: int = SEED) -> GatedPair:
        """Adam over balanced batches of texts."""
        rng = np.random.default_rng(seed)
        split = [[split_words(t) or [""] for t in part] for part in (toxic, clean)]
        names = {w: i for i, w in enumerate(dict.fromkeys(["", *(w for part in split for t in part for w in t)]))}
        every = word_features(list(names))
        coded = [[np.array([names[w] for w in t]) for t in part] for part in split]
        net = cls(seed, shared([t for part in coded for t in part], every))
        every = net.rows(every)
        first = {k: np.zeros_like(v) for k, v in net.p.items()}
        second = {k: np.zeros_like(v) for k, v in net.p.items()}
        for step in range(1, steps + 1):
            chosen = [part[i] for part, n in zip(coded, (16, 24), strict=True) for i in rng.integers(0, len(part), n)]
            labels = np.repeat([1.0, 0.0], [16, 24])
            begin, stop, texts = windows_of(np.array([len(t) for t in chosen]))
            begin, stop, texts = drawn(rng, begin, stop, texts)
            flat = np.concatenate(chosen)
            at = begin[:, None] + np.arange(WINDOW)
            mask = (at < stop[:, None]).astype(np.float32)
            used, words = np.unique(np.where(mask > 0, flat[np.minimum(at, len(flat) - 1)], 0), return_inverse=True)
            if used[0] != 0:
                used, words = np.append(0, used), words + 1
            seen = np.ones((len(used), INPUTS), np.float32)
            seen[:, :WORD_DIMS] = (rng.random((len(used), 1)) < 1 - DROPOUT) / (1 - DROPOUT)
            seen *= rng.random((len(used), 1)) < KEEP_WORD
            g = net.gradients(taken(every, used), words.reshape(at.shape), mask, texts, labels, seen)
            rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
            for k, v in g.items():
                first[k] += 0.1 * (v - first[k])
                second[k] += 0.01 * (v * v - second[k])
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                net.p[k] = (net.p[k] * (1 - DECAY * rate) - rate * move).astype(np.float32)
        return net


class Scorer:
    """Scores of whole texts by a fitted network."""

    def __init__(self, net: GatedPair, shift: float = 0.0):
        self.net, self.shift = net, shift
        self.reset()

    def reset(self) -> None:
        self.place = {"": 0}
        self.gates = np.zeros((KEPT + 1, 6 * HIDDEN), np.float32)
        self.gates[:1] = self.net.gates(self.net.inputs(self.net.rows(word_features([""]))))

    def numbers(self, words: list[str]) -> np.ndarray:
        place = self.place
        new = [w for w in dict.fromkeys(words) if w not in place]
        if len(place) + len(new) > KEPT:
            self.reset()
            place = self.place
            new = [w for w in dict.fromkeys(words) if w not in place]
        if new:
            at = len(place)
            if at + len(new) > len(self.gates):
                self.gates = np.vstack([self.gates, np.zeros((len(new), 6 * HIDDEN), np.float32)])
            self.gates[at : at + len(new)] = self.net.gates(self.net.inputs(self.net.rows(word_features(new))))
            place.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(place.__getitem__, words), np.int64, len(words))

    def part_logits(self, parts: list[list[str]]) -> np.ndarray:
        """The highest window logit of each list of words."""
        flat = np.append(self.numbers([w for p in parts for w in p]), 0)
        begin, stop, texts = windows_of(np.array([len(p) for p in parts], np.int64))
        out = []
        for i in range(0, len(begin), WINDOWS):
            at = begin[i : i + WINDOWS, None] + np.arange(WINDOW)
            inside = at < stop[i : i + WINDOWS, None]
            out.append(self.net.logits(self.gates, np.where(inside, flat[np.minimum(at, len(flat) - 1)], 0), inside.astype(np.float32)))
        return np.maximum.reduceat(np.concatenate(out), texts)

    def logits(self, texts: list[str]) -> np.ndarray:
        parts, owner = [], []
        for k, text in enumerate(texts):
            held: list[str] = []
            for piece in _pieces(text):
                full = len(held) // STRIDE * STRIDE
                if full > 2 * WINDOW:  # go on from a window's start, so that all start as in the whole text
                    parts.append(held[:full])
                    owner.append(k)
                    held = held[full - WINDOW :]
                held += cut_words(piece)
            parts.append(held)
            owner.append(k)
        out = np.full(len(texts), -np.inf)
        np.maximum.at(out, owner, self.part_logits(parts))
        return out

    def scores(self, texts: list[str]) -> list[float]:
        return sigmoid(self.logits(texts) + self.shift).tolist() if texts else []


def best_shift(bins: dict[int, dict[int, float]]) -> float:
    """What to add to logits so that the threshold has the best F1, by the weights
    of the bins that toxic (1) and clean (0) rows fall in."""
    every = np.array(sorted({*bins[0], *bins[1]}))
    toxic, clean = (np.array([bins[k].get(b, 0.0) for b in every.tolist()]) for k in (1, 0))
    hit, wrong = (np.append(np.cumsum(x[::-1])[::-1][1:], 0.0) for x in (toxic, clean))
    cuts = np.append((every[1:] + every[:-1] + 1) / 2, every[-1] + 1 + BINS) / BINS
    f1 = 2 * hit / (hit + wrong + toxic.sum())
    good = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(np.log(THRESHOLD / (1 - THRESHOLD)) - cuts[good[len(good) // 2]])


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose doc_id has a label and is not held out, with it as ``toxic``."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(~is_held_out(F.col("doc_id")))
    return rows.join(known.withColumnRenamed("doc_id", "_d"), F.col("doc_id") == F.col("_d")).drop("_d")


def fit_network(docs: DataFrame, labels: DataFrame) -> tuple[GatedPair, list] | None:
    """Fit on a bounded sample of the labelled rows that are not held out; also
    gives the ids fitted on."""
    docs = docs.select("doc_id", "text").filter("text <> ''")
    ids = with_labels(docs.select("doc_id"), labels).distinct()
    ids = staged(ids.withColumn("_h", F.xxhash64("doc_id")), "toxicity-ids")
    if ids.select("toxic").distinct().count() < 2:
        return None
    fitted: dict[int, list] = {}
    for kind, most in ((1, FIT_TOXIC), (0, FIT_CLEAN)):
        chosen = ids.filter(F.col("toxic") == kind).orderBy("_h", "doc_id").limit(most).select(F.col("doc_id").alias("_d"), "_h")
        found = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("_d")).select("_h", "_d", "text")
        rows = found.groupBy("_h", "_d").agg(F.min("text").alias("text")).orderBy("_h", "_d").select("_d", "text").collect()
        fitted[kind] = rows[max(1, len(rows) // 5) :] or rows
    net = GatedPair.fitted(*([r["text"] for r in fitted[kind]] for kind in (1, 0)))
    return net, [r["_d"] for rows in fitted.values() for r in rows]


def placed_shift(rows: DataFrame, labels: DataFrame, fitted: list) -> float:
    """The best shift for all labelled rows (doc_id, _logit) that are neither held
    out nor fitted on, each kind weighed by its number of labelled rows. A kind
    with no others is judged by those fitted on."""
    binned = rows.groupBy("doc_id", F.floor(F.col("_logit") * BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    known = with_labels(binned, labels).groupBy("toxic", F.col("doc_id").isin(fitted).alias("seen"), "bin").agg(F.sum("n").alias("n"))
    counts = known.collect()
    bins: dict[int, dict[int, float]] = {}
    for kind in (0, 1):
        own = [r for r in counts if r["toxic"] == kind]
        placed = [r for r in own if not r["seen"]] or own
        weight = sum(r["n"] for r in own) / sum(r["n"] for r in placed)
        bins[kind] = {r["bin"]: r["n"] * weight for r in placed}
    return best_shift(bins)


def fit_scorer(docs: DataFrame, labels: DataFrame) -> Scorer | None:
    """A scorer fitted and placed on the labelled rows that are not held out."""
    found = fit_network(docs, labels)
    if found is None:
        return None
    rows = with_logits(with_labels(docs.select("doc_id", "text"), labels).select("doc_id", "text"), found[0], keep_text=False)
    return Scorer(found[0], placed_shift(rows, labels, found[1]))


def with_logits(docs: DataFrame, net: GatedPair, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add ``_logit``, of the whole text, to the documents (``keep_text``: with
    their texts)."""
    kept = [c for c in docs.columns if keep_text or c != text]
    schema = docs.select(*kept, F.lit(0.0).alias("_logit")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(net)
        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                part = batch.slice(i, 128)
                logits = own.logits([t or "" for t in part.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(logits, pa.float64())], names=[*kept, "_logit"])

    return map_arrow(docs, run, schema)


def scored(docs: DataFrame, labels: DataFrame, out: str = "score", keep_text: bool = True) -> DataFrame:
    """Add ``out`` to the documents (``keep_text``: with their texts), by a network
    fitted on their labels. Texts are read by it once: their logits are written,
    and the threshold is placed on those of the labelled rows."""
    kept = [c for c in docs.columns if keep_text or c != "text"]
    found = fit_network(docs, labels)
    if found is None:
        return docs.select(*kept, F.lit(0.0).alias(out))
    rows = staged(with_logits(docs, found[0], keep_text=keep_text), "toxicity-logits")
    shift = placed_shift(rows, labels, found[1])
    return rows.select(*kept, (1 / (1 + F.exp(-(F.col("_logit") + shift)))).alias(out))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "text")
    rows = scored(docs, table(spark, sf_dir, "labels"), keep_text=False)
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
