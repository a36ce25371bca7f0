"""Resampling, decontamination and clustering: against plain loops and DuckDB."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest_llm import DOCS, doc, odd_rows, words
from oracle_check import compare
from refyield.llm import clustering, decontamination, resampling, wordbytes
from refyield.llm.queries import ORACLE_SQL, QUERIES
from test_native import duck

NOT_WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ITEMS = "item_id long, text string, words string, fp string, window string"


def split(text: str | None) -> list[bytes]:
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    return re.findall(NOT_WORD, (text or "").encode().translate(lower))


def item(item_id, text):
    return (item_id, text, "x", "x", "x")


@pytest.fixture(scope="module")
def tables(spark, write_tables):
    """(folder, documents, items): the odd documents and more, with planted windows."""
    rng = random.Random(3)
    eleven, nine, cjk = words(rng, 11), words(rng, 9), "你好" * 40
    items = [
        item(1, eleven),
        item(2, eleven),
        item(3, words(rng, 30)),
        item(10, nine),
        item(11, words(rng, 5)),
        item(12, "solo"),
        item(13, None),
        item(14, " -- "),
        item(None, words(rng, 14)),
        item(15, "Tie tie TIE tie tie tie tie tie tie tie tie tie"),
        item(15, words(rng, 12)),
        item(16, f"{cjk} a {cjk} b {cjk} c d e f g h"),
    ]
    docs = odd_rows()
    long = [f"v{rng.randrange(900)}" for _ in range(20_000)]
    for k, (_, text, *_) in enumerate(items):
        at = rng.randrange(19_000)
        long[at:at] = split(text)[:0] or (text or "").split()
        before, after = words(rng, rng.randrange(0, 30)), words(rng, rng.randrange(0, 30))
        docs.append(doc(500 + k, f"{before} {text or ''}\n{after}"))
        docs.append(doc(600 + k, " ".join((text or "").split()[:9])))
        docs.append(doc(700 + k, (text or "").upper().replace(" ", ", ")))
    docs.append(doc(800, " ".join(long)))
    docs.append(doc(801, "tie " * 40))
    docs += [doc(802, eleven + " " + eleven)] * 3
    docs += [doc(None, f"{eleven} {i % 2}") for i in range(30)]
    folder = write_tables(
        documents=spark.createDataFrame(docs, DOCS).repartition(5),
        benchmark=spark.createDataFrame(items, ITEMS).repartition(2),
    )
    return folder, docs, items


@pytest.mark.parametrize("name", ["op11_resample", "op12_decontamination"])
def test_statement_on_planted_rows(spark, tables, name):
    ok, msg = compare(spark, duck(tables[0]), name, QUERIES[name], ORACLE_SQL[name], tables[0])
    assert ok, msg


@pytest.mark.parametrize("name", ["op11_resample", "op12_decontamination", "op13_vantage_clusters"])
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def test_documents_without_a_benchmark(spark, write_tables):
    folder = write_tables(
        documents=spark.createDataFrame(odd_rows(), DOCS),
        benchmark=spark.createDataFrame([], "item_id long, text string"),
    )
    got = QUERIES["op12_decontamination"](spark, folder).collect()
    assert len(got) == len(odd_rows()) and not any(r.contaminated or r.n_hit or r.n_items for r in got)
    rows = QUERIES["op11_resample"](spark, folder).collect()
    assert len(rows) == len(odd_rows()) and [r["rank"] for r in rows if r["rank"]] == [1]


# -- resampling -------------------------------------------------------------


def features(text) -> list[int]:
    w = split(text)
    return [zlib.crc32(b" ".join(w[i : i + r])) % 10_000 for r in (1, 2, 3) for i in range(len(w) - r + 1)]


def test_resampling_by_plain_loops(spark, tables):
    folder, docs, items = tables
    found = [features(d[1]) for d in docs]
    s, t = Counter(b for f in found for b in f), Counter(b for i in items for b in features(i[1]))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in range(10_000)]
    rows = []
    for d, f in zip(docs, found, strict=True):
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{'null' if d[0] is None else d[0]}".encode()).hexdigest()[:8], 16)
        rows.append((d[0], len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(split(d[1]))))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = 5 * len(able) // 100
    assert drawn >= 2
    want = Counter((*r[:4], k + 1) for k, r in enumerate(able[:drawn])) + Counter((*r[:4], None) for r in able[drawn:])
    want += Counter((*r[:4], None) for r in rows if r[4] < 20)
    assert Counter(tuple(r) for r in QUERIES["op11_resample"](spark, folder).collect()) == want


@pytest.mark.parametrize("piece", [1 << 20, 60, 5])
def test_features_of_pieces(piece):
    rng = random.Random(piece)
    hashed = resampling.FeatureHash(piece=piece)
    for _ in range(60):
        texts = [" ".join(rng.choice(["Ab", "é" * rng.randrange(1, 60), "1a,", "-", "", "y" * rng.randrange(1, 200)]) for _ in range(rng.randrange(30))) for _ in range(rng.randrange(1, 6))]
        got: Counter = Counter()
        n_words = np.zeros(len(texts), int)
        for bucket, owner, more in hashed([t.encode() for t in texts]):
            got.update(zip(owner.tolist(), bucket.tolist(), strict=True))
            n_words += more
        assert got == Counter((i, b) for i, t in enumerate(texts) for b in features(t))
        assert n_words.tolist() == [len(split(t)) for t in texts]


def test_planes_sum_exactly():
    rng = np.random.default_rng(4)
    gain = rng.integers(-20_000, 20_000, 10_000)
    counts = np.stack([rng.integers(0, 10**e, 10_000) * (rng.random(10_000) < 0.3) for e in range(1, 8)] + [np.zeros(10_000, int)])
    assert resampling.GainPlanes(gain).weights(counts) == (counts @ gain).tolist()
    assert resampling.GainPlanes(np.zeros(10_000, int)).weights(counts) == [0] * 8


# -- decontamination --------------------------------------------------------


def brute_hits(docs, items):
    windows: dict[tuple, set] = {}
    for i, text, *_ in items:
        w = split(text)
        n = min(len(w), 10)
        for s in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[s : s + n]), set()).add("null" if i is None else str(i))
    lengths = {len(w) for w in windows}
    for d, text, *_ in docs:
        w = split(text)
        hit, held = set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if found := windows.get(tuple(w[s : s + n])):
                    hit |= set(range(s, s + n))
                    held |= found
        yield d, len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit)


def test_decontamination_by_plain_loops(spark, tables):
    folder, docs, items = tables
    got = Counter(tuple(r) for r in QUERIES["op12_decontamination"](spark, folder).collect())
    assert got == Counter(brute_hits(docs, items))
    assert sum(k[5] for k in got) > 20


def test_long_texts_in_pieces(spark, tables, monkeypatch):
    """Pieces of 200 bytes give the same words and the same kept fingerprints."""
    _, docs, _ = tables
    texts = [(d[1] or "").encode() for d in docs]
    for text in texts:
        for n in (10, 7, 1):
            whole, cut = set(), set()
            for out, size in ((whole, 1 << 20), (cut, 200)):
                count = 0
                for _, number, w, old in decontamination.words_of([text], size):
                    starts, fps, places = w.kept(n)
                    count += int(w.n_words[0]) - old
                    out |= {(number + int(s), int(fp), number + int(p), w.spell(s, s + n)) for s, fp, p in zip(starts, fps, places, strict=True) if s + n > old}
                assert count == len(split(text.decode()))
            assert whole == cut


def test_equal_spans_keep_one_fingerprint():
    """Wherever 10 words stand, the same fingerprint is kept, at the same place."""
    rng = random.Random(9)
    span = [rng.choice(["a", "b", "tie"]) for _ in range(10)]
    seen = set()
    for _ in range(50):
        left, right = ([rng.choice("abc") for _ in range(rng.randrange(20))] for _ in range(2))
        (_, _, w, _), = decontamination.words_of([" ".join(left + span + right).encode()])
        starts, fps, places = w.kept(10)
        at = starts.tolist().index(len(left))
        seen.add((int(fps[at]), int(places[at]) - len(left)))
    assert len(seen) == 1


def test_filter_lets_all_members_pass(spark):
    rng = np.random.default_rng(5)
    fps = rng.integers(-(2**63), 2**63 - 1, 5000)
    bloom = decontamination.bloom_filter(spark.createDataFrame([(int(x),) for x in fps], "fp long"), 5000)
    assert decontamination.passes(bloom, fps.view(np.uint64)).all()
    others = rng.integers(-(2**63), 2**63 - 1, 20_000)
    assert decontamination.passes(bloom, others.view(np.uint64)).mean() < 0.02


# -- clustering ---------------------------------------------------------------


def brute_clusters(rows, k=16, rounds=3, dims=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(64 * x) for x in v]))
    kept.sort(key=lambda r: (hashlib.sha256(f"1:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in kept[:k]]
    for r in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids)) for _, v in kept]
        if r == rounds:
            break
        for n in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, near, strict=True) if c == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    cap = lambda x: min(x, 2**63 - 1)
    by: Counter = Counter()
    for d, n in near:
        by[n] += cap(d)
    return Counter(
        (i, n, cap(d), cap(by[n]), cap(sum(by.values())), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest())
        for (i, _), (d, n) in zip(kept, near, strict=True)
    )


def vectors(rng, n):
    centres = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(9)]
    return [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(centres)], 1, "x", "x") for i in range(n)]


VECTORS = "vec_id long, embedding array<double>, label int, cluster string, v string"


def odd_vectors(rng):
    rows = vectors(rng, 150)
    rows += [(rows[0][0], *rows[0][1:])] * 3 + [(None, rows[5][1], None, None, None)] * 2
    rows += [(200 + i, [float((i >> b % 3) & 1) / 64 for b in range(64)], 1, "x", "x") for i in range(40)]  # ties
    rows += [(300, None, 1, "x", "x"), (301, [], 1, "x", "x"), (302, [0.5] * 63, 1, "x", "x"), (303, [0.5] * 65, 1, "x", "x")]
    rows += [(304, [None] + [0.5] * 63, 1, "x", "x"), (305, [math.nan] + [0.5] * 63, 1, "x", "x"), (306, [-math.inf] + [0.5] * 63, 1, "x", "x")]
    return rows


def test_clusters_by_plain_loops(spark, write_tables):
    rows = odd_vectors(random.Random(2))
    folder = write_tables(embeddings=spark.createDataFrame(rows, VECTORS).repartition(4))
    got = Counter(tuple(r) for r in QUERIES["op13_vantage_clusters"](spark, folder).collect())
    assert got == brute_clusters([r[:2] for r in rows])
    ok, msg = compare(spark, duck(folder), "op13", QUERIES["op13_vantage_clusters"], ORACLE_SQL["op13_vantage_clusters"], folder)
    assert ok, msg


@pytest.mark.parametrize("size", [1e6, 1e12, 1e30])
def test_clusters_of_large_components(spark, write_tables, size):
    rng = random.Random(6)
    rows = [(i, [x * size * rng.choice([1, 1, 1e-7]) for x in v], *more) for i, v, *more in vectors(rng, 60)]
    folder = write_tables(embeddings=spark.createDataFrame(rows, VECTORS).repartition(3))
    got = Counter(tuple(r) for r in QUERIES["op13_vantage_clusters"](spark, folder).collect())
    assert got == brute_clusters([r[:2] for r in rows])


def test_fewer_vectors_than_centroids(spark, write_tables):
    rows = vectors(random.Random(8), 5) + [(1, [0.25] * 64, 1, "x", "x")] * 2
    folder = write_tables(embeddings=spark.createDataFrame(rows, VECTORS))
    got = Counter(tuple(r) for r in QUERIES["op13_vantage_clusters"](spark, folder).collect())
    assert got == brute_clusters([r[:2] for r in rows])


@pytest.mark.parametrize("k,dims,spread", [(1, 3, 5), (2, 2, 3), (40, 2, 4), (200, 5, 50), (60, 16, 10**9)])
def test_tree_finds_the_nearest(k, dims, spread):
    rng = random.Random(k)
    point = lambda: [rng.randrange(-spread, spread + 1) for _ in range(dims)]
    centroids = [point() for _ in range(k)]
    centroids += rng.sample(centroids, k // 4)
    rows = [point() for _ in range(300)] + centroids
    number, best = clustering.VantageTree(centroids).nearest(np.array(rows, float))
    want = [min((sum((a - b) ** 2 for a, b in zip(r, c, strict=True)), n) for n, c in enumerate(centroids)) for r in rows]
    assert [(int(d), n) for d, n in zip(best.tolist(), number.tolist(), strict=True)] == want


def test_tree_leaves_off_far_nodes():
    """Of well-parted centroids few distances are taken."""
    rng = np.random.default_rng(1)
    centroids = rng.integers(-10_000, 10_000, (256, 2))
    rows = centroids[rng.integers(0, 256, 500)] + rng.integers(-20, 20, (500, 2))
    seen = []
    plain = clustering.squares
    tree = clustering.VantageTree(centroids.tolist())
    try:
        clustering.squares = lambda r, p: (seen.append(len(r)), plain(r, p))[1]
        tree.nearest(rows.astype(float))
    finally:
        clustering.squares = plain
    assert sum(seen) < 500 * 256 / 4


def test_limbs():
    for v in (0, 1, -1, 2**39 - 1, 2**39, -(2**39), -(2**39) - 1, 10**40, -(10**40)):
        assert sum(part << (clustering.LIMB * place) for place, part in clustering.limbs(v)) == v


def test_words_match_the_pattern():
    text = bytes(range(128)) + "éß你 ".encode() + b"\x00Zz9"
    assert text.translate(wordbytes.WORD_BYTES).split() == re.findall(NOT_WORD, text.translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    for size in (3, 10, 1000):
        pieces = list(wordbytes.pieces(text.translate(wordbytes.WORD_BYTES), size))
        assert b"".join(pieces) == text.translate(wordbytes.WORD_BYTES)
        assert [w for p in pieces for w in p.split()] == text.translate(wordbytes.WORD_BYTES).split()
