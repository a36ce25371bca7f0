"""Near-duplicate operators: against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from conftest_llm import DOCS, doc, words
from pyspark.sql import functions as F

from refyield.llm import blocks, fingerprints, jaccard, shingles, vectors
from refyield.llm.components import components

# -- helpers ----------------------------------------------------------------------


def least_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(1000 + i, 1001 + i) for i in range(200)] + [(5000, 5000), (5000 + 1, 5000), (5000 + 1, 5000)]
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    nodes = {n for p in links for n in p}
    want = least_reachable(nodes, links)
    alone = {n for n in nodes if not any(a != b and n in (a, b) for a, b in links)}
    assert got == {n: r for n, r in want.items() if n not in alone}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_blocks_meet_every_pair_once(spark):
    rows = spark.createDataFrame([(g, k) for g, n in (("a", 1), ("b", 2), ("c", 23)) for k in range(n)], "g string, k long")
    pairs = blocks.in_block_pairs(rows, "g", "k", 5).collect()
    work = defaultdict(list)
    for r in pairs:
        work[r.g, r.lo, r.hi].append((r.blk, r.k))
    met = []
    sizes = defaultdict(int)
    for r in pairs:
        sizes[r.g, r.blk] += r.lo == r.hi
    assert max(sizes.values()) <= 12 and len([k for k in sizes if k[0] == "c"]) == 5
    for (g, lo, hi), members in work.items():
        members.sort()
        for left, right in blocks.row_pairs(np.zeros(1, np.int64), *(np.array(x) for x in ([b for b, _ in members], [lo] * len(members), [hi] * len(members))), most=7):
            met += [(g, *sorted((members[i][1], members[j][1]))) for i, j in zip(left, right, strict=True)]
    assert sorted(met) == sorted([("b", 0, 1), *(("c", i, j) for i in range(23) for j in range(i + 1, 23))])


# -- shingles ---------------------------------------------------------------------


def brute_shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_shingle_sets(monkeypatch):
    rng = random.Random(2)
    for text in ["", " \n", "one", "a b c d", "a b c d e", words(rng, 500, 20)]:
        assert len(shingles.shingle_set(text)) == len(brute_shingles(text))
    text = words(rng, 3000)
    whole = shingles.shingle_set(text).tolist()
    monkeypatch.setattr(shingles, "CHARS", 100)
    assert shingles.shingle_set(text).tolist() == whole
    assert len(shingles.shingle_set("a b c")) == 1


# -- operator 8 ---------------------------------------------------------------------


def brute_chain(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    texts = [t or "" for _, t in rows]
    out = []
    for i, (d, _) in enumerate(rows):
        text, following = texts[i], texts[(i + 1) % len(rows)]
        third = len(text) // 3
        new = text[: len(text) - third] + following[:third]
        a, b, c = (fingerprints.signature(x) for x in (text, new, following))
        out.append((d, len(text), hashlib.sha256(new.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(), float((a == b).mean()), float((a == c).mean())))
    return sorted(out, key=str)


def test_fingerprint_query(spark, odd, empty, write_tables):
    folder, rows = odd
    plain = [(d, t) for d, t, *_ in rows]
    got = sorted((tuple(r) for r in fingerprints.op8_minhash_fingerprints(spark, folder).collect()), key=str)
    assert got == brute_chain(plain)
    assert fingerprints.op8_minhash_fingerprints(spark, empty).count() == 0
    one = write_tables(documents=spark.createDataFrame([doc(5, "abcdef ghi")], DOCS))
    r = fingerprints.op8_minhash_fingerprints(spark, one).first()
    assert (r.near_next, r.edited_sha256) == (1.0, hashlib.sha256(b"abcdef abc").hexdigest())


def test_likeness_estimates_jaccard():
    rng = random.Random(3)
    for _ in range(5):
        a = words(rng, 400)
        b = a.split()
        for i in rng.sample(range(400), 8):
            b[i] = "new"
        b = " ".join(b)
        sa, sb = brute_shingles(a), brute_shingles(b)
        true = len(sa & sb) / len(sa | sb)
        assert abs(fingerprints.likeness(fingerprints.signature(a), fingerprints.signature(b)) - true) < 0.2


def test_near_representatives(spark):
    rng = random.Random(4)
    base = words(rng, 300)
    near = base.split()
    near[10] = "x"
    far = " ".join(base.split()[:150]) + " " + words(rng, 150)
    df = spark.createDataFrame([(3, base), (4, base), (7, " ".join(near)), (9, far), (10, None), (11, ""), (12, words(rng, 90))], "doc_id long, text string")
    got = {(r.doc_id, r.near_id): r.jaccard for r in fingerprints.near_representatives(df).collect()}
    assert set(got) == {(7, 3)}
    a, b = brute_shingles(base), brute_shingles(" ".join(near))
    assert got[7, 3] == len(a & b) / len(a | b)


def test_near_representatives_of_a_shared_template(spark, monkeypatch):
    """Texts alike through a common passage; near pairs under ids that are not the
    least of their buckets, and one pair under a single id."""
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", 8)
    rng = random.Random(6)
    passage = words(rng, 180)
    rows = []
    for i in range(60):
        own = f"{passage} {words(rng, 20)}".split()
        near = [f"x{i}" if k in (30, 70, 110, 150) else w for k, w in enumerate(own)]
        rows += [(2 * i, " ".join(own)), (2 * i + (i > 0), " ".join(near))]
    got = {(r.doc_id, r.near_id) for r in fingerprints.near_representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [brute_shingles(t) for _, t in rows]
    want = {(rows[j][0], rows[i][0]) for i in range(len(rows)) for j in range(i + 1, len(rows)) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert {(2 * i + (i > 0), 2 * i) for i in range(60)} <= want and got == want


# -- operator 10 ----------------------------------------------------------------------


def brute_classes(rows):
    """Sorted (doc_id, class_id, n_links) of (doc_id, text) with distinct ids or
    equal texts for one id."""
    sets = [brute_shingles(t) if t is not None else None for _, t in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] is None or sets[j] is None:
                continue
            same = rows[i][1] == rows[j][1]
            union = len(sets[i] | sets[j])
            if same or union and len(sets[i] & sets[j]) >= 0.8 * union - 1e-9:
                links.append((j, i))
    root = least_reachable(range(len(rows)), links)
    least = defaultdict(list)
    for i, r in root.items():
        if rows[i][0] is not None:
            least[r].append(rows[i][0])
    count = [sum(i in p for p in links) for i in range(len(rows))]
    return sorted(((rows[i][0], min(least[r], default=None), count[i]) for i, r in root.items()), key=str)


def near_rows(rng):
    rows = []
    for g in range(12):
        base = words(rng, rng.randrange(30, 200)).split()
        for _ in range(rng.randrange(1, 12)):
            copy = list(base)
            for i in rng.sample(range(len(copy)), rng.randrange(0, max(1, len(copy) // 40) + 1)):
                copy[i] = f"e{rng.randrange(99)}"
            rows.append(" ".join(copy))
    shared = words(rng, 60)
    rows += [words(rng, 40) + " " + shared for _ in range(20)]
    rows += ["hot text that many rows repeat"] * 40 + ["one two", "one  two", "", "", " ", None, None]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_jaccard_classes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BUCKET_BLOCK", 3)  # groups are cut into many blocks
    monkeypatch.setattr(jaccard, "CLUSTER_BLOCK", 2)
    rows = near_rows(random.Random(6))
    got = jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute_classes(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_a_chain_of_templates_is_no_class(spark, monkeypatch):
    """Neighbours of a chain are alike at 0.65, so one cluster holds them; few link,
    and only texts with a pair to verify are fetched."""
    monkeypatch.setattr(jaccard, "CLUSTER_BLOCK", 8)
    rng = random.Random(12)
    text, rows = [f"w{i}" for i in range(100)], []
    for i in range(60):
        rows.append((i, " ".join(text)))
        for at in range(i % 4 * 5 + 4, 100, 25):
            text[at] = f"n{i}-{at}"
    near = [(200 + i, rows[i][1] + " end") for i in range(0, 60, 20)]
    far = [(300 + i, words(rng, 50)) for i in range(20)]
    rows += near + far
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.jaccard_classes(df).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute_classes(rows)
    keyed = df.select(jaccard.text_key().alias("key"), "text")
    fetched = jaccard.may_hold(keyed, keyed.filter("text LIKE '% end'").select("key"))
    assert 3 <= fetched.count() < 20


def test_a_null_id_is_not_the_least(spark):
    rng = random.Random(5)
    base = words(rng, 100)
    rows = [(None, base), (9, base + " x"), (8, base + " x y")]
    got = jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.class_id, r.n_links, r.kept) for r in got) == [("8", 8, 2, True), ("9", 8, 2, False), ("None", 8, 2, False)]


def test_jaccard_query_on_odd_rows(spark, odd, empty):
    folder, rows = odd
    got = jaccard.op10_jaccard_join(spark, folder).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute_classes([r[:2] for r in rows])
    assert jaccard.op10_jaccard_join(spark, empty).count() == 0


def test_keep_one(spark, odd):
    rows = [r[:2] for r in odd[1]]
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    classes = {c for _, c, _ in brute_classes([r for r in rows if r[1] is not None])}
    assert len([r for r in kept if r.text is not None]) == len(classes)
    assert sorted(r.doc_id for r in kept if r.text is None) == [4, 12]


def test_posterior_keeps_what_may_reach_the_threshold():
    needed = jaccard.needed_matches(0.8, 1e-6)
    assert list(needed) == [32, 64, 96, 128, 160]
    rng = np.random.default_rng(0)
    t = 0.8 + 0.2 / 256
    for n, least in needed.items():
        draws = rng.beta(least, n - least + 2, 200_000)  # one agreement fewer
        assert (draws >= t).mean() < 1e-4
        assert 0 < least < n * t


# -- operator 1 -----------------------------------------------------------------------


def vector_rows(rng):
    rows, n = [], 0
    for g in range(40):
        base = rng.normal(size=48)
        for _ in range(int(rng.integers(1, 25)) if g % 4 == 0 else 1):
            rows.append((n, (base + rng.normal(size=48) * rng.choice([0.02, 0.1, 0.14])).astype(np.float32).tolist(), int(g % 3)))
            n += 1
    rows += [(n, rows[0][1], rows[0][2]), (n + 1, rows[0][1], rows[0][2] + 1), (n + 2, [x * 4 for x in rows[0][1]], rows[0][2])]
    n += 3
    odd = [None, [], [0.0] * 48, [float("nan")] * 48, [float("inf")] + [1.0] * 47, [None] + [1.0] * 47]
    rows += [(n + i, v, 0) for i, v in enumerate(odd)]
    n += len(odd)
    rows += [(n, rows[0][1], None), (n + 1, rows[0][1], None), (n + 2, [1.0, 2.0, 3.0], 0), (n + 3, [1.0, 2.0, 3.01], 0), (n + 4, [5.0], 0), (n + 5, [2.0], 0), (n + 6, [-2.0], 0)]
    return rows


def brute_vectors(rows):
    unit = []
    for _, v, label in rows:
        good = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if good else None)
    links = []
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98:
                links.append((rows[j][0], rows[i][0]))
    root = least_reachable([r[0] for r in rows], links)
    return sorted((r[0], sum(r[0] in p for p in links), root[r[0]], root[r[0]] == r[0]) for r in rows)


def test_near_vectors_equal_brute_force(spark, write_tables, empty, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 4)
    rows = vector_rows(np.random.default_rng(8))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    names = {"key": F.lit("x"), "id": F.lit("y"), "unit": F.lit(1), "codes": F.lit(2), "root": F.lit(3)}
    folder = write_tables(embeddings=df.withColumns(names))
    got = sorted(tuple(r) for r in vectors.op1_near_vectors(spark, folder).collect())
    assert got == brute_vectors(rows)
    assert vectors.op1_near_vectors(spark, empty).count() == 0


def test_hadamard_is_the_matrix():
    x = np.random.default_rng(1).normal(size=(3, 8))
    h = np.array([[1.0]])
    for _ in range(3):
        h = np.block([[h, h], [h, -h]])
    assert np.allclose(vectors.hadamard(x), x @ h)


@pytest.mark.parametrize("cosine,least", [(0.98, 0.97), (0.99, 0.99)])
def test_recall_of_codes(cosine, least):
    rng = np.random.default_rng(2)
    a = rng.normal(size=(600, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    hasher = vectors.CrossPolytope(64)
    salt = np.zeros(600, np.int64)
    met = [bool(set(x) & set(y)) for x, y in zip(hasher.codes(a, salt).tolist(), hasher.codes(b, salt).tolist(), strict=True)]
    assert np.mean(met) >= least


def test_closest_axes():
    rng = np.random.default_rng(2)
    for d in (1, 2, 4, 64):
        y = rng.normal(size=(50, d))
        most = min(3, 2 * d)
        best, close = vectors.closest_axes(y, most)
        both = np.concatenate([y, -y], axis=1)
        order = np.argsort(-both, axis=1)[:, :most]
        assert (best == order).all() and np.allclose(close, np.take_along_axis(both, order, 1))
