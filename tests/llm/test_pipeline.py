"""The corpus pipeline: stages against brute force, one after the other."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from conftest_llm import DOCS, doc, words

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from refyield.llm import bpe, mixing, toxicity  # noqa: E402
from test_near import brute_classes  # noqa: E402

COLUMNS = corpus_pipeline.COLUMNS


@pytest.fixture(scope="module")
def corpus(spark, write_tables):
    rng = random.Random(12)
    docs, labels = [], []
    for i in range(500):
        text = words(rng, rng.randrange(8, 150), 700).split()
        toxic = i % 4 == 0
        if toxic:
            text[3] = rng.choice(["vile", "rotten"])
            text.insert(rng.randrange(len(text)), "grub")
        docs.append(doc(i, " ".join(text), f"s{i % 5}" if i % 3 else "s0"))
        labels.append((i, 1, int(toxic)))
    for i in range(500, 560):  # copies and near copies of clean texts
        text = docs[i - 499][1].split()
        if i % 2 and len(text) > 60:
            text[-1] = "changed"
        docs.append(doc(i, " ".join(text), None))
    docs += [doc(900, None), doc(901, ""), doc(902, ""), doc(3, docs[3][1], docs[3][3]), doc(None, "a text without a key " * 3)]
    folder = write_tables(documents=spark.createDataFrame(docs, DOCS).repartition(3), labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return folder, docs


def test_stages(spark, corpus, tmp_path):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append(docs.collect())
        if i < 3:
            assert docs.columns == COLUMNS, name

    # toxicity: what the fitted network scores under the threshold stays
    source = spark.read.parquet(f"{folder}/documents.parquet")
    scorer = toxicity.fit_scorer(source, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = scorer.scores([r[1] or "" for r in rows])
    clean = Counter(r[:5] for r, s in zip(rows, scores, strict=True) if s < toxicity.THRESHOLD)
    assert Counter(map(tuple, seen[0])) == clean
    labelled = [(r[0] % 4 == 0, r[:5] not in clean) for r in rows[:500]]
    assert sum(a == b for a, b in labelled) >= 490

    # one of each class
    left = [(r.doc_id, r.text) for r in seen[0]]
    texts = [x for x in left if x[1] is not None]
    classes = {c for _, c, _ in brute_classes(texts)}
    assert Counter(r.doc_id for r in seen[1] if r.text is not None) == Counter(classes)
    assert sum(r.text is None for r in seen[1]) == sum(t is None for _, t in left)

    # the mix: each row as often as taken / size rounds to
    sizes = [(r.doc_id, r.source, len((r.text or "").split()), hashlib.md5((r.text or "").encode()).hexdigest()) for r in seen[1]]
    mixed = mixing.mix(spark.createDataFrame(sizes, "doc_id long, source string, size long, tie string"), tie="tie").collect()
    want = {r.doc_id: int(r.taken / max(r["size"], 1) + 0.5) for r in mixed}
    assert Counter(r.doc_id for r in seen[2]) == Counter({d: n for d, n in want.items() if n})
    total = sum(r[2] for r in sizes)
    assert abs(sum(len(r.text.split()) for r in seen[2]) - total) < 0.1 * total

    # ids of every row
    encoder = bpe.RankBPE(*bpe.multi_rank_file())
    ids = [(r.doc_id, encoder.encode_texts([r.text])[0], r.text) for r in seen[2]]
    want = Counter((d, len(x) // 4, hashlib.sha256(x).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for d, x, t in ids)
    assert Counter(map(tuple, seen[3])) == want
    assert Counter(map(tuple, corpus_pipeline.run(spark, folder).collect())) == want


def test_empty(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_the_mix_tells_texts_without_an_id_apart(spark):
    """Rows of one id and size, dealt in two orders: the same texts are kept."""
    rows = [(None, f"{'a b c d e f g'} w{i}", "en", "ab"[i % 2], None) for i in range(60)]
    rows += [(7, f"one id w{i} x y z", "en", "a", None) for i in range(30)]
    kept = []
    for seed in range(2):
        docs = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), "doc_id long, text string, lang string, source string, n_chars long").repartition(2 + seed)
        kept.append(Counter(r.text for r in corpus_pipeline.mix_sources(spark, docs, "").collect()))
    assert kept[0] == kept[1] and len(kept[0]) < 90
