"""Token files, BPE and token counts: against the public libraries."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from refyield.llm import bpe, counting, idstore  # noqa: E402
from refyield.llm.common import staged  # noqa: E402

BLANKS = "".join(map(chr, [9, 10, 11, 12, 13, 28, 31, 32, 0x85, 0xA0, 0x1680, 0x180E, 0x2003, 0x200B, 0x2028, 0x3000]))
STOCK = "ab'srtdlvemTHE 01½²٣éñßçàñ你好абв\U0001f600-_.,!?#" + BLANKS


def random_texts(n: int) -> list[str]:
    rng = random.Random(11)
    texts = ["".join(rng.choice(STOCK) for _ in range(rng.randrange(200))) for _ in range(n)]
    texts += ["'" + "".join(rng.choice("strevlmd' a") for _ in range(20)) for _ in range(n // 4)]
    return texts + ["", " ", "\n", "a\n", "a \n b", "a" * 3000, " " * 500, "aaab" * 40, "z" * 64, "z" * 65, "你好" * 300, "x<|endoftext|>y <|EndOfText|>"]


@pytest.fixture(scope="module")
def rank_bpe():
    return bpe.RankBPE(*bpe.multi_rank_file())


def test_bpe_equals_the_library(rank_bpe):
    import tiktoken

    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=rank_bpe.ranks, special_tokens={})
    texts = random_texts(400)
    for text, ids in zip(texts, rank_bpe.encode_texts(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode_ordinary(text)
        assert bpe.decoded(ids, bpe.token_bytes(bpe.multi_rank_file()[0])) == text.encode()


def test_both_trees_merge_alike(rank_bpe):
    rng = random.Random(1)
    words = [bytes(rng.choice(b"aehinrst \xc3\xa9") for _ in range(rng.randrange(1, 33))) for _ in range(500)]
    assert rank_bpe.merge_rows(words, 32) == [rank_bpe.merge_one(w) for w in words]


def test_decoding_apart(spark, odd):
    rank_file, pattern = bpe.multi_rank_file()
    docs = spark.read.parquet(f"{odd[0]}/documents.parquet").select("doc_id", "lang", "text")
    both = bpe.decode(bpe.encode(docs, rank_file, pattern), rank_file)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.lang, bytes(r.decoded)) for r in both.collect()), key=str)
    assert got == sorted(((d is None, d or 0, "en", (t or "").encode()) for d, t, *_ in odd[1]), key=str)


def test_bpe_query(spark, odd, empty, monkeypatch):
    folder, rows = odd
    enc = bpe.RankBPE(*bpe.multi_rank_file())
    monkeypatch.setattr(bpe, "CHARS", 10_000)  # the long texts go piece by piece in the next line
    want = sorted((d is None, d or 0, hashlib.sha256(enc.encode_texts([t or ""])[0]).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for d, t, *_ in rows)
    got = bpe.op6_byte_bpe(spark, folder).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert all(r.n_tokens == len(enc.encode_texts([t or ""])[0]) // 4 for r, t in ((r, t) for r in got for d, t, *_ in rows if d == r.doc_id and d not in (None, 2)))
    assert bpe.op6_byte_bpe(spark, empty).count() == 0


@pytest.fixture(scope="module")
def tokenizer_json():
    with open(P.path("byte_bpe_50k.json"), "rb") as f:
        return f.read()


@pytest.mark.parametrize("piece", [1_000_000, 700])
def test_counts_equal_the_library(tokenizer_json, monkeypatch, piece):
    from tokenizers import Tokenizer

    monkeypatch.setattr(counting, "CHARS", piece)
    lib = Tokenizer.from_str(tokenizer_json.decode())
    texts = random_texts(400)
    got = counting.TokenCounter(tokenizer_json).count_texts(texts)
    assert got == [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_compiled_states_may_be_dropped(tokenizer_json, monkeypatch):
    monkeypatch.setattr(counting, "COMPILED", 50)
    monkeypatch.setattr(counting, "KEPT", 20)
    texts = random_texts(100)
    small = counting.TokenCounter(tokenizer_json).count_texts(texts)
    monkeypatch.undo()
    assert small == counting.TokenCounter(tokenizer_json).count_texts(texts)


def test_count_query(spark, odd, empty, tokenizer_json):
    from tokenizers import Tokenizer

    folder, rows = odd
    lib = Tokenizer.from_str(tokenizer_json.decode())
    want = sorted((d is None, d or 0, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for d, t, *_ in rows)
    got = counting.op7_token_counts(spark, folder).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    assert counting.op7_token_counts(spark, empty).count() == 0


# -- id files -----------------------------------------------------------------------


def brute_id_rows(rows):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    return [[*lib.encode(t or "", add_special_tokens=False).ids, 2] for t in rows]


def test_id_files_read_back(spark, odd, empty, monkeypatch):
    folder, rows = odd
    got = idstore.op3_token_id_files(spark, folder).orderBy("start").collect()
    ids = brute_id_rows([t for _, t, *_ in rows])
    want = sorted((d is not None, d or 0, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (d, *_), x in zip(rows, ids, strict=True))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == [w[:2] for w in want]
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert idstore.op3_token_id_files(spark, empty).count() == 0


def test_word_encoder_equals_the_library():
    with open(P.path("word_bpe_49k.json"), "rb") as f:
        encoder = idstore.WordEncoder(f.read())
    encoder.KEPT = 50  # generations turn often
    texts = random_texts(300) + ["The end. <|endoftext|>. It's 3.5, OK, <|ENDOFTEXT|> <|startoftext|>x"]
    want = brute_id_rows(texts)
    for i in range(0, len(texts), 7):
        for ids, w in zip(encoder.encode(texts[i : i + 7]), want[i : i + 7], strict=True):
            assert np.frombuffer(ids, "<u2").tolist() == w


def test_perfect_hash_and_absent_keys(tmp_path):
    keys = idstore.make_keys([None, None, *range(-50, 5000, 3), 7_000, 7_000])
    lengths = np.arange(len(keys)) % 9
    hashed = idstore.PerfectHash.build(keys)
    assert sorted(hashed.slots(keys).tolist()) == list(range(len(keys)))
    index = idstore.index_bytes(keys, lengths, 2)
    file = idstore.IdFile(index, None)
    offsets, found = file.find(keys)
    assert found.tolist() == lengths.tolist() and offsets.tolist() == (np.cumsum(lengths) - lengths).tolist()
    absent = idstore.make_keys(list(range(10_000, 20_000)))
    assert (file.find(absent)[0] == -1).all()
    none = idstore.IdFile(idstore.index_bytes(idstore.make_keys([]), np.zeros(0, int), 2), None)
    assert (none.find(absent)[0] == -1).all()


def test_one_document_by_key(spark, odd, tmp_path):
    with open(P.path("word_bpe_49k.json"), "rb") as f:
        tokenizer = f.read()
    folder = f"file://{tmp_path}/ids"
    files = idstore.write_ids(spark.read.parquet(f"{odd[0]}/documents.parquet"), tokenizer, folder).collect()
    want = dict(zip([d for d, *_ in odd[1]], brute_id_rows([t for _, t, *_ in odd[1]]), strict=True))
    found = {}
    for f in files:
        with idstore.open_ids(folder, f.name) as ids:
            for key in (8, 10, 123, None, 99_999):
                offset, length = (x.tolist()[0] for x in ids.find(idstore.make_keys([key])))
                if offset >= 0:
                    found[key] = ids.read(offset, length).tolist()
    assert found == {k: want[k] for k in (8, 10, 123, None)}


def test_lookup_opens_the_files_of_its_keys_alone(spark, odd, empty, tmp_path, monkeypatch):
    monkeypatch.setattr(idstore, "FILE_DOCS", 2)  # many files; rows of one key fall into several
    with open(P.path("word_bpe_49k.json"), "rb") as f:
        tokenizer = f.read()
    folder = f"file://{tmp_path}/ids"
    files = staged(idstore.write_ids(spark.read.parquet(f"{odd[0]}/documents.parquet"), tokenizer, folder), "files")
    starts = {(r.doc_id, r.start) for r in idstore.read_documents(files, folder).collect()}
    where = idstore.directory(files, folder)
    asked = [8, 2, 123, None, 99_999, 8]
    spoilt = 0
    for r in where.collect():
        if not any(r.first_key <= (idstore.NULL_KEY if k is None else k) <= r.last_key for k in asked):
            spoilt += 1
            for end in ("idx", "ids"):
                (tmp_path / "ids" / f"{r.name}.{end}").write_bytes(b"rubbish")
    assert spoilt
    got = idstore.lookup(where, folder, asked).collect()
    want = [(d, ids) for (d, *_), ids in zip(odd[1], brute_id_rows([t for _, t, *_ in odd[1]]), strict=True) if d in asked]
    assert sorted(((r.doc_id, r.ids) for r in got), key=str) == sorted(want, key=str)
    assert {(r.doc_id, r.start) for r in got} == {s for s in starts if s[0] in asked}
    assert idstore.lookup(where, folder, []).count() == 0
    none = idstore.write_ids(spark.read.parquet(f"{empty}/documents.parquet"), tokenizer, f"file://{tmp_path}/none")
    assert idstore.lookup(idstore.directory(none, f"file://{tmp_path}/none"), f"file://{tmp_path}/none", [1]).count() == 0


def test_files_are_the_same_when_a_task_runs_again(tmp_path):
    folder = f"file://{tmp_path}"
    for _ in range(2):
        idstore.put(folder, "000000-00000.ids", [b"ab", b"cd"])
    assert [p.name for p in tmp_path.iterdir()] == ["000000-00000.ids"]
    assert (tmp_path / "000000-00000.ids").read_bytes() == b"abcd"
