"""Rows that the tests share."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use inside
        *[T.StructField(n, T.StringType()) for n in ("key", "ids", "size", "shard", "part", "_h", "label", "n", "rep", "score")],
    ]
)


def doc(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None, *["x"] * 10)


def words(rng: random.Random, n: int, stock: int = 5000) -> str:
    return " ".join(f"w{rng.randrange(stock)}" for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls, empty and long texts, ties, repeated rows."""
    rng = random.Random(7)
    base = words(rng, 60)
    edited = base.split()
    edited[30] = "changed"
    rows = [
        doc(1, base),
        doc(2, base),
        doc(2, base),
        doc(3, " ".join(edited)),
        doc(4, None),
        doc(5, ""),
        doc(6, "", None),
        doc(None, "no key at all", "b"),
        doc(7, " \n\t "),
        doc(8, "héllo wörld ß 你好 \U0001f600 <|endoftext|> it's 12,345.67!!", "b"),
        doc(9, words(rng, 30_000), "c"),
        doc(10, "x" * 70_000, "c"),
        doc(11, "one two", None),
        doc(12, None, None),
    ]
    return rows + [doc(100 + i, words(rng, rng.randrange(1, 80)), f"s{i % 4}") for i in range(40)]
