"""A training corpus from ``documents``: toxic texts out, one text of each group
of near copies, sources mixed to target weights, then byte-level BPE ids.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and
works on all rows that the stage before kept. ``run`` writes each stage's result
as Parquet to the shared folder and reads it back as the next one's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refyield.llm.bpe import round_trip
from refyield.llm.common import one_of_each, row_keys, staged, table, text_or_empty
from refyield.llm.jaccard import keep_one
from refyield.llm.mixing import mix, word_count
from refyield.llm.toxicity import THRESHOLD, scored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under the threshold, by a network fitted on the labels.

    Whole texts of any length are scored; null and empty ones are scored as empty.
    Repeated rows have one score and stay or go together; a score at the threshold
    goes. Without labelled texts of both kinds all stay; an empty table gives an
    empty one, and other columns than those of documents are dropped.
    """
    return scored(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), out="_score").filter(F.col("_score") < THRESHOLD).drop("_score")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (five words, Jaccard 0.8).

    The least doc_id stays (any id before none); of repeated rows one. Empty texts
    are copies of each other, null texts all stay; an empty table gives an empty
    one, and other columns than those of documents are dropped.
    """
    return keep_one(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: the words taken over its size,
    rounded half up; a document that is not reached that often goes. A row without
    words (a null, empty or blank text) has no share in the mix and goes too. Rows
    that share a doc_id, or have none, are told apart by their text, in any order of
    the rows; repeated rows are counted each and come out together. An empty table
    gives an empty one."""
    docs = docs.select(*COLUMNS)
    keyed = docs.withColumns(row_keys())
    sized = staged(keyed.select("doc_id", "source", word_count(text_or_empty()).alias("size"), "_d", "_k"), "mix-sizes")
    times = F.floor(F.col("taken") / F.greatest("size", F.lit(1)) + 0.5).cast("int")
    copies = mix(sized, tie="_k").groupBy("_d", "_k").agg(F.sum(times).cast("int").alias("_times")).filter("_times > 0")
    chosen = one_of_each(docs, COLUMNS).join(copies, ["_d", "_k"])
    return chosen.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every row's text, decoded again, as counts and digests.

    Whole texts of any length; a null or empty one has no ids. Repeated rows have a
    row each; an empty table gives an empty one; other columns are not read.
    """
    return round_trip(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("jaccard_join", keep_one_of_near_copies),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode),
]

#: SQL has neither the network nor the tokenizer: tests/llm holds the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
    return docs
