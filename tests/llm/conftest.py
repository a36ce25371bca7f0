from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import DOCS, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def write_tables(spark, tmp_path_factory):
    """Write tables as the driver lays them out; gives the folder."""

    def write(**tables) -> str:
        folder = tmp_path_factory.mktemp("tables")
        for name, df in tables.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return write


@pytest.fixture(scope="session")
def odd(spark, write_tables):
    """(folder, rows) of the odd documents."""
    rows = odd_rows()
    return write_tables(documents=spark.createDataFrame(rows, DOCS).repartition(3)), rows


@pytest.fixture(scope="session")
def empty(spark, write_tables):
    none = lambda s: spark.createDataFrame([], s)
    return write_tables(
        documents=none(DOCS),
        labels=none("doc_id long, quality int, toxic int"),
        embeddings=none("vec_id long, embedding array<float>, label int"),
        conversations=none("conv_id long, turn long, role string, text string"),
        benchmark=none("item_id long, text string"),
    )
