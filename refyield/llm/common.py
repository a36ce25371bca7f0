"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import io
import math
import uuid
import weakref
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyarrow import fs
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refyield.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: a lineage
    cut whose files outlive any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_files(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path, for pyarrow, of a folder as Spark names it."""
    if "://" not in folder:
        folder = "file://" + folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def put(folder: str, name: str, data: list[bytes]) -> None:
    """Write a file of the shared folder whole, then move it into place.

    A task that runs again makes the same file: where a store does not move onto
    a file, the one in place stays.
    """
    files, root = arrow_files(folder)
    part = f"{root}/.{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:
        for d in data:
            out.write(d)
    try:
        files.move(part, f"{root}/{name}")
    except OSError:
        if files.get_file_info(f"{root}/{name}").type != fs.FileType.File:
            raise
        files.delete_file(part)


def make_folder(folder: str) -> None:
    files, root = arrow_files(folder)
    files.create_dir(root, recursive=True)


_shipped: weakref.WeakSet[SparkContext] = weakref.WeakSet()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once a context, as
    ``--py-files`` would: workers need not find it on a path of their own."""
    if spark.sparkContext in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    folder = scratch_path(spark, "package")
    make_folder(folder)
    put(folder, "refyield.zip", [packed.getvalue()])
    spark.sparkContext.addPyFile(f"{folder}/refyield.zip")
    _shipped.add(spark.sparkContext)


#: Rows of an Arrow batch, where the session has Spark's 10,000: batches of whole
#: texts are held several times over, in the JVM and in Python.
BATCH_ROWS = 1000


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the workers, and batches of
    ``BATCH_ROWS`` for the session unless it was given a size of its own."""
    conf, batch = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(batch) == "10000":
        conf.set(batch, str(BATCH_ROWS))
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def partitions_for(df: DataFrame, bytes_each: int) -> int:
    """Partitions of about ``bytes_each`` by the planner's size estimate, at
    least the session's shuffle partitions."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / bytes_each))


def row_keys(text: str = "text") -> dict[str, Column]:
    """Join-ready columns that tell documents apart: doc_id (null included) and
    the md5 of the text."""
    return {"_d": F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "_k": F.md5(text_or_empty(text))}


def one_of_each(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The documents' ``columns`` with ``row_keys``, repeated rows once."""
    keyed = docs.select(*columns).withColumns(row_keys())
    return keyed.groupBy("_d", "_k").agg(F.first(F.struct(*columns)).alias("_row")).select("_d", "_k", "_row.*")
