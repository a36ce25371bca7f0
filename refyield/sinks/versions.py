"""Tables that are replaced whole, and stay readable while they are.

A new version is written to a folder of its own beside the ones before it and is
then named in a manifest: a line appended to ``<base>/versions``, one small file
that a Spark writer moves into place. Readers follow the newest line. A run that
fails at any point before that has changed nothing that a reader sees, and a run that
is started again writes to a new folder. One writer at a time.

Everything goes through Spark's readers and writers, so any file system they
know will do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

_SCHEMA = "version long, content string"


def _manifest(base: str) -> str:
    return f"{base.rstrip('/')}/versions"


def newest(spark: SparkSession, base: str) -> tuple[int, Any]:
    """(number, content) of the newest version; (0, None) where there is none."""
    try:
        lines = spark.read.schema(_SCHEMA).json(_manifest(base))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, None
    found = lines.orderBy(lines.version.desc()).limit(1).collect()
    return (found[0].version, json.loads(found[0].content)) if found else (0, None)


def publish(spark: SparkSession, base: str, content: Any, after: int | None = None) -> int:
    """Make ``content`` (anything JSON holds) the newest version; return its number.

    ``after``: the number of the version before, where it is known.
    """
    version = (newest(spark, base)[0] if after is None else after) + 1
    line = spark.createDataFrame([(version, json.dumps(content))], _SCHEMA)
    line.coalesce(1).write.mode("append").json(_manifest(base))
    return version


def new_folder(base: str, name: str = "data") -> str:
    """A folder below ``base`` that no other run writes to."""
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def replace(spark: SparkSession, base: str, write: Callable[[str], None]) -> str:
    """Let ``write`` fill a new folder, then make it the current one; return it."""
    folder = new_folder(base)
    write(folder)
    publish(spark, base, {"folder": folder.rsplit("/", 1)[1]})
    return folder


def current_folder(spark: SparkSession, base: str) -> str | None:
    """The folder that ``replace`` filled last, None where it never did."""
    _, content = newest(spark, base)
    return f"{base.rstrip('/')}/{content['folder']}" if content else None


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that no version names any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
