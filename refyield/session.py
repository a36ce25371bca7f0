"""Spark session defaults and the shared scratch folder.

The library never picks machine-local folders on a cluster: anything it
writes for itself (round-trip scans, lineage cuts) goes below the folder the
cluster names in ``spark.checkpoint.dir``. Only a local session (tests) may
leave it unset.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; everything else stays at Spark's default.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_spark(
    master: str | None = None,
    app_name: str = "refyield",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder.

    Where it is unset, a local session gets a temporary folder, removed when
    Python ends; any other session must name one, as its executors do not
    share the driver's disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="refyield-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder (never reused between runs)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/refyield-{name}-{uuid.uuid4().hex}"
