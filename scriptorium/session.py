"""Session settings and the shared folder of a run."""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import SparkSession

_scratch: list[str] = []


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the stages rely on; the cluster's own settings stay in force."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new scratch folder that every executor can reach; it is removed when the process ends.

    It lies under ``spark.checkpoint.dir`` or, where a local session leaves that unset, under the
    warehouse folder; a cluster has to name the checkpoint folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "scratch")
    path = os.path.join(root, f"{name}-{uuid.uuid4().hex}")
    _scratch.append(path)
    return path


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, in any file system that Spark reads."""
    files, place = _located(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    files, place = _located(spark, path)
    files.delete(place, True)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder before the process ends."""
    remove(spark, path)
    _scratch.remove(path)


@atexit.register
def remove_scratch() -> None:
    """Delete the scratch folders this process asked for, wherever they lie."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    while _scratch:
        remove(spark, _scratch.pop())
