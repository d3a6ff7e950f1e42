"""Runs that become visible at once: layers in a folder of the run, and one record that readers resolve.

A run writes ``<layer>/run=<key>/process_date=<day>/`` for every layer. Nobody reads that before the run appends its records,
one a day, to ``published``: a single file, whose commit is the publication of all layers of all its days. A run that
dies before leaves readers where they were, in every layer; one that is repeated takes a key of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from scriptorium.operators.report import ARTIFACTS
from scriptorium.plans.daily import Layout, RunResult, run_day
from scriptorium.session import exists, remove
from scriptorium.sources.layers import JSON_OPTIONS, PARTITION, check_contract

_TEXT = StringType()
#: One published day of a run; of several records of a day the one with the largest number holds.
RECORD = StructType(
    [
        StructField("number", LongType()),
        StructField("run", _TEXT),
        StructField("run_id", _TEXT),
        StructField(PARTITION, _TEXT),
        StructField("artifacts", StructType([StructField(name, _TEXT) for name in ARTIFACTS])),
    ]
)


def new_run(root: str, fmt: str = "json") -> Layout:
    """The layout of a run of its own under ``root``."""
    return Layout(root, fmt, run=uuid.uuid4().hex)


def _records(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/published"
    if not exists(spark, path):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).json(path)


def publish_run(
    spark: SparkSession, layout: Layout, run_id: str, artifacts: dict[str, dict[str, str]], removed: Sequence[str] = ()
) -> None:
    """Make the run's days visible, each with the paths of what was made; ``removed`` days have nothing any more."""
    last = _records(spark, layout.root).agg(F.max("number")).first()[0] or 0
    made = artifacts | {day: {} for day in removed}
    rows = [
        (last + 1, layout.run, run_id, day, tuple(found.get(name) for name in ARTIFACTS)) for day, found in made.items()
    ]
    if rows:
        spark.createDataFrame(rows, RECORD).coalesce(1).write.mode("append").json(f"{layout.root}/published")


def run_day_at_once(
    spark: SparkSession, landed: str | Sequence[str], root: str, day: str, run_id: str = "manual", fmt: str = "json", **options
) -> RunResult:
    """:func:`~scriptorium.plans.daily.run_day` with all layers published together at its end, or none."""
    layout = new_run(root, fmt)
    done = run_day(spark, landed, root, day, run_id, fmt=fmt, run=layout.run, **options)
    publish_run(spark, layout, run_id, {day: done.artifacts})
    return done


def published_days(spark: SparkSession, root: str) -> DataFrame:
    """The record that holds of each day."""
    newest = Window.partitionBy(PARTITION).orderBy(F.desc("number"), F.desc("run"))
    ranked = _records(spark, root).withColumn("_rank", F.row_number().over(newest))
    return ranked.where("_rank = 1").drop("_rank", "number")


def read_published(
    spark: SparkSession,
    root: str,
    name: str,
    schema: StructType,
    required: Sequence[str] = (),
    days: Sequence[str] | None = None,
    fmt: str = "json",
) -> DataFrame:
    """Rows of a layer as published; the folders of these days only are listed."""
    held = published_days(spark, root).select(PARTITION, F.col(f"artifacts.{name}").alias("path")).where("path is not null")
    if days is not None:
        held = held.where(F.col(PARTITION).isin(list(days)))
    # one row per calendar day
    folders = [r["path"] for r in held.orderBy(PARTITION).collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).format(fmt).option("basePath", f"{root}/{name}")
    if fmt == "json":
        reader = reader.options(mode="PERMISSIVE", **JSON_OPTIONS)
    rows = reader.load(folders).select(*schema.names)
    check_contract(rows, required)
    return rows


def remove_unpublished(spark: SparkSession, layout: Layout) -> None:
    """Delete what a run has written, for a run that is given up."""
    held = published_days(spark, layout.root).where(F.col("run") == layout.run)
    if layout.run and held.isEmpty():
        for name in (*ARTIFACTS, "publish"):
            remove(spark, layout.layer(name))
