"""Daily runs: landed feed to bronze, and bronze to every later layer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from scriptorium.operators import validate as v
from scriptorium.operators.chat import CHATML, ChatTemplate, training_text
from scriptorium.operators.gold import gold
from scriptorium.operators.report import eval_report, manifest, train_manifest
from scriptorium.operators.silver import silver
from scriptorium.operators.training import training_messages
from scriptorium.session import remove
from scriptorium.sources import feed
from scriptorium.sources.layers import (
    PARTITION,
    STAGE_META,
    DayCounts,
    StageMeta,
    raw_lines,
    read_layer,
    require_rows,
    stage_meta,
    write_layer,
    write_record,
)
from scriptorium.sources.schemas import (
    BRONZE,
    BRONZE_REQUIRED,
    GOLD,
    METRICS,
    SILVER,
    SILVER_REQUIRED,
    TRAINING_ROW,
)

PIPELINE = "scriptorium_daily"
#: Layers of a run, by the names of the manifest.
LAYERS = ("bronze_raw", "bronze_validated", "validation_report", "silver", "gold", "sft_train")


@dataclass(frozen=True)
class Layout:
    """Where the layers of a run lie. Each layer is partitioned by ``process_date``.

    ``fmt`` is the format of the silver, gold and training layers. In a columnar one, a stage reads only
    the columns it uses. With ``run`` every layer lies in a folder of that run, which nobody reads before the run
    is published (see :mod:`scriptorium.plans.publication`). ``compression`` is the codec of lines and JSON rows, each
    of which is written once a layer; None leaves them plain. A file is read by one task then, and a task writes one a day.
    """

    root: str
    fmt: str = "json"
    run: str | None = None
    compression: str | None = "gzip"

    def layer(self, name: str) -> str:
        return f"{self.root}/{name}" + (f"/run={self.run}" if self.run else "")

    def day(self, name: str, day: str) -> str:
        return f"{self.layer(name)}/{PARTITION}={day}"

    @property
    def raw(self) -> str:
        return self.layer("bronze_raw")

    @property
    def validated(self) -> str:
        return self.layer("bronze_validated")

    @property
    def silver(self) -> str:
        return self.layer("silver")

    @property
    def gold(self) -> str:
        return self.layer("gold")

    @property
    def training(self) -> str:
        return self.layer("sft_train")


@dataclass
class RunResult:
    """Rows per stage, the days that a quality gate stopped with the reason, and the rejected lines per day and reason."""

    rows: dict[str, int] = field(default_factory=dict)
    stopped: dict[str, str] = field(default_factory=dict)
    rejected: dict[str, dict[str, int]] = field(default_factory=dict)
    artifacts: dict[str, str] = field(default_factory=dict)


def as_lines(rows: DataFrame) -> DataFrame:
    """Rows as JSON lines, with the day kept both in the line and as partition column."""
    line = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    return rows.select(line.alias("value"), PARTITION)


def extract(
    spark: SparkSession,
    landed: str | Sequence[str],
    layout: Layout,
    day: str,
    run_id: str = "manual",
    scale: str = feed.DEFAULT_SCALE,
) -> int:
    """Newest entries of landed feed files to the day's raw bronze lines."""
    window = feed.feed_window(feed.read_feed(spark, landed, feed.CATEGORIES), scale)
    lines = as_lines(feed.to_bronze(window, day, run_id))
    return write_layer(lines, layout.raw, days=[day], fmt="text", compression=layout.compression)


def validate_days(
    spark: SparkSession,
    layout: Layout,
    days: Sequence[str],
    raw: str | None = None,
    rejected: dict[str, dict[str, int]] | None = None,
) -> dict[str, str]:
    """Write validated lines and a report per day; returns the days that fail a gate, with the reason.

    Lines are read and parsed once, in one job for any number of days: the counts per day and reject reason
    are taken while the valid lines are written. ``rejected`` receives those that are not 0.
    """
    raw = raw or layout.raw
    counts, seen = DayCounts(days, 1 + len(v.REASONS)), Observation()
    kind = F.array_position(F.array(*map(F.lit, v.REASONS)), F.coalesce("reason", F.lit("")))
    flagged = v.validate(raw_lines(spark, raw, days)).observe(seen, counts.metric(F.col(PARTITION), kind).alias("n"))
    lines = v.valid_records(flagged).select(F.col("line").alias("value"), PARTITION)
    write_layer(lines, layout.validated, days=days, fmt="text", compression=layout.compression)
    counted = []
    for day, (valid, *invalid) in counts.read(seen.get["n"]).items():
        counted.append((day, valid + sum(invalid), valid, sum(invalid)))
        if rejected is not None and any(invalid):
            rejected[day] = {reason: n for reason, n in zip(v.REASONS, invalid) if n}
    gated = v.with_gates(
        spark.createDataFrame(
            counted, f"{PARTITION} string, total_lines bigint, valid bigint, invalid bigint"
        )
    )
    failed = F.col("failure").isNotNull()
    _write_reports(layout, gated.where(~failed).drop("failure"), raw)
    return {r[PARTITION]: r["failure"] for r in gated.where(failed).collect()}


def _write_reports(layout: Layout, counts: DataFrame, raw: str) -> None:
    def at(root: str):
        return F.concat(F.lit(f"{root}/{PARTITION}="), F.col(PARTITION))

    report = v.with_ratio(counts).select(
        PARTITION,
        at(raw).alias("raw_path"),
        at(layout.validated).alias("validated_path"),
        "total_lines",
        "valid",
        "invalid",
        "invalid_ratio",
    )
    write_layer(report.coalesce(1), layout.layer("validation_report"))


def finish_stage(spark: SparkSession, stage: str, rows: int, source: str, target: str) -> None:
    """Stop on an empty stage; record the rows of any other beside its layer."""
    require_rows(rows, stage)
    meta = StageMeta(rows, "pyspark", spark.sparkContext.appName, source, target)
    write_record(stage_meta(spark, meta), f"{target}/_meta")


def _finish(
    spark: SparkSession, result: RunResult, stage: str, source: str, target: str, rows: dict[str, int]
) -> None:
    """Record the rows of each day beside the layer; a later run for other days leaves them."""
    app = spark.sparkContext.appName
    metas = [(n, "pyspark", app, source, target, day) for day, n in rows.items()]
    table = spark.createDataFrame(metas, f"{STAGE_META}, {PARTITION} string")
    write_layer(table.coalesce(1), f"{target}/_meta")
    result.rows[stage] = result.rows.get(stage, 0) + sum(rows.values())


def process_days(
    spark: SparkSession,
    layout: Layout,
    days: Sequence[str],
    raw: str | None = None,
) -> RunResult:
    """Validate days of raw lines and write their silver, gold and training layers.

    Each stage reads what the one before wrote, so a lost executor costs one stage's tasks at most. No
    stage shuffles: a layer's files lie by day already, so a task writes to one day or a few. Writing
    replaces these days and no others. A day that fails a gate stops there; the others go on. The rows
    of each stage are recorded per day.
    """
    result = RunResult()
    result.stopped = validate_days(spark, layout, days, raw, result.rejected)
    days = [d for d in days if d not in result.stopped]
    if days:
        _later_stages(spark, layout, days, result)
    for stage, rows in result.rows.items():
        require_rows(rows, stage)
    return result


def _later_stages(
    spark: SparkSession, layout: Layout, days: Sequence[str], result: RunResult
) -> None:
    """Silver, gold and training layer of the days."""
    rows = read_layer(spark, layout.validated, BRONZE, BRONZE_REQUIRED, days)
    written: dict[str, int] = {}
    write_layer(silver(rows), layout.silver, days=days, fmt=layout.fmt, per_day=written, compression=layout.compression)
    _finish(spark, result, "silver", layout.validated, layout.silver, written)

    rows = read_layer(spark, layout.silver, SILVER, SILVER_REQUIRED, days, fmt=layout.fmt)
    write_layer(gold(rows), layout.gold, days=days, fmt=layout.fmt, per_day=written, compression=layout.compression)
    _finish(spark, result, "gold", layout.silver, layout.gold, written)

    rows = read_layer(spark, layout.gold, GOLD, days=days, strict=True, fmt=layout.fmt)
    messages = training_messages(rows, keep=(PARTITION,)).drop("fallback")
    write_layer(messages, layout.training, days=days, fmt=layout.fmt, per_day=written, compression=layout.compression)
    _finish(spark, result, "sft_train", layout.gold, layout.training, written)


def clear_days(spark: SparkSession, layout: Layout, days: Sequence[str]) -> None:
    """Take the days out of every layer, for days whose raw lines are gone."""
    for name in LAYERS:
        for day in days:
            remove(spark, layout.day(name, day))
            remove(spark, f"{layout.layer(name)}/_meta/{PARTITION}={day}")


def training_texts(
    spark: SparkSession,
    layout: Layout,
    days: Sequence[str],
    template: ChatTemplate | None = CHATML,
) -> DataFrame:
    """Texts of the days' training rows, ready for a tokenizer."""
    schema = StructType([*TRAINING_ROW.fields, StructField(PARTITION, StringType())])
    rows = read_layer(spark, layout.training, schema, days=days, strict=True, fmt=layout.fmt)
    return training_text(rows, template, keep=(PARTITION,))


def evaluate(spark: SparkSession, layout: Layout, metrics_path: str, day: str) -> None:
    """Evaluation report of the day's training metrics."""
    report = eval_report(_metrics(spark, metrics_path, day), F.lit(metrics_path))
    write_layer(report, layout.layer("eval_report"))


def _metrics(spark: SparkSession, path: str, day: str) -> DataFrame:
    return spark.read.schema(METRICS).option("multiLine", True).json(path).withColumn(PARTITION, F.lit(day))


def record_training(
    spark: SparkSession, layout: Layout, checkpoint_dir: str, metrics_path: str, day: str
) -> None:
    """Record of the day's finished training, from its metrics."""
    metrics = _metrics(spark, metrics_path, day)
    record = train_manifest(metrics, F.lit(checkpoint_dir), F.lit(metrics_path), keep=(PARTITION,))
    write_layer(record, layout.layer("qwen_train_manifest"))


def publish(
    spark: SparkSession,
    layout: Layout,
    day: str,
    run_id: str,
    artifacts: dict[str, str],
    pipeline: str = PIPELINE,
) -> DataFrame:
    """Write and return the run manifest; an artifact that was not made is null."""
    rows = [(day, run_id, name, path) for name, path in artifacts.items()]
    # A run without artifacts still has a manifest.
    rows = rows or [(day, run_id, None, None)]
    table = spark.createDataFrame(
        rows, f"{PARTITION} string, run_id string, artifact string, path string"
    )
    record = manifest(table, pipeline)
    write_record(record, layout.day("publish", day))
    return record


def run_day(
    spark: SparkSession,
    landed: str | Sequence[str],
    root: str,
    day: str,
    run_id: str = "manual",
    scale: str = feed.DEFAULT_SCALE,
    metrics_path: str | None = None,
    fmt: str = "json",
    checkpoint_dir: str | None = None,
    run: str | None = None,
) -> RunResult:
    """One daily run from landed feed files to the manifest. Running a day again replaces it.

    ``metrics_path`` and ``checkpoint_dir`` are what a training run has left: with metrics an evaluation report is written, with
    both a record of the training. With ``run`` the layers go to folders of that run and are not visible until
    :func:`scriptorium.plans.publication.publish_run`.
    """
    layout = Layout(root, fmt, run)
    extracted = extract(spark, landed, layout, day, run_id, scale)
    done = process_days(spark, layout, [day])
    if day in done.stopped:
        raise v.QualityGateError(done.stopped[day])
    done.rows["bronze_raw"] = extracted
    done.artifacts = {name: layout.day(name, day) for name in LAYERS}
    if checkpoint_dir:
        done.artifacts["qwen_checkpoint_dir"] = checkpoint_dir
    if metrics_path:
        evaluate(spark, layout, metrics_path, day)
        done.artifacts["qwen_metrics"] = metrics_path
        done.artifacts["eval_report"] = layout.day("eval_report", day)
    if metrics_path and checkpoint_dir:
        record_training(spark, layout, checkpoint_dir, metrics_path, day)
        done.artifacts["qwen_train_manifest"] = layout.day("qwen_train_manifest", day)
    publish(spark, layout, day, run_id, done.artifacts)
    return done
