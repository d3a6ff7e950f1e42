"""Training metrics, evaluation reports and the run manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.rounding import round_4

# Fixed values of the reports.
EVAL_NOTES = "Метрики с train; отдельный test split не использовался."
TRAIN_STATUS = "finished_micro_sft"
ARTIFACTS = (
    "bronze_raw",
    "bronze_validated",
    "validation_report",
    "silver",
    "gold",
    "sft_train",
    "qwen_checkpoint_dir",
    "qwen_train_manifest",
    "qwen_metrics",
    "eval_report",
)


def perplexity(loss: Column) -> Column:
    """``exp(loss)`` to four places; null for no loss and where the exponential overflows."""
    infinity = F.lit(float("inf"))
    value = F.exp(loss)
    return F.when(F.isnan(loss) | (loss == infinity), loss).when(
        value < infinity, round_4(value)
    )


def eval_report(metrics: DataFrame, metrics_source: Column) -> DataFrame:
    """One report per row of training metrics with its ``process_date``."""
    return metrics.select(
        "process_date",
        F.lit(False).alias("mock"),
        "train_loss",
        perplexity(F.col("train_loss")).alias("perplexity_estimate"),
        metrics_source.alias("metrics_source"),
        "device",
        "model_name",
        F.lit(EVAL_NOTES).alias("notes"),
    )


def train_manifest(
    metrics: DataFrame, checkpoint_dir: Column, metrics_path: Column, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Record of a finished training run, from its metrics."""
    return metrics.select(
        *keep,
        F.lit(TRAIN_STATUS).alias("status"),
        F.lit(False).alias("mock"),
        checkpoint_dir.alias("checkpoint_dir"),
        metrics_path.alias("metrics_path"),
        F.col("model_name").alias("base_model"),
        F.col("n_samples").alias("train_samples"),
        "device",
    )


def sample_counts(texts: DataFrame, *by: str) -> DataFrame:
    """``n_samples``: number of training texts."""
    return texts.groupBy(*by).agg(F.count(F.lit(1)).alias("n_samples"))


def manifest(artifacts: DataFrame, pipeline: str) -> DataFrame:
    """One row per run from rows (process_date, run_id, artifact, path); absent artifacts are null."""
    runs = (
        artifacts.groupBy("process_date", "run_id")
        .pivot("artifact", list(ARTIFACTS))
        .agg(F.max("path"))
    )
    return runs.select(
        "process_date",
        "run_id",
        F.lit(pipeline).alias("pipeline"),
        F.struct(*ARTIFACTS).alias("artifacts"),
    )
