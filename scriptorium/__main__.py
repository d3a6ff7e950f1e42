"""Command line: ``python -m scriptorium <stage> ...`` or the same through ``spark-submit``.

Ends with status 2 when an input or a required column is missing.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from scriptorium.operators import validate as v
from scriptorium.operators.chat import training_text
from scriptorium.operators.gold import gold
from scriptorium.operators.silver import silver
from scriptorium.operators.training import training_messages
from scriptorium.plans import daily
from scriptorium.plans.publication import run_day_at_once
from scriptorium.session import build_session
from scriptorium.sources import feed, layers
from scriptorium.sources.schemas import (
    BRONZE,
    BRONZE_REQUIRED,
    GOLD,
    SILVER,
    SILVER_REQUIRED,
)
from scriptorium.streaming.incremental import run_incremental


def _silver(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = layers.read_layer(spark, args.input, BRONZE, BRONZE_REQUIRED)
    written = layers.write_layer(silver(rows), args.output)
    daily.finish_stage(spark, "silver", written, args.input, args.output)


def _gold(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = layers.read_layer(spark, args.input, SILVER, SILVER_REQUIRED)
    written = layers.write_layer(gold(rows), args.output)
    daily.finish_stage(spark, "gold", written, args.input, args.output)


def _training(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = layers.read_layer(spark, args.input, GOLD, strict=True)
    messages = training_messages(rows, keep=(layers.PARTITION,)).drop("fallback")
    written = layers.write_layer(messages, args.output)
    daily.finish_stage(spark, "sft_train", written, args.input, args.output)


def _texts(spark: SparkSession, args: argparse.Namespace) -> None:
    texts = training_text(layers.read_training_rows(spark, args.input))
    texts.write.mode("overwrite").json(args.output)


def _validate(spark: SparkSession, args: argparse.Namespace) -> None:
    counts = Observation()
    flagged = v.validate(layers.raw_lines(spark, args.input))
    valid = v.valid_records(flagged.observe(counts, *v.report_columns()))
    valid.select("line").write.mode("overwrite").text(args.output)
    counted = spark.createDataFrame([counts.get])
    v.check_gates(counted, args.input)
    paths = F.lit(args.input).alias("raw_path"), F.lit(args.output).alias("validated_path")
    report = v.with_ratio(counted).select(*paths, "total_lines", "valid", "invalid", "invalid_ratio")
    layers.write_record(report, args.report or f"{args.output}/_report")
    print(counts.get)


def _run_day(spark: SparkSession, args: argparse.Namespace) -> None:
    scale = feed.resolve_scale({"scale": args.scale})
    run = run_day_at_once if args.at_once else daily.run_day
    done = run(
        spark,
        args.landed,
        args.root,
        args.day,
        args.run_id,
        scale=scale,
        metrics_path=args.metrics,
        checkpoint_dir=args.checkpoint_dir,
    )
    print(done.rows)


def _incremental(spark: SparkSession, args: argparse.Namespace) -> None:
    done = run_incremental(spark, args.landing, args.root, args.checkpoint, at_once=args.at_once)
    print(done.rows if done else "nothing new")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="scriptorium")
    stages = top.add_subparsers(dest="stage", required=True)
    for name, run, text in (
        ("validate", _validate, "raw JSON lines to valid lines"),
        ("silver", _silver, "valid lines to the silver layer"),
        ("gold", _gold, "silver to the gold layer"),
        ("training", _training, "gold to training messages"),
        ("texts", _texts, "training rows to gated texts"),
    ):
        stage = stages.add_parser(name, help=text)
        stage.add_argument("--input", required=True)
        stage.add_argument("--output", required=True)
        if name == "validate":
            stage.add_argument("--report", help="where the report goes, if not beside the valid lines")
        stage.set_defaults(run=run)
    day = stages.add_parser("run-day", help="landed feed files to the manifest of a day")
    day.add_argument("--landed", required=True)
    day.add_argument("--root", required=True)
    day.add_argument("--day", required=True)
    day.add_argument("--run-id", default="manual")
    day.add_argument("--scale")
    day.add_argument("--metrics")
    day.add_argument("--checkpoint-dir")
    day.add_argument("--at-once", action="store_true", help="publish all layers together")
    day.set_defaults(run=_run_day)
    new = stages.add_parser("incremental", help="bring days with new landed files up to date")
    new.add_argument("--landing", required=True)
    new.add_argument("--root", required=True)
    new.add_argument("--checkpoint", required=True)
    new.add_argument("--at-once", action="store_true", help="publish all layers together")
    new.set_defaults(run=_incremental)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(f"scriptorium_{args.stage}")
    try:
        args.run(spark, args)
    except (layers.ContractError, AnalysisException) as error:
        print(f"ERROR: {error}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
