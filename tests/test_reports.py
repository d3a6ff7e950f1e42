import math

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import report as rep
from scriptorium.sources.schemas import EVAL_REPORT


@pytest.mark.parametrize(
    "loss, expected",
    [
        (0.0, 1.0),
        (2.5, 12.1825),
        (-800.0, 0.0),
        (10.123, round(math.exp(10.123), 4)),
        (709.0, round(math.exp(709.0), 4)),
        (709.79, None),
        (710.0, None),
        (None, None),
        (float("inf"), float("inf")),
        (float("-inf"), 0.0),
    ],
)
def test_perplexity(one, loss, expected):
    assert one(rep.perplexity(F.lit(loss).cast("double"))) == expected


def test_perplexity_of_nan(one):
    assert math.isnan(one(rep.perplexity(F.lit(float("nan")))))


def metrics(spark):
    return spark.createDataFrame(
        [("2026-01-01", 2.5, "m", "cpu", 7), ("2026-01-02", None, None, None, 0)],
        "process_date string, train_loss double, model_name string, device string, n_samples long",
    )


def test_eval_report(spark):
    got = rep.eval_report(metrics(spark), F.lit("metrics.json"))
    assert got.columns == EVAL_REPORT.names
    first, second = got.orderBy("process_date").collect()
    assert first.asDict() == {
        "process_date": "2026-01-01",
        "mock": False,
        "train_loss": 2.5,
        "perplexity_estimate": 12.1825,
        "metrics_source": "metrics.json",
        "device": "cpu",
        "model_name": "m",
        "notes": "Метрики с train; отдельный test split не использовался.",
    }
    assert (second.train_loss, second.perplexity_estimate) == (None, None)


def test_train_manifest(spark):
    row = rep.train_manifest(metrics(spark), F.lit("c"), F.lit("p")).first()
    assert row.asDict() == {
        "status": "finished_micro_sft",
        "mock": False,
        "checkpoint_dir": "c",
        "metrics_path": "p",
        "base_model": "m",
        "train_samples": 7,
        "device": "cpu",
    }


def test_manifest(spark):
    rows = [("d1", "r", "gold", "g1"), ("d1", "r", "silver", "s1"), ("d2", "r", "gold", None), ("d3", "r", None, None)]
    table = spark.createDataFrame(rows, "process_date string, run_id string, artifact string, path string")
    got = {r.process_date: r for r in rep.manifest(table, "p").collect()}
    assert tuple(got["d1"].artifacts.asDict()) == rep.ARTIFACTS
    assert (got["d1"].artifacts.gold, got["d1"].artifacts.silver, got["d1"].artifacts.sft_train) == ("g1", "s1", None)
    assert set(got["d2"].artifacts) == set(got["d3"].artifacts) == {None}
    assert {r.pipeline for r in got.values()} == {"p"}


def test_sample_counts(spark):
    texts = spark.createDataFrame([("a", "t"), ("a", "t"), ("b", "t")], "day string, text string")
    assert {r.day: r.n_samples for r in rep.sample_counts(texts, "day").collect()} == {"a": 2, "b": 1}
    assert rep.sample_counts(texts).first().n_samples == 3
