"""Runs whose layers become visible together."""

import json
import os
import shutil

import pytest

from scriptorium.operators.report import ARTIFACTS
from scriptorium.plans import daily, publication
from scriptorium.plans import standins as st
from scriptorium.plans.publication import published_days, read_published, run_day_at_once
from scriptorium.sources.schemas import GOLD, SILVER
from scriptorium.streaming.incremental import run_incremental

DAY = "2026-01-01"
LINES = "value string, process_date string"
TRAINING = "messages array<struct<role:string,content:string>>, process_date string"
READ = {"bronze_validated": (LINES, "text"), "silver": (SILVER, "json"), "gold": (GOLD, "json"), "sft_train": (TRAINING, "json")}


def rows(spark, root, days=None):
    """Rows of every layer as published."""
    schema = {n: spark.createDataFrame([], s).schema if isinstance(s, str) else s for n, (s, _) in READ.items()}
    found = {n: read_published(spark, root, n, schema[n], days=days, fmt=READ[n][1]) for n in READ}
    return {n: sorted(map(str, df.collect())) for n, df in found.items()}


@pytest.fixture
def landed(spark, tmp_path):
    path = str(tmp_path / "feed")
    st.write_feed(st.feed_entries(st.table(spark, "/root/testdata/sf0.001", "documents")), path)
    return path


def test_a_run_killed_in_gold_leaves_readers_on_the_earlier_day(spark, tmp_path, landed, monkeypatch):
    root = str(tmp_path / "out")
    assert rows(spark, root) == dict.fromkeys(READ, [])
    metrics = tmp_path / "metrics.json"
    metrics.write_text(json.dumps({"train_loss": 2.5, "model_name": "m", "device": "cpu", "n_samples": 7}))
    options = {"metrics_path": str(metrics), "checkpoint_dir": "models/m"}
    run_day_at_once(spark, landed, root, DAY, "first", scale="smoke", **options)
    first = rows(spark, root)
    assert len(first["silver"]) == len(first["gold"]) == len(first["bronze_validated"]) > 0

    def dies(_):
        raise RuntimeError("killed in gold")

    with monkeypatch.context() as patched:
        patched.setattr(daily, "gold", dies)
        with pytest.raises(RuntimeError, match="killed in gold"):
            run_day_at_once(spark, landed, root, DAY, "second", scale="test", **options)
    assert len(os.listdir(f"{root}/silver")) == 2
    assert rows(spark, root) == first

    run_day_at_once(spark, landed, root, DAY, "third", scale="test", **options)
    third = rows(spark, root)
    assert len(third["silver"]) == len(third["gold"]) > len(first["gold"])

    (record,) = published_days(spark, root).collect()
    assert record.run_id == "third"
    assert set(record.artifacts.asDict()) == set(ARTIFACTS) and all(record.artifacts)
    assert record.artifacts.gold == f"{root}/gold/run={record.run}/process_date={DAY}"
    manifest = spark.read.json(f"{root}/publish/run={record.run}/process_date={DAY}").first()
    assert manifest.artifacts.asDict() == record.artifacts.asDict()
    training = spark.read.json(record.artifacts.qwen_train_manifest).first()
    assert (training.status, training.checkpoint_dir, training.train_samples) == ("finished_micro_sft", "models/m", 7)


def test_a_run_that_is_given_up_can_be_removed(spark, tmp_path, landed):
    root = str(tmp_path / "out")
    kept, given_up = publication.new_run(root), publication.new_run(root)
    for layout in (kept, given_up):
        done = daily.run_day(spark, landed, root, DAY, scale="smoke", run=layout.run)
        if layout is kept:
            publication.publish_run(spark, layout, "kept", {DAY: done.artifacts})
    before = rows(spark, root)
    for layout in (kept, given_up):
        publication.remove_unpublished(spark, layout)
    assert os.listdir(f"{root}/gold") == [f"run={kept.run}"]
    assert rows(spark, root) == before


def test_incremental_states_are_published_together(spark, tmp_path):
    def land(day, n):
        folder = tmp_path / "in" / f"process_date={day}"
        folder.mkdir(parents=True, exist_ok=True)
        record = {"source": "arxiv", "title": "A fair title", "content": "word " * 300, "published_at": "2024-01-02", "process_date": day}
        lines = [json.dumps({**record, "url": f"http://arxiv.org/abs/{i}"}) for i in range(n)]
        (folder / "a").write_text("\n".join(lines))

    def run():
        return run_incremental(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt"), at_once=True)

    def counts():
        return {n: len(found) for n, found in rows(spark, str(tmp_path / "out")).items()}

    land(DAY, 3)
    land("2026-01-02", 2)
    assert run().rows["gold"] == 5
    assert counts() == dict.fromkeys(READ, 5)
    land(DAY, 1)
    assert run().rows["gold"] == 1
    assert counts() == dict.fromkeys(READ, 3)
    assert {len(v) for v in rows(spark, str(tmp_path / "out"), [DAY]).values()} == {1}
    shutil.rmtree(tmp_path / "in" / "process_date=2026-01-02")
    run()
    assert counts() == dict.fromkeys(READ, 1)
    assert run() is None
