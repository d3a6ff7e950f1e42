"""Layers on disk, daily runs and incremental runs."""

import glob
import json
import os
import shutil
from collections import Counter

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from scriptorium.operators.training import training_messages
from scriptorium.operators.validate import QualityGateError
from scriptorium.plans import daily
from scriptorium.plans import standins as st
from scriptorium.sources import layers
from scriptorium.sources.schemas import GOLD, SILVER
from scriptorium.streaming import incremental
from scriptorium.streaming.incremental import run_incremental

DAYS = ["2026-01-01", "2026-01-02", "2026-01-03"]


def record(i, day="2026-01-01", **changes):
    base = {
        "source": "arxiv",
        "url": f"http://arxiv.org/abs/{i}",
        "title": f"Title number {i}",
        "content": f"Body {i} " + "word " * 200,
        "published_at": "2024-01-02T03:04:05Z",
        "process_date": day,
    }
    return json.dumps({**base, **changes})


def land(root, day, name, lines):
    folder = os.path.join(root, f"process_date={day}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as out:
        out.write("".join(line + "\n" for line in lines))


def per_day(spark, path, schema=GOLD):
    rows = spark.read.schema(schema).json(path).groupBy("process_date").count().collect()
    return {r.process_date: r["count"] for r in rows}


def days_frame(spark, counts):
    rows = [(i, day) for day, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "i int, process_date string")


# --- sinks and sources -----------------------------------------------------------------------------


def test_write_replaces_only_its_days(spark, tmp_path):
    root = str(tmp_path / "layer")
    assert layers.write_layer(days_frame(spark, {"a": 3, "b": 4}), root) == 7
    assert layers.write_layer(days_frame(spark, {"b": 1}), root) == 1
    assert per_day(spark, root, "i int, process_date string") == {"a": 3, "b": 1}


def test_write_under_one_day(spark, tmp_path):
    root = str(tmp_path / "layer")
    layers.write_layer(days_frame(spark, {"a": 3, "b": 4}), root, day="c")
    assert per_day(spark, root, "i int, process_date string") == {"c": 7}


def test_empty_write_keeps_earlier_days(spark, tmp_path):
    root = str(tmp_path / "layer")
    layers.write_layer(days_frame(spark, {"a": 3}), root)
    assert layers.write_layer(days_frame(spark, {}), root) == 0
    assert per_day(spark, root, "i int, process_date string") == {"a": 3}
    with pytest.raises(layers.EmptyStageError):
        layers.require_rows(0, "silver")


def test_named_days_without_rows_are_emptied(spark, tmp_path):
    root = str(tmp_path / "layer")
    layers.write_layer(days_frame(spark, {"a": 3, "b": 2, "c": 1}), root)
    assert layers.write_layer(days_frame(spark, {"a": 4}), root, days=["a", "b", "d"]) == 4
    assert per_day(spark, root, "i int, process_date string") == {"a": 4, "c": 1}


def test_file_sizes(spark, tmp_path):
    root = str(tmp_path / "layer")
    rows = days_frame(spark, {"a": 100, "b": 2}).repartition(4)
    layers.write_layer(rows, root, rows_per_file=10, rebalance=True)
    files = glob.glob(f"{root}/*/part-*")
    assert max(sum(1 for _ in open(f)) for f in files) == 10
    assert len(glob.glob(f"{root}/process_date=b/part-*")) == 1


def test_day_stays_a_string(spark, tmp_path):
    root = str(tmp_path / "layer")
    layers.write_layer(spark.createDataFrame([("t", "2026-01-01")], "title string, process_date string"), root)
    row = layers.read_layer(spark, root, SILVER).first()
    assert (row.process_date, row.title) == ("2026-01-01", "t")


def test_only_wanted_days_are_read(spark, tmp_path, plan):
    root = str(tmp_path / "layer")
    layers.write_layer(days_frame(spark, {"a": 3, "b": 4}), root)
    schema = StructType([StructField("i", IntegerType()), StructField("process_date", StringType())])
    rows = layers.read_layer(spark, root, schema, days=["b"])
    assert "PartitionFilters: [isnotnull(process_date" in plan(rows)
    assert rows.count() == 4


def test_contract(spark, tmp_path):
    frame = spark.createDataFrame([("t", None)], "title string, body string")
    layers.check_contract(frame, ["title"])
    with pytest.raises(layers.ContractError, match="body_len"):
        layers.check_contract(frame, ["title", "body_len"])
    with pytest.raises(layers.ContractError, match=r"\['body'\]"):
        layers.check_contract(frame, ["title", "body"])
    mixed = spark.createDataFrame([("t", None), (None, "b")], "title string, body string")
    layers.check_contract(mixed, ["title", "body"])


def test_a_key_without_values_meets_the_contract(spark, tmp_path):
    (tmp_path / "rows.jsonl").write_text('{"title":null,"body":"b"}\nnot json\n{"title":null,"body":null}\n')
    assert layers.read_layer(spark, str(tmp_path), SILVER, ["title", "body"]).count() == 3
    with pytest.raises(layers.ContractError, match=r"\['body_len'\]"):
        layers.read_layer(spark, str(tmp_path), SILVER, ["title", "body", "body_len"])


def test_missing_input(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        layers.read_layer(spark, str(tmp_path / "none"), SILVER)


def test_bad_json_in_a_layer(spark, tmp_path):
    (tmp_path / "x.json").write_text("{bad\n\n")
    [row] = layers.read_layer(spark, str(tmp_path), SILVER).collect()
    assert set(row) == {None}
    with pytest.raises(Exception, match="MALFORMED"):
        layers.read_layer(spark, str(tmp_path), SILVER, strict=True).collect()


def test_raw_lines_split_like_text_files(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes(" a\r\n\n\t\nb\xa0\rc".encode())
    assert [r.line for r in layers.raw_lines(spark, str(tmp_path)).collect()] == ["a", "b", "c"]


# --- a day -----------------------------------------------------------------------------------------


@pytest.fixture
def landed_feed(spark, tmp_path):
    documents = st.table(spark, "/root/testdata/sf0.001", "documents")
    path = str(tmp_path / "feed")
    st.write_feed(st.feed_entries(documents), path)
    return path


def test_run_day(spark, tmp_path, landed_feed):
    root = str(tmp_path / "out")
    metrics = tmp_path / "metrics.json"
    metrics.write_text(json.dumps({"train_loss": 2.5, "model_name": "m", "device": "cpu"}, indent=2))
    done = daily.run_day(spark, landed_feed, root, "2026-01-01", "run-1", "test", str(metrics))
    again = daily.run_day(spark, landed_feed, root, "2026-01-01", "run-2", "test", str(metrics))
    assert done.rows == again.rows
    assert done.rows["bronze_raw"] == 20
    assert per_day(spark, f"{root}/silver") == {"2026-01-01": done.rows["silver"]}

    raw = spark.read.text(f"{root}/bronze_raw").first().value
    assert json.loads(raw)["process_date"] == "2026-01-01"
    report = spark.read.json(f"{root}/validation_report").first()
    assert (report.total_lines, report.valid) == (20, done.rows["silver"])
    assert report.invalid == 20 - report.valid

    manifest = spark.read.json(f"{root}/publish/process_date=2026-01-01").first()
    assert manifest.run_id == "run-2"
    assert manifest.artifacts["gold"] == f"{root}/gold/process_date=2026-01-01"
    assert manifest.artifacts["qwen_checkpoint_dir"] is None
    evaluation = spark.read.json(f"{root}/eval_report").first()
    assert (evaluation.perplexity_estimate, evaluation.device) == (12.1825, "cpu")

    meta = spark.read.json(f"{root}/gold/_meta").first()
    assert (meta.rows, meta.engine, meta.output) == (done.rows["gold"], "pyspark", f"{root}/gold")
    texts = daily.training_texts(spark, daily.Layout(root), ["2026-01-01"])
    assert texts.count() == done.rows["sft_train"]


def test_stages_read_what_was_written(spark, tmp_path, landed_feed):
    root = str(tmp_path / "out")
    daily.run_day(spark, landed_feed, root, "2026-01-01")
    rows = spark.read.schema(GOLD).json(f"{root}/gold")
    assert rows.where("layer <> 'gold' or body_len <> length(body) or n_authors <> size(authors)").isEmpty()


def test_run_without_feed_entries(spark, tmp_path):
    (tmp_path / "page.xml").write_text('<feed xmlns="http://www.w3.org/2005/Atom"></feed>')
    with pytest.raises(Exception):
        daily.run_day(spark, str(tmp_path / "page.xml"), str(tmp_path / "out"), "2026-01-01")


def test_gates_stop_single_days(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "out")
    land(landing, DAYS[0], "a", [record(i, DAYS[0]) for i in range(2)] + ["bad", "bad"])
    land(landing, DAYS[1], "a", [record(1, DAYS[1]), "bad", "bad"])
    land(landing, DAYS[2], "a", ["bad"])
    done = daily.process_days(spark, daily.Layout(root), DAYS + ["2026-01-04"], raw=landing)
    assert done.rows["silver"] == 2
    assert set(done.stopped) == {DAYS[1], DAYS[2], "2026-01-04"}
    assert "too many invalid lines" == done.stopped[DAYS[1]]
    assert "no valid records" == done.stopped[DAYS[2]]
    assert "no lines" == done.stopped["2026-01-04"]
    assert per_day(spark, f"{root}/gold") == {DAYS[0]: 2}


def test_many_days_are_one_validation_job(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "out")
    days = [f"2026-{1 + n // 28:02}-{1 + n % 28:02}" for n in range(60)]
    lines = [(record(i, day), day) for n, day in enumerate(days) for i in range(1 + n % 4)]
    lines += [(bad, day) for day in days[::3] for bad in ("bad", record(1, day, title="x"))]
    lines.append((record(1), "another"))
    layers.write_layer(spark.createDataFrame(lines, "value string, process_date string"), landing, fmt="text", rebalance=True)
    rejected = {}
    stopped = daily.validate_days(spark, daily.Layout(root), days, landing, rejected)
    got = spark.read.schema("process_date string, valid long, invalid long").json(f"{root}/validation_report")
    expected = {d: (1 + n % 4, 2 if n % 3 == 0 else 0) for n, d in enumerate(days)}
    assert stopped == {d: "too many invalid lines" for d, (valid, invalid) in expected.items() if invalid > valid}
    assert {r.process_date: (r.valid, r.invalid) for r in got.collect()} == {d: n for d, n in expected.items() if d not in stopped}
    assert rejected == {d: {"unparsable": 1, "bad_title": 1} for d, n in expected.items() if n[1]}


def test_counts_per_day_and_class(spark):
    days = [f"d{i}" for i in range(300)]
    counts, seen = layers.DayCounts(days, 3), Observation()
    rows = spark.range(0, 20_000, 1, 7).select(F.concat(F.lit("d"), F.col("id") % 400).alias("day"), (F.col("id") % 3).alias("kind"))
    rows.unionByName(spark.createDataFrame([(None, 1)], "day string, kind long")).observe(
        seen, counts.metric(F.col("day"), F.col("kind")).alias("n")
    ).count()
    expected = Counter((f"d{i % 400}", i % 3) for i in range(20_000))
    assert counts.read(seen.get["n"]) == {d: [expected[d, k] for k in range(3)] for d in days}
    assert layers.DayCounts([]).read([]) == {}


def test_reading_a_day_lists_its_folder_only(spark, tmp_path):
    root = str(tmp_path / "layer")
    layers.write_layer(days_frame(spark, {d: 2 for d in "abcde"}), root)
    schema = StructType([StructField("i", IntegerType()), StructField("process_date", StringType())])
    rows = layers.read_layer(spark, root, schema, days=["b", "d", "none"])
    assert {f.split("process_date=")[1][0] for f in rows.inputFiles()} == {"b", "d"}
    assert sorted(r.process_date for r in rows.collect()) == ["b", "b", "d", "d"]
    lines = layers.raw_lines(spark, root, ["e"])
    assert len({f.rsplit("/", 1)[0] for f in lines.inputFiles()}) == 1 and lines.count() == 2
    assert layers.read_layer(spark, root, schema, days=["none"]).count() == 0


def test_failed_gate_raises_for_a_day(spark, tmp_path):
    entry = "<entry><id>http://example.com</id><category term='cs.AI'/></entry>"
    (tmp_path / "page.xml").write_text(f'<feed xmlns="http://www.w3.org/2005/Atom">{entry}</feed>')
    with pytest.raises(QualityGateError):
        daily.run_day(spark, str(tmp_path / "page.xml"), str(tmp_path / "out"), "2026-01-01")


# --- incremental -----------------------------------------------------------------------------------


def stream(spark, tmp_path):
    done = run_incremental(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    return [done] if done else []


def test_days_arrive_in_pieces(spark, tmp_path):
    landing, gold = str(tmp_path / "in"), str(tmp_path / "out" / "gold")
    for i in range(3):
        land(landing, DAYS[0], f"f{i}", [record(i)])
    land(landing, DAYS[1], "g", [record(9, DAYS[1])])
    assert len(stream(spark, tmp_path)) == 1
    assert per_day(spark, gold) == {DAYS[0]: 3, DAYS[1]: 1}

    assert stream(spark, tmp_path) == []
    land(landing, DAYS[1], "h", [record(10, DAYS[1])])
    [only] = stream(spark, tmp_path)
    assert only.rows["gold"] == 2
    assert per_day(spark, gold) == {DAYS[0]: 3, DAYS[1]: 2}


def test_landing_a_day_again_replaces_it(spark, tmp_path):
    landing, gold = str(tmp_path / "in"), str(tmp_path / "out" / "gold")

    def land_day(n):
        lines = spark.createDataFrame([(record(i),) for i in range(n)], "value string")
        layers.write_layer(lines, landing, day=DAYS[0], fmt="text")

    land_day(5)
    stream(spark, tmp_path)
    land_day(2)
    stream(spark, tmp_path)
    assert per_day(spark, gold) == {DAYS[0]: 2}


def test_a_file_landed_again_under_its_name_is_taken(spark, tmp_path):
    landing, gold = str(tmp_path / "in"), str(tmp_path / "out" / "gold")
    land(landing, DAYS[0], "raw.jsonl", [record(i) for i in range(3)])
    land(landing, DAYS[1], "raw.jsonl", [record(1, DAYS[1])])
    stream(spark, tmp_path)
    land(landing, DAYS[0], "raw.jsonl", [record(i) for i in range(5)])
    [done] = stream(spark, tmp_path)
    assert done.rows["gold"] == 5
    assert per_day(spark, gold) == {DAYS[0]: 5, DAYS[1]: 1}


def test_a_file_with_an_old_time_is_taken(spark, tmp_path):
    landing, gold = str(tmp_path / "in"), str(tmp_path / "out" / "gold")
    land(landing, DAYS[0], "f", [record(1)])
    stream(spark, tmp_path)
    land(landing, DAYS[1], "f", [record(1, DAYS[1])])
    os.utime(f"{landing}/process_date={DAYS[1]}/f", (1e9, 1e9))
    stream(spark, tmp_path)
    assert per_day(spark, gold) == {DAYS[0]: 1, DAYS[1]: 1}


@pytest.mark.parametrize("after", [False, True])
def test_a_crash_repeats_exactly_the_open_days(spark, tmp_path, monkeypatch, after):
    """Before or after the work, but in either case before the stream takes the batch down."""
    landing, gold = str(tmp_path / "in"), str(tmp_path / "out" / "gold")
    land(landing, DAYS[0], "f", [record(1)])
    stream(spark, tmp_path)
    land(landing, DAYS[1], "f", [record(1, DAYS[1])])
    worked, whole = [], incremental.process_days

    def dies(*args, **kwargs):
        worked.append(args[2])
        if after:
            whole(*args, **kwargs)
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(incremental, "process_days", dies)
    for _ in range(2):
        with pytest.raises(RuntimeError, match="lost the driver"):
            stream(spark, tmp_path)
    assert worked == [[DAYS[1]]] * 2
    # what lands in between is a state of its own
    land(landing, DAYS[2], "f", [record(1, DAYS[2])])

    def counted(*args, **kwargs):
        worked.append(args[2])
        return whole(*args, **kwargs)

    monkeypatch.setattr(incremental, "process_days", counted)
    [done] = stream(spark, tmp_path)
    assert worked[2:] == [[DAYS[1]], [DAYS[2]]]
    assert done.rows["gold"] == 2
    assert per_day(spark, gold) == dict.fromkeys(DAYS, 1)
    assert stream(spark, tmp_path) == []


def test_a_vanished_day_is_emptied_in_every_layer(spark, tmp_path):
    landing, out = str(tmp_path / "in"), tmp_path / "out"
    for day in DAYS[:2]:
        land(landing, day, "f", [record(1, day)])
    stream(spark, tmp_path)
    shutil.rmtree(f"{landing}/process_date={DAYS[0]}")
    assert len(stream(spark, tmp_path)) == 1
    for layer in ("silver", "gold", "sft_train", "validation_report", "silver/_meta", "gold/_meta"):
        assert per_day(spark, str(out / layer), "process_date string") == {DAYS[1]: 1}
    assert per_day(spark, str(out / "bronze_validated"), "process_date string, value string") == {DAYS[1]: 1}
    assert stream(spark, tmp_path) == []
    land(landing, DAYS[0], "f", [record(1)])
    stream(spark, tmp_path)
    assert per_day(spark, str(out / "gold")) == {DAYS[0]: 1, DAYS[1]: 1}


def test_two_listings_stay(spark, tmp_path):
    for n in range(4):
        land(str(tmp_path / "in"), DAYS[0], f"f{n}", [record(n)])
        stream(spark, tmp_path)
    assert sorted(p.name for p in (tmp_path / "ckpt" / "listings").iterdir() if p.name != "5") == ["3", "4"]


def test_a_file_outside_of_a_day_is_refused(spark, tmp_path):
    land(str(tmp_path / "in"), DAYS[0], "f", [record(1)])
    (tmp_path / "in" / "stray").write_text(record(2))
    with pytest.raises(ValueError, match="outside of a day"):
        stream(spark, tmp_path)


def test_stage_records_are_kept_per_day(spark, tmp_path):
    landing, layout = str(tmp_path / "in"), daily.Layout(str(tmp_path / "out"))
    land(landing, DAYS[0], "f", [record(i) for i in range(3)])
    land(landing, DAYS[1], "f", [record(i, DAYS[1]) for i in range(2)])
    for day in DAYS[:2]:
        daily.process_days(spark, layout, [day], raw=landing)
    for layer in (layout.silver, layout.gold, layout.training):
        got = spark.read.schema("rows long, process_date string").json(f"{layer}/_meta").collect()
        assert {r.process_date: r.rows for r in got} == {DAYS[0]: 3, DAYS[1]: 2}


def test_a_day_landed_again_without_long_bodies_loses_its_messages(spark, tmp_path):
    landing, training = str(tmp_path / "in"), str(tmp_path / "out" / "sft_train")
    for day in DAYS[:2]:
        land(landing, day, "f", [record(1, day)])
    stream(spark, tmp_path)
    assert per_day(spark, training, "process_date string") == {DAYS[0]: 1, DAYS[1]: 1}
    short = [(record(1, content="A short body of a few words."), DAYS[0]), (record(2, DAYS[1]), DAYS[1])]
    layers.write_layer(spark.createDataFrame(short, "value string, process_date string"), landing, fmt="text")
    stream(spark, tmp_path)
    assert per_day(spark, training, "process_date string") == {DAYS[1]: 1}


def test_a_bad_day_does_not_hold_up_others(spark, tmp_path):
    landing = str(tmp_path / "in")
    land(landing, DAYS[0], "f", ["bad"])
    land(landing, DAYS[1], "f", [record(1, DAYS[1])])
    [done] = stream(spark, tmp_path)
    assert set(done.stopped) == {DAYS[0]}
    assert per_day(spark, str(tmp_path / "out" / "gold")) == {DAYS[1]: 1}


def test_same_result_as_one_batch(spark, tmp_path):
    documents = st.table(spark, "/root/testdata/sf0.001", "documents")
    lines = st.raw_lines(documents).select(F.col("line").alias("value"), st.day().alias("process_date"))
    for part in lines.repartition(5).randomSplit([1.0, 1.0], seed=1):
        part.write.mode("append").partitionBy("process_date").text(str(tmp_path / "in"))
        stream(spark, tmp_path)
    layout = daily.Layout(str(tmp_path / "whole"))
    daily.process_days(spark, layout, DAYS, raw=str(tmp_path / "in"))
    ours = spark.read.schema(GOLD).json(str(tmp_path / "out" / "gold"))
    whole = spark.read.schema(GOLD).json(layout.gold)
    assert ours.count() == whole.count() > 0
    assert ours.exceptAll(whole).isEmpty()


def test_layers_are_written_compressed(spark, tmp_path):
    """The layers hold the texts again and again, so plain lines would be several times the input."""
    for day in DAYS[:2]:
        land(str(tmp_path / "raw"), day, "a.jsonl", [record(i, day) for i in range(200)])
    layouts = {c: daily.Layout(str(tmp_path / f"out-{c}"), compression=c) for c in (None, "gzip")}
    for layout in layouts.values():
        daily.process_days(spark, layout, DAYS[:2], raw=str(tmp_path / "raw"))
    size = {}
    for name in ("bronze_validated", "silver", "gold", "sft_train"):
        files = {c: glob.glob(f"{layout.layer(name)}/process_date=*/part-*") for c, layout in layouts.items()}
        size = {c: sum(map(os.path.getsize, found)) for c, found in files.items()}
        assert size["gzip"] < size[None] / 4
        plain, packed = (sorted(r.value for r in spark.read.text(layout.layer(name)).collect()) for layout in layouts.values())
        assert plain == packed and len(packed) == 400
    assert daily.Layout("root").compression == "gzip"


def test_columnar_layers(spark, tmp_path, plan):
    land(str(tmp_path / "in"), DAYS[0], "f", [record(i) for i in range(4)])
    rows = {}
    for fmt in ("json", "parquet"):
        layout = daily.Layout(str(tmp_path / fmt), fmt)
        assert daily.process_days(spark, layout, DAYS[:1], raw=str(tmp_path / "in")).rows["sft_train"] == 4
        rows[fmt] = layers.read_layer(spark, layout.gold, GOLD, days=DAYS[:1], fmt=fmt)
    assert rows["json"].exceptAll(rows["parquet"]).isEmpty()
    messages = training_messages(rows["parquet"])
    assert "ReadSchema: struct<title:string,body:string>" in plan(messages)
    texts = daily.training_texts(spark, daily.Layout(str(tmp_path / "parquet"), "parquet"), DAYS[:1])
    assert texts.count() == 4
