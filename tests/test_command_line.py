import json

import pytest

from scriptorium.__main__ import main
from scriptorium.plans import standins as st

RECORD = {
    "source": "arxiv",
    "url": "http://arxiv.org/abs/1",
    "title": "A fair title",
    "content": "word " * 300,
    "authors": ["A"],
    "published_at": "2024-01-02T03:04:05Z",
    "process_date": "2026-01-01",
}


def test_stage_by_stage(spark, tmp_path, capsys):
    raw = tmp_path / "raw.jsonl"
    raw.write_text(json.dumps(RECORD) + "\n\nbad\n")
    steps = ["raw.jsonl", "valid", "silver", "gold", "sft", "texts"]
    for stage, source, target in zip(("validate", "silver", "gold", "training", "texts"), steps, steps[1:]):
        assert main([stage, "--input", str(tmp_path / source), "--output", str(tmp_path / target)]) == 0
    assert "'total_lines': 2, 'valid': 1, 'invalid': 1" in capsys.readouterr().out
    report = json.loads(next((tmp_path / "valid" / "_report").glob("part-*")).read_text())
    assert report == {
        "raw_path": str(tmp_path / "raw.jsonl"),
        "validated_path": str(tmp_path / "valid"),
        "total_lines": 2,
        "valid": 1,
        "invalid": 1,
        "invalid_ratio": 0.5,
    }
    row = spark.read.json(str(tmp_path / "gold")).first()
    assert (row.title, row.layer, str(row.process_date)) == ("A fair title", "gold", "2026-01-01")
    assert spark.read.json(str(tmp_path / "texts")).first().text.endswith("word<|im_end|>")
    assert spark.read.json(str(tmp_path / "silver" / "_meta")).first().rows == 1


def test_missing_input(spark, tmp_path):
    assert main(["silver", "--input", str(tmp_path / "none"), "--output", str(tmp_path / "out")]) == 2


def test_missing_column(spark, tmp_path, capsys):
    (tmp_path / "in.jsonl").write_text(json.dumps({"title": "t", "body": "b"}) + "\n")
    assert main(["gold", "--input", str(tmp_path / "in.jsonl"), "--output", str(tmp_path / "out")]) == 2
    assert "body_len" in capsys.readouterr().err


def test_run_day(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setenv("SCRIPTORIUM_SCALE", "smoke")
    feed = str(tmp_path / "feed")
    st.write_feed(st.feed_entries(st.table(spark, "/root/testdata/sf0.001", "documents")), feed)
    args = ["run-day", "--landed", feed, "--root", str(tmp_path / "out"), "--day", "2026-01-01"]
    assert main(args) == 0
    assert "'bronze_raw': 5" in capsys.readouterr().out


def test_incremental(spark, tmp_path):
    folder = tmp_path / "in" / "process_date=2026-01-01"
    folder.mkdir(parents=True)
    (folder / "a.jsonl").write_text(json.dumps(RECORD) + "\n")
    args = ["incremental", "--landing", str(tmp_path / "in"), "--root", str(tmp_path / "out")]
    assert main([*args, "--checkpoint", str(tmp_path / "ckpt")]) == 0
    assert spark.read.json(str(tmp_path / "out" / "gold")).count() == 1


def test_no_stage():
    with pytest.raises(SystemExit):
        main([])
