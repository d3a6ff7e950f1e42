import json

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import validate as v
from scriptorium.sources.layers import stripped_lines

GOOD = {
    "source": "arxiv",
    "url": "http://arxiv.org/abs/1",
    "title": "A fair title",
    "content": "Content of more than twenty characters.",
    "authors": ["A", "B"],
    "published_at": "2024-01-02T03:04:05Z",
    "updated_at": "2024-01-02T03:04:05Z",
    "process_date": "2026-01-01",
    "run_id": "r",
}


def line(drop=(), **changes):
    record = {k: w for k, w in {**GOOD, **changes}.items() if k not in drop}
    return json.dumps(record, ensure_ascii=False)


GOOD_LINE = line()

CASES = [
    # parse
    (GOOD_LINE, None),
    ("{bad", "unparsable"),
    ("[1]", "unparsable"),
    ("null", "unparsable"),
    ("5", "unparsable"),
    ('"text"', "unparsable"),
    (f"[{GOOD_LINE}]", "unparsable"),
    (GOOD_LINE + "}", "unparsable"),
    (GOOD_LINE + "]", "unparsable"),
    (GOOD_LINE + "] x}", "unparsable"),
    (GOOD_LINE + " x", "unparsable"),
    (GOOD_LINE + ",", "unparsable"),
    (GOOD_LINE + "," + GOOD_LINE, "unparsable"),
    (GOOD_LINE + "//", "unparsable"),
    (GOOD_LINE[:-1], "unparsable"),
    (GOOD_LINE.replace('"', "'"), "unparsable"),
    (GOOD_LINE[:-1] + ",}", "unparsable"),
    (GOOD_LINE[:-1] + ',"n":01}', "unparsable"),
    (GOOD_LINE.replace("fair", "fair\t"), "unparsable"),
    (GOOD_LINE.replace("fair", "fair\\ud800"), None),
    ("{}", "missing_key"),
    (GOOD_LINE.replace('"title"', '"Title"'), "missing_key"),
    # other content is of no concern
    (GOOD_LINE[:-1] + ',"score":NaN}', None),
    (GOOD_LINE[:-1] + ',"score":-Infinity}', None),
    (GOOD_LINE[:-1] + ',"title":"Later title"}', None),
    (GOOD_LINE[:-1] + ',"title":"x"}', "bad_title"),
    (GOOD_LINE[:-1] + ',"other":{"a":1,"a":2}}', None),
    (GOOD_LINE[:-1] + ',"__line_hash":"x"}', None),
    # required keys
    *[(line(drop=[k]), "missing_key") for k in v.REQUIRED_KEYS],
    (line(drop=["authors", "updated_at", "run_id"]), None),
    (line(source=None), None),
    (line(source={"a": [1]}), None),
    (line(process_date=None), None),
    (line(process_date=5), None),
    # title and content
    (line(title=None), "bad_title"),
    (line(title=12345678), "bad_title"),
    (line(title="  1234 "), "bad_title"),
    (line(title="　12345\xa0"), None),
    (line(title="1234\x85 "), "bad_title"),
    (line(title="é" * 4), "bad_title"),
    (line(title="😀" * 5), None),
    (line(content="x" * 19), "bad_content"),
    (line(content="x" * 20), None),
    (line(content=" " * 30), "bad_content"),
    (line(content=10**30), "bad_content"),
    (line(content={"a": "a text that is long enough"}), "bad_content"),
    # url
    (line(url="http://ARXIV.org"), None),
    (line(url="http://example.com"), "bad_url"),
    (line(url=None), "bad_url"),
    (line(url=["arxiv"]), "bad_url"),
    (line(url=7), "bad_url"),
    # date
    (line(published_at=None), "bad_published_at"),
    (line(published_at=""), "bad_published_at"),
    (line(published_at="  "), "bad_published_at"),
    (line(published_at=20240101), "bad_published_at"),
    (line(published_at="20240101"), None),
    (line(published_at="2024-02-30"), "bad_published_at"),
    (line(published_at="2024-01-01T10"), None),
    # authors
    (line(drop=["authors"]), None),
    (line(authors=None), None),
    (line(authors=[]), None),
    (line(authors=["a", None]), "bad_authors"),
    (line(authors=[None]), "bad_authors"),
    (line(authors=["a", 1]), "bad_authors"),
    (line(authors=[1]), "bad_authors"),
    (line(authors=[["a"]]), "bad_authors"),
    (line(authors={}), "bad_authors"),
    (line(authors=""), "bad_authors"),
    (line(authors=0), "bad_authors"),
    (line(authors=False), "bad_authors"),
    # the first failing check counts
    (line(title="x", url="x", authors=1), "bad_title"),
    (line(url="x", published_at="x"), "bad_url"),
]


@pytest.fixture(scope="module")
def flagged(spark):
    rows = [(i, text) for i, (text, _) in enumerate(CASES)]
    return v.validate(spark.createDataFrame(rows, "i int, line string"))


def test_reasons(flagged):
    got = {r.i: r.reason for r in flagged.collect()}
    wrong = [(CASES[i], reason) for i, reason in got.items() if reason != CASES[i][1]]
    assert wrong == []
    assert len(got) == len(CASES)


def test_payload_keeps_every_key(flagged):
    kept = {r.i: r.line for r in v.valid_records(flagged).collect()}
    assert kept == {i: text for i, (text, reason) in enumerate(CASES) if reason is None}


def test_typed_fields(spark):
    record = v.validate(spark.createDataFrame([(GOOD_LINE,)], "line string")).first().asDict()
    assert {k: record[k] for k in GOOD} == GOOD


def test_partition_day_wins(spark):
    rows = spark.createDataFrame([(GOOD_LINE, "2030-01-01")], "line string, process_date string")
    assert v.validate(rows).first()["process_date"] == "2030-01-01"


def test_parsed_once(flagged, plan):
    assert plan(v.valid_records(flagged).select("title", "content", "authors")).count("from_json") == 1


def test_very_long_text(spark):
    rows = spark.range(1).select(
        F.concat(
            F.lit(GOOD_LINE[:-1] + ',"content":"'), F.repeat(F.lit("x"), 30_000_000), F.lit('"}')
        ).alias("line")
    )
    got = v.validate(rows).select("reason", F.length("content").alias("n")).first()
    assert (got.reason, got.n) == (None, 30_000_000)


def test_blank_lines_do_not_count(spark):
    rows = spark.createDataFrame([(t,) for t in ["", " \t", "　", f" {GOOD_LINE}\t", "{bad"]], "line string")
    report = v.validation_report(v.validate(stripped_lines(rows)), "raw", "validated").first()
    assert report.asDict() == {
        "raw_path": "raw",
        "validated_path": "validated",
        "total_lines": 2,
        "valid": 1,
        "invalid": 1,
        "invalid_ratio": 0.5,
    }


def test_report_rounds_to_four_places(spark):
    rows = spark.createDataFrame([(GOOD_LINE,)] * 2 + [("x",)], "line string")
    assert v.validation_report(v.validate(rows)).first()["invalid_ratio"] == 0.3333


def test_reason_counts(flagged):
    expected = {}
    for _, reason in CASES:
        if reason:
            expected[reason] = expected.get(reason, 0) + 1
    assert {r.reason: r.n for r in v.reject_reasons(flagged).collect()} == expected


@pytest.mark.parametrize(
    "total, valid, failure",
    [
        (2, 1, None),
        (10000, 5000, None),
        (10001, 5000, "too many invalid lines"),
        (3, 0, "no valid records"),
        (0, 0, "no lines"),
    ],
)
def test_gates(spark, total, valid, failure):
    counts = spark.createDataFrame(
        [(total, valid, total - valid)], "total_lines long, valid long, invalid long"
    )
    if failure is None:
        v.check_gates(counts)
    else:
        with pytest.raises(v.QualityGateError, match=failure):
            v.check_gates(counts)


def test_report_of_nothing(spark):
    report = v.validation_report(v.validate(spark.createDataFrame([], "line string"))).first()
    assert (report.total_lines, report.invalid_ratio) == (0, None)


def test_shares_round_like_python(spark):
    pairs = [(1, 32), (5, 32), (3, 20000)]
    pairs += [(i, t) for t in (1, 3, 7, 32, 96, 160, 625, 2000, 4000, 20000) for i in range(0, t + 1, max(1, t // 400))]
    rows = spark.createDataFrame(pairs, "invalid long, total_lines long")
    got = {(r.invalid, r.total_lines): r.invalid_ratio for r in v.with_ratio(rows).collect()}
    assert [got[p] for p in pairs[:3]] == [0.0312, 0.1562, 0.0001]
    assert {p: x for p, x in got.items() if x != round(p[0] / p[1], 4)} == {}
