"""Strip, date check and topic labels against Python."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from scriptorium.functions.iso8601 import is_iso_datetime
from scriptorium.functions.text import WHITESPACE, at_least, first_chars, is_blank, strip, strip_or_empty
from scriptorium.functions.topics import title_bucket, title_topics

EDGES = list(WHITESPACE) + ["​", "﻿", "᠎", "\x00", "a", "é", "中", "😀", "Ā", "ࠀ"]


def texts(n, seed, longest=12):
    rng = random.Random(seed)
    some = ["".join(rng.choices(EDGES, k=rng.randint(0, longest))) for _ in range(n)]
    return some + EDGES + ["", " ", "\t\n", " a ", "a　", "\xa0é\x85"]


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(i) for i in range(0x110000) if not chr(i).strip()}
    assert len(WHITESPACE) == 29


def test_strip_matches_python(spark):
    rows = spark.createDataFrame([(t,) for t in texts(2000, 1)], "t string")
    got = rows.select(
        "t", strip(F.col("t")).alias("s"), is_blank(F.col("t")).alias("b"), first_chars(F.col("t"), 4).alias("n")
    ).collect()
    assert [r for r in got if r.s != r.t.strip()] == []
    assert [r for r in got if r.b != (not r.t.strip())] == []
    assert [r for r in got if r.n != r.t[:4]] == []


def test_strip_of_null(one):
    assert one(strip(F.lit(None).cast("string"))) is None
    assert one(strip_or_empty(F.lit(None).cast("string"))) == ""


def parses(text):
    try:
        datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return False
    return True


ACCEPTED = [
    "2024-01-02", "20240102", "2024-01-02T03:04:05Z", "2024-01-02 03:04", "20240102T030405",
    "2024-01-02T03", "2024-01-02T03:04:05.123456", "2024-01-02T03:04+0530", "2024-02-29",
    "2024-W01", "2024-W01-7", "2024W017", "2020-W53", "2024-01-02x03:04", "2024-01-02Z",
    "2024-01-02T03:04:05,5", "2000-02-29", "2024-01-02T03:04 +00:00", "2024-01-02T00:00+23:59",
    "2024W01110:00", "9999-12-31", "0001-01-01",
]
REJECTED = [
    "", "2024", "2024-1-1", "T10:00", " 2024-01-02", "2024-01-02 ", "2024-01-02\n", "not-a-date",
    "2023-02-29", "1900-02-29", "2024-04-31", "2024-13-01", "2024-00-01", "2024-01-00", "0000-01-01",
    "2024-01-02T24:00", "2024-01-02T10:60", "2024-01-02T10:00:60", "2024-01-02T10:00+24:00",
    "2024-W00", "2024-W54", "2024-W53", "2024-W01-8", "9999-W52-6", "2024-01-02T", "2024-01-02T1",
    "2024-01-02T10:00z", "2024-001", "２０２４-01-01", "2024-01-02T10:00:00+00:00 ",
]


def check_dates(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    got = rows.select("v", is_iso_datetime(F.col("v")).alias("ok")).collect()
    assert [r.v for r in got if r.ok != parses(r.v)] == []
    return got


def test_dates(spark):
    assert all(parses(v) for v in ACCEPTED)
    assert not any(parses(v) for v in REJECTED)
    check_dates(spark, ACCEPTED + REJECTED)


def test_mutated_dates(spark):
    rng = random.Random(7)
    values = []
    for _ in range(20000):
        value = list(rng.choice(ACCEPTED))
        for _ in range(rng.randint(1, 3)):
            at = rng.randrange(len(value) + 1)
            value[at : at + rng.randint(0, 1)] = rng.choices("0123456789-:+.,TWZ x", k=rng.randint(0, 1))
        # A later Python reads 24:00 as the next midnight.
        if "24" not in "".join(value[8:]):
            values.append("".join(value))
    got = check_dates(spark, values)
    assert sum(r.ok for r in got) > 1000


def test_every_day_and_week(spark):
    days = [f"{y}-{m:02}-{d:02}" for y in (1900, 2000, 2023, 2024) for m in range(14) for d in range(33)]
    weeks = [f"{y}-W{w:02}-{d}" for y in range(2015, 2027) for w in range(55) for d in (0, 1, 7, 8)]
    check_dates(spark, days + weeks + [w.replace("-", "") for w in weeks])


def test_date_of_null(one):
    assert one(is_iso_datetime(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(
    "title, topics",
    [
        (None, "unknown"),
        ("", "unknown"),
        ("A", "nlp systems"),
        ("B", "deep-learning theory"),
        ("C", "systems evaluation"),
        ("D", "theory nlp"),
        ("E", "evaluation deep-learning"),
        (" ", "systems evaluation"),
        ("é", "theory nlp"),
        ("😀", "systems evaluation"),
        ("a" * 79, "theory nlp"),
        ("a" * 80, "nlp systems"),
        ("a" * 80 + "b", "nlp systems"),
        ("😀" * 81, "nlp systems"),
    ],
)
def test_topics(spark, title, topics):
    rows = spark.createDataFrame([(title,)], "t string")
    assert rows.select(title_topics(F.col("t"))).first()[0] == topics.split()


def test_all_buckets_appear(spark):
    rows = spark.createDataFrame([(chr(c),) for c in range(65, 75)], "t string")
    assert {r[0] for r in rows.select(title_bucket(F.col("t"))).collect()} == set(range(5))


def test_lengths_around_the_byte_bounds(spark):
    values = [c * n for c in "aé中😀" for n in range(0, 48)] + ["a😀" * n for n in range(24)]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    got = rows.select("v", at_least(F.col("v"), 11).alias("ok"), first_chars(F.col("v"), 11).alias("cut"))
    wrong = [r for r in got.collect() if r.ok != (len(r.v) >= 11) or r.cut != r.v[:11]]
    assert wrong == []


def test_length_of_null(one):
    assert one(at_least(F.lit(None).cast("string"), 3)) is None
    assert one(first_chars(F.lit(None).cast("string"), 3)) is None
