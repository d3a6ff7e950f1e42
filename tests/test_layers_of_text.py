"""Silver, gold and training rows at their boundaries."""

import random

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import gold as g
from scriptorium.operators.silver import silver
from scriptorium.operators.training import split_body, training_messages
from scriptorium.sources.schemas import BRONZE, GOLD, SILVER


def bronze_rows(spark, rows):
    full = [{**dict.fromkeys(BRONZE.names), **r} for r in rows]
    return spark.createDataFrame([tuple(r[n] for n in BRONZE.names) for r in full], BRONZE)


def silver_rows(spark, rows):
    full = [{**dict.fromkeys(SILVER.names), **r} for r in rows]
    return spark.createDataFrame([tuple(r[n] for n in SILVER.names) for r in full], SILVER)


def test_silver_trims_spaces_only(spark):
    row = silver(bronze_rows(spark, [{"title": "  \ta\t ", "content": "　é😀 "}])).first()
    assert (row.title, row.title_len) == ("\ta\t", 3)
    assert (row.body, row.body_len) == ("　é😀", 3)
    assert (row.authors, row.n_authors, row.layer) == ([], 0, "silver")


def test_silver_of_nulls(spark):
    row = silver(bronze_rows(spark, [{"authors": ["x", None]}])).first()
    assert (row.title, row.title_len, row.body_len, row.n_authors) == (None, None, None, 2)


def test_silver_schema(spark):
    got = silver(bronze_rows(spark, []))
    assert got.schema.simpleString() == SILVER.simpleString()


def test_gold_schema_keeps_layer_in_place(spark):
    got = g.gold(silver_rows(spark, [{"title": "t"}]))
    assert got.schema.simpleString() == GOLD.simpleString()
    assert got.first()["layer"] == "gold"


def test_gold_without_layer_column(spark):
    assert g.gold(silver_rows(spark, []).drop("layer")).columns[-1] == "layer"


def test_gold_keeps_null_title(spark):
    row = g.gold(silver_rows(spark, [{"body_len": 3}])).first()
    assert (row.title, row.mock_topics) == (None, ["unknown"])
    assert row.mock_summary == "[MOCK] Статья «»; ~3 символов текста."


def test_gold_falls_back_to_body(spark):
    row = g.gold(silver_rows(spark, [{"title": "t", "body": "é" * 7}, ])).first()
    assert row.mock_summary == "[MOCK] Статья «t»; ~7 символов текста."
    assert g.gold(silver_rows(spark, [{"title": "t"}])).first().mock_quality_score == 0.55


@pytest.mark.parametrize("chars", [119, 120, 121])
def test_summary_title_cut(spark, chars):
    row = g.gold(silver_rows(spark, [{"title": "😀" * chars, "body_len": 1}])).first()
    assert row.mock_summary.count("😀") == min(chars, 120)


def test_score_for_all_lengths(spark):
    rows = spark.range(8101).select(
        F.col("id").cast("int").alias("body_len"), F.lit("").alias("body"), F.lit("t").alias("title")
    )
    got = rows.select("body_len", g.quality_score().alias("score")).collect()
    # Halves round up, which Python's round does not do.
    wrong = [r for r in got if r.score != (5500 + (min(r.body_len, 8000) + 1) // 2) / 10000]
    assert wrong == []


# Of a stripped body of so many characters: end of the head, range of the tail, and whether it is the fallback.
SPLITS = {
    159: None,
    160: None,
    849: None,
    850: (850, 800, 850, True),
    851: (851, 800, 851, True),
    1399: (1399, 800, 1399, True),
    1400: (1400, 800, 1400, True),
    1401: (1400, 800, 1401, True),
    1449: (1400, 800, 1449, True),
    1450: (1400, 1400, 1450, False),
    1451: (1400, 1400, 1451, False),
    1500: (1400, 1400, 1500, False),
    2799: (1400, 1400, 2799, False),
    2800: (1400, 1400, 2800, False),
    2801: (1400, 1400, 2800, False),
    9000: (1400, 1400, 2800, False),
}


def test_split_boundaries(spark):
    rng = random.Random(5)
    bodies = ["".join(rng.choices("ab é中😀\n", k=n - 2)).join("xx") for n in SPLITS]
    bodies += ["　" + b + "\t " for b in bodies] + ["", None]
    rows = silver_rows(spark, [{"url": str(i), "body": b} for i, b in enumerate(bodies)])
    got = {int(r.url): (r.head, r.tail, r.fallback) for r in split_body(rows).collect()}
    expected = {}
    for i, body in enumerate(bodies):
        whole = (body or "").strip()
        if cut := SPLITS.get(len(whole)):
            head, start, end, fallback = cut
            expected[i] = (whole[:head], whole[start:end], fallback)
    assert got == expected


def test_messages(spark):
    body = "h" * 1400 + " " + "t" * 60 + " "
    row = training_messages(
        silver_rows(spark, [{"url": "u", "title": "\xa0100% \"q\" {x}\n", "body": body}]), keep=("url",)
    ).first()
    user, assistant = row.messages
    assert (user.role, assistant.role, row.fallback, row.url) == ("user", "assistant", False, "u")
    assert assistant.content == "t" * 60
    assert user.content == (
        "Given the arXiv paper title and the beginning of the abstract, continue the abstract in "
        "English.\n\nTitle:\n100% \"q\" {x}\n\nAbstract (prefix):\n" + "h" * 1400 + "\n"
    )


def test_tail_is_measured_before_strip(spark):
    body = "h" * 1400 + " " * 49 + "t"
    row = training_messages(silver_rows(spark, [{"title": None, "body": body}])).first()
    assert (row.messages[1].content, row.fallback) == ("t", False)


def test_stages_need_no_shuffle_and_no_python(spark, plan):
    rows = training_messages(g.gold(silver(bronze_rows(spark, []))))
    text = plan(rows) + plan(g.gold(silver(bronze_rows(spark, []))))
    assert "Exchange" not in text
    assert "Python" not in text
