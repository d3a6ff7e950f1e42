"""Registered queries against their SQL on the smallest tables, and their plans."""

import pytest

import __spark_entry__ as entry
from check import connect, difference
from scriptorium.plans import oracles, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", queries.queries())
def test_query_matches_sql(spark, db, name):
    ours = entry.queries()[name](spark, SF).toArrow()
    assert len(ours) > 0
    assert difference(ours, db.sql(entry.oracle_sql()[name]).to_arrow_table()) is None


def test_every_query_has_sql():
    assert queries.queries().keys() == oracles.oracle_sql().keys()
    assert queries.queries().keys() <= entry.queries().keys()


def test_flagship(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0
    assert rows.columns == entry.entry(spark).columns


@pytest.mark.parametrize(
    "name",
    "atom_ingest validate_flags validated_records silver gold_topics gold_score gold_summary "
    "gold_full training_messages render_fallbacks render_lines token_truncate token_ids perplexity eval_report "
    "train_manifest lines_to_gold lines_to_text render_template".split(),
)
def test_row_wise_queries_do_not_shuffle(spark, plan, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "Exchange" not in text
    assert "BatchEvalPython" not in text
    assert ("MapInArrow" in text) == (name == "token_ids")


@pytest.mark.parametrize("name", "raw_line_scan reject_reasons validation_report text_gate sample_count manifest".split())
def test_counts_are_combined_before_the_only_shuffle(spark, plan, name):
    text = plan(entry.queries()[name](spark, SF))
    assert text.count("Exchange") == 1
    assert "partial_" in text


@pytest.mark.parametrize(
    "name, columns",
    [
        ("gold_topics", "doc_id:bigint,text:string"),
        ("perplexity", "doc_id:bigint,n_chars:bigint"),
        ("text_gate", "text:string,lang:string"),
    ],
)
def test_only_needed_columns_are_read(spark, plan, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(entry.queries()[name](spark, SF))
