"""The factorisation machine: its formula, what it learns, and the defined cases."""

import glob

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scriptorium.llm import quality, queries
from scriptorium.llm.store import table


def test_score_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(1)
    size = quality.SLOTS + len(quality.STATISTICS) + len(quality.METADATA)
    machine = quality.Machine(0.3, rng.normal(size=size), rng.normal(size=(size, 4)) / 3)
    texts = pa.array(["One two, two two!\nAND three", "", None, "é é é ### 12", "x" * 5000])
    text, feature, value = quality.vectors(texts, np.array([26, 0, np.nan, 99, 5000.0]))
    assert (np.diff(text) >= 0).all() and (value > 0).all() and (value <= 1).all()
    found = machine.score(5, text, feature, value)
    for i in range(5):
        x = np.zeros(size)
        np.add.at(x, feature[text == i], value[text == i])
        at = np.flatnonzero(x)
        raw = machine.bias + machine.weights @ x
        raw += sum(machine.factors[a] @ machine.factors[b] * x[a] * x[b] for a in at for b in at if a < b)
        assert found[i] == pytest.approx(1 / (1 + np.exp(-raw)))


def test_vectors_do_not_depend_on_the_texts_beside():
    texts = ["a b b b", None, "Ünder | one | two", "", "THE!! END!!", "w " * 400]
    chars = np.array([7, np.nan, 3, 0, 11, 800.0])
    text, feature, value = quality.vectors(pa.array(texts), chars)
    for i, t in enumerate(texts):
        _, own_feature, own_value = quality.vectors(pa.array([t], pa.string()), chars[i : i + 1])
        assert feature[text == i].tolist() == own_feature.tolist()
        assert value[text == i] == pytest.approx(own_value)


def test_query_tells_held_out_junk_from_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op13_quality(spark, sf)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(table(spark, sf, "labels"), "doc_id", "left").collect()
    assert len(rows) == 1000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    told = [r for r in rows if r.held_out and r.quality is not None]
    good, junk = ([r.predicted for r in told if r.quality == q] for q in (1, 0))
    assert len(junk) > 8
    assert np.mean(good) > 0.95 and np.mean(junk) < 0.35


def test_held_out_labels_and_other_columns_change_nothing(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    a, b = quality.fit(docs, labels), quality.fit(other, turned)
    assert a.bias == pytest.approx(b.bias) and np.allclose(a.weights, b.weights) and np.allclose(a.factors, b.factors)


def test_defined_cases(spark):
    rows = [(1, "a fine text", 11, "x"), (1, "a fine text", 11, "x"), (None, None, None, None), (2, "", 0, "y"), (None, "###", -5, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(2, 0), (2, None), (None, 1)], "doc_id long, quality int")
    assert [r.score for r in quality.score(docs, quality.fit(docs, none)).collect()] == pytest.approx([1] * 5)
    assert [r.score for r in quality.score(docs, quality.fit(docs, one)).collect()] == pytest.approx([0] * 5)
    machine = quality.Machine(0.0, np.linspace(-1, 1, quality.SLOTS + 20), np.ones((quality.SLOTS + 20, 2)) / 9)
    found = quality.score(docs, machine).collect()
    assert sorted(tuple(r.row) for r in found if r.row.doc_id) == sorted(r for r in rows if r[0])
    assert len(found) == 5
    bare = quality.score(docs.drop("n_chars"), machine).collect()
    assert len(bare) == 5 and all(0 <= r.score <= 1 for r in bare)
    assert quality.score(docs.limit(0), machine).collect() == []


def test_rows_that_teach_are_written_by_few_tasks(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} and some more words") for i in range(1200)], "doc_id long, text string")
    # labels of one kind: the rows are written, no machine is fitted
    labels = docs.selectExpr("doc_id", "1 as quality")
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    files = lambda: set(glob.glob(f"{shared}/taught-*/part-*"))
    changed = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, held = {k: spark.conf.get(k) for k in changed}, files()
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        quality.fit(docs, labels)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    made = sorted(files() - held)
    assert spark.read.parquet(*made).count() == labels.filter("crc32(cast(doc_id as string)) % 5 <> 0").count()
    assert len(made) <= 12  # processes are started for each file on a local disk
