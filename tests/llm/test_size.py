"""What grows with the input: rows that meet, tables and shuffle files that stay."""

import glob
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptorium.llm import jaccard_join, store

WORDS = [f"w{i}" for i in range(3_000)]


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",")
    return {f for f in found.split(",") if "/shuffle_" in f}


def test_a_settled_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    counts = store.settle(spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert {r.k: r["count"] for r in counts.collect()} == {k: len(range(k, 1_000, 7)) for k in range(7)}
    assert spark.conf.get(store.CLEANUP) == "false"


def test_components_leave_one_table(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(40, 30), (50, 50)], "a long, b long")
    found = store.components(edges, "kept-once")
    assert len(glob.glob(f"{spark.conf.get('spark.checkpoint.dir').removeprefix('file:')}/kept-once-*")) == 1
    assert {(r.node, r.root) for r in found.collect()} == {(i, 0) for i in range(21)} | {(30, 30), (40, 30)}


def alike(base, n, rng):
    """Texts of the words of base, one of them replaced in each."""
    texts = []
    for _ in range(n):
        own = list(base)
        own[rng.randrange(len(own))] = rng.choice(WORDS)
        texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("others", [0, 12])
def test_blocks_of_connected_documents_do_not_meet(spark, monkeypatch, others):
    rng, real, rows = random.Random(7), jaccard_join._links, spark.sparkContext.accumulator(0)

    def counted(*a):
        def run(batches):
            def told():
                for batch in batches:
                    rows.add(batch.num_rows)
                    yield batch

            yield from real(*a)(told())

        return run

    monkeypatch.setattr(jaccard_join, "_links", counted)
    monkeypatch.setattr(jaccard_join, "SHARED", 2, raising=False)
    base = [rng.choice(WORDS) for _ in range(120)]
    texts = alike(base, 80, rng)
    # half of the words are those of the others: one part with them, and no link
    texts += [" ".join(base[:60] + [rng.choice(WORDS) for _ in range(60)]) for _ in range(others)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_join.similar_components(docs, 3, 80, 100, block_docs=10).collect()}
    assert found == {i: 0 for i in range(80)} | {i: i for i in range(80, 80 + others)}
    # in two bands of 8 to 10 blocks each block met each other one before, which is 1280 and 1840 rows
    assert rows.value < (1_000 if others else 600)


def test_blocks_that_do_not_fit_together_take_turns(spark, monkeypatch):
    rng, real, shuffled = random.Random(5), jaccard_join.settle, []

    def settled(rows, name):
        shuffled.append(name)
        return real(rows, name)

    monkeypatch.setattr(jaccard_join, "settle", settled)
    common = [rng.choice(WORDS) for _ in range(60)]
    texts = [" ".join(common + [rng.choice(WORDS) for _ in range(60)]) for _ in range(60)]
    texts += [t + " more" for t in texts[::9]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_join.similar_components(docs, 3, 80, 100, block_docs=10).collect()}
    assert found == {i: i for i in range(60)} | {60 + k: i for k, i in enumerate(range(0, 60, 9))}
    # each of 7 blocks meets each in two bands: 14 times the shingles of all documents, one and a half in a turn
    assert shuffled.count("links") >= 8


def test_known_links_are_not_looked_for_again():
    sets = [np.arange(i, 100 + i, dtype=np.uint64) for i in range(4)]
    every = np.arange(4)
    assert list(jaccard_join.linked_pairs(sets, every, None, 80, 100, np.array([7, 7, 7, 7]))) == []
    assert len(list(jaccard_join.linked_pairs(sets, every, None, 80, 100, np.array([7, 9, 9, 7])))) == 1
    assert len(list(jaccard_join.linked_pairs(sets, every, None, 80, 100))) == 3
