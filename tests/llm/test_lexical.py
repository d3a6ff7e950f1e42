"""Ranked lexical search against a plain count of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from scriptorium.llm import lexical
from scriptorium.llm.lexical import Scanner, blocks, item_terms, ranked

WORDS = ["a", "b", "The", "éa", "x1", "ß", "日本", "w" * 64, "w" * 65, "w" * 64 + "v", "u" * 300] + [f"w{i}" for i in range(40)]


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain_ranking(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_all = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, own in asked.items():
        scored = []
        for d, c in counted:
            m = 100 - 50 + ((50 * sum(c.values()) * n_docs) // n_all)
            weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in own if t in c}
            score = sum(w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t, w in weight.items())
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        scored.sort(key=lambda s: s[:3])
        out += [(i, rank, s[3], -s[0]) for rank, s in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(2)
    docs = [(i if i % 17 else None, rng.choice([" ", ", ", "\n", " - ", "_"]).join(rng.choices(WORDS, k=rng.randint(0, 60)))) for i in range(300)]
    docs += [(5, None), (6, ""), (7, ".. \x00 `"), (9, "b" * 100_000)] + [(8, "a b The x1")] * 60
    items = [(i % 9 if i % 5 else None, " ".join(rng.choices(WORDS, k=rng.randint(0, 12)))) for i in range(30)]
    items += [(50, "zzz"), (51, None), (52, "the, THE!"), (53, "b" * 100_000)]
    made = spark.createDataFrame([(*d, "s", 3) for d in docs], "doc_id long, text string, item_id string, term int").repartition(5)
    return docs, items, made, spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, score int")


@pytest.mark.parametrize("k", [3, 50])
@pytest.mark.parametrize("bounds", [{}, {"pairs": 10}, {"term_bytes": 40}])
def test_ranking_is_that_of_a_plain_count(tables, bounds, k):
    docs, items, made, asked = tables
    found = ranked(made, asked, k, **bounds)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_ranking(docs, items, k)


def test_rows_are_cut_to_the_best_while_a_task_runs(tables, monkeypatch):
    docs, items, made, asked = tables
    monkeypatch.setattr(lexical, "ROWS", 20)
    monkeypatch.setattr(lexical, "CELLS", 60)
    best = lexical.Best(3, 4)
    rng = np.random.default_rng(0)
    scores = rng.integers(0, 6, (500, 3))
    for a in range(0, 500, 7):
        part = scores[a : a + 7]
        best.add(part, np.zeros(len(part), np.int64), np.arange(a, a + len(part))[::-1])
    best.cut()
    ids = np.concatenate([np.arange(a, min(a + 7, 500))[::-1] for a in range(0, 500, 7)])
    for item in range(3):
        expected = sorted((-s, i) for s, i in zip(scores[:, item].tolist(), ids.tolist()) if s > 0)[:4]
        assert [(-r[1], r[3]) for r in best.rows[best.rows[:, 0] == item].tolist()] == expected


def test_blocks_keep_within_their_bounds(spark, tables):
    _, items, _, asked = tables
    own = {}
    for i, t in items:
        own.setdefault(i, set()).update(terms(t))
    made = list(blocks(item_terms(asked), pairs=15))
    assert sorted((i for b in made for i in b.items), key=repr) == sorted((i for i, t in own.items() if t), key=repr)
    assert all(len(b.pairs) <= 15 or len(b.items) == 1 for b in made)
    assert sum(len(b.pairs) for b in made) == sum(map(len, own.values()))


def test_long_texts_are_scanned_in_pieces(monkeypatch):
    monkeypatch.setattr(lexical, "SLICE_BYTES", 50)
    rng = random.Random(3)
    texts = [" ".join(rng.choices(WORDS, k=rng.randint(0, 200))) for _ in range(20)] + ["", None, "a", "v" * 700 + " a"]
    known = ["a", "b", "the", "w1", "w22", "日本", "ß"]
    n_words, text, term, tf = Scanner(known).count(pa.array(texts))
    assert n_words.tolist() == [len(terms(t)) for t in texts]
    counted = {(i, j): Counter(terms(t))[k] for i, t in enumerate(texts) for j, k in enumerate(known) if k in terms(t)}
    assert dict(zip(zip(text.tolist(), term.tolist()), tf.tolist())) == counted


def test_empty_tables(tables):
    _, _, made, asked = tables
    assert ranked(made.limit(0), asked).collect() == []
    assert ranked(made, asked.limit(0)).collect() == []
