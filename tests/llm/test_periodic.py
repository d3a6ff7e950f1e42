"""Lyndon lengths, runs and the registered query against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptorium.llm import queries
from scriptorium.llm.runs import find_runs, lyndon_lengths, runs


def plain_lyndon(s):
    """Up to the next smaller suffix."""
    return [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i for i in range(len(s))]


def plain_runs(s, least=6, powers=4):
    found = []
    for q in range(1, len(s) // powers + 1):
        i = 0
        while i + q < len(s):
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            body = s[i : j + q]
            if len(body) >= max(least, powers * q) and not any(body[r:] == body[:-r] for r in range(1, q)):
                found.append((i, len(body), q))
            i = j
    return sorted(found)


def plain_collapse(s, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(s) if i not in gone)


def repetitive(rng, size):
    s = []
    while len(s) < size:
        if rng.random() < 0.5:
            s += [rng.randrange(4) for _ in range(rng.randint(0, 9))]
        else:
            base = [rng.randrange(3) for _ in range(rng.randint(1, 7))]
            s += (base * 9)[: rng.randint(1, 40)]
    return s


def fibonacci_word(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def test_lyndon_lengths_are_those_of_all_suffixes():
    rng = random.Random(1)
    words = [repetitive(rng, rng.randint(1, 60)) for _ in range(300)] + [[0] * 50, fibonacci_word(150), thue_morse(128), [5]]
    for s in words:
        for ordered in (s, [-x for x in s]):
            ranks = np.unique(ordered, return_inverse=True)[1]
            assert lyndon_lengths(ranks).tolist() == plain_lyndon(ordered)


@pytest.mark.parametrize("least, powers", [(6, 4), (2, 2), (9, 3)])
def test_runs_are_those_of_all_periods(least, powers):
    rng = random.Random(least)
    for _ in range(150):
        texts = [repetitive(rng, rng.randint(0, 70)) for _ in range(rng.randint(1, 4))]
        texts.append(rng.choice([[], fibonacci_word(89), thue_morse(64), [7] * 40]))
        first = np.cumsum([0, *map(len, texts)])
        code = np.array([x for s in texts for x in s], np.uint64)
        expected = [(a + int(f), n, q) for f, s in zip(first, texts) for a, n, q in plain_runs(s, least, powers)]
        assert [tuple(r) for r in find_runs(code, first, least, powers).tolist()] == sorted(expected)


def texts():
    rng = random.Random(4)
    made = [None, "", " \n\t", "a a a a a", "a a a a a a", "A a " * 9, "x\ty\nz\x0b" * 30, "é é é é " * 7, "w " * 1_500]
    made += [" ".join(f"w{x}" for x in repetitive(rng, rng.randint(1, 200))) for _ in range(60)]
    made += [" ".join(f"u{rng.randrange(50)}" for _ in range(rng.randint(1, 90))) for _ in range(60)]
    return made


def test_operator_on_nulls_repeats_and_clashing_columns(spark):
    rows = [(i if i % 7 else None, t, "kept", 5) for i, t in enumerate(texts())] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int").repartition(3)
    found = runs(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        s = re.findall(r"[^\x20\x09-\x0D]+", r.row.text or "")
        expected = plain_runs(s)
        assert (r.n_words, [tuple(x) for x in r.runs], r.collapsed) == (len(s), expected, plain_collapse(s, expected))
        assert (r.row.runs, r.row.n_words) == ("kept", 5)
    assert runs(docs.limit(0)).collect() == []


def test_query_on_planted_periods(spark, tmp_path):
    """Every column of the query, by a plain reading of its contract."""
    rows = list(enumerate(texts() * 3)) + [(None, "q " * 8), (10, "again " * 6), (10, "again " * 6)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for doc_id, text in rows:
        s = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = len(s)
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            s = [s[i] if i < a else s[a + (i - a) % p] for i in range(n)]
        found = plain_runs(s)
        a, n, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        digests = (hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{x},{y},{z}\n" for x, y, z in found), plain_collapse(s, found)))
        expected.append((doc_id, len(found), a, n, q, n and 1000 * n // q, *digests))
    query = queries.op11_runs(spark, str(tmp_path))
    assert query.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert [t for _, t in query.dtypes] == ["bigint"] * 6 + ["string"] * 2
    assert sorted(map(tuple, query.collect()), key=repr) == sorted(expected, key=repr)
    assert sum(r[1] > 0 for r in expected) > 30
    assert spark.read.parquet(f"{tmp_path}/documents.parquet").filter(F.crc32(F.col("doc_id").cast("string")) % 10 == 0).count() > 5
