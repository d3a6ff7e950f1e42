"""What the tasks hold of memory, and what they leave in a worker that later stages use."""

import tracemalloc

import numpy as np
import pyarrow as pa

from scriptorium.llm import jaccard_join, worker
from scriptorium.llm.sentencepiece import MODEL, _encoder, load


def texts(n, n_words):
    words = np.random.default_rng(5).integers(0, 10**9, (n, n_words))
    return [" ".join(map(str, row)) for row in words.tolist()]


def passed_on(rows):
    return jaccard_join._keys(5, 80, 100, 10**9, np.zeros(0, np.uint64))(iter([rows]))


def test_keys_are_passed_on_whole_in_small_batches():
    own = texts(150, 3_000)
    alike = [t + " more" for t in own[:20]] + [own[0]]
    rows = pa.RecordBatch.from_arrays([pa.array(range(171), pa.int64()), pa.array(own + alike)], ["doc_id", "text"])
    sets = jaccard_join.shingle_sets(rows.column("text").slice(0, 170), 5)
    which, key = jaccard_join.group_keys(sets, 80, 100)
    least = {}
    for doc, k in zip(which.tolist(), key.tolist()):
        least[k] = min(doc, least.get(k, doc))
    pairs = {(doc, least[k]) for doc, k in zip(which.tolist(), key.tolist()) if doc != least[k]}
    assert len(least) > 2 * 50_000 and pairs >= {(150 + i, i) for i in range(20)}
    found, met = {}, set()
    for batch in passed_on(rows):
        assert batch.num_rows <= 50_000
        for k, a, b in zip(*(batch.column(c).to_pylist() for c in ("key", "a", "b"))):
            if b is None:
                assert found.setdefault(k, a) == a
            else:
                met.add((a, b))
    assert found == least and met == pairs


def test_keys_take_a_small_multiple_of_their_own_size():
    rows = pa.RecordBatch.from_arrays([pa.array(range(1_000), pa.int64()), pa.array(texts(1_000, 3_000))], ["doc_id", "text"])
    list(passed_on(rows.slice(0, 10)))  # tables of powers are made once
    tracemalloc.start()
    n = sum(batch.num_rows for batch in passed_on(rows))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # a key and its document are 16 bytes
    assert n > 1_500_000 and peak < 3 * 16 * n


def test_a_worker_drops_what_another_operator_kept():
    class Held:
        value = load(MODEL)

    encoder = _encoder(Held)
    assert _encoder(Held) is encoder
    rows = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array(["a b c"])], ["doc_id", "text"])
    assert sum(b.num_rows for b in worker.lean(jaccard_join._signatures(2))(iter([rows]))) == 1
    assert not worker._kept
    assert _encoder(Held) is not encoder


def test_workers_of_a_session_drop_what_another_operator_kept(spark):
    def keeps(batches):
        for batch in batches:
            worker.kept("encoder", lambda: 1)
            yield batch

    def tells(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(worker._kept)])], ["id"])

    rows = spark.range(0, 4, 1, 1)
    rows.mapInArrow(keeps, "id long").collect()
    assert [r.id for r in rows.mapInArrow(tells, "id long").collect()] == [1]
    assert [r.id for r in rows.mapInArrow(worker.lean(tells), "id long").collect()] == [0]
