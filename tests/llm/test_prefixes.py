"""What the bucket search of sharding sends to the driver."""

import random

from scriptorium.llm import sharding


def test_prefixes_of_shards_meet_in_no_join(spark, tmp_path, monkeypatch):
    plans, real = {}, sharding.settle

    def settled(rows, name):
        plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        return real(rows, name)

    monkeypatch.setattr(sharding, "settle", settled)
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, "x" * rng.randrange(400)) for i in range(500)] + [(7, "y" * 300)] * 9, "doc_id long, text string")
    found = sharding.write_shards(docs, str(tmp_path / "shards"), 1_000).collect()
    assert len(found) == 509
    # the rows of the join would be sent to the driver and to every executor, as its files are small
    assert "Join" not in plans["buckets"]
    # a bucket is the shortest prefix whose rows fit
    hashes = {r["doc_id"]: (format(r["hash"], "060b"), r["n_bytes"]) for r in docs.select("doc_id", *sharding._measures()).distinct().collect() if r["doc_id"] != 7}
    sizes = {}
    for code, n in hashes.values():
        for depth in range(61):
            sizes[code[:depth]] = sizes.get(code[:depth], 0) + n
    for code, n in {(format(r["hash"], "060b"), r["n_bytes"]) for r in docs.filter("doc_id = 7").select(*sharding._measures()).collect()}:
        times = 9 if n == 300 else 1
        for depth in range(61):
            sizes[code[:depth]] = sizes.get(code[:depth], 0) + n * times
    for r in found:
        if r["doc_id"] != 7:
            code = hashes[r["doc_id"]][0]
            assert r["shard"] == next(code[:d] for d in range(61) if sizes[code[:d]] <= 1_000)
