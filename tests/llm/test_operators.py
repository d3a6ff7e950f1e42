"""The operators against brute force on small tables with nulls, ties, repeats, empty and long texts."""

import glob
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import zstandard
from pyspark.sql import functions as F

from scriptorium.llm import nearest as nearest_module
from scriptorium.llm import packing, queries, toxicity, warc
from scriptorium.llm.decontaminate import contamination, searched
from scriptorium.llm.jaccard_join import similar_components
from scriptorium.llm.nearest import nearest
from scriptorium.llm.perspectives import perspectives
from scriptorium.llm.sentencepiece import MODEL, Encoder, Model, encode_decode, load
from scriptorium.llm.sharding import assign_shards, write_shards
from scriptorium.llm.store import settle
from scriptorium.llm.substring_dedup import FMIndex, first_places, remove_repeats

DOCS = "doc_id long, text string, n_words long, kept string, anchors int"  # the last three clash with names made inside


def documents(spark, n=60, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [rng.choice(words) for _ in range(40)]
    base = [rng.choice(words) for _ in range(120)]
    texts = [None, "", "  \n ", "one two", "one two", "One TWO", "x " * 700, "é " * 50 + "Éa"]
    for i in range(n):
        own = [rng.choice(words) for _ in range(rng.randint(1, 150))]
        if i % 4 == 0:
            own[len(own) // 2 : len(own) // 2] = passage
        if i % 5 == 0:
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = rng.choice(words)
        texts.append((" " if i % 3 else "\n\t").join(own))
    return spark.createDataFrame([(i, t, 7, "k", 1) for i, t in enumerate(texts)], DOCS)


def words_of(text, lower=False):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


# --- similarity ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("shingle, level, block", [(3, 90, 6000), (5, 80, 6000), (3, 60, 3)])
def test_components_are_those_of_all_pairs(spark, shingle, level, block):
    docs = documents(spark)
    sets = {}
    for r in docs.collect():
        w = words_of(r.text, True)
        runs = [tuple(w)] if 0 < len(w) < shingle else [tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)]
        sets[r.doc_id] = set(runs)
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= level * (len(sets[a]) + len(sets[b]) - both) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    found = similar_components(docs, shingle, level, 100, block_docs=block, combine_keys=500).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {i: (len(sets[i]), root[i]) for i in sets}


def test_components_of_an_empty_table_and_without_ids(spark):
    empty = documents(spark).limit(0)
    assert similar_components(empty).collect() == []
    nameless = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (1, "a b c")], "doc_id long, text string")
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in similar_components(nameless, shingle=2).collect()]
    assert sorted(found, key=repr) == [(1, 2, 1), (1, 2, 1), (None, 2, None)]


@pytest.mark.parametrize("level", [40, 60, 66, 75])
def test_a_set_within_a_much_larger_one_is_linked(spark, level):
    """The larger set of a link may be several bands of sizes above the smaller."""
    rows = []
    for n, size in enumerate((205, 60, 333, 47)):
        words = [f"w{n}_{i}" for i in range(size * 100 // level)]
        rows += [(10 * n + 1, " ".join(words[:size])), (10 * n + 2, " ".join(words)), (10 * n + 3, " ".join(words[: size // 3]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in similar_components(docs, 1, level, 100).collect()}
    assert found == {i: i - (i % 10 == 2) for i, _ in rows}


# --- substring dedup ----------------------------------------------------------------------------------


def removed(rows, window):
    """Flags of the words to remove, by document."""
    seen, gone = set(), {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        w = words_of(r.text)
        gone[r.doc_id] = [False] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if key in seen:
                gone[r.doc_id][i : i + window] = [True] * window
            seen.add(key)
    return gone


@pytest.mark.parametrize("window, gram, hot, shard", [(20, 8, 20_000, 400_000), (6, 3, 2, 50), (4, 4, 10**9, 30)])
def test_repeats_are_those_of_all_windows(spark, window, gram, hot, shard):
    docs = documents(spark)
    expected = removed(docs.collect(), window)
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = remove_repeats(docs, window, gram, hot, shard, keep=tuple(docs.columns)).collect()
    assert len(found) == len(texts)
    for r in found:
        kept = [w for w, g in zip(words_of(texts[r.row.doc_id]), expected[r.row.doc_id]) if not g]
        assert r.n_removed == sum(expected[r.row.doc_id])
        assert r.kept_text == (" ".join(kept) if r.n_removed else texts[r.row.doc_id])
        assert (r.row.n_words, r.row.kept, r.row.anchors) == (7, "k", 1)


def test_first_places_of_repetitive_text():
    rng = np.random.default_rng(0)
    for window in (2, 3, 5):
        text = np.concatenate([np.append(rng.integers(1, 3, rng.integers(window, 12)), 0) for _ in range(9)])
        runs = [tuple(text[i : i + window]) for i in range(len(text) - window + 1)]
        expected = [i for i, r in enumerate(runs) if 0 not in r and runs.index(r) == i]
        assert first_places(text, window).tolist() == expected


def test_index_is_compressed_and_finds_shorter_matches():
    rng = np.random.default_rng(1)
    text = np.append(rng.integers(1, 4, 5_000), 0).astype(np.int32)
    index = FMIndex(text, 4)
    bits = [b for b, _ in index.levels] + [index.opens]
    held = index.places.nbytes + index.edges.nbytes + sum(b.packed.nbytes + b.before.nbytes for b in bits)
    assert held < 9 * len(text)
    shares = [tuple(np.append(text, [0] * 3)[p : p + 3]) for p in index.places.tolist()]
    low, high = index.shorter(np.arange(len(text)))
    for row in range(0, len(text), 97):
        same = [i for i, s in enumerate(shares) if s == shares[row]]
        assert (low[row], high[row]) == (same[0], same[-1] + 1)


def test_rows_without_id_and_hot_anchors_do_not_meet_in_a_join(spark):
    line = " ".join(f"w{i}" for i in range(30))
    rows = spark.createDataFrame([(None, line)] * 5 + [(i, f"{i} {line}") for i in range(9)], "doc_id long, text string")
    found = remove_repeats(rows, hot_anchor=3).collect()
    assert sorted((r.row.doc_id is None, r.row.doc_id or 0, r.n_removed) for r in found) == [
        (False, 0, 0), *[(False, i, 30) for i in range(1, 9)], *[(True, 0, 0)] * 5
    ]


def test_repeats_without_rows_or_ids(spark):
    assert remove_repeats(documents(spark).limit(0)).collect() == []
    rows = spark.createDataFrame([(None, "a " * 30), (1, "a " * 30)], "doc_id long, text string")
    assert {r.row.doc_id: r.n_removed for r in remove_repeats(rows).collect()} == {None: 0, 1: 29}


# --- decontamination ----------------------------------------------------------------------------------


def test_contamination_is_that_of_all_windows(spark):
    docs = documents(spark)
    text = {r.doc_id: r.text for r in docs.collect()}
    body = text[8].split()
    items = [(1, " ".join(body[:30])), (2, "One two"), (3, None), (4, "zz"), (5, "; ".join(body[:30])), (6, "w1 w2 w3")]
    bench = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, doc_id string")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    for r in contamination(docs, bench).collect():
        w, hit, ids = split(text[r.doc_id]), set(), set()
        for item, t in items:
            v = split(t)
            n = min(10, len(v))
            for i in range(len(v) - n + 1) if n else ():
                for s in range(len(w) - n + 1):
                    if w[s : s + n] == v[i : i + n]:
                        hit |= set(range(s, s + n))
                        ids.add(item)
        assert (r.n_words, r.n_hit, r.items or []) == (len(w), len(hit), sorted(ids))


def test_empty_benchmark_leaves_all_clean(spark):
    found = contamination(documents(spark), spark.createDataFrame([], "item_id long, text string")).collect()
    assert {r.n_hit for r in found} == {0}


def test_documents_and_items_without_id_are_searched(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    docs = [(None, f"a {passage} b"), (None, "clean words only"), (None, None), (7, "clean words only"), (7, f"{passage} end"), (8, "x y z")]
    bench = spark.createDataFrame([(3, passage), (None, passage), (None, "x y z")], "item_id long, text string")
    found = searched(spark.createDataFrame(docs, "doc_id long, text string"), bench, keep=("doc_id", "text")).collect()
    held = {tuple(r.row): (r.n_hit, r.items or []) for r in found}
    assert len(found) == len(docs)
    assert held == dict(zip(docs, [(12, [3]), (0, []), (0, []), (0, []), (12, [3]), (3, [])]))


# --- tokens -------------------------------------------------------------------------------------------

HARD = [
    "", None, " ", "Hello  world\n x\tñ 🙂  ", "a▁b", " " * 54 + "x", "日本語" * 99, "ab" * 400, "\0<s></s>", " 🙂🙂 x"
]


def mixed(n):
    rng = random.Random(5)
    return ["".join(rng.choice("abetnsio  \n.é🙂▁你") for _ in range(rng.randint(1, 60))) for _ in range(n)]


def test_bpe_ids_and_texts_are_those_of_the_library():
    library, encoder = sentencepiece.SentencePieceProcessor(model_file=MODEL), Encoder(load(MODEL))
    texts = HARD + mixed(1500)
    ids, first = encoder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        own = ids[first[i] : first[i + 1]]
        assert own.tolist() == library.encode(text or "")
        assert encoder.decode(own) == library.decode(own.tolist())


def field(number, value):
    if isinstance(value, int):
        return bytes([number << 3, value])
    return bytes([number << 3 | 2, len(value)]) + value


def test_unigram_ids_are_those_of_the_library():
    rng = random.Random(1)
    pieces = {"<unk>": (0.0, 2), "<s>": (0.0, 3), "</s>": (0.0, 3)}
    while len(pieces) < 120:
        piece = rng.choice(["", "▁"]) + "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4)))
        pieces.setdefault(piece, (-rng.randint(10, 900) / 64, 1))
    body = b""
    for piece, (score, kind) in pieces.items():
        body += field(1, field(1, piece.encode()) + b"\x15" + np.float32(score).tobytes() + field(3, kind))
    data = body + field(2, field(3, 1)) + field(3, field(1, b"identity") + field(3, 1) + field(4, 0) + field(5, 1))
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    encoder = Encoder(Model(data))
    texts = ["".join(rng.choice("abcdé z") for _ in range(rng.randint(0, 25))) for _ in range(800)]
    ids, first = encoder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == library.encode(texts)


def test_round_trip_of_a_table(spark):
    rows = spark.createDataFrame([(i, t, 5) for i, t in enumerate(HARD)], "doc_id long, text string, ids int")
    found = {r.row.doc_id: r for r in encode_decode(rows, keep=("doc_id", "ids")).collect()}
    for i, text in enumerate(HARD):
        assert found[i].decoded == (text or "").replace("▁", " ") and found[i].row.ids == 5
        assert found[i].n_tokens == len(found[i].ids)
    assert encode_decode(rows.limit(0)).collect() == []


def test_best_fit_puts_each_piece_into_the_fullest_row_that_holds_it():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 65, 500)
    row, offset, n = packing.best_fit_decreasing(lengths, 64)
    room = []
    for length in sorted(lengths.tolist(), reverse=True):
        fits = [r for r in room if r >= length]
        if fits:
            room.remove(min(fits))
        else:
            fits = [64]
        if min(fits) > length:
            room.append(min(fits) - length)
        else:
            room.append(0)
    assert n == len(room)
    used = np.zeros((n, 64), int)
    for r, o, x in zip(row, offset, lengths):
        used[r, o : o + x] += 1
    assert used.max() == 1


def test_units_met_often_stay_remembered(monkeypatch):
    model, plain, met = load(MODEL), load(MODEL), []
    monkeypatch.setattr("scriptorium.llm.sentencepiece.REMEMBERED", 50)
    encoded = model.encode_units
    monkeypatch.setattr(model, "encode_units", lambda units: met.extend(units) or encoded(units))
    encoder = Encoder(model)
    for i in range(12):
        texts = pa.array([f"the same words come again, rare{i}x{j} wörd{chr(0x4E00 + 20 * i + j)}" for j in range(20)] + [None, ""])
        ids, first = encoder.encode(texts)
        fresh, starts = Encoder(plain).encode(texts)
        assert ids.tolist() == fresh.tolist() and first.tolist() == starts.tolist()
    assert met.count("▁same") == met.count("▁again") == 1


def test_ids_of_long_units_are_bounded_as_well(monkeypatch):
    monkeypatch.setattr("scriptorium.llm.sentencepiece.REMEMBERED", 50)
    model = load(MODEL)
    encoder = Encoder(model)
    for i in range(30):
        texts = pa.array(["ab" * (300 + i)])
        ids, _ = encoder.encode(texts)
        assert ids.tolist() == Encoder(model).encode(texts)[0].tolist() and len(ids) > 200
        assert len(encoder.flat) < 2000


def test_packed_pieces_give_the_ids_back(spark):
    docs = documents(spark).select("doc_id", "text")
    blocks = settle(packing.pack(docs, width=64, shard_bytes=3000, block_rows=3), "packed").collect()
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = {}
    for b in blocks:
        matrix = np.frombuffer(bytes(b.ids), "<u2").reshape(b.n_rows, 64)
        ends, named = np.frombuffer(bytes(b.cu_seqlens), "<u4").tolist(), iter(b.segments)
        resets = iter(np.frombuffer(bytes(b.resets), "<u4").tolist())
        for r, n in enumerate(b.n_segments):
            own, ends = ends[: n + 1], ends[n + 1 :]
            for start, end in zip(own, own[1:]):
                s = next(named)
                assert next(resets) == start
                found[s.doc_id, s.piece] = matrix[r, start:end].tolist()
    for r in docs.collect():
        ids = library.encode(r.text or "")
        pieces = [found.pop((r.doc_id, i)) for i in range(-(-len(ids) // 64))]
        assert sum(pieces, []) == ids
    assert not found


# --- shards, chats, archives --------------------------------------------------------------------------


def test_no_shard_is_too_large(spark, tmp_path):
    docs = documents(spark).union(spark.createDataFrame([(5, "same " * 40, 1, "", 1)] * 30, DOCS))
    found = write_shards(docs, str(tmp_path / "shards"), 1000).collect()
    assert len(found) == docs.count()
    sizes = {}
    for r in found:
        sizes.setdefault((r["shard"], r["copy"]), []).append(r["n_bytes"])
        assert r["shard_bytes"] == sum(x["n_bytes"] for x in found if (x["shard"], x["copy"]) == (r["shard"], r["copy"]))
    assert all(sum(s) <= 1000 or len(s) == 1 for s in sizes.values())
    names = {s for s, _ in sizes}
    assert not any(a != b and b.startswith(a) for a in names for b in names)
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(found)
    assert assign_shards(docs.limit(0), 10).collect() == []
    assert {r["shard"] for r in assign_shards(docs, 10**9).collect()} == {""}


def test_shards_hold_their_rows_in_whatever_order_the_input_is_read(spark, tmp_path):
    rows = documents(spark).union(spark.createDataFrame([(5, "same " * 40, 1, "", 1)] * 30 + [(None, None, 1, "", 1)], DOCS))
    # another order at every read, as of an input that is split differently
    dealt = F.udf(lambda: random.SystemRandom().randrange(10**6), "int").asNondeterministic()
    found = write_shards(rows.repartition(5, dealt()), str(tmp_path / "shards"), 1000)
    written = spark.read.parquet(str(tmp_path / "shards")).collect()
    assert sorted(tuple(r)[:5] for r in written if r.doc_id is not None) == sorted(tuple(r) for r in rows.collect() if r.doc_id is not None)
    assert sum(r.doc_id is None for r in written) == rows.filter("doc_id is null").count()
    sizes = {}
    for r in written:
        body = hashlib.md5((r.text or "").encode()).hexdigest()
        spelled = f"{'null' if r.doc_id is None else r.doc_id}:{body}"
        bits = f"{int(hashlib.md5(spelled.encode()).hexdigest()[:15], 16):060b}"
        shard, copy = r._shard[1:].split("-")
        assert bits.startswith(shard)
        sizes.setdefault((shard, int(copy)), []).append(len((r.text or "").encode()))
    assert all(sum(s) <= 1000 or len(s) == 1 for s in sizes.values())
    told = {(r.shard, r.copy): r.shard_bytes for r in found.collect()}
    assert told == {name: sum(s) for name, s in sizes.items()}


def test_tables_of_prefixes_are_written_by_few_tasks(spark, tmp_path):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat(cast(id as string), 5) as text")
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    files = lambda: {f for name in ("fine", "buckets", "large", "sizes") for f in glob.glob(f"{shared}/{name}-*/part-*")}
    changed = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, held = {k: spark.conf.get(k) for k in changed}, files()
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        found = write_shards(docs, str(tmp_path / "shards"), 1000).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(found) == 3000 and max(r["shard_bytes"] for r in found) <= 1000
    assert len(files() - held) <= 16  # a process is started for each file on a local disk


def test_the_sharding_query_writes_its_shards(spark):
    made = lambda: set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir').removeprefix('file:')}/**/_shard=b*", recursive=True))
    held = made()
    found = {(r.shard, r.copy) for r in queries.op4_sharding(spark, "/root/testdata/sf0.001").collect()}
    assert {f"_shard=b{s}-{c}" for s, c in found} == {path.rsplit("/", 1)[1] for path in made() - held}


def test_every_speaker_gets_the_whole_dialogue(spark):
    rows = [(1, i, r, f"t{i}") for i, r in enumerate(["system", "ann", "bob", "ann", None])]
    rows += [(1, 1, "ann", "t1"), (1, None, "bob", None), (1, 40, "ann", "late"), (2, 0, "system", "alone")]
    turns = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, part int")
    found = perspectives(turns, piece_rows=2).orderBy("part", "piece").collect()
    assert {r.participant for r in found} == {"ann", "bob"} and {r.conv_id for r in found} == {1}
    ann = [r for r in found if r.participant == "ann" and r.part is not None]
    whole = "".join(r.text for r in ann)
    head = "<|im_start|>{}\n{}<|im_end|>\n".format
    assert whole == "".join(
        [head("system", "t0"), head("assistant", "t1"), head("user name=bob", "t2"), head("assistant", "t3"),
         head("user name=unknown", "t4"), head("assistant", "late")]
    )
    assert [r.text[s.start : s.end] for r in ann for s in r.spans] == ["t1", "t3", "late"]


def test_pieces_hold_consecutive_turns_up_to_the_bound(spark):
    kind = "conv_id long, turn long, role string, text string"
    shown = lambda found: sorted((r.participant, r.part, r.piece, r.n_turns, r.text) for r in found.collect())
    rows = [(1, i, ("ann", "bob")[i % 2], f"t{i}") for i in range(8)]
    once = shown(perspectives(spark.createDataFrame(rows, kind)))
    assert [x[:4] for x in once] == [("ann", 0, 0, 8), ("bob", 0, 0, 8)]
    assert shown(perspectives(spark.createDataFrame(rows * 33, kind))) == once
    # more different turns than fit: full pieces, in the order of turn, role and text
    rows += [(1, 3, "cid", f"x{i:03}") for i in range(40)] + [(None, None, None, "alone"), (1, None, "ann", None)]
    mixed = spark.createDataFrame(rows * 2, kind).repartition(7)
    found = [r for r in perspectives(mixed, piece_rows=10).collect() if r.participant == "ann" and r.part == 0]
    found.sort(key=lambda r: r.piece)
    assert [(r.piece, r.n_turns) for r in found] == [(0, 10), (1, 10), (2, 10), (3, 10), (4, 8)]
    texts = [line for r in found for line in r.text.replace("<|im_end|>", "").split("\n")[1::2]]
    assert texts == ["t0", "t1", "t2", "t3", *[f"x{i:03}" for i in range(40)], "t4", "t5", "t6", "t7"]


def test_archives_give_the_pages_back(spark, tmp_path):
    pages = [(i, f"http://a/{i}\r\n x", "<p>é</p>" * (i % 7)) for i in range(40)] + [(50, None, None), (50, None, None)]
    rows = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, refers_to string")
    archives = warc.write_archives(rows, f"file://{tmp_path}/w", archive_bytes=2000)
    found = warc.read_archives(archives).collect()
    assert sorted(r.page_id for r in found) == sorted(p[0] for p in pages)
    kept = {}
    for page, _, html in pages:
        kept[html or ""] = max(page, kept.get(html or "", 0))
    for r in found:
        html = next(p[2] or "" for p in pages if p[0] == r.page_id)
        assert r.payload_digest == warc.digest(html.encode()) and r.payload_bytes == len(html.encode())
        first = kept[html] == r.page_id
        assert (r.record_type, r.refers_to) == (("response", None) if first else ("revisit", kept[html]))
        assert r.payload is None or bytes(r.payload) == html.encode()
    assert warc.read_archives(warc.write_archives(rows.limit(0), f"file://{tmp_path}/e")).collect() == []


def test_broken_records_and_archives_are_refused(tmp_path):
    good = warc.record(1, "http://a", b"body", None, "1970-01-01T00:00:00Z")
    assert warc.parse(good)["payload"] == b"body"
    for bad in (good[:-1], good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"body", b"bodx"), good.replace(b"WARC-Date: ", b"X: ")):
        with pytest.raises(warc.BadArchive):
            warc.parse(bad)
    path = tmp_path / "x.warc.zst"
    path.write_bytes(zstandard.compress(good))
    with pytest.raises(warc.BadArchive, match="dictionary"):
        list(warc.read_archive(f"file://{path}"))


# --- vectors and scores -------------------------------------------------------------------------------


def test_nearest_has_nine_of_ten_true_neighbours(spark):
    rng = np.random.default_rng(4)
    rows = rng.standard_normal((1500, 16)) + 2 * rng.standard_normal((12, 16))[rng.integers(0, 12, 1500)]
    data = [(i, r.tolist(), 1.0) for i, r in enumerate(rows)]
    data += [(2000, None, 1.0), (2020, [0.0] * 16, 1.0), (2040, [float("nan")] * 16, 1.0), (2060, [None] * 16, 1.0), (40, data[40][1], 1.0)]
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>, score double")
    found = nearest(table, table.filter("vec_id % 20 = 0"), k=10, block=200).collect()
    scores = rows[::20] @ rows.T
    hits = 0
    for q, row in zip(range(0, 1500, 20), scores):
        row[q] = -np.inf
        best = np.lexsort((np.arange(1500), -row))[:10].tolist()
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 11))
        assert all(abs(r.score - row[r.vec_id]) < 1e-9 for r in own)
        hits += len(set(best) & {r.vec_id for r in own})
    assert hits >= 0.9 * 10 * 75 and {r.query_id for r in found} == set(range(0, 1500, 20))
    assert nearest(table.limit(0), table).collect() == []
    three = table.filter("vec_id < 3")
    assert nearest(three, three).count() == 6


def test_toxicity_learns_and_scores_all_texts(spark):
    rng = random.Random(6)
    plain = [f"word{i}" for i in range(80)]
    rows = [(i, " ".join(rng.choice(plain) for _ in range(30)) + (" you idiot scum" if i % 5 == 0 else "")) for i in range(600)]
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0), 1) for i in range(600)] + [(901, None, 0)], "doc_id long, toxic int, score int")
    found = {r.row.doc_id: r.score for r in toxicity.Model(docs, labels).score(docs).collect()}
    assert len(found) == 603 and all(0 <= s <= 1 for s in found.values())
    wrong = [i for i in range(600) if (found[i] >= 0.7) != (i % 5 == 0)]
    assert len(wrong) < 12 and found[900] < 0.7
    none = toxicity.Model(docs, labels.limit(0)).score(docs)
    assert {r.score for r in none.collect()} == {0.0}


def test_rows_that_teach_toxicity_are_written_by_few_tasks(spark):
    told = " you idiot", *[" and more"] * 4
    docs = spark.createDataFrame([(i, f"word{i % 7}{told[i % 5]}") for i in range(1200)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 5 = 0 as int) as toxic")
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    files = lambda: set(glob.glob(f"{shared}/taught-*/part-*"))
    changed = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, held = {k: spark.conf.get(k) for k in changed}, files()
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        toxicity.Model(docs, labels)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    made = sorted(files() - held)
    taught = spark.read.parquet(*made)
    assert taught.count() == labels.filter("crc32(cast(doc_id as string)) % 3 <> 1").count() and taught.filter("text is null").isEmpty()
    assert len(made) <= 12  # processes are started for each file on a local disk


def test_vectors_of_every_length_are_searched(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8 if i % 3 else 5).tolist()) for i in range(300)] + [(999, [1.0] * 400)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest(vectors, vectors.filter("vec_id % 10 = 0 or vec_id = 999"), k=3, confidence=0.9999).collect()
    shown, held = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found}, dict(rows)
    right = 0
    for q in range(0, 300, 10):
        best = sorted((-float(np.dot(held[q], v)), i) for i, v in rows if i != q and len(v) == len(held[q]))[:3]
        for rank, (score, i) in enumerate(best, 1):
            right += shown[q, rank] == (i, pytest.approx(-score))
    assert len(found) == 90 and right >= 81


def test_a_block_goes_to_the_turns_that_ask_it_only(spark, monkeypatch):
    monkeypatch.setattr(nearest_module, "QUERIES", 7)
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((400, 6)))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = vectors.filter("vec_id % 20 = 0")
    few, whole = (nearest(vectors, asked, k=5, confidence=0.9999, block=b).collect() for b in (50, 8_192))
    # the same neighbours, whatever the blocks and turns; at most a few are missed
    assert len(few) == len(whole) == 100
    assert len({(r.query_id, r.vec_id) for r in few} & {(r.query_id, r.vec_id) for r in whole}) >= 95


def test_repeated_rows_take_one_place_among_the_neighbours(spark):
    rng = np.random.default_rng(8)
    rows = rng.standard_normal((300, 8))
    data = [(i, r.tolist()) for i, r in enumerate(rows)]
    near = int(np.argsort(-(rows @ rows[0]))[:2].max())  # the best of query 0 that is not itself
    kind = "vec_id long, embedding array<double>"
    once = spark.createDataFrame(data, kind)
    asked = once.filter("vec_id % 20 = 0")
    expected = sorted(nearest(once, asked, k=10).collect())
    # a worse row of an id counts no more than an equal one
    for more in (data, [data[near]] * 30, [(near, (rows[near] * 0.99).tolist())] * 30):
        found = nearest(spark.createDataFrame(data + more, kind), asked, k=10).collect()
        assert {(r.query_id, r.rank) for r in found} == {(q, n) for q in range(0, 300, 20) for n in range(1, 11)}
        same = sum((a.query_id, a.rank, a.vec_id) == (b.query_id, b.rank, b.vec_id) for a, b in zip(sorted(found), expected))
        assert same >= 0.95 * len(expected)
