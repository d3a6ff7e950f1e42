"""Token ids packed into rows of fixed width by best-fit decreasing, written as binary matrices.

Texts are encoded; a document longer than the width is split into pieces of that width and a rest, without loss. Pieces are
dealt by hash into shards of about ``SHARD_BYTES`` of text, each of which is packed on its own in one task: longest first,
every piece goes to the row with the least room that still holds it, found by a segment tree over capacities, or to a
new row. Rows are written in blocks:

* ``ids``: the matrix of ``n_rows`` x ``width`` little-endian unsigned numbers, 2 or 4 bytes each, padded;
* ``cu_seqlens``: for each row the cumulative segment lengths from 0, little-endian 4-byte numbers, row after row;
* ``resets``: for each row the offsets at which positions start again from 0, as 4-byte numbers, row after row;
* ``n_segments``: segments of each row, and ``segments``: document and piece of each, in the order of the matrix.

Blocks are rows of a Parquet table, so a task that is lost or repeated leaves nothing behind. Defined cases: null and empty
texts have no pieces and no place. Rows that repeat a doc_id are packed one by one; a null doc_id stays null. Other columns
are not used; an empty table writes an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.sentencepiece import MODEL, _encoder, load
from scriptorium.llm.store import small_batches
from scriptorium.llm.words import slices

WIDTH = 2_048
#: Text of a shard, and rows of a block.
SHARD_BYTES, BLOCK_ROWS = 4_000_000, 256

BLOCK = (
    "shard long, block int, n_rows int, width int, id_bytes int, ids binary, cu_seqlens binary, resets binary, "
    "n_segments array<int>, segments array<struct<doc_id:bigint,piece:int>>"
)
_SEGMENT = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32())])


class Rooms:
    """Rows by the room they have left; a segment tree finds the least room that is large enough."""

    def __init__(self, width: int):
        self.size = 1
        while self.size <= width:
            self.size *= 2
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]
        self.tree = [0] * (2 * self.size)  # number of rows below each node

    def _add(self, room: int, change: int) -> None:
        node = room + self.size
        while node:
            self.tree[node] += change
            node //= 2

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, needed: int) -> tuple[int, int] | None:
        """A row with the least room of at least ``needed``, and that room."""
        node = needed + self.size
        while not self.tree[node]:  # up to the next subtree on the right that holds any
            while node & 1:
                node //= 2
            if not node:
                return None
            node += 1
        while node < self.size:
            node *= 2
            if not self.tree[node]:
                node += 1
        room = node - self.size
        self._add(room, -1)
        return self.rows[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and offset of each length, and the number of rows."""
    row, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms, n = Rooms(width), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        found = rooms.take(length) if length < width else None
        if found is None:
            found, n = (n, width), n + 1
        row[i], offset[i] = found[0], width - found[1]
        if found[1] > length:
            rooms.put(found[1] - length, found[0])
    return row, offset, n


def _pieces(held, width: int, id_type: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(held)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, first = encoder.encode(part.column("text"))
                places, pieces, found = [], [], []
                for i, (a, b) in enumerate(zip(first.tolist(), first[1:].tolist())):
                    for piece, start in enumerate(range(a, b, width)):
                        places.append(i), pieces.append(piece)
                        found.append(ids[start : min(b, start + width)].astype(id_type).tobytes())
                at = pa.array(places, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("place").take(at), part.column("doc_id").take(at), pa.array(pieces, pa.int32()), pa.array(found, pa.binary())],
                    ["place", "doc_id", "piece", "ids"],
                )

    return run


def _packed(width: int, id_type: str, pad: int, block_rows: int):
    size = np.dtype(id_type).itemsize

    def blocks(shard: int, docs: list, pieces: list, found: list) -> Iterator[dict]:
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // size
        row, offset, n = best_fit_decreasing(lengths, width)
        order = np.lexsort((offset, row))
        cuts = np.searchsorted(row[order], np.arange(0, n + block_rows, block_rows)).tolist()
        for block, (a, b) in enumerate(zip(cuts, cuts[1:])):
            first = block * block_rows
            rows = min(block_rows, n - first)
            matrix = np.full((rows, width), pad, id_type)
            ends: list[list[int]] = [[0] for _ in range(rows)]
            for i in order[a:b].tolist():
                r, o, l = int(row[i]) - first, int(offset[i]), int(lengths[i])
                matrix[r, o : o + l] = np.frombuffer(found[i], id_type)
                ends[r].append(o + l)
            yield {
                "shard": shard, "block": block, "n_rows": rows, "width": width, "id_bytes": size, "ids": matrix.tobytes(),
                "cu_seqlens": np.array([x for e in ends for x in e], "<u4").tobytes(),
                "resets": np.array([x for e in ends for x in e[:-1]], "<u4").tobytes(),
                "n_segments": [len(e) - 1 for e in ends],
                "segments": [{"doc_id": docs[i], "piece": pieces[i]} for i in order[a:b].tolist()],
            }

    def batch_of(made: dict) -> pa.RecordBatch:
        kinds = [pa.int64(), *[pa.int32()] * 4, *[pa.binary()] * 3, pa.list_(pa.int32()), pa.list_(_SEGMENT)]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(made.values(), kinds)], list(made))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, docs, pieces, found = None, [], [], []
        for batch in batches:
            for shard, doc, piece, ids in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "piece", "ids"))):
                if shard != last and found:
                    yield from map(batch_of, blocks(last, docs, pieces, found))
                    docs, pieces, found = [], [], []
                last = shard
                docs.append(doc), pieces.append(piece), found.append(ids)
        if found:
            yield from map(batch_of, blocks(last, docs, pieces, found))

    return run


def pack(docs: DataFrame, model: str = MODEL, width: int = WIDTH, shard_bytes: int = SHARD_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of packed ids of all texts (see above); write them as they come."""
    small_batches(docs.sparkSession)
    loaded = load(model)
    id_type, pad = ("<u2" if len(loaded.pieces) <= 1 << 16 else "<u4"), loaded.unknown
    held = docs.sparkSession.sparkContext.broadcast(loaded)  # as large as the vocabulary, whatever the input
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_bytes))
    rows = docs.select(F.monotonically_increasing_id().alias("place"), "doc_id", "text")
    pieces = rows.mapInArrow(_pieces(held, width, id_type), "place long, doc_id long, piece int, ids binary")
    # dealt by place, so that rows with the same id are spread as well
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("place", "piece"), F.lit(shards)))
    ordered = dealt.repartition("shard").sortWithinPartitions("shard", "place", "piece")
    return ordered.mapInArrow(_packed(width, id_type, pad, block_rows), BLOCK)


def segments(blocks: DataFrame) -> DataFrame:
    """(doc_id, piece, shard, block, row, start, length, ids_sha256) of every segment, read from the matrices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                matrix = np.frombuffer(block["ids"], f"<u{block['id_bytes']}").reshape(block["n_rows"], block["width"])
                ends, resets = np.frombuffer(block["cu_seqlens"], "<u4").tolist(), np.frombuffer(block["resets"], "<u4").tolist()
                at, named, out = 0, iter(block["segments"]), []
                starts = iter(resets)
                for r, n in enumerate(block["n_segments"]):
                    for end in ends[at + 1 : at + n + 1]:
                        segment, start = next(named), next(starts)
                        ids = matrix[r, start:end].astype("<u4")
                        out.append((segment["doc_id"], segment["piece"], r, start, end - start, hashlib.sha256(ids.tobytes()).hexdigest()))
                    at += n + 1
                columns = list(zip(*out)) or [[]] * 6
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string())
                made = [pa.array(c, k) for c, k in zip(columns, kinds)]
                made[2:2] = [pa.array([block["shard"]] * len(out), pa.int64()), pa.array([block["block"]] * len(out), pa.int32())]
                yield pa.RecordBatch.from_arrays(made, ["doc_id", "piece", "shard", "block", "row", "start", "length", "ids_sha256"])

    return blocks.mapInArrow(run, "doc_id long, piece int, shard long, block int, row int, start int, length int, ids_sha256 string")
