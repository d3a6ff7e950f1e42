"""Substring dedup: words of passages that start earlier in the corpus are removed.

A window is ``window`` consecutive words of one document. Every word covered by a window whose word
sequence also starts earlier (smaller doc_id, or same document and earlier start) goes; windows are judged
on the input. Steps:

1. **Anchors.** Of the codes of all ``gram``-word runs, those that are smallest among the runs of some window
   are anchors, so every window holds one. Where a window's smallest anchor occurs once in the corpus, the window
   is unique and needs no index.
2. **Segments.** Windows of one document that have the same smallest anchor and follow each other form a
   segment, whose text goes to the shard of that anchor: equal windows meet in one shard. Equal segments are
   combined before and after the shuffle; the earliest stands for all. Segments of an anchor with more than
   ``hot_anchor`` places are split into single windows, spread by their text, which is exact as well.
3. **FM-index per shard.** A shard's distinct segments, in corpus order, become a wavelet matrix over the
   Burrows-Wheeler transform (bit vectors with sampled ranks). The segments are streamed through it from
   right to left, all at once: a backward step takes in the next word, and a match of full window length first
   lets go of its last word, by the bounds of the rows that share ``window - 1`` words. Every match of
   window length is an interval of rows; its smallest text place is where that window starts first.
4. **Removal.** Candidate windows that are not the first of their kind cover the words to remove.

Defined cases: null, empty and too short texts lose nothing. Rows without doc_id lose nothing and do not count
as earlier places. Rows that repeat a doc_id share its places, so equal rows are treated alike. Other columns are
kept as they are by :func:`remove_repeats`; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.store import settle, small_batches
from scriptorium.llm.words import Words, grams, slices, words_of
from scriptorium.llm.worker import lean

WINDOW = 20
GRAM = 8
#: Places of an anchor from which on its windows are spread singly.
HOT_ANCHOR = 20_000
#: Words of one index.
SHARD_WORDS = 400_000


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best of every ``width`` consecutive values."""
    reach = 1
    while reach * 2 <= width:
        values = best(values[: len(values) - reach], values[reach:])
        reach *= 2
    rest = width - reach
    return best(values[: len(values) - rest], values[rest:]) if rest else values


class Anchors:
    """Anchors of several texts: code and word index of each run of ``gram`` words, and which are anchors."""

    def __init__(self, words: Words, window: int, gram: int):
        self.code, self.at = grams(words, gram)
        self.width = window - gram + 1
        n = len(self.code)
        self.chosen = np.zeros(n, bool)
        self.windows = np.zeros(0, np.int64)  # index of each window's first run
        if n < self.width:
            return
        text = words.text[self.at]
        first = np.flatnonzero(text[: n - self.width + 1] == text[self.width - 1 :])
        least = _sliding(self.code, self.width, np.minimum)
        self.windows, self.least = first, least[first]
        held = np.zeros(n + self.width - 1, np.uint64)
        held[first + self.width - 1] = self.least
        self.chosen = _sliding(held, self.width, np.maximum)[:n] == self.code

    def smallest(self) -> np.ndarray:
        """Index of the first run with the smallest code in each window."""
        at = np.flatnonzero(self.chosen)
        from_ = np.searchsorted(at, self.windows)
        best = at[from_]
        for step in range(1, self.width):  # the smallest of a window is an anchor, mostly the first or second
            wrong = self.code[best] != self.least
            if not wrong.any():
                break
            best[wrong] = at[from_[wrong] + step]
        return best


def _anchor_codes(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"))
                found = Anchors(words, window, gram)
                code = found.code[found.chosen].view(np.int64)
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)[words.text[found.at[found.chosen]]]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(code)], ["doc_id", "anchor"])

    return run


def _lists(column: pa.Array, dtype) -> Iterator[np.ndarray]:
    for i in range(len(column)):
        yield np.asarray(column[i].values, dtype=dtype) if column[i].is_valid else np.zeros(0, dtype)


def _marked(words: Words, found: Anchors, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """For each run of words, whether it is an anchor of the document's repeated ones, and a hot one."""
    chosen = np.flatnonzero(found.chosen)
    bounds = np.searchsorted(words.text[found.at[chosen]], np.arange(words.n_texts + 1))
    repeated, hot = np.zeros(len(found.code), bool), np.zeros(len(found.code), bool)
    code = found.code.view(np.int64)
    for i, (mine, warm) in enumerate(zip(_lists(part.column("anchors"), np.int64), _lists(part.column("hot"), bool))):
        if len(mine):
            own = chosen[bounds[i] : bounds[i + 1]]
            order = np.argsort(mine)
            place = np.minimum(np.searchsorted(mine, code[own], sorter=order), len(mine) - 1)
            same = mine[order[place]] == code[own]
            repeated[own] = same
            hot[own] = same & warm[order[place]]
    return repeated, hot


def _segments(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.filter(batch.column("anchors").is_valid()), "text"):
                words = words_of(part.column("text"))
                found = Anchors(words, window, gram)
                repeated, hot = _marked(words, found, part)
                least = found.smallest()
                chosen = np.flatnonzero(repeated[least])
                if not len(chosen):
                    continue
                least = least[chosen]
                start = found.at[found.windows[chosen]]
                new = np.ones(len(chosen), bool)
                new[1:] = (least[1:] != least[:-1]) | (start[1:] != start[:-1] + 1) | hot[least[1:]]
                opens = np.flatnonzero(new)
                last = np.append(opens[1:], len(chosen)) - 1
                text = words.text[start[opens]]
                body = words.data.tobytes()
                pieces = [
                    b" ".join(body[a:b].split())
                    for a, b in zip(words.start[start[opens]].tolist(), words.end[start[last] + window - 1].tolist())
                ]
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)[text]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array((start[opens] - words.first[text]).astype(np.int64)),
                        pa.array(found.code[least[opens]].view(np.int64)),
                        pa.array(hot[least[opens]]),
                        pa.array([p.decode() for p in pieces], pa.string()),
                    ],
                    ["doc_id", "start", "anchor", "hot", "words"],
                )

    return run


class Bits:
    """Bit vector in words of 64, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray, kind: np.dtype):
        self.packed = np.packbits(np.append(bits, np.zeros(64 - len(bits) % 64, bool)), bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.packed) + 1, kind)
        np.cumsum(np.bitwise_count(self.packed), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each of the given places."""
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.packed[at >> 6] & mask)


class FMIndex:
    """Wavelet matrix over the Burrows-Wheeler transform of numbers from 1; 0 ends each segment.

    Rows are in the order of their first ``2**rounds`` numbers, which is enough for matches up to that length.
    A number costs its bits and an eighth to three sixteenths of that for ranks, 4 bytes for its place and, where rows
    with the same ``window - 1`` numbers end, 4 bytes for that bound; all grow to 8 bytes from 2**31 numbers on.
    """

    def __init__(self, text: np.ndarray, window: int):
        n = len(text)
        self.kind = np.dtype(np.int32 if n < 2**31 - 64 else np.int64)
        rank, reach = text.astype(np.int64), 1
        while reach < window:
            key = rank * (int(rank.max()) + 1)
            key[: n - reach] += rank[reach:]
            rank = np.unique(key, return_inverse=True)[1].reshape(-1).astype(np.int64) + 1
            reach *= 2
        self.places = np.argsort(rank, kind="stable").astype(self.kind)
        self.size = n
        bwt = text[self.places - 1]
        self.bits = max(1, int(text.max()).bit_length())
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1))])
        self.levels = []
        for shift in range(self.bits - 1, -1, -1):
            bit = ((bwt >> shift) & 1).astype(bool)
            self.levels.append((Bits(bit, self.kind), n - int(bit.sum())))
            bwt = np.concatenate([bwt[~bit], bwt[bit]])
        self._bounds(text, window - 1)

    def _bounds(self, text: np.ndarray, depth: int) -> None:
        """Where the rows that share their first ``depth`` numbers begin."""
        padded = np.concatenate([text, np.zeros(depth, text.dtype)])
        alike = np.ones(max(self.size - 1, 0), bool)
        for d in range(depth):
            here = padded[self.places + d]
            alike &= here[1:] == here[:-1]
        self.edges = np.concatenate([[0], np.flatnonzero(~alike) + 1, [self.size]]).astype(self.kind)
        opens = np.zeros(self.size, bool)
        opens[self.edges[:-1]] = True
        self.opens = Bits(opens, self.kind)

    def shorter(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last + 1 of the rows that share their first ``window - 1`` numbers with each row."""
        group = self.opens.rank(row + 1)
        return self.edges[group - 1], self.edges[group]

    def step(self, number: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose text is the number followed by a text of the given rows."""
        ends = np.concatenate([low, high])
        base = np.zeros(len(number), np.int64)
        both = np.concatenate([number, number])
        start = np.concatenate([base, base])
        for i, (bits, zeros) in enumerate(self.levels):
            bit = ((both >> (self.bits - 1 - i)) & 1).astype(bool)
            upto, before = bits.rank(ends), bits.rank(start)
            ends = np.where(bit, zeros + upto, ends - upto)
            start = np.where(bit, zeros + before, start - before)
        count = ends - start
        n = len(number)
        first = self.below[number]
        return first + count[:n], first + count[n:]


def first_places(text: np.ndarray, window: int) -> np.ndarray:
    """Places of ``text`` at which a window starts for the first time; 0 ends each segment, in corpus order.

    Streams all segments through the index of the same text, right to left.
    """
    index = FMIndex(text, window)
    end = np.flatnonzero(text == 0)
    begin = np.concatenate([[0], end[:-1] + 1])
    order = np.argsort(begin - end, kind="stable")  # longest first, so the ones still streaming are a prefix
    begin, at = begin[order], end[order] - 1
    low, high = np.zeros(len(at), np.int64), np.full(len(at), index.size, np.int64)
    held, lows, highs, places = 0, [], [], []
    while True:
        going = int(np.searchsorted(begin - at, 0, side="right"))
        if not going:
            break
        low, high, at, begin = low[:going], high[:going], at[:going], begin[:going]
        if held == window:
            (low, high), held = index.shorter(low), held - 1
        low, high = index.step(text[at], low, high)
        held += 1
        if held == window:
            lows.append(low.astype(index.kind)), highs.append(high.astype(index.kind)), places.append(at.astype(index.kind))
        at = at - 1
    if not lows:
        return np.zeros(0, np.int64)
    low, high, place = map(np.concatenate, (lows, highs, places))
    rows, which = np.unique(low, return_index=True)
    pairs = np.stack([rows, high[which]], axis=1).reshape(-1)
    least = np.minimum.reduceat(np.append(index.places, index.kind.type(index.size)), pairs)[::2]
    return np.sort(place[place == least[np.searchsorted(rows, low)]])


def _firsts(window: int, shard_words: int):
    """Places of first windows, from segments that are sorted by route."""

    def index(ids: list, starts: list, texts: list) -> pa.RecordBatch:
        order = np.lexsort((starts, ids))
        ids, starts = np.asarray(ids, np.int64)[order], np.asarray(starts, np.int64)[order]
        split = [texts[i].split(" ") for i in order]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        codes: dict[str, int] = {}
        flat = np.zeros(int(sizes.sum()) + len(split), np.int32)
        base = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        inside = np.ones(len(flat), bool)
        inside[base + sizes] = False
        flat[inside] = [codes.setdefault(w, len(codes) + 1) for words in split for w in words]
        kept = first_places(flat, window)
        which = np.searchsorted(base, kept, side="right") - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[which]), pa.array(starts[which] + kept - base[which])], ["doc_id", "start"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, starts, texts, last, n = [], [], [], None, 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("route", "doc_id", "start", "words"))
            for route, doc, start, text in zip(*columns):
                if n >= shard_words and route != last:
                    yield index(ids, starts, texts)
                    ids, starts, texts, n = [], [], [], 0
                ids.append(doc), starts.append(start), texts.append(text)
                n += text.count(" ") + 1
                last = route
        if texts:
            yield index(ids, starts, texts)

    return run


def _removal(window: int, gram: int):
    """Per row: kept words (the text itself where nothing goes), counts and the digest of what is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"))
                found = Anchors(words, window, gram)
                repeated, _ = _marked(words, found, part)
                start = found.at[found.windows[repeated[found.smallest()]]]
                first = words.first
                gone = np.zeros(len(words.code) + 1, np.int64)
                mine = np.searchsorted(words.text[start], np.arange(words.n_texts + 1))
                for i, kept in enumerate(_lists(part.column("kept"), np.int64)):
                    own = start[mine[i] : mine[i + 1]]
                    if len(own):
                        own = own[~np.isin(own - first[i], kept)]
                        gone[own] += 1
                        gone[own + window] -= 1
                stay = np.cumsum(gone[:-1]) == 0
                n_words = np.diff(first)
                n_removed = n_words - np.diff(np.concatenate([[0], np.cumsum(stay)])[first])
                texts, digests = [], []
                for i, text in enumerate(part.column("text")):
                    own = (text.as_py() or "").encode().split()
                    if n_removed[i]:
                        own = [w for w, s in zip(own, stay[first[i] : first[i + 1]]) if s]
                    joined = b" ".join(own)
                    digests.append(hashlib.sha256(joined).hexdigest())
                    texts.append(joined.decode() if n_removed[i] else text.as_py())
                made = [pa.array(texts, pa.string()), pa.array(n_words), pa.array(n_removed), pa.array(digests)]
                names = ["row", "kept_text", "n_words", "n_removed", "kept_sha256"]
                yield pa.RecordBatch.from_arrays([part.column("row"), *made], names)

    return run


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    hot_anchor: int = HOT_ANCHOR,
    shard_words: int = SHARD_WORDS,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """For every row ``row`` (a struct of the ``keep`` columns), ``kept_text``, ``n_words``, ``n_removed`` and
    ``kept_sha256``.

    ``kept_text`` joins the kept words by one space; it is the text itself where no word goes.
    """
    small_batches(docs.sparkSession)
    # place and anchor of all documents, written once: counted first, then joined with the repeated ones
    known = docs.select("doc_id", "text").filter("doc_id is not null and text is not null")
    anchors = settle(known.mapInArrow(lean(_anchor_codes(window, gram)), "doc_id long, anchor long"), "anchors")
    counted = anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
    repeated = settle(counted.select("anchor", (F.col("n") > hot_anchor).alias("hot")), "repeated")
    # the few hot anchors are known before; their places look nothing up, from a key of their own, so that no join brings them together
    hot = settle(repeated.filter("hot").select("anchor", "hot"), "hot")
    asked = F.when(F.col("hot"), F.xxhash64("doc_id", "anchor")).otherwise(F.col("anchor")).alias("asked")
    places = anchors.join(hot, "anchor", "left").select("doc_id", "anchor", "hot", asked)
    told = repeated.filter("not hot").select(F.col("anchor").alias("asked"), F.col("hot").alias("told"))
    marks = (
        places.join(told, "asked", "left")
        .filter("hot or told is not null")
        .select("doc_id", "anchor", F.coalesce("hot", F.lit(False)).alias("hot"))
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("anchor", "hot")).alias("m"))
        .select("doc_id", F.col("m.anchor").alias("anchors"), F.col("m.hot").alias("hot"))
    )
    marks = settle(marks, "marks")

    # used twice with the same columns, so that the texts are shuffled once
    rows = docs.select("doc_id", "text", F.struct(*keep).alias("row"))
    named, bare = rows.filter("doc_id is not null"), rows.filter("doc_id is null")
    marked = named.join(marks, "doc_id", "left").select("row", "doc_id", "text", "anchors", "hot")
    segments = marked.mapInArrow(
        lean(_segments(window, gram)), "doc_id long, start long, anchor long, hot boolean, words string"
    )
    route = F.when(F.col("hot"), F.xxhash64("words")).otherwise(F.col("anchor"))
    distinct = (
        segments.withColumn("route", route)
        .groupBy("route", "words")
        .agg(F.min(F.struct("doc_id", "start")).alias("at"))
        .select("route", "at.doc_id", "at.start", "words")
    )
    first = (
        distinct.repartition("route")
        .sortWithinPartitions("route")
        .mapInArrow(lean(_firsts(window, shard_words)), "doc_id long, start long")
        .groupBy("doc_id")
        .agg(F.collect_list("start").alias("kept"))
    )
    made = "kept_text string, n_words long, n_removed long, kept_sha256 string"
    # rows without id stay where they are
    judged = marked.join(first, "doc_id", "left").unionByName(bare, allowMissingColumns=True)
    return judged.mapInArrow(lean(_removal(window, gram)), f"row {rows.schema['row'].dataType.simpleString()}, {made}")
