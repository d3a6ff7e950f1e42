"""Ranked lexical search: the best documents for each item, by a scan of the texts with an automaton of the items' terms.

An Aho-Corasick automaton of all terms of the items runs over every text and counts the terms in it; there is no index of
documents. A term is a maximal run of letters, digits and bytes above 127 with A-Z in lower case. Everything else in a text
becomes a space, a text begins and ends with one, and so does every pattern, which guards the ends of words. Terms over
``LONG`` bytes stand for themselves by a digest, in items and texts alike, so that no automaton grows by a long word.

Items are taken in blocks of at most ``PAIRS`` terms and ``TERM_BYTES`` of them (one item is a block at least; it is a row,
which has to fit into a task anyway). A block costs two scans: one counts documents, words and the documents of each term
(summed in each task before the shuffle), the second scores. A task keeps the k best documents of each item it has seen,
so that it hands on k rows an item at most; these meet in ``BUCKETS`` groups an item before the last choice.

The score of a document adds, over the item's terms, w * ((1000000000 * tf) div (1000 * tf + 20 * m)) with
w = floor(1000 * ln((2N + 2) / (2df + 1))) and m = 50 + (50 * n * N) div L, for N documents with L terms in all.

Defined cases: a document without terms (null, empty, only signs) counts nowhere. Rows that repeat a doc_id are documents of
their own; a null doc_id comes last among equal scores. Rows that repeat an item_id are one item with the terms of all of
them; null is an id like others. Items without terms, and terms that no document holds, give no row. Other columns of
either table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.store import settle, small_batches
from scriptorium.llm.words import SLICE_BYTES, slices, utf8

#: Documents of each item to return.
BEST = 50
#: Terms of a block at most, one item's terms counted for each item, and bytes of them.
PAIRS, TERM_BYTES = 50_000, 1_000_000
#: Bytes above which a term is replaced by its digest.
LONG = 64
#: Groups of tasks in which the best rows of an item meet first.
BUCKETS = 64
#: Scores held at once, documents times items, and rows kept before they are cut to the best.
CELLS, ROWS = 2_000_000, 200_000

_ALL = np.arange(256)
_UPPER = (_ALL >= 65) & (_ALL <= 90)
_INSIDE = ((_ALL >= 48) & (_ALL <= 57)) | _UPPER | ((_ALL >= 97) & (_ALL <= 122)) | (_ALL >= 128)
_READ = np.where(_INSIDE, np.where(_UPPER, _ALL + 32, _ALL), 32).astype(np.uint8)
_TERM = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
_UPPER_CASE, _LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _mark(digest: str) -> str:
    """What stands for a long term: it begins with a capital, which no term holds."""
    return "A" + digest[: LONG - 1]


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the distinct terms of each item, long ones by their digest."""
    lower = F.translate("text", _UPPER_CASE, _LOWER_CASE)
    found = items.select("item_id", F.explode(F.regexp_extract_all(lower, F.lit(_TERM), F.lit(1))).alias("term"))
    digest = F.concat(F.lit("A"), F.substring(F.sha2("term", 256), 1, LONG - 1))
    return found.select("item_id", F.when(F.octet_length("term") > LONG, digest).otherwise(F.col("term")).alias("term")).distinct()


@dataclass
class Block:
    """Items, the distinct terms of all of them, and which item has which term."""

    items: list = field(default_factory=list)
    terms: dict[str, int] = field(default_factory=dict)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    n_bytes: int = 0

    def add(self, item_id: int | None, terms: list[str]) -> None:
        self.n_bytes += sum(len(t.encode()) for t in terms)
        self.pairs.extend((self.terms.setdefault(t, len(self.terms)), len(self.items)) for t in terms)
        self.items.append(item_id)


def blocks(terms: DataFrame, pairs: int = PAIRS, term_bytes: int = TERM_BYTES) -> Iterator[Block]:
    """The items in blocks within the bounds; the rows pass through the driver a partition at a time."""
    block, item_id, own = Block(), None, []

    def closes(n: int, size: int) -> bool:
        return bool(block.items) and (len(block.pairs) + n > pairs or block.n_bytes + size > term_bytes)

    def ended() -> Iterator[Block]:
        nonlocal block
        if own:
            if closes(len(own), sum(len(t.encode()) for t in own)):
                yield block
                block = Block()
            block.add(item_id, own)

    for row in terms.orderBy("item_id", "term").toLocalIterator():
        if own and row.item_id != item_id:
            yield from ended()
            own = []
        item_id = row.item_id
        own.append(row.term)
    yield from ended()
    if block.items:
        yield block


def _cut(text: np.ndarray) -> Iterator[np.ndarray]:
    """A guarded text in pieces of about ``SLICE_BYTES``, cut at separators, which both sides keep."""
    begin = 0
    while len(text) - begin > 2 * SLICE_BYTES:
        end = begin + SLICE_BYTES
        while end < len(text) and not (gaps := np.flatnonzero(text[end : end + SLICE_BYTES] == 32)).size:
            end += SLICE_BYTES
        if end >= len(text):
            break
        end += int(gaps[0])
        yield text[begin : end + 1]
        begin = end
    yield text[begin:]


class Scanner:
    """Counts the terms of a block in slices of texts."""

    def __init__(self, terms: list[str]):
        self.n_terms = len(terms)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, term in enumerate(terms):
            self.automaton.add_word(f" {term} ".encode().decode("latin-1"), number)
        self.automaton.make_automaton()

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each text, and (text, term, tf) for what occurs."""
        data, offsets = utf8(texts)
        n = len(offsets) - 1
        # a separator before each text and after the last
        guarded = np.full(len(data) + n + 1, 32, np.uint8)
        guarded[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = _READ[data]
        bounds = offsets + np.arange(n + 1)
        inside = guarded != 32
        start = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        n_words = np.bincount(np.searchsorted(bounds, start, side="right") - 1, minlength=n)
        for at in np.flatnonzero(end - start > LONG):
            a, b = int(start[at]), int(end[at])
            digest = _mark(hashlib.sha256(guarded[a:b].tobytes()).hexdigest())
            guarded[a:b] = 32
            guarded[a : a + LONG] = np.frombuffer(digest.encode(), np.uint8)
        keys = []
        begin = 0
        for piece in _cut(guarded):
            hits = self.automaton.iter(piece.tobytes().decode("latin-1"))
            hits = np.fromiter(hits, dtype=np.dtype([("end", np.int64), ("term", np.int64)]))
            # the separator that ends a word is before the next text's first byte
            text = np.searchsorted(bounds, hits["end"] + begin - 1, side="right") - 1
            keys.append(text * self.n_terms + hits["term"])
            begin += len(piece) - 1
        key, tf = np.unique(np.concatenate(keys), return_counts=True)
        return n_words, key // self.n_terms, key % self.n_terms, tf


def _counts(terms: list[str]) -> Callable:
    """(term, n) of a task: the documents that hold each term; documents with terms as -1, their terms as -2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(terms)
        n = np.zeros(len(terms) + 2, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                n_words, _, term, _ = scanner.count(part.column("text"))
                n[:-2] += np.bincount(term, minlength=len(terms))
                n[-1] += np.count_nonzero(n_words)
                n[-2] += n_words.sum()
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.where(at < len(terms), at, at - len(n))), pa.array(n[at])], ["term", "n"])

    return run


class Best:
    """The k best (score, document) of each item so far, as rows (item, score, null id, id)."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.least = np.ones(n_items, np.int64)
        self.rows = np.zeros((0, 4), np.int64)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0

    def add(self, scores: np.ndarray, null: np.ndarray, doc_id: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.least)
        self.waiting.append(np.stack([item, scores[doc, item], null[doc], doc_id[doc]], axis=1))
        self.n_waiting += len(doc)
        if self.n_waiting > ROWS:
            self.cut()

    def cut(self) -> None:
        rows = np.concatenate([self.rows, *self.waiting])
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        begin = np.searchsorted(rows[:, 0], np.arange(len(self.least)))
        rows = rows[np.arange(len(rows)) - begin[rows[:, 0]] < self.k]
        n = np.bincount(rows[:, 0], minlength=len(self.least))
        last = np.cumsum(n) - 1
        full = n == self.k
        self.least[full] = rows[last[full], 1]
        self.rows, self.waiting, self.n_waiting = rows, [], 0


def _scores(terms: list[str], pairs: list[tuple[int, int]], n_items: int, weight: np.ndarray, n_docs: int, n_all: int, k: int) -> Callable:
    """(item, doc_id, score) of a task: the k best documents of each item of the block, by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(terms)
        listed = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        first = np.searchsorted(listed[:, 0], np.arange(len(terms) + 1))
        best = Best(n_items, k)
        rows = max(1, CELLS // n_items)
        for batch in batches:
            for part in slices(batch, "text"):
                n_words, doc, term, tf = scanner.count(part.column("text"))
                m = 50 + (50 * n_words * n_docs) // n_all
                gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
                ids = part.column("doc_id")
                null = np.asarray(ids.is_null()).astype(np.int64)
                ids = np.asarray(ids.fill_null(0)).astype(np.int64)
                for a in range(0, len(ids), rows):
                    some = slice(*np.searchsorted(doc, [a, a + rows]))
                    times = (first[1:] - first[:-1])[term[some]]
                    begin = np.repeat(first[term[some]] - np.cumsum(times) + times, times)
                    item = listed[begin + np.arange(times.sum()), 1]
                    scores = np.zeros((min(rows, len(ids) - a), n_items), np.int64)
                    np.add.at(scores.reshape(-1), np.repeat(doc[some] - a, times) * n_items + item, np.repeat(gain[some], times))
                    best.add(scores, null[a : a + rows], ids[a : a + rows])
        best.cut()
        item, score, null, doc_id = best.rows.T
        made = [pa.array(item), pa.array(doc_id, mask=null == 1), pa.array(score)]
        yield pa.RecordBatch.from_arrays(made, ["item", "doc_id", "score"])

    return run


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST, pairs: int = PAIRS, term_bytes: int = TERM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, equal scores by doc_id."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = items.schema["item_id"].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {kind}, doc_id long, score long, bucket long")
    for block in blocks(settle(item_terms(items), "item-terms"), pairs, term_bytes):
        terms = list(block.terms)
        counted = texts.select("text").mapInArrow(_counts(terms), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        counts = {r.term: r.n for r in counted.collect()}
        n_docs, n_all = counts.get(-1, 0), counts.get(-2, 0)
        if not n_docs:
            break
        held = np.array([counts.get(t, 0) for t in range(len(terms))])
        weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * held + 1))).astype(np.int64)
        scored = texts.mapInArrow(
            _scores(terms, block.pairs, len(block.items), weight, n_docs, n_all, k), "item long, doc_id long, score long"
        )
        names = spark.createDataFrame(list(enumerate(block.items)), f"item long, item_id {kind}")
        scored = scored.withColumn("bucket", (F.spark_partition_id() % BUCKETS).cast("long"))
        found = found.union(scored.join(F.broadcast(names), "item").select("item_id", "doc_id", "score", "bucket"))
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    for group in (("item_id", "bucket"), ("item_id",)):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        found = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")
