"""Periodic runs: maximal stretches of words that repeat with a period, found through Lyndon roots.

Every run has a Lyndon word of its period, under one of two opposite orders of the words, that is the longest Lyndon
word at some place of it. So the longest Lyndon words of all places under both orders (their lengths are the Lyndon
array) give a root for each run, and how far the text repeats itself to the right and left of a root (longest common
extensions) gives the run. The Lyndon arrays are those that phase one of a suffix sorter by grouping leaves behind: places are
grouped by first word, groups are taken from the largest down, and what precedes a group's places without being in
a larger one moves up, its context getting longer by the group's. No suffixes are sorted for it.

Only repetitive stretches go through this: in a run of period q and at least ``powers`` periods (and ``least`` words) each
word but those of the last period comes again within q words. Stretches of such words, for q up to each power of two, are
found in arrays for many texts at once, and a run of at least that size lies inside one, its neighbours included.

Texts are independent of each other; nothing is shuffled. A slice of about a megabyte of text is in memory at once, or one
text if that is longer, with some 50 bytes a word and, in repetitive stretches, 200 more.

Defined cases: null and empty texts have no words, no runs and an empty rest. Rows that repeat a doc_id, or have none, are
searched one by one. All columns are handed through in ``row``, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.store import small_batches
from scriptorium.llm.words import slices, utf8, words_in

#: A run has at least so many words, and at least so many periods.
LEAST, POWERS = 6, 4

_ALL = np.arange(256)
_INSIDE = ~((_ALL == 32) | ((_ALL >= 9) & (_ALL <= 13)))
_RUNS = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lyndon_lengths(ranks: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each place of a sequence of ranks 0, 1, ….

    A group is known by where its interval of the sorted places begins. Groups below the one at hand shrink from
    above when places leave them, so that beginnings stay in the groups' order.
    """
    n = len(ranks)
    order = np.argsort(ranks, kind="stable")
    cuts = np.flatnonzero(np.diff(ranks[order])) + 1
    begins = np.concatenate([[0], cuts])
    ends = np.append(cuts, n)
    group = np.empty(n, np.int64)
    group[order] = np.repeat(begins, ends - begins)
    group = group.tolist()
    places = order.tolist()
    members = {b: places[b:e] for b, e in zip(begins.tolist(), ends.tolist())}
    begin_of = dict(zip(ends.tolist(), begins.tolist()))
    end_of = dict(zip(begins.tolist(), ends.tolist()))
    context = dict.fromkeys(begins.tolist(), 1)
    # places that are in no group taken so far, as a list linked both ways
    left, right = list(range(-1, n)), list(range(1, n + 2))
    found = [0] * n
    end = n
    while end > 0:
        begin = begin_of[end]
        size = context[begin]
        # one after the other in the text: the place before each, and how often it precedes
        before: list[int] = []
        times: list[int] = []
        last = -1
        for i in members.pop(begin):
            if group[i] != begin:
                continue
            found[i] = size
            p, q = left[i], right[i]
            right[p] = q
            left[q] = p
            if p == last:
                if p >= 0:
                    times[-1] += 1
            else:
                last = p
                before.append(p)
                times.append(1)
        moved: defaultdict[tuple[int, int], list[int]] = defaultdict(list)
        for p, t in zip(before, times):
            moved[-t, group[p]].append(p)
        for (t, old), gone in sorted(moved.items()):
            top = end_of[old]
            new = top - len(gone)
            reach = context[old] - t * size
            if new == old:
                members[old] = gone
            else:
                end_of[old], begin_of[new] = new, old
                begin_of[top], end_of[new] = new, top
                members[new] = gone
                for p in gone:
                    group[p] = new
            context[new] = reach
        end = begin
    return np.array(found, np.int64)


class Extensions:
    """How far a sequence agrees with itself from two places on, by names for its blocks of 1, 2, 4, … ranks."""

    def __init__(self, ranks: np.ndarray, longest: int):
        self.names = [ranks.astype(np.int64)]
        size = 1
        while 2 * size <= longest:
            last = self.names[-1]
            pairs = last[:-size] * (int(last.max()) + 1) + last[size:]
            self.names.append(np.unique(pairs, return_inverse=True)[1].reshape(-1))
            size *= 2

    def agree(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """For a < b, the ranks that agree from a and b on, or before a and b if ``back``."""
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names, size = self.names[k], 1 << k
            x, y = (a - total - size, b - total - size) if back else (a + total, b + total)
            fits = np.flatnonzero((x >= 0) & (y < len(names)))
            same = fits[names[x[fits]] == names[y[fits]]]
            total[same] += size
        return total


def _stretches(code: np.ndarray, first: np.ndarray, least: int, powers: int) -> list[tuple[int, int]]:
    """Stretches of places, in order and apart, that hold every run of at least that size with its neighbours."""
    n = len(code)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((code, text))
    again = np.full(n, n + 1, np.int64)
    same = (text[order[1:]] == text[order[:-1]]) & (code[order[1:]] == code[order[:-1]])
    again[order[:-1][same]] = (order[1:] - order[:-1])[same]
    longest = int(np.diff(first).max(initial=0))
    found = []
    reach = 1
    while True:
        smallest = reach // 2 + 1 if reach > 1 else 1
        needed = max(least, powers * smallest)
        if needed > longest:
            break
        flags = np.concatenate([[False], again <= reach, [False]])
        turns = np.flatnonzero(flags[1:] != flags[:-1])
        begin, end = turns[::2], turns[1::2]
        # the words of all but the last period; a period of up to `reach` may have to be added, and both neighbours
        long = end - begin >= max(least - reach, (powers - 1) * smallest, 1)
        begin, end = begin[long], end[long]
        at = text[begin]
        found.append(np.stack([np.maximum(begin - 1, first[at]), np.minimum(end + reach + 1, first[at + 1])], axis=1))
        reach *= 2
    if not found:
        return []
    every = np.concatenate(found)
    every = every[np.argsort(every[:, 0], kind="stable")]
    if not len(every):
        return []
    upto = np.maximum.accumulate(every[:, 1])
    # stretches of different texts touch, but do not overlap
    new = np.concatenate([[True], (every[1:, 0] >= upto[:-1])])
    at = np.flatnonzero(new)
    return list(zip(every[at, 0].tolist(), upto[np.append(at[1:], len(every)) - 1].tolist()))


def find_runs(code: np.ndarray, first: np.ndarray, least: int = LEAST, powers: int = POWERS) -> np.ndarray:
    """Rows (start, length, period) of all runs in texts whose words ``code`` begin at ``first``; starts count over all texts."""
    none = np.zeros((0, 3), np.int64)
    stretches = _stretches(code, first, least, powers) if len(code) else []
    if not stretches:
        return none
    # one sequence of all stretches, each followed by a rank of its own
    lengths = np.array([e - b for b, e in stretches], np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1
    place = np.repeat(np.array([b for b, _ in stretches]) - begins, lengths + 1) + np.arange(int((lengths + 1).sum()))
    closing = begins + lengths
    inside = np.ones(len(place), bool)
    inside[closing] = False
    distinct, ranks_inside = np.unique(code[place[inside]], return_inverse=True)
    ranks = np.zeros(len(place), np.int64)
    ranks[inside] = ranks_inside.reshape(-1)
    ranks[closing] = len(distinct) + np.arange(len(closing))
    starts, periods = [], []
    for b, size in zip(begins.tolist(), lengths.tolist()):
        own = np.unique(ranks[b : b + size], return_inverse=True)[1].reshape(-1)
        for ordered in (own, own.max() - own):
            starts.append(np.arange(b, b + size))
            periods.append(lyndon_lengths(ordered))
    start, period = np.concatenate(starts), np.concatenate(periods)
    extensions = Extensions(ranks, int(lengths.max()))
    after = extensions.agree(start, start + period)
    # where a root comes a second time at all
    some = np.flatnonzero(after > 0)
    start, period, after = start[some], period[some], after[some]
    ahead = extensions.agree(start, start + period, back=True)
    length = ahead + period + after
    kept = length >= np.maximum(least, powers * period)
    runs = np.stack([place[start[kept]] - ahead[kept], length[kept], period[kept]], axis=1)
    return np.unique(runs, axis=0) if len(runs) else none


def runs(docs: DataFrame, least: int = LEAST, powers: int = POWERS, column: str = "text") -> DataFrame:
    """``row`` (a struct of all columns), ``n_words``, ``runs`` of (start, length, period) by start and period, and
    ``collapsed``: the words joined by one space, without those that a run repeats after its first period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row")
            for part in slices(pa.RecordBatch.from_arrays([rows, rows.field(column)], ["row", "text"]), "text"):
                data, offsets = utf8(part.column("text"))
                words = words_in(data, offsets, inside=_INSIDE)
                first = words.first
                found = find_runs(words.code, first, least, powers)
                text = np.searchsorted(first, found[:, 0], side="right") - 1
                gone = np.zeros(len(words.code) + 1, np.int64)
                np.add.at(gone, found[:, 0] + found[:, 2], 1)
                np.add.at(gone, found[:, 0] + found[:, 1], -1)
                stays = np.cumsum(gone)[:-1] == 0
                touched = set(text.tolist())
                kept = []
                for i in range(len(offsets) - 1):
                    split = data[offsets[i] : offsets[i + 1]].tobytes().split()
                    if i in touched:
                        split = compress(split, stays[first[i] : first[i + 1]].tolist())
                    kept.append(b" ".join(split))
                found[:, 0] -= first[text]
                cuts = pa.array(np.searchsorted(text, np.arange(len(first))), pa.int32())
                listed = pa.StructArray.from_arrays([pa.array(c) for c in found.T.copy()], fields=list(_RUNS))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        pa.array(np.diff(first), pa.int64()),
                        pa.ListArray.from_arrays(cuts, listed),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    ["row", "n_words", "runs", "collapsed"],
                )

    small_batches(docs.sparkSession)
    packed = docs.select(F.struct(*docs.columns).alias("row"))
    kind = packed.schema["row"].dataType.simpleString()
    made = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return packed.mapInArrow(run, f"row {kind}, {made}")


def with_planted_period(doc_id: Column, text: Column) -> Column:
    """The text of every tenth document, by the checksum of its id, with a tail that repeats itself; others as they are.

    Of n words, those from word a = g % n on repeat the first 1 + (n - a) div (3 + g % 8) of them, g being a tenth of the checksum.
    """
    checksum = F.crc32(doc_id.cast("string"))
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n = F.size(words).cast("long")
    tenth = F.floor(checksum / 10).cast("long")
    at = (tenth % n).cast("int")
    period = (F.lit(1) + F.floor((n - at) / (F.lit(3) + tenth % 8))).cast("int")
    rest = (n - at).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice(words, at + 1, period), F.ceil(rest / period).cast("int")))
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), at), F.slice(repeated, F.lit(1), rest)), " ")
    return F.when((checksum % 10 == 0) & (n > 0), planted).otherwise(text)
