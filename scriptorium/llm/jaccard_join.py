"""N-gram Jaccard join: documents whose sets of word shingles are alike, through R-trees of count vectors.

A document's set holds its distinct ``shingle``-word runs (A-Z lower-cased); with fewer words the whole
sequence is the one element, without words the set is empty. Two documents link when
``scale * |intersection| >= level * |union|``. Steps:

1. **Equal sets.** Every set gets a 128-bit digest; of equal sets the smallest doc_id goes on alone.
2. **Routing.** Linked sets of at most ``hi`` elements differ in at most ``e = 2 hi (scale - level) / (scale + level)``
   of them, so if the elements are hashed into more than ``e`` groups, some group is the same in both. Sets of
   similar size use the same number of groups (a set near the next size band uses that one's as well), and every
   group's content is a key. Keys are combined in the task, met in one shuffle, and read off in order: documents
   are joined to the smallest one that shares a key. Some spare groups make up for groups that are empty (or
   nearly, where groups are large), whose keys would bring unlike documents together. Shingles that many unlike
   documents of a sample hold (lines all over the corpus) are left out of the keys, which cannot add a difference. The connected parts hold all links; no pair is listed.
3. **R-tree.** The documents of a part meet in a task. A part of more than ``block_docs`` is taken by bands of set sizes
   and in blocks: first every block by itself, with some documents that all blocks of the band have. Documents that are
   connected by then need not meet again, so only blocks that hold something else meet two by two. Their
   elements are hashed into ``AXES`` groups, whose counts are a point; points are packed into a tree of boxes.
   Two boxes can hold a link only if the sum of their smaller upper coordinates reaches the overlap that their
   smallest sets need; the same holds for two points, first in ``AXES`` and then in ``FINE`` groups. Pairs that pass
   and are not connected yet are verified on the sets. The verified links connect the same documents as all links do.

Defined cases: null, empty and blank texts have no elements and no links. Rows that repeat a doc_id with the same
text are one document in every count; rows without doc_id have the size of their set and no component. Columns
other than doc_id and text are not used; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.store import components, settle, small_batches
from scriptorium.llm.words import grams, mix, slices, words_of
from scriptorium.llm.worker import lean

SHINGLE, LEVEL, SCALE = 5, 80, 100
#: Growth of set sizes within a band of equal group numbers.
BAND = 1.5
#: Coordinates of a count vector in the tree, and of the finer one that pairs of points are held against.
AXES, FINE = 24, 512
#: Points of a leaf, and children of an inner node.
LEAF, FANOUT = 32, 8
#: Documents of one connected part, and their shingles, that a task takes from each of its two blocks.
BLOCK_DOCS, BLOCK_SHINGLES = 6_000, 3_000_000
#: Of so many documents of a block there is one that all blocks of its band have.
SHARED = 100
#: Numbers that documents are hashed to, so that those of a few parts can be told in every task; more documents share a number.
TOLD = 1 << 20
#: Shingles that are shuffled with their texts in one turn, as a multiple of those of all documents.
TURN = 1.5
#: Documents that common shingles are looked for in; unlike documents of these that must hold one; and how many count.
COMMON_SAMPLE, COMMON_DOCS, COMMON = 8_000, 6, 30_000
#: Keys that a task combines before it passes them on.
COMBINE_KEYS = 1_500_000
#: Rows of an Arrow batch of keys at most; a batch is held whole on either side.
BATCH_ROWS = 50_000


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit codes."""
    words = words_of(texts, lower=True)
    code, at = grams(words, k)
    bounds = np.searchsorted(words.text[at], np.arange(words.n_texts + 1)).tolist()
    sets = [np.unique(code[a:b]) for a, b in zip(bounds, bounds[1:])]
    first = words.first
    sizes = np.diff(first)
    for i in np.flatnonzero((sizes > 0) & (sizes < k)):
        whole = np.uint64(sizes[i])
        for word in words.code[first[i] : first[i + 1]]:
            whole = mix(np.array([whole]) + np.array([word]))[0]
        sets[i] = np.array([whole])
    return sets


def _digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two 64-bit sums of each set."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    code = np.concatenate([*sets, np.zeros(1, np.uint64)])
    begin = np.concatenate([[0], np.cumsum(sizes)])

    def sums(values):
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
        return (upto[begin[1:]] - upto[begin[:-1]]).view(np.int64)

    return sizes, sums(mix(code)), sums(mix(code ^ np.uint64(0xA5A5_5A5A_C3C3_3C3C)))


def _bands(level: int, scale: int, largest: int) -> tuple[np.ndarray, ...]:
    """Of each band of set sizes: the smallest, differing elements at most, spare groups, and largest weak group.

    Groups of at most one element are weak where groups are large on average, else empty groups only; there are as many
    spare groups as the smallest sets of the band have weak ones, and some more.
    """
    lows = [1]
    while len(lows) < 2 or lows[-2] <= largest:
        lows.append(max(lows[-1] + 1, int(lows[-1] * BAND)))
    low, high = np.array(lows[:-1]), np.array(lows[1:]) - 1
    differ = 2 * high * (scale - level) // (scale + level)
    weak = (low >= 6 * (differ + 1)).astype(np.int64)
    spare = np.zeros(len(low), np.int64)
    for _ in range(3):  # the spare groups thin out the others a little
        groups = differ + 1 + spare
        mean = low / groups
        expected = groups * np.exp(-mean) * np.where(weak, 1 + mean, 1.0)
        spare = np.ceil(expected + 2.5 * np.sqrt(expected)).astype(np.int64) + 1
    return low, differ, spare, weak


def group_keys(sets: list[np.ndarray], level: int, scale: int, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(index of the set, key): sets that link have a key in common, unless they are equal."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    low, differ, spare, weakest = _bands(level, scale, int(sizes.max(initial=0)) * scale // level + 1)
    own = np.searchsorted(low, sizes, side="right") - 1
    code = np.concatenate([*sets, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), sizes)
    rare = np.ones(len(code), bool)
    if common is not None and len(common):
        rare = common[np.minimum(np.searchsorted(common, code), len(common) - 1)] != code
    which, keys = [], []
    for above in range(len(low)):
        # the larger of a linked pair may lie in any band that its size can reach
        band = np.minimum(own + above, len(low) - 1)
        takes = (sizes > 0) & (own + above < len(low)) & ((above == 0) | (sizes * scale >= low[band] * level))
        if not takes.any():
            break
        takes = takes & (differ[band] > 0)  # where nothing may differ, linked sets are equal
        m = np.where(takes, differ[band] + 1 + spare[band], 0)
        base = np.concatenate([[0], np.cumsum(m)])
        if not base[-1]:
            continue
        inside = takes[owner] & rare
        mine, values = owner[inside], mix(code[inside] + np.uint64(0x51ED_270B_9F3D))
        slot = base[mine] + (values % m[mine].astype(np.uint64)).astype(np.int64)
        count = np.bincount(slot, minlength=base[-1])
        halves = [np.bincount(slot, (values >> s) & np.uint64(0xFFFF_FFFF), base[-1]) for s in (np.uint64(0), np.uint64(32))]
        content = halves[0].astype(np.uint64) + (halves[1].astype(np.uint64) << np.uint64(32))
        doc = np.repeat(np.arange(len(sets)), m)
        group = np.arange(base[-1]) - base[doc]
        weak = count <= weakest[band[doc]]
        few = np.bincount(doc, weak, len(sets)) <= spare[band]
        emit = ~(weak & few[doc])
        salt = mix((band[doc] * 1_000_003 + group).astype(np.uint64))
        which.append(doc[emit])
        keys.append(mix(content + salt)[emit] >> np.uint64(16))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(which), np.concatenate(keys).view(np.int64)


def _ids(part: pa.RecordBatch) -> np.ndarray:
    return part.column("doc_id").to_numpy(zero_copy_only=False)


def _signatures(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                made = _digests(shingle_sets(part.column("text"), shingle))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *map(pa.array, made)], ["doc_id", "n_shingles", "d1", "d2"]
                )

    return run


def _meet(keys: list[np.ndarray], docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key and smallest document of each run of equal keys, and (document, smallest) of the others; empties both lists."""
    key = np.concatenate(keys)
    keys.clear()
    doc = np.concatenate(docs)
    docs.clear()
    order = np.lexsort((doc, key))
    key = key[order]
    doc = doc[order]
    del order
    opens = np.ones(len(key), bool)
    opens[1:] = key[1:] != key[:-1]
    first, others = np.flatnonzero(opens), np.flatnonzero(~opens)
    pairs = np.stack([doc[others], doc[first[np.searchsorted(first, others) - 1]]], axis=1)
    pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
    key = key[first]
    return key, doc[first], pairs[:, 0], pairs[:, 1]


def _held_shingles(shingle: int):
    """(code, kind) of each shingle of each text; near copies mostly have the same kind, their smallest remixed code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), shingle)
                kinds = np.array([mix(s + np.uint64(77)).min() if len(s) else 0 for s in sets], np.uint64)
                code = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                kind = np.repeat(kinds, [len(s) for s in sets]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(kind)], ["code", "kind"])

    return run


def _keys(shingle: int, level: int, scale: int, combine: int, common: np.ndarray):
    """(key, doc_id, null) of each group, and (any, a, b) for documents that met in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        docs: list[np.ndarray] = []
        n, seen = 0, set()

        def passed_on() -> Iterator[pa.RecordBatch]:
            key, doc, a, b = _meet(keys, docs)
            for at in range(0, len(key), BATCH_ROWS):
                some = [pa.array(c[at : at + BATCH_ROWS]) for c in (key, doc)]
                yield pa.RecordBatch.from_arrays([*some, pa.nulls(len(some[0]), pa.int64())], ["key", "a", "b"])
            for at in range(0, len(a), BATCH_ROWS):
                one, two = (pa.array(c[at : at + BATCH_ROWS]) for c in (a, b))
                yield pa.RecordBatch.from_arrays([one, one, two], ["key", "a", "b"])

        for batch in batches:
            for part in slices(batch, "text"):
                sets, ids = shingle_sets(part.column("text"), shingle), _ids(part)
                fresh = []
                for i, digest in enumerate(zip(*(d.tolist() for d in _digests(sets)))):
                    if digest not in seen:
                        seen.add(digest)
                        fresh.append(i)
                which, key = group_keys([sets[i] for i in fresh], level, scale, common)
                keys.append(key)
                docs.append(ids[np.array(fresh, np.int64)][which].astype(np.int64))
                n += len(key)
                if n >= combine:
                    yield from passed_on()
                    n, seen = 0, set()
        if n:
            yield from passed_on()

    return run


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) from rows sorted by key and document: each document with the first one of its key."""
    last_key, last_doc = None, None
    for batch in batches:
        key, a = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "a"))
        met = batch.column("b").is_valid().to_numpy(zero_copy_only=False)
        known = batch.column("b").drop_null().to_numpy(zero_copy_only=False)
        pairs = [np.stack([a[met], known], axis=1).astype(np.int64)]
        key, doc = key[~met], a[~met]
        if len(key):
            opens = np.ones(len(key), bool)
            opens[1:] = key[1:] != key[:-1]
            least = doc[np.flatnonzero(opens)][np.cumsum(opens) - 1]
            if key[0] == last_key:
                least[: np.searchsorted(key, key[0], side="right")] = last_doc
            last_key, last_doc = key[-1], least[-1]
            pairs.append(np.stack([doc, least], axis=1)[doc != least])
        pairs = np.unique(np.concatenate(pairs), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


class CountTree:
    """R-tree over points of group counts; a node has the bounds of its points and of their set sizes."""

    def __init__(self, sets: list[np.ndarray], members: np.ndarray):
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        self.points = np.zeros((len(sets), AXES), np.int32)
        # a coordinate is at most the size of its set
        self.fine = np.zeros((len(sets), FINE), np.min_scalar_type(int(self.sizes.max(initial=0))))
        for point, fine, codes in zip(self.points, self.fine, sets):
            mixed = mix(codes) >> np.uint64(20)
            point[:] = np.bincount((mixed % np.uint64(AXES)).astype(np.int64), minlength=AXES)
            fine[:] = np.bincount((mixed % np.uint64(FINE)).astype(np.int64), minlength=FINE)
        self.root = self._node(members)

    def _node(self, members: np.ndarray) -> tuple:
        """(members, children, upper bounds, smallest size); split along the widest coordinate or the size."""
        points = self.points[members]
        high, least = points.max(axis=0), int(self.sizes[members].min())
        if len(members) <= LEAF:
            return members, [], high, least
        wide = high - points.min(axis=0)
        spread = self.sizes[members].max() - least
        by = self.sizes[members] if spread >= wide.max() else points[:, int(wide.argmax())]
        parts = np.array_split(members[np.argsort(by, kind="stable")], min(FANOUT, -(-len(members) // LEAF)))
        return members, [self._node(p) for p in parts], high, least


def linked_pairs(
    sets: list[np.ndarray], left: np.ndarray, right: np.ndarray | None, level: int, scale: int, known: np.ndarray | None = None
) -> Iterator[tuple[int, int]]:
    """Links that connect what all links within ``left`` (or between left and right) connect.

    Sets with the same number in ``known`` are connected already.
    """
    tree = CountTree(sets, left)
    other = tree._node(right) if right is not None else tree.root
    label = np.arange(len(sets))
    if known is not None:
        _, first, which = np.unique(known, return_index=True, return_inverse=True)
        label = first[which.reshape(-1)]
    parent = label.tolist()

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    stack = [(tree.root, other)]
    while stack:
        one, two = stack.pop()
        # |a and b| >= level / scale * |a or b|, so (level + scale) * overlap >= level * (|a| + |b|)
        if (level + scale) * int(np.minimum(one[2], two[2]).sum()) < level * (one[3] + two[3]):
            continue
        if one[1] or two[1]:
            if one is two:
                stack += [(a, b) for i, a in enumerate(one[1]) for b in one[1][i:]]
            elif len(one[0]) >= len(two[0]):
                stack += [(a, two) for a in one[1]]
            else:
                stack += [(one, b) for b in two[1]]
            continue
        a, b = one[0], two[0]
        bound = np.minimum(tree.points[a][:, None, :], tree.points[b][None, :, :]).sum(axis=2)
        need = tree.sizes[a][:, None] + tree.sizes[b][None, :]
        passes = ((level + scale) * bound >= level * need) & (label[a][:, None] != label[b][None, :])
        if one is two:
            passes &= np.arange(len(a))[:, None] < np.arange(len(b))[None, :]
        changed = False
        i, j = np.nonzero(passes)
        overlap = np.minimum(tree.fine[a[i]], tree.fine[b[j]]).sum(axis=1, dtype=np.int64)
        likely = (level + scale) * overlap >= level * need[i, j]
        for x, y in zip(a[i[likely]].tolist(), b[j[likely]].tolist()):
            rx, ry = root(x), root(y)
            if rx == ry:
                continue
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if scale * both >= level * (len(sets[x]) + len(sets[y]) - both):
                parent[max(rx, ry)] = min(rx, ry)
                changed = True
                yield x, y
        if changed:
            for i in (*a.tolist(), *b.tolist()):
                label[i] = root(i)


def _links(shingle: int, level: int, scale: int):
    """Links from rows sorted by (part, band, one, two): the documents of blocks one and two of a part."""

    def joined(ids: list[int], blocks: list[int], roots: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        block = np.array(blocks)
        left = np.flatnonzero(block == block.min())
        right = np.flatnonzero(block != block.min())
        pairs = linked_pairs(sets, left, right if len(right) else None, level, scale, np.array(roots))
        return [(ids[x], ids[y]) for x, y in pairs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, ([], [], [], [])
        found: list[tuple[int, int]] = []

        def out() -> pa.RecordBatch:
            pairs = np.array(found, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            # texts become sets as they arrive, so that a task holds no more than its blocks' sets
            for piece in slices(batch, "text"):
                columns = (piece.column(c).to_pylist() for c in ("part", "band", "one", "two", "block", "doc_id", "root"))
                sets = shingle_sets(piece.column("text"), shingle)
                for part, band, one, two, block, doc, root, codes in zip(*columns, sets):
                    if (part, band, one, two) != last:
                        if len(held[0]) > 1:
                            found += joined(*held)
                        last, held = (part, band, one, two), ([], [], [], [])
                    held[0].append(doc), held[1].append(block), held[2].append(root), held[3].append(codes)
            if len(found) > 10_000:
                yield out()
                found = []
        if len(held[0]) > 1:
            found += joined(*held)
        yield out()

    return run


def _across(large: DataFrame, links: DataFrame, counted: list, blocks, spread) -> DataFrame:
    """Pairs of blocks (doc_id, root, part, band, block, n_shingles, one, two) in which the documents of large bands meet that are not connected.

    What is connected and fills half a block has blocks of its own, which do not meet each other; all else is dealt to loose
    blocks, numbered from 0, which meet each other and the blocks of their own.
    """
    within = components(links.join(large.select(F.col("node").alias("a")).distinct(), "a", "left_semi"), "within")
    rooted = large.join(within, "node", "left").select("node", "part", "band", "n_shingles", "blocks", F.coalesce("root", "node").alias("root"))
    rooted = settle(rooted, "rooted")
    bands, trees = ["part", "band"], ["part", "band", "root"]
    trunks = rooted.groupBy(*trees).agg(*counted, F.max("blocks").alias("blocks"))
    whole = rooted.groupBy(*bands).agg(F.count("*").alias("of"))
    # half of what a block has on average
    trunks = trunks.join(whole, bands).filter(F.col("n") * F.col("blocks") * 2 >= F.col("of")).select(*trees, blocks.alias("own"))
    before = Window.partitionBy(*bands).orderBy("root").rowsBetween(Window.unboundedPreceding, -1)
    trunks = settle(trunks.select("*", F.coalesce(F.sum("own").over(before), F.lit(0)).cast("int").alias("start")), "trunks")
    placed = settle(rooted.join(trunks, trees, "left"), "placed")
    loose = placed.filter("own is null").groupBy(*bands).agg(*counted).select(*bands, blocks.alias("loose"))
    owned = trunks.groupBy(*bands).agg(F.sum("own").cast("int").alias("owned"))
    sizes = rooted.select(*bands).distinct().join(loose, bands, "left").join(owned, bands, "left")
    sizes = settle(sizes.select(*bands, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("loose", "owned"))), "sizes")
    to = lambda a, b: F.when(b > a, F.sequence(a, b - 1)).otherwise(F.array().cast("array<int>"))  # noqa: E731  a up to b
    n, first, own = F.col("loose"), F.col("loose") + F.col("start"), F.col("own")
    end = n + F.col("owned")
    met = F.when(own.isNull(), to(F.lit(0), end)).otherwise(F.concat(to(F.lit(0), n), to(n, first), to(first + own, end)))
    # loose blocks are made of the earlier ones, which need not meet themselves again if they are as many
    at = F.floor(spread(F.col("blocks")) * n / F.col("blocks")).cast("int")
    block = F.when(own.isNull(), at).otherwise(first + spread(own)).alias("block")
    again = own.isNotNull() | (n < F.col("blocks"))
    found = placed.join(sizes, bands).select(F.col("node").alias("doc_id"), "root", *bands, block, "n_shingles", again.alias("again"), F.explode(met).alias("other"))
    return found.filter("again or block <> other").select("doc_id", "root", *bands, "block", "n_shingles", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))


def similar_components(
    docs: DataFrame,
    shingle: int = SHINGLE,
    level: int = LEVEL,
    scale: int = SCALE,
    block_docs: int = BLOCK_DOCS,
    combine_keys: int = COMBINE_KEYS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; component_id is the smallest doc_id it is linked with."""
    small_batches(docs.sparkSession)
    known = docs.select("doc_id", "text").filter("doc_id is not null")
    measured_as = "doc_id long, n_shingles long, d1 long, d2 long"
    signed = settle(known.mapInArrow(lean(_signatures(shingle)), measured_as), "sets")
    # rows that have no id to be linked by
    nameless = docs.filter("doc_id is null").select(F.lit(0).cast("long").alias("doc_id"), "text").mapInArrow(lean(_signatures(shingle)), measured_as)
    none = F.lit(None).cast("long")
    nameless = nameless.select(none.alias("doc_id"), "n_shingles", none.alias("component_id"))
    classes = signed.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("least"))
    classed = signed.join(classes, ["n_shingles", "d1", "d2"]).select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("rep")
    )
    classed = settle(classed, "classes")
    twins = classed.filter("doc_id <> rep").select("doc_id", "rep").distinct()

    # shingles of many unlike documents, from a sample of fixed size; leaving any out of the keys loses no link
    some = classed.filter("doc_id = rep").select("doc_id").distinct().orderBy(F.xxhash64("doc_id")).limit(COMMON_SAMPLE)
    seen = known.join(F.broadcast(settle(some, "some")), "doc_id").select("text")
    told = seen.mapInArrow(lean(_held_shingles(shingle)), "code long, kind long").distinct()
    told = told.groupBy("code").agg(F.count("*").alias("kinds"))
    told = told.filter(F.col("kinds") >= COMMON_DOCS).orderBy(F.desc("kinds"), "code").limit(COMMON)
    common = np.sort(np.array([r["code"] for r in told.collect()], np.int64).view(np.uint64))

    met = (
        known.mapInArrow(lean(_keys(shingle, level, scale, combine_keys, common)), "key long, a long, b long")
        .repartition("key")
        .sortWithinPartitions("key", "a")
        .mapInArrow(lean(_neighbours), "a long, b long")
    )
    for side in "ab":  # equal sets are one node
        twin = twins.select(F.col("doc_id").alias(side), F.col("rep").alias(f"{side}_rep"))
        met = met.join(twin, side, "left").withColumn(side, F.coalesce(f"{side}_rep", side)).drop(f"{side}_rep")
    parts = settle(components(met, "near").withColumnRenamed("root", "part"), "parts")

    measured = parts.join(classed.select(F.col("doc_id").alias("node"), "n_shingles"), "node")
    counted = [F.count("*").alias("n"), F.sum("n_shingles").alias("elements")]
    blocks = F.ceil(F.greatest(F.col("n") / block_docs, F.col("elements") / BLOCK_SHINGLES)).cast("int")
    # a large part is taken by bands of set sizes: a pair meets in the band of its larger set
    band = lambda n: F.floor(F.log(n) / math.log(BAND) + 1e-9)
    reach = F.sequence(band(F.col("n_shingles")), band(F.col("n_shingles") * (scale / level)))
    banded = measured.join(measured.groupBy("part").agg(*counted), "part").select(
        "node", "part", "n_shingles", F.explode(F.when(blocks > 1, reach).otherwise(F.array(F.lit(-1).cast("long")))).alias("band")
    )
    banded = banded.join(banded.groupBy("part", "band").agg(*counted), ["part", "band"])
    dealt = settle(banded.select("node", "part", "band", "n_shingles", blocks.alias("blocks")), "dealt")

    every_shingle = classed.agg(F.sum("n_shingles")).first()[0] or 0

    def met_in(placed: DataFrame, known: DataFrame) -> DataFrame:
        """Links among the documents (doc_id, root, part, band, block, n_shingles, one, two) of blocks one and two.

        Blocks of a large band meet in many pairs: these take turns, and what a turn has shuffled is dropped after it.
        """
        turns = max(1, math.ceil((placed.agg(F.sum("n_shingles")).first()[0] or 0) / max(1, TURN * every_shingle)))
        found = []
        for turn in range(turns):
            own = placed.filter(F.pmod(F.xxhash64("part", "band", "one", "two"), F.lit(turns)) == turn).drop("n_shingles")
            # the places come of a table whose file is small beside them, so that Spark would broadcast them all
            links = (
                known.join(own.hint("merge"), "doc_id")
                .repartition("part", "band", "one", "two")
                .sortWithinPartitions("part", "band", "one", "two")
                .mapInArrow(lean(_links(shingle, level, scale)), "a long, b long")
            )
            found.append(settle(links, "links"))
        return reduce(DataFrame.union, found)

    # some documents are in all blocks, so that what is alike in several blocks is connected through them
    spread = lambda n, seed=0: F.pmod(F.xxhash64("node", F.lit(seed)), n).cast("int")
    shared = (F.col("blocks") > 1) & (spread(F.col("blocks") * SHARED, 1) == 0)
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    alone = dealt.select("node", "part", "band", "n_shingles", F.explode(F.when(shared, every).otherwise(F.array(spread(F.col("blocks"))))).alias("block"))
    node, block = F.col("node"), F.col("block")
    alone = alone.select(node.alias("doc_id"), node.alias("root"), "part", "band", "block", "n_shingles", block.alias("one"), block.alias("two"))
    links = met_in(alone, known)
    large = dealt.filter("blocks > 1")
    if not large.isEmpty():
        across = settle(_across(large, links, counted, blocks, spread), "across")
        # the other texts are not shuffled again
        number = lambda c: F.pmod(F.xxhash64(c), F.lit(TOLD))
        told = settle(across.select(number("doc_id").alias("number")).distinct(), "told")
        some = known.join(F.broadcast(told), number("doc_id") == F.col("number"), "left_semi")
        links = links.union(met_in(across, some))
    linked = components(links, "linked")
    return classed.join(linked, F.col("rep") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "rep").alias("component_id")
    ).union(nameless)
