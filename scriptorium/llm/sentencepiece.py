"""SentencePiece encoding and decoding with batched Viterbi passes in numpy.

A text is cut into units where no piece has the two neighbouring bytes side by side, as before most spaces; equal units
are encoded once and remembered. Units with equally many characters advance together: for each end, the hashes of all substrings that
end there (differences of prefix hashes) are looked up among the sorted hashes of the pieces, and the best candidate of
each unit gives its backpointer. What is best depends on the model:

* unigram: the largest sum of scores, as usual;
* BPE: such a model does not maximise a sum, it merges the best pair again and again. Its result is the only sequence in
  which merging would leave every two neighbours apart, so a candidate is taken if it is stable beside the piece its start
  was reached with. Whether two pieces are stable is read off by undoing their merges, the latest first, on all candidates
  at once. Units that begin with several spaces (pieces of equal score) or have over ``LONG`` characters are merged
  directly, with a heap.

Characters that no piece covers become byte pieces, or the unknown piece in a model without them. Supported are models
without a character map and without user-defined pieces; others are refused. Defined cases: null and empty texts have no
ids and decode to the empty text; unknown ids read as `` ⁇ ``, control ids as nothing, and ids outside the model fail.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.store import small_batches
from scriptorium.llm.words import _BASE, _INVERSE, _VALUE, _power, mix, slices, utf8
from scriptorium.llm.worker import kept

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
LONG = 200
#: Units remembered by a worker, and ids of a unit on average; about 40 bytes each.
REMEMBERED, IDS = 500_000, 8

UNIGRAM, BPE = 1, 2
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol-buffer message."""
    i = 0

    def number() -> int:
        nonlocal i
        value = shift = 0
        while True:
            byte = data[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while i < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            yield tag >> 3, data[i : i + size]
            i += size


def _slot(pairs: np.ndarray) -> np.ndarray:
    return (pairs.astype(np.uint64) * np.uint64(_BASE)) >> np.uint64(43)


class Model:
    """Pieces, scores and tables of a model file; picklable, of about the size of the file."""

    def __init__(self, data: bytes):
        self.digest = hashlib.sha256(data).hexdigest()
        self.pieces, scores, self.kinds = [], [], []
        trainer, rules = {}, {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                self.kinds.append(piece.get(3, _NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                rules = dict(_fields(value))
        self.scores = np.array(scores)
        self.type = trainer.get(3, UNIGRAM)
        self.prefix, self.squeeze = rules.get(3, 1), rules.get(4, 1)
        if self.type not in (UNIGRAM, BPE) or rules.get(2) or _USER in self.kinds or not rules.get(5, 1) or trainer.get(24):
            raise ValueError("only unigram and BPE models without character map and user-defined pieces are supported")
        self.normal = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == _NORMAL}
        self.unknown = self.kinds.index(_UNKNOWN)
        self.bytes = [i for i, k in enumerate(self.kinds) if k == _BYTE]
        n = len(self.pieces)
        self.left, self.right = np.full(n, -1), np.full(n, -1)
        usable = list(self.normal)
        if self.type == BPE:
            for piece, i in self.normal.items():
                if len(piece) > 1:
                    self.left[i], self.right[i] = self._last_merge(piece)
            usable = [p for p, i in self.normal.items() if len(p) == 1 or self.left[i] >= 0]
            pairs = [
                (self.normal[p[:c]] * n + self.normal[p[c:]], i)
                for p, i in self.normal.items()
                for c in range(1, len(p))
                if p[:c] in self.normal and p[c:] in self.normal
            ]
            pairs.sort()
            self.pair = np.array([k for k, _ in pairs] or [-1])
            self.pair_score = np.array([self.scores[i] for _, i in pairs] or [0.0])
            self.maybe_pair = np.zeros(1 << 21, bool)
            self.maybe_pair[_slot(self.pair)] = True
        self.longest = max(map(len, usable), default=1)
        hashes = self.hashes_of(usable)
        order = np.argsort(hashes)
        self.hash, self.hash_id = hashes[order], np.array([self.normal[p] for p in usable], np.int64)[order]
        self.maybe = np.zeros(1 << 20, bool)  # by the first bits of a hash, whether any piece has them
        self.maybe[self.hash >> np.uint64(44)] = True
        self.parts = self._parts()
        self.lowest = min((self.scores[i] for i in self.normal.values()), default=0.0)

    @staticmethod
    def hashes_of(texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.uint64)
        for i, text in enumerate(texts):
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
            out[i] = (mix(points + np.uint64(1)) * _power(_BASE, len(points))).sum()
        return out

    def merge(self, text: str) -> tuple[list[int], tuple[int, int]]:
        """Pieces of a unit after merging the best pair until none is left (-1: not in the model), and the last pair."""
        ids = [self.normal.get(c, -1) for c in text]
        ends = list(range(1, len(text) + 1))
        before, after = list(range(-1, len(text) - 1)), [*range(1, len(text)), -1]
        begin, heap, last = list(range(len(text))), [], (-1, -1)

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0:
                whole = self.normal.get(text[begin[a] : ends[b]])
                if whole is not None:
                    heapq.heappush(heap, (-self.scores[whole], a, ends[b], whole))

        for i in range(len(text) - 1):
            offer(i, i + 1)
        alive = [True] * len(text)
        while heap:
            _, a, end, whole = heapq.heappop(heap)
            b = after[a] if alive[a] else -1
            if b < 0 or ends[b] != end or self.normal.get(text[a:end]) != whole:
                continue
            last = ids[a], ids[b]
            ids[a], ends[a], alive[b], after[a] = whole, end, False, after[b]
            if after[b] >= 0:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        found, i = [], 0
        while 0 <= i < len(text):
            found.append(ids[i] if ids[i] >= 0 else -2 - ord(text[i]))
            i = after[i]
        return found, last

    def _last_merge(self, piece: str) -> tuple[int, int]:
        found, last = self.merge(piece)
        return last if found == [self.normal[piece]] else (-1, -1)

    @cached_property
    def spelling(self) -> list[bytes]:
        """Bytes that each id stands for."""
        out = []
        for piece, kind in zip(self.pieces, self.kinds):
            if kind == _BYTE:
                out.append(bytes([int(piece[3:5], 16)]))
            elif kind == _CONTROL:
                out.append(b"")
            else:
                out.append(" ⁇ ".encode() if kind == _UNKNOWN else piece.replace(SPACE, " ").encode())
        return out

    def _parts(self) -> np.ndarray:
        """For two bytes of UTF-8, whether no piece has them side by side, so that no merge or piece spans the place."""
        apart = np.ones((256, 256), bool)
        apart[:, 0x80:0xC0] = False  # inside a character
        for piece in self.normal:
            spelled = np.frombuffer(piece.replace(SPACE, " ").encode(), np.uint8)
            apart[spelled[:-1], spelled[1:]] = False
        if len(self.bytes) < 256:  # neighbours that no piece covers become one unknown piece
            apart[~np.isin(np.arange(256), [ord(p) for p in self.normal if len(p.encode()) == 1])] = False
        return apart

    # --- units of equal length -------------------------------------------------------------------------

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, -1 where there is none."""
        ids = np.full(len(hashes), -1)
        some = np.flatnonzero(self.maybe[hashes >> np.uint64(44)])
        if len(some):
            at = np.minimum(np.searchsorted(self.hash, hashes[some]), len(self.hash) - 1)
            same = self.hash[at] == hashes[some]
            ids[some[same]] = self.hash_id[at[same]]
        return ids

    def _merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Scores of the pieces that the pairs merge to, -inf where there is none."""
        score = np.full(len(a), -np.inf)
        key = a * len(self.pieces) + b
        some = np.flatnonzero(self.maybe_pair[_slot(key)])
        if len(some):
            at = np.minimum(np.searchsorted(self.pair, key[some]), len(self.pair) - 1)
            same = self.pair[at] == key[some]
            score[some[same]] = self.pair_score[at[same]]
        return score

    @cached_property
    def _judged(self) -> np.ndarray:
        """For slots of pairs, the pair last judged there, times two, plus whether it is stable."""
        return np.full(1 << 20, -1)

    def stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging never joins parts of piece a with parts of piece b that follows it."""
        key = a * len(self.pieces) + b
        slot = _slot(key) >> np.uint64(1)
        judged = self._judged[slot]
        good = (judged & 1).astype(bool)
        rest = np.flatnonzero(judged >> 1 != key)
        if len(rest):
            good[rest] = self._stays(a[rest], b[rest])
            self._judged[slot[rest]] = key[rest] * 2 + good[rest]
        return good

    def _stays(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        good = self._merged(a, b) == -np.inf
        rest = np.flatnonzero(good)
        a, b = a[rest], b[rest]
        while len(rest):
            made_a = np.where(self.left[a] >= 0, self.scores[a], np.inf)
            made_b = np.where(self.left[b] >= 0, self.scores[b], np.inf)
            going = ~(np.isinf(made_a) & np.isinf(made_b))
            rest, a, b, made_a, made_b = rest[going], a[going], b[going], made_a[going], made_b[going]
            second = made_b <= made_a  # of equal merges the left one comes first
            a, b = np.where(second, a, self.right[a]), np.where(second, self.left[b], b)
            joined = self._merged(a, b)
            apart = np.where(second, joined < made_b, joined <= made_a)
            good[rest[~apart]] = False
            rest, a, b = rest[apart], a[apart], b[apart]
        return good

    def _viterbi(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of units of equally many characters, and how many each unit has; characters that no piece covers are
        -2 - code point."""
        n, length = len(units), len(units[0])
        points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).reshape(n, length).astype(np.uint64)
        upto = np.zeros((n, length + 1), np.uint64)
        np.cumsum(mix(points + np.uint64(1)) * _power(_BASE, length), axis=1, out=upto[:, 1:])
        back = _power(_INVERSE, length + 1)
        last = np.full((n, length + 1), -1, np.int64)  # piece that ends here
        begin = np.zeros((n, length + 1), np.int64)
        reached = np.zeros((n, length + 1), bool)
        best = np.full((n, length + 1), -np.inf)
        reached[:, 0], best[:, 0] = True, 0.0
        for end in range(1, length + 1):
            starts = np.arange(max(0, end - self.longest), end)
            ids = self._find(((upto[:, end, None] - upto[:, starts]) * back[starts]).reshape(-1)).reshape(n, -1)
            takes = (ids >= 0) & reached[:, starts]
            bare = ids[:, -1] < 0  # no piece for the character alone
            if self.type == BPE:
                rows, cols = np.nonzero(takes)
                previous = last[rows, starts[cols]]
                beside = previous >= 0  # the first piece and those after uncovered characters stand alone
                fits = np.ones(len(rows), bool)
                fits[beside] = self.stable(previous[beside], ids[rows, cols][beside])
                value = np.full(ids.shape, -np.inf)
                value[rows[fits], cols[fits]] = 0.0
            else:
                value = np.where(takes, best[:, starts] + self.scores[ids], -np.inf)
                value[bare, -1] = best[bare, end - 1] + self.lowest - 10
            if self.type == BPE:
                value[bare, -1] = 0.0
            choice = value.argmax(axis=1)
            row = np.arange(n)
            best[:, end] = value[row, choice]
            reached[:, end] = best[:, end] > -np.inf
            begin[:, end] = starts[choice]
            last[:, end] = ids[row, choice]
        # back from the end, all units at once; the ids of a unit come last first
        owner, found = [], []
        row, at = np.arange(n), np.full(n, length)
        while len(row):
            piece = last[row, at]
            bare = piece < 0
            piece[bare] = -2 - points[row[bare], at[bare] - 1].astype(np.int64)
            owner.append(row), found.append(piece)
            at = begin[row, at]
            row, at = row[at > 0], at[at > 0]
        owner, found = np.concatenate(owner)[::-1], np.concatenate(found)[::-1]
        return found[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=n)

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the units one after the other, and how many each unit has."""
        by_length: dict[int, list[int]] = {}
        which, flat, counts = [], [], []
        for i, unit in enumerate(units):
            if self.type == BPE and (len(unit) > LONG or unit.startswith(SPACE * 2)):
                ids = np.array(self.merge(unit)[0])
                which.append([i]), flat.append(ids), counts.append([len(ids)])
            else:
                by_length.setdefault(len(unit), []).append(i)
        for length, some in by_length.items():
            step = max(1, 400_000 // length)
            for a in range(0, len(some), step):
                ids, count = self._viterbi([units[i] for i in some[a : a + step]])
                which.append(some[a : a + step]), flat.append(ids), counts.append(count)
        if not units:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        which, flat, counts = np.concatenate(which), np.concatenate(flat), np.concatenate(counts)
        flat, counts = self._spelled(flat, counts)
        sizes = np.zeros(len(units), np.int64)
        sizes[which] = counts
        place = np.argsort(np.repeat(which, counts), kind="stable")
        return flat[place].astype(np.int32), sizes

    def _spelled(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """With uncovered characters as byte pieces, or runs of them in a unit as the unknown piece."""
        bare = np.flatnonzero(ids < 0)
        if not len(bare):
            return ids, counts
        owner = np.repeat(np.arange(len(counts)), counts)
        if len(self.bytes) == 256:
            spelled = [[self.bytes[byte] for byte in chr(-2 - i).encode()] for i in ids[bare].tolist()]
        else:
            follows = (bare > 0) & (ids[bare - 1] < 0) & (owner[bare - 1] == owner[bare])
            spelled = [[] if f else [self.unknown] for f in follows]
        many = np.ones(len(ids), np.int64)
        many[bare] = [len(x) for x in spelled]
        out, first = np.repeat(ids, many), np.cumsum(many) - many
        for i, x in zip(bare.tolist(), spelled):
            out[first[i] : first[i] + len(x)] = x
        return out, np.bincount(owner, many, len(counts)).astype(np.int64)


class Encoder:
    """Encodes batches of texts, remembering units."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        # codes of units in ascending order; the ids of each in ``flat``, and how often it was met
        self.code, self.uses = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.first, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _forget_rare(self) -> None:
        """Keep the half that was met most often."""
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: len(self.uses) // 2])
        size = self.size[kept]
        first = np.cumsum(size) - size
        self.flat = self.flat[np.arange(size.sum()) + np.repeat(self.first[kept] - first, size)]
        self.code, self.uses, self.first, self.size = self.code[kept], self.uses[kept] // 2, first, size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the first of each text and at the end their number."""
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), SPACE, " ")
        if self.model.squeeze:
            texts = pc.replace_substring_regex(pc.utf8_trim(texts, " "), " {2,}", " ")
        if self.model.prefix:
            blank = pc.equal(texts, "")
            texts = pc.if_else(blank, texts, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
        data, offsets = utf8(texts)
        opens = np.zeros(len(data), bool)
        opens[1:] = self.model.parts[data[:-1], data[1:]]
        opens[offsets[:-1][offsets[:-1] < len(data)]] = True
        start = np.flatnonzero(opens)
        end = np.append(start[1:], len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUE[data] * _power(_BASE, len(data)), out=sums[1:])
        code = mix((sums[end] - sums[start[: len(end)]]) * _power(_INVERSE, len(data) + 1)[start]) if len(start) else np.zeros(0, np.uint64)
        keys, which, inverse, times = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
        if len(self.code) > REMEMBERED or len(self.flat) > REMEMBERED * IDS:
            self._forget_rare()
        at = np.searchsorted(self.code, keys)
        unknown = np.ones(len(keys), bool)
        inside = at < len(self.code)
        unknown[inside] = self.code[at[inside]] != keys[inside]
        new = np.flatnonzero(unknown)
        if len(new):
            body = data.tobytes()
            units = [body[a:b].decode().replace(" ", SPACE) for a, b in zip(start[which[new]].tolist(), end[which[new]].tolist())]
            flat, sizes = self.model.encode_units(units)
            before = at[new]
            self.first = np.insert(self.first, before, len(self.flat) + np.cumsum(sizes) - sizes)
            self.flat, self.size = np.concatenate([self.flat, flat]), np.insert(self.size, before, sizes)
            self.code, self.uses = np.insert(self.code, before, keys[new]), np.insert(self.uses, before, 0)
            at += np.cumsum(unknown) - unknown
        self.uses[at] += times
        place = at[inverse]
        many = self.size[place]
        upto = np.concatenate([[0], np.cumsum(many)])
        ids = self.flat[np.arange(upto[-1]) - np.repeat(upto[:-1] - self.first[place], many)]
        return ids, upto[np.searchsorted(start, offsets)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids, without the space that encoding puts in front."""
        spelling = self.model.spelling
        text = b"".join([spelling[i] for i in ids.tolist()])
        if self.model.prefix and text[:1] == b" ":
            text = text[1:]
        return text.decode(errors="replace")


def _encoder(held) -> Encoder:
    """The encoder of this worker process, which later tasks find again with what it remembers."""
    model = held.value
    return kept(f"encoder {model.digest}", lambda: Encoder(model))


def load(path: str) -> Model:
    """Read a model file on the driver; tasks get it with the function."""
    with open(path, "rb") as file:
        return Model(file.read())


def _coded(held, decoded: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(held)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, first = encoder.encode(part.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids))
                texts = [encoder.decode(ids[a:b]) for a, b in zip(first, first[1:])]
                if decoded == "sha256":
                    same = pc.equal(pc.fill_null(part.column("text"), ""), pa.array(texts, part.column("text").type))
                    texts = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
                    extra, names = [pa.array(texts), same], ["decoded_sha256", "round_trip"]
                else:
                    extra, names = [pa.array(texts, pa.string())], ["decoded"]
                counts = pa.array(np.diff(first).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), lists, counts, *extra], ["row", "ids", "n_tokens", *names]
                )

    return run


def encode_decode(docs: DataFrame, model: str = MODEL, keep: tuple[str, ...] = ("doc_id",), digest: bool = False) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns), ``ids``, ``n_tokens`` and the text ``decoded`` from the ids.

    With ``digest`` the decoded text's sha256 and whether it equals the text come instead of it.
    """
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(load(model))  # as large as the vocabulary, whatever the input
    rows = docs.select(F.struct(*keep).alias("row"), "text")
    made = "decoded_sha256 string, round_trip boolean" if digest else "decoded string"
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_coded(held, "sha256" if digest else "text"), f"row {kind}, ids array<int>, n_tokens long, {made}")
