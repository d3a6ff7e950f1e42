"""Words of Arrow text columns as arrays: places and 64-bit codes, computed for many texts at once.

A word is a run of bytes other than ASCII white space (``[^\\x20\\x09-\\x0D]+``). Its code is a polynomial
over random values of its bytes, modulo 2**64, so equal words have equal codes in every process; two
different words share one with a chance of about 2**-63. Nothing here sees more than a slice of about
``SLICE_BYTES`` of text at once, or one text if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that are turned into arrays at once.
SLICE_BYTES = 1_000_000

_PLAIN = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_PLAIN >= 65) & (_PLAIN <= 90), _PLAIN + 32, _PLAIN).astype(np.uint8)
_IS_SPACE = (_PLAIN == 32) | ((_PLAIN >= 9) & (_PLAIN <= 13))
_VALUE = np.random.default_rng(20_240_607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 … base**(n-1) modulo 2**64, kept between calls."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        factors = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        factors[0] = 1
        held = _powers[base] = np.multiply.accumulate(factors)
    return held[:n]


def mix(codes: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = codes ^ (codes >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


@dataclass
class Words:
    """Words of several texts in order: text index, byte range in ``data`` and code of each."""

    n_texts: int
    data: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    code: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Index of each text's first word, and at the end the number of words."""
        return np.searchsorted(self.text, np.arange(self.n_texts + 1))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_in(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, lower: bool = False) -> Words:
    """Runs of bytes that ``inside`` (a table of 256) names, of texts that begin at ``offsets``."""
    if lower:
        data = _LOWER[data]
    n = len(data)
    held = inside[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = held[:-1], held[1:]
    if n:
        before[offsets[:-1][offsets[:-1] < n]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
    start = np.flatnonzero(held & ~before)
    end = np.flatnonzero(held & ~after) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * _power(_BASE, n), out=sums[1:])
    code = mix((sums[end] - sums[start]) * _power(_INVERSE, n + 1)[start])
    text = np.searchsorted(offsets, start, side="right") - 1
    return Words(len(offsets) - 1, data, text, start, end, code)


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Words of all texts; ``lower`` turns A-Z into a-z first."""
    return words_in(*utf8(texts), inside=~_IS_SPACE, lower=lower)


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``SLICE_BYTES`` of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the runs of k words within one text, and the index of each run's first word."""
    n = len(words.code) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = total * np.uint64(_BASE) + words.code[i : i + n]
    at = np.flatnonzero(words.text[:n] == words.text[k - 1 :])
    return mix(total[at]), at
