"""Memory of Python workers, which Spark keeps for the tasks of all later stages."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

#: What this worker process keeps for later tasks of one operator.
_kept: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """What ``make`` gave an earlier task of this worker under the same name; only the last name is kept."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def forget() -> None:
    """Drop what is kept, and return freed memory to the system, which the allocators hold on to otherwise."""
    _kept.clear()
    _trim()


def _trim() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function for ``mapInArrow`` that drops what other operators kept, and leaves no freed memory behind."""

    def leanly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # called by name: Spark copies this function to the workers, but not what the module holds there
        forget()
        yield from run(batches)
        forget()

    return leanly
