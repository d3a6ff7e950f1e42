"""Atom feed files as a Spark data source: whole documents, by namespace, an entry at a time.

``spark.read.format("atom").load(path)`` reads every file under ``path`` (``paths``: several, one a line), a partition
each; ``categories`` (comma-separated) keeps the entries filed under one of these, and no other is built. A file is
parsed as its bytes arrive and entries are dropped once they are rows, so that memory follows the largest entry. Names are
resolved by namespace, whatever the prefix. A document that is malformed, cut anywhere, empty or followed by more
fails the read; one whose root is not a feed has no entries.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import urlsplit
from xml.etree import ElementTree

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from scriptorium.sources.schemas import FEED_ENTRY

# Fixed value: the namespace of Atom.
ATOM = "{http://www.w3.org/2005/Atom}"
#: Bytes read, and entries handed on, at a time.
BLOCK, ENTRIES = 1 << 20, 500
#: Kinds of addresses that the source opens by itself.
SCHEMES = ("", "file", "s3", "gs", "hdfs")

_TEXTS = ("id", "title", "summary", "published", "updated")
_ARROW = pa.schema(
    [(name, pa.string()) for name in _TEXTS]
    + [
        ("author", pa.list_(pa.struct([("name", pa.string())]))),
        ("category", pa.list_(pa.struct([("_term", pa.string())]))),
    ]
)


class MalformedFeedError(ValueError):
    """A feed file is not one whole XML document."""


def entries_of(feed: BinaryIO, name: str, categories: Sequence[str] | None = None) -> Iterator[dict]:
    """Entries directly under the root of one document; an element that is not there is None."""
    parser = ElementTree.XMLPullParser(("start", "end"))
    wanted = None if categories is None else set(categories)
    root, depth = None, 0
    try:
        while block := feed.read(BLOCK):
            parser.feed(block)
            for event, element in parser.read_events():
                if event == "start":
                    root = element if root is None else root
                    depth += 1
                    continue
                depth -= 1
                if depth != 1:
                    continue
                if element.tag == f"{ATOM}entry":
                    terms = [c.get("term") for c in element.findall(f"{ATOM}category")]
                    if wanted is None or wanted.intersection(terms):
                        yield _entry(element, terms)
                # what the root has gathered so far
                root.clear()
        parser.close()
    except ElementTree.ParseError as error:
        raise MalformedFeedError(f"MALFORMED feed {name}: {error}") from error


def _entry(element: ElementTree.Element, terms: list[str | None]) -> dict:
    found = {name: element.findtext(ATOM + name) for name in _TEXTS}
    found["author"] = [{"name": a.findtext(f"{ATOM}name")} for a in element.findall(f"{ATOM}author")]
    found["category"] = [{"_term": t} for t in terms]
    return found


def batches_of(entries: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """Entries as record batches of at most ``ENTRIES`` rows and about ``BLOCK`` characters of summaries."""
    held, size = [], 0
    for entry in entries:
        held.append(entry)
        size += len(entry["summary"] or "")
        if len(held) >= ENTRIES or size >= BLOCK:
            yield pa.RecordBatch.from_pylist(held, _ARROW)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, _ARROW)


def _located(path: str) -> tuple[pa.fs.FileSystem, str]:
    if urlsplit(path).scheme in ("", "file"):
        return pa.fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    return pa.fs.FileSystem.from_uri(path)


def _shown(path: str) -> bool:
    return not path.rsplit("/", 1)[-1].startswith(("_", "."))


@dataclass
class FeedFile(InputPartition):
    """One file: the address that its folder was asked by, and its place there."""

    origin: str
    place: str


class AtomReader(DataSourceReader):
    def __init__(self, paths: list[str], categories: list[str] | None):
        self.paths = paths
        self.categories = categories

    def partitions(self) -> Sequence[FeedFile]:
        found = []
        for path in self.paths:
            files, place = _located(path)
            info = files.get_file_info(place)
            if info.type == pa.fs.FileType.NotFound:
                raise FileNotFoundError(f"PATH_NOT_FOUND {path}")
            if info.is_file:
                found.append(FeedFile(path, place))
                continue
            inside = files.get_file_info(pa.fs.FileSelector(place))
            found += [FeedFile(path, i.path) for i in sorted(inside, key=lambda i: i.path) if i.is_file and _shown(i.path)]
        return found

    def read(self, partition: FeedFile) -> Iterator[pa.RecordBatch]:
        files, _ = _located(partition.origin)
        with files.open_input_stream(partition.place, compression="detect") as feed:
            yield from batches_of(entries_of(feed, partition.place, self.categories))


class AtomSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "atom"

    def schema(self) -> StructType:
        return FEED_ENTRY

    def reader(self, schema: StructType) -> AtomReader:
        paths = self.options.get("paths") or self.options.get("path")
        if not paths:
            raise ValueError("atom: no path")
        named = self.options.get("categories")
        return AtomReader(paths.split("\n"), None if named is None else [c.strip() for c in named.split(",")])


def read_atom(spark: SparkSession, paths: Sequence[str], categories: Sequence[str] | None = None) -> DataFrame:
    """Entries of feed files. Addresses that only Spark can open, and patterns, are read through its own file source,
    which leaves out files without a byte."""
    plain = all(urlsplit(p).scheme in SCHEMES and not re.search(r"[*?\[{]", p) for p in paths)
    if plain:
        spark.dataSource.register(AtomSource)
        reader = spark.read.format("atom").option("paths", "\n".join(paths))
        return (reader if categories is None else reader.option("categories", ",".join(categories))).load()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                yield from batches_of(entries_of(pa.BufferReader(content.as_buffer()), path, categories))

    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")
    return files.mapInArrow(parse, FEED_ENTRY)
