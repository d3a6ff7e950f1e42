"""WARC archives compressed with Zstandard: a dictionary in a leading skippable frame, then one frame per record.

Writing: each task turns its pages into archives of about ``ARCHIVE_BYTES`` under names of their own in the shared folder
and returns their paths, so an archive of a lost or repeated attempt is never listed. The dictionary is trained on the
first records of the archive. Of pages with equal payloads of at least ``min_revisit`` bytes, the one with the largest
page_id is a ``response``, the others are ``revisit`` records that refer to it; only digests with several pages are joined
to the pages, as a written table that Spark broadcasts if it is small.

Reading: the dictionary is taken from the skippable frame, plain or itself compressed; frames are decoded one at a time
from a stream. Version line, header lines, mandatory fields, lengths, closing line ends, and the digests of blocks and
payloads are checked; an archive that fails raises :class:`BadArchive`.

Defined cases: a null html is an empty payload, a null url leaves out the target field. Pages without page_id are responses
with an empty number unless a page with an id has the same payload. Rows that repeat a page_id have a record each. Control
characters and spaces of a url are percent-encoded. Other columns are not stored; an empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.store import settle
from scriptorium.session import shared_dir

ARCHIVE_BYTES = 64_000_000
#: What a dictionary is trained on at most, and its size.
TRAINING_BYTES, TRAINING_RECORDS, DICTIONARY_BYTES = 2_000_000, 300, 32_768
READ_BYTES = 1 << 20

# Fixed values of the formats.
_DICTIONARY_FRAME = 0x184D2A5D
_ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")


class BadArchive(ValueError):
    """An archive or record that breaks its format."""


def digest(data: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _file(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


# --- records ---------------------------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, which keeps the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)))
    if refers_to is not None:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return _VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _number(urn: str) -> int | None:
    if not (urn.startswith("<urn:page:") and urn.endswith(">")):
        raise BadArchive(f"record id {urn}")
    inner = urn[len("<urn:page:") : -1]
    return int(inner) if inner else None


def parse(data: bytes) -> dict:
    """Fields of one record after all checks; ``payload`` is None for a revisit."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] != _VERSION:
        raise BadArchive(f"version line {lines[0][:20]!r}")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise BadArchive(f"header line {line[:60]!r}")
        fields[name.decode().lower()] = value.decode().strip()
    missing = [f for f in _MANDATORY if f not in fields]
    if missing or not fields["content-length"].isdigit():
        raise BadArchive(f"missing or bad {missing or 'content-length'}")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise BadArchive(f"content-length {n}, but {len(rest) - 4} bytes")
    block = rest[:n]
    if fields.get("warc-block-digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
        raise BadArchive("block digest")
    http, found, payload = block.partition(b"\r\n\r\n")
    lengths = [v for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.lower() == b"content-length"]
    if not found or len(lengths) != 1 or not lengths[0].strip().isdigit():
        raise BadArchive("HTTP head")
    size, kind = int(lengths[0]), fields["warc-type"]
    told = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and (size != len(payload) or told != digest(payload)):
        raise BadArchive("payload length or digest")
    if kind not in ("response", "revisit") or kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise BadArchive(f"record of type {kind}")
    return {
        "page_id": _number(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": told,
        "record_type": kind,
        "refers_to": _number(fields["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


# --- archives --------------------------------------------------------------------------------------------


class _Writer:
    """One archive; its dictionary comes from the records that are held back at first."""

    def __init__(self, root: str):
        self.path = f"{root}/{uuid.uuid4().hex}.warc.zst"
        system, inner = _file(self.path)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(inner, compression=None)
        self.held, self.held_bytes, self.n, self.size, self.compressor = [], 0, 0, 0, None

    def _begin(self) -> None:
        try:
            words = zstandard.train_dictionary(DICTIONARY_BYTES, self.held)
        except zstandard.ZstdError:  # too few or too small records to train on
            words = zstandard.ZstdCompressionDict(b"".join(self.held)[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        packed = zstandard.ZstdCompressor().compress(words.as_bytes())
        self._put(struct.pack("<II", _DICTIONARY_FRAME, len(packed)) + packed)
        self.compressor = zstandard.ZstdCompressor(dict_data=words, write_checksum=True)
        for data in self.held:
            self._put(self.compressor.compress(data))
        self.held = []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, data: bytes) -> None:
        self.n += 1
        if self.compressor:
            self._put(self.compressor.compress(data))
            return
        self.held.append(data)
        self.held_bytes += len(data)
        if self.held_bytes >= TRAINING_BYTES or self.n >= TRAINING_RECORDS:
            self._begin()

    def close(self) -> tuple[str, int, int]:
        if not self.compressor:
            self._begin()
        self.out.close()
        return self.path, self.n, self.size


def read_archive(uri: str) -> Iterator[dict]:
    """Records of an archive, one decoded frame at a time."""
    system, inner = _file(uri)
    with system.open_input_stream(inner, compression=None) as file:
        rest = file.read(8)
        if len(rest) < 8 or struct.unpack("<I", rest[:4])[0] != _DICTIONARY_FRAME:
            raise BadArchive("no dictionary frame")
        n = struct.unpack("<I", rest[4:])[0]
        words = file.read(n)
        if len(words) != n:
            raise BadArchive("dictionary frame is cut off")
        if words[:4] == _ZSTD_MAGIC:
            words = zstandard.ZstdDecompressor().decompressobj().decompress(words)
        decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words))
        data = file.read(READ_BYTES)
        while data:
            if data[:4] != _ZSTD_MAGIC[: len(data[:4])]:
                raise BadArchive("not a frame")
            frame, parts = decoder.decompressobj(), []
            while True:
                try:
                    parts.append(frame.decompress(data))
                except zstandard.ZstdError as error:
                    raise BadArchive(str(error)) from error
                if frame.eof:
                    break
                data = file.read(READ_BYTES)
                if not data:
                    raise BadArchive("frame is cut off")
            yield parse(b"".join(parts))
            data = frame.unused_data
            if len(data) < 4:
                data += file.read(READ_BYTES)


def write_archives(pages: DataFrame, root: str, min_revisit: int = 0, archive_bytes: int = ARCHIVE_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write pages (page_id, url, html) as archives under ``root``; returns (path, n_records, n_bytes) of each archive."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "utf-8")))
    large = rows.filter(F.octet_length("html") >= min_revisit).groupBy("digest")
    copied = large.agg(F.count("*").alias("n"), F.max("page_id").alias("kept")).filter("n > 1 and kept is not null")
    refers = (F.octet_length("html") >= min_revisit) & ~F.col("page_id").eqNullSafe(F.col("kept"))
    rows = rows.join(settle(copied.drop("n"), "copied"), "digest", "left").select(
        "page_id", "url", "html", F.when(refers, F.col("kept")).alias("refers_to")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            for page, url, html, refers_to in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to"))):
                writer = writer or _Writer(root)
                writer.add(record(page.as_py(), url.as_py(), html.as_py().encode(), refers_to.as_py(), date))
                if writer.size >= archive_bytes:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        columns = list(zip(*done)) or [[], [], []]
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "n_records", "n_bytes"])

    return settle(rows.mapInArrow(run, "path string, n_records long, n_bytes long"), "archives")


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of the listed archives (path), one task for each archive as far as there are tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {
            "page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
            "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary(),
        }
        names = [k for k in kinds if payloads or k != "payload"]

        def out(held: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], kinds[k]) for k in names], names)

        held, size = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for found in read_archive(path):
                    held.append(found)
                    size += found["payload_bytes"] + 200
                    if size >= 8_000_000:
                        yield out(held)
                        held, size = [], 0
        yield out(held)

    made = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    some = archives.select("path").repartition(max(1, archives.count()))
    return some.mapInArrow(run, made + (", payload binary" if payloads else ""))


def archive_root(spark: SparkSession) -> str:
    """A new folder for archives in the shared folder."""
    return shared_dir(spark, "warc")
