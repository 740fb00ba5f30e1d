"""WARC archives compressed record by record with an embedded Zstandard dictionary.

An archive (``.warc.zst``) starts with a skippable frame that holds a
dictionary built from its own first records; every record then is a frame of
its own, compressed with that dictionary, so a reader can start at any
record.  Records whose payload equals another's are ``revisit`` records that
refer to the one kept in full.

Tasks write archives under names of their own into a shared folder and
return their manifest rows; only archives in the written manifest count, so
a task that ran twice leaves at most an unlisted file.

Defined cases: a null html is an empty payload; a null url or page_id leaves
its header out and reads back as null; a group of equal payloads whose ids
are all null has no revisits; rows that repeat the id of a group's response
are responses too; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertally.llm.common import BROADCAST_ROWS, bounded_broadcast, map_arrow, pieces, staged
from ordertally.session import scratch_path

# Payloads of fewer bytes are always kept in full.
REVISIT_BYTES = 1000
ARCHIVE_BYTES = 128 << 20  # uncompressed record bytes after which a new archive begins
SAMPLE_BYTES = 8 << 20  # of records that a dictionary is built from
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
# Pages carry no capture time; records need one.
WARC_DATE = "1970-01-01T00:00:00Z"

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _clean(value: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def _record_id(page_id: int | None, digest: bytes) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest.hex()}')}>"


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record: a response, or a revisit of the page ``refers_to``."""
    digest = hashlib.sha1(payload).digest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _record_id(page_id, digest),
        "WARC-Date": WARC_DATE,
        "WARC-Target-URI": None if url is None else _clean(url),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(digest).decode(),
        "WARC-Profile": None if refers_to is None else REVISIT_PROFILE,
        "WARC-Refers-To": None if refers_to is None else _record_id(refers_to, digest),
        "Page-ID": page_id,
        "Refers-To-Page-ID": refers_to,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an uncompressed WARC stream."""
    f = io.BufferedReader(stream, 1 << 20) if not isinstance(stream, io.BufferedReader) else stream
    while line := f.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        head = {}
        while (line := f.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().partition(":")
            head[k.strip().lower()] = v.strip()
        size = int(head["content-length"])
        block = f.read(size)
        if len(block) != size:
            raise ValueError("a WARC record is cut off")
        yield head, block


def record_row(head: dict[str, str], block: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of a record read back."""
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda k: int(head[k]) if k in head else None
    if head["warc-type"] == "response":
        return number("page-id"), len(payload), hashlib.sha1(payload).hexdigest(), "response", None
    fields = dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:])
    digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
    return number("page-id"), int(fields[b"Content-Length"]), digest, "revisit", number("refers-to-page-id")


def build_dictionary(records: list[bytes]) -> bytes:
    """A trained dictionary, or the records' own tail where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-DICTIONARY_BYTES:]


class ArchiveWriter:
    """Writes records to a binary stream; holds back the first ones for the dictionary."""

    def __init__(self, out):
        self.out, self.held, self.size, self.records, self.compressor = out, [], 0, 0, None

    def add(self, record: bytes) -> None:
        self.size += len(record)
        self.records += 1
        if self.compressor is None:
            self.held.append(record)
            if self.size >= SAMPLE_BYTES:
                self._begin()
        else:
            self.out.write(self.compressor.compress(record))

    def _begin(self) -> None:
        dictionary = build_dictionary(self.held)
        self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
        shared = zstandard.ZstdCompressionDict(dictionary)
        shared.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(dict_data=shared, level=LEVEL)
        for record in self.held:
            self.out.write(self.compressor.compress(record))
        self.held = []

    def close(self) -> None:
        if self.compressor is None:
            self._begin()
        self.out.close()


def read_archive(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of an archive, using the dictionary of its leading frame."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive has no leading dictionary frame")
    shared = zstandard.ZstdCompressionDict(stream.read(size))
    reader = zstandard.ZstdDecompressor(dict_data=shared).stream_reader(stream, read_across_frames=True)
    yield from parse_records(reader)


def _located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path.split("/", 1)[0] else (fs.LocalFileSystem(), path)


def with_record_types(pages: DataFrame, max_broadcast: int = BROADCAST_ROWS // 4) -> DataFrame:
    """(page_id, url, payload, refers_to): the page a revisit refers to, null for responses.

    Only digests that occur twice or more take part in the join; they are few
    and broadcast if they are at most ``max_broadcast``.  Otherwise pages are
    joined on the digest, small payloads on a key of their own, and a group
    of very many equal payloads is split by the adaptive skew join.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    long_enough = F.octet_length("payload") >= REVISIT_BYTES
    rows = rows.withColumn(
        "digest", F.when(long_enough, F.sha1("payload")).otherwise(F.concat_ws(":", F.lit("own"), "page_id"))
    )
    groups = (
        rows.filter(long_enough)
        .groupBy("digest")
        .agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "kept")
    )
    joined = rows.join(bounded_broadcast(groups, max_broadcast), "digest", "left")
    again = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("kept")), F.col("kept"))
    return joined.select("page_id", "url", "payload", again.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages to archives in ``folder``; returns the manifest (path, records, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = _located(folder)
        where.create_dir(root, recursive=True)
        writer, path, made = None, "", []

        def finish() -> None:
            writer.close()
            made.append((path, writer.records, where.get_file_info(_located(path)[1]).size))

        for b in pieces(batches):
            for page_id, url, payload, refers_to in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if writer is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
                    writer = ArchiveWriter(where.open_output_stream(_located(path)[1], compression=None))
                writer.add(warc_record(page_id, url, payload, refers_to))
                if writer.size >= ARCHIVE_BYTES:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        if made:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*made), (pa.string(), pa.int64(), pa.int64()))],
                ["path", "records", "bytes"],
            )

    rows = map_arrow(with_record_types(pages), run, "path string, records long, bytes long")
    return staged(pages.sparkSession, rows, "warc-manifest")


ROW = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(manifest: DataFrame) -> DataFrame:
    """A row per record of the archives in a manifest, read from the archives themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in ROW.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        pack = lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*rows), types, strict=True)], names
        )
        rows = []
        for b in batches:
            for path in b.column(0).to_pylist():
                where, at = _located(path)
                with where.open_input_stream(at, compression=None) as f:
                    for head, block in read_archive(f):
                        rows.append(record_row(head, block))
                        if len(rows) >= 10_000:
                            yield pack(rows)
                            rows = []
        if rows:
            yield pack(rows)

    # One archive a task, as far as there are cores.
    spread = manifest.select("path").repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism), "path")
    return map_arrow(spread, run, ROW)


def op8(pages: DataFrame) -> DataFrame:
    folder = scratch_path(pages.sparkSession, f"warc-{uuid.uuid4().hex}")
    return read_archives(write_archives(pages, folder))
