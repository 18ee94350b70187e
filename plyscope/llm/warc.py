"""Web archives: a writer with revisit records and a reader that salvages damaged files.

Every record is a gzip member of its own (or plain, with ``compress=False``). The reader checks each record: the
member's checksum, the version line, the lengths, the block digest. After a failed check it searches for the next
gzip member or version line from which a valid record can be read, goes on there, and reports the bytes between as
a quarantined gap with the reason. Nothing behind damage is lost but the damaged records themselves.

NULL payloads count as empty. Records without a key keep a NULL key. Of rows with equal payloads of at least
``least`` bytes the smallest key is the response; the others revisit it (rows that repeat that key are responses).
Archives are written under names of their own, and only files that a finished task lists are ever read, so a task
that runs again leaves no doubles.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from plyscope.llm.common import stored
from plyscope.session import scratch_path

LEAST_BYTES = 100
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 20
HEADER_BYTES = 1 << 20
VERSION = b"WARC/"
MEMBER = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space for URLs (fixed value)


def record_id(key) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORDS, f'record:{key}')}>"


def record(key, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One record; a revisit has the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        "WARC-Type: " + ("response" if refers_to is None else "revisit"),
        f"WARC-Record-ID: {record_id(key)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url:
        lines.append("WARC-Target-URI: " + "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in url))
    if key is not None:
        lines.append(f"X-Key: {key}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Key: {refers_to}", f"WARC-Profile: {PROFILE}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_revisits(df: DataFrame, key: str, url: str, payload: str, least: int = LEAST_BYTES) -> DataFrame:
    """key, url, payload (binary), digest and refers_to of every row."""
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("key"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= least
    first = (
        rows.where(large).groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    )
    joined = rows.join(first.select("digest", "first"), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    return joined.select("key", "url", "payload", "digest", F.when(again, F.col("first")).alias("refers_to"))


def write_archives(
    df: DataFrame,
    folder: str | None = None,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = LEAST_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    compress: bool = True,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write the archives below a folder that all executors reach; returns the list of files: path, bytes, records."""
    folder = folder or scratch_path(df.sparkSession, "archives")
    rows = with_revisits(df, key, url, payload, least)
    listing = "path string, bytes long, records long"

    def write(batches):
        store, place = fs.FileSystem.from_uri(folder)
        store.create_dir(place, recursive=True)
        out, name, size, count = None, "", 0, 0
        for batch in batches:
            for k, u, body, digest, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc" + ".gz" * compress, 0, 0
                    out = store.open_output_stream(f"{place}/{name}", compression=None)
                data = record(k, u, body, digest, refers, date)
                if compress:
                    packer = zlib.compressobj(3, wbits=31)
                    data = packer.compress(data) + packer.flush()
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [size], "records": [count]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [size], "records": [count]})

    return stored(rows.mapInArrow(write, listing), "archive-list")


class Damage(Exception):
    """A check that a record failed."""


class Source:
    """A file read forwards, with the bytes from ``base`` on at hand."""

    def __init__(self, stream):
        self.stream, self.base, self.held, self.ended = stream, 0, bytearray(), False

    def more(self) -> bool:
        got = b"" if self.ended else self.stream.read(READ_BYTES)
        self.ended = not got
        self.held += got
        return bool(got)

    def have(self, to: int) -> bool:
        """Whether the bytes up to ``to`` exist."""
        while self.base + len(self.held) < to:
            if not self.more():
                return False
        return True

    def take(self, start: int, end: int) -> bytes:
        return bytes(self.held[start - self.base : end - self.base])

    def forget(self, before: int) -> None:
        if before - self.base >= READ_BYTES:
            del self.held[: before - self.base]
            self.base = before

    def find(self, what: bytes, start: int, limit: int | None = None) -> int:
        """Place of the next occurrence, or -1; reads on as far as ``limit`` bytes."""
        at = start
        while True:
            found = self.held.find(what, at - self.base)
            if found >= 0:
                return found + self.base
            end = self.base + len(self.held)
            if limit is not None and end - start > limit or not self.more():
                return -1
            at = max(start, end - len(what) + 1)


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", errors="replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise Damage("no version line")
    found = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damage("header line without a colon")
        found[name.strip().lower()] = value.strip()
    return found


def _checked(head: bytes, block: bytes) -> tuple[dict[str, str], bytes]:
    headers = _headers(head)
    kind, _, want = headers.get("warc-block-digest", "").partition(":")
    if kind == "sha256" and hashlib.sha256(block).hexdigest() != want:
        raise Damage("block digest differs")
    return headers, block


def _length(head: bytes) -> int:
    value = _headers(head).get("content-length", "")
    if not value.isascii() or not value.isdigit():
        raise Damage("no content length")
    return int(value)


def read_record(source: Source, at: int) -> tuple[int, dict[str, str], bytes]:
    """End, headers and block of the record at a place; raises Damage."""
    source.have(at + len(VERSION))
    start = source.take(at, at + len(VERSION))
    if start.startswith(MEMBER):
        return _member(source, at)
    if start == VERSION:
        stop = source.find(b"\r\n\r\n", at, HEADER_BYTES)
        if stop < 0:
            raise Damage("header without an end")
        head = source.take(at, stop)
        end = stop + 4 + _length(head)
        if not source.have(end + 4) or source.take(end, end + 4) != b"\r\n\r\n":
            raise Damage("record end is missing")
        return end + 4, *_checked(head, source.take(stop + 4, end))
    raise Damage("neither a member nor a version line")


def _member(source: Source, at: int) -> tuple[int, dict[str, str], bytes]:
    unpack, parts, place = zlib.decompressobj(wbits=31), [], at
    while not unpack.eof:
        if not source.have(place + 1):
            raise Damage("member is cut off")
        upto = min(place + READ_BYTES, source.base + len(source.held))
        try:
            parts.append(unpack.decompress(source.take(place, upto)))
        except zlib.error as error:
            raise Damage(f"member: {error}") from None
        place = upto
    data = b"".join(parts)
    stop = data.find(b"\r\n\r\n")
    if stop < 0:
        raise Damage("header without an end")
    end = stop + 4 + _length(data[:stop])
    if data[end:] != b"\r\n\r\n":
        raise Damage("record end is missing")
    return place - len(unpack.unused_data), *_checked(data[:stop], data[stop + 4 : end])


def salvage(stream) -> Iterator[tuple[str, int, int, str | None, dict[str, str], bytes]]:
    """('record' or 'gap', offset, length, reason, headers, block) through a file, in order and without overlap."""
    source, at = Source(stream), 0
    gap: tuple[int, str] | None = None
    while source.have(at + 1):
        try:
            end, headers, block = read_record(source, at)
        except Damage as damage:
            if gap is None:
                gap = (at, str(damage))
            starts = [x for x in (source.find(MEMBER, at + 1, READ_BYTES), source.find(VERSION, at + 1, READ_BYTES)) if x >= 0]
            held_to = source.base + len(source.held)
            at = min(starts) if starts else held_to if source.ended else max(at + 1, held_to - len(VERSION))
            source.forget(at)
            continue
        if gap is not None:
            yield "gap", gap[0], at - gap[0], gap[1], {}, b""
            gap = None
        yield "record", at, end - at, None, headers, block
        at = end
        source.forget(at)
    if gap is not None:
        yield "gap", gap[0], at - gap[0], gap[1], {}, b""


#: What the reader returns; ``gap`` rows have a reason and no record columns.
READ = (
    "path string, kind string, offset long, length long, reason string, record_type string, record_key long, url string, "
    "refers_to long, payload_length long, payload_digest string, payload binary, headers map<string,string>"
)


def read_archives(files: DataFrame, path: str = "path") -> DataFrame:
    """Records and quarantined gaps of the listed files, one task for each few files."""
    names = files.select(F.col(f"`{path}`").alias("path"))
    dealt = names.repartition(max(1, names.count()), "path")
    schema = pa.schema(
        [("path", pa.string()), ("kind", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("reason", pa.string()), ("record_type", pa.string()), ("record_key", pa.int64()), ("url", pa.string()), ("refers_to", pa.int64()), ("payload_length", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("headers", pa.map_(pa.string(), pa.string()))]
    )

    def number(value):
        return int(value) if value is not None else None

    def read(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                if name is None:
                    continue
                store, place = fs.FileSystem.from_uri(name)
                rows, held = [], 0
                with store.open_input_stream(place, compression=None) as stream:
                    for kind, offset, length, reason, headers, block in salvage(stream):
                        head = block.find(b"\r\n\r\n")
                        payload = block[head + 4 :] if headers.get("warc-type") == "response" and head >= 0 else None
                        digest = headers.get("warc-payload-digest", "").partition(":")[2] or None
                        rows.append((name, kind, offset, length, reason, headers.get("warc-type"), number(headers.get("x-key")), headers.get("warc-target-uri"), number(headers.get("x-refers-to-key")), number(headers.get("x-payload-length")), digest, payload, list(headers.items())))
                        held += len(block)
                        if held >= READ_BYTES * 4:
                            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return dealt.mapInArrow(read, READ)
