"""WARC archives compressed with Zstandard: one frame per record, the dictionary in front.

An archive starts with a skippable frame that holds the dictionary; each record is a frame of its own
after it, so a record can be read by its offset alone. The reader loads the dictionary, itself compressed or
not, decodes frame by frame in time that grows with the bytes, and validates versions, headers, lengths and digests.
It reads archives of other writers too: field names in any case, repeated and folded fields, responses without
digest or length or sent in chunks, revisits that name nothing, and records of other types, which it passes over.

Archives are written by the tasks to the folder that all executors share, through the file system its
address names. A table lists the archives that Spark took as written, so the leavings of lost or repeated
tasks are never read.

Odd rows: a null page counts as empty, a null url leaves its header out, null ids come last among equal payloads;
repeated rows are records of their own, of which the first is the response; no rows make no archive; other columns
are not read, whatever their names. A record is held in memory whole, an archive up to its size.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.frames import materialise, numbered
from freshet.session import scratch_dir

SKIPPABLE = 0x184D2A5D
_SKIPPABLES = range(0x184D2A50, 0x184D2A60)
_ZSTD = b"\x28\xb5\x2f\xfd"
# Bytes of an archive that a record's decoding is first given; as many again, and so on, until it ends.
WINDOW = 2**12
ARCHIVE_BYTES = 32 * 2**20
DICT_SAMPLES = 200
DICT_SAMPLE_BYTES = 4096
DICT_BYTES = 32 * 2**10
MIN_PAYLOAD = 0
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


class BadRecord(ValueError):
    """An archive that breaks the format: where and how."""


class Fields(dict):
    """Header fields; their names count the same in any case."""

    def __setitem__(self, name: str, value: str) -> None:
        super().__setitem__(name.lower(), value)

    def __getitem__(self, name: str) -> str:
        return super().__getitem__(name.lower())

    def __contains__(self, name: object) -> bool:
        return isinstance(name, str) and super().__contains__(name.lower())

    def get(self, name: str, default: str | None = None) -> str | None:
        return super().get(name.lower(), default)


@dataclass
class Record:
    headers: Fields
    block: bytes
    offset: int = 0
    http: Fields = field(default_factory=Fields)
    payload: bytes = b""


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def encode_record(page_id: int | None, url: str | None, payload: bytes, revisit_of: int | None, revisit: bool) -> bytes:
    """A response with its payload, or a revisit with the HTTP headers alone. Null urls leave their
    header out; characters that would end a header line are percent-encoded."""
    block = _HTTP + str(len(payload)).encode() + b"\r\n\r\n" + (b"" if revisit else payload)
    headers = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": record_id(page_id), "WARC-Date": DATE}
    if url is not None:
        headers["WARC-Target-URI"] = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    headers["WARC-Payload-Digest"] = f"sha1:{sha1_base32(payload)}"
    if revisit:
        headers |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(revisit_of)}
    headers |= {"Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return b"WARC/1.1\r\n" + head.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def dictionary(samples: list[bytes]) -> bytes:
    """A dictionary trained on the records' first bytes; the samples themselves where they are too few."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICT_BYTES] or b"WARC/1.1\r\n"


def encode_archive(records: list[bytes]) -> bytes:
    words = dictionary([r[:DICT_SAMPLE_BYTES] for r in records[:DICT_SAMPLES]])
    packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(words), write_checksum=True)
    return struct.pack("<II", SKIPPABLE, len(words)) + words + b"".join(map(packer.compress, records))


def parse_record(raw: bytes, offset: int = 0) -> Record:
    """The record, or `BadRecord` if its version, headers, length, end or digest are not as they should."""

    def fail(why: str) -> BadRecord:
        return BadRecord(f"record at {offset}: {why}")

    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not mark or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise fail("no WARC version line or no end of headers")
    headers = _headers(lines[1:], fail)
    missing = [name for name in ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length") if name not in headers]
    if missing:
        raise fail(f"without {missing}")
    if not headers["Content-Length"].isdigit():
        raise fail("Content-Length is not a number")
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise fail(f"{len(rest) - 4} bytes of content and end, {length} announced")
    record = Record(headers, rest[:length], offset)
    kind = headers["WARC-Type"].lower()
    if kind == "response":
        record.payload = record.block
        if headers.get("Content-Type", "application/http").lower().startswith("application/http"):
            _read_http(record, fail)
            announced = record.http.get("Content-Length")
            if announced is not None and announced != str(len(record.payload)):
                raise fail(f"payload of {len(record.payload)} bytes, {announced} announced")
            if "chunked" in record.http.get("Transfer-Encoding", "").lower():
                record.payload = _unchunked(record.payload)
        method, _, digest = headers.get("WARC-Payload-Digest", "").partition(":")
        if method.lower() == "sha1" and digest.upper() != sha1_base32(record.payload):
            raise fail("payload digest differs")
    elif kind == "revisit" and record.block:
        _read_http(record, fail)
        if record.payload:
            raise fail("a revisit has no payload")
    return record


def _read_http(record: Record, fail) -> None:
    """Take the block apart into HTTP fields and payload."""
    head, mark, record.payload = record.block.partition(b"\r\n\r\n")
    status, *fields = head.decode("latin-1").split("\r\n")
    if not mark or not status.startswith("HTTP/"):
        raise fail("no HTTP headers")
    record.http = _headers(fields, fail)


def _unchunked(body: bytes) -> bytes:
    """A body sent in chunks, put together; as it is if its chunks do not add up (some writers store it so)."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at, at + 1024)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,8}", size):
            return body
        n, at = int(size, 16), end + 2
        if n == 0:
            return b"".join(parts)
        if body[at + n : at + n + 2] != b"\r\n":
            return body
        parts.append(body[at : at + n])
        at += n + 2


def _headers(lines: Iterable[str], fail) -> Fields:
    """Fields by name. Those that come again are joined, but for the ones a record has once; a line that starts with
    white space goes on with the one before."""
    out, name = Fields(), ""
    for line in lines:
        if line[:1] in (" ", "\t") and name:
            out[name] = f"{out[name]} {line.strip()}"
            continue
        name, mark, value = line.partition(":")
        name = name.strip()
        if not mark or not name:
            raise fail(f"header line {line[:60]!r}")
        if name in out and name.lower() in _SINGLE and out[name] != value.strip():
            raise fail(f"header {name} twice")
        out[name] = f"{out[name]}, {value.strip()}" if name in out and name.lower() not in _SINGLE else value.strip()
    return out


_SINGLE = frozenset(("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"))


def read_archive(data: bytes) -> Iterator[Record]:
    """Its records in order; memory holds the archive and one record."""
    if len(data) < 8:
        raise BadRecord("shorter than a frame")
    magic, size = struct.unpack_from("<II", data)
    words, at = None, 0
    if magic == SKIPPABLE and len(data) >= 8 + size:
        given, at = data[8 : 8 + size], 8 + size
        if given.startswith(_ZSTD):
            given = zstandard.ZstdDecompressor().decompressobj().decompress(given)
        words = zstandard.ZstdCompressionDict(given)
    elif not data.startswith(_ZSTD):
        raise BadRecord("no dictionary frame in front")
    unpack, view = zstandard.ZstdDecompressor(dict_data=words), memoryview(data)
    while at < len(data):
        if len(data) - at >= 8:
            magic, size = struct.unpack_from("<II", data, at)
            if magic in _SKIPPABLES:
                at += 8 + size
                continue
        unpacker, parts, fed, window = unpack.decompressobj(), [], at, WINDOW
        while not unpacker.eof and fed < len(data):
            try:
                parts.append(unpacker.decompress(view[fed : fed + window]))
            except zstandard.ZstdError as why:
                raise BadRecord(f"frame at {at}: {why}") from why
            fed, window = min(len(data), fed + window), 2 * window
        if not unpacker.eof:
            raise BadRecord(f"frame at {at}: cut off")
        yield parse_record(b"".join(parts), at)
        at = fed - len(unpacker.unused_data)


def _file_system(address: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(address if "://" in address or address.startswith("file:") else f"file://{address}")


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows (`page_id`, `url`, `payload`, `revisit`, `refers_to`) as archives of about
    `archive_bytes` of records; the table of archives: `path`, `n_records`, `n_bytes`."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        system, root = _file_system(folder)
        system.create_dir(root)

        def close(held: list[bytes]) -> pd.DataFrame:
            path, data = f"{root}/{uuid.uuid4().hex}.warc.zst", encode_archive(held)
            with system.open_output_stream(path, compression=None) as out:
                out.write(data)
            return pd.DataFrame({"path": [path], "n_records": [len(held)], "n_bytes": [len(data)]})

        held, size = [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to", "revisit")]
            for values in zip(*columns, strict=True):
                page_id, url, payload, refers_to, revisit = (v.as_py() for v in values)
                held.append(encode_record(page_id, url, payload or b"", refers_to, revisit))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield close(held)
                    held, size = [], 0
        if held:
            yield close(held)

    def arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in each(batches):
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    return materialise(records.mapInArrow(arrow, "path string, n_records long, n_bytes long"), "archives")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """The responses and revisits of the listed archives: `record_id`, `record_type`, `url`, `payload_bytes`,
    `payload_digest`, `refers_to_id`, and `payload` (null for a revisit, whose length and digest are those it
    states, if any). A bad record fails the read."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _file_system(folder)
        names = ["record_id", "record_type", "url", "payload_bytes", "payload_digest", "refers_to_id", "payload"]
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with system.open_input_stream(path, compression=None) as stream:
                    data = stream.read()
                rows, size = [], 0
                for r in read_archive(data):
                    kind = r.headers["WARC-Type"].lower()
                    if kind not in ("response", "revisit"):
                        continue
                    response, stated = kind == "response", r.http.get("Content-Length", "")
                    length = len(r.payload) if response else int(stated) if stated.isdigit() else None
                    told = sha1_base32(r.payload) if response else r.headers.get("WARC-Payload-Digest", "").partition(":")[2] or None
                    rows.append((r.headers["WARC-Record-ID"], kind, r.headers.get("WARC-Target-URI"), length, told,
                                 r.headers.get("WARC-Refers-To"), r.payload if response else None))
                    size += len(r.payload)
                    if size > 8 * 2**20 or len(rows) == 5000:
                        yield _batch(rows, names, kinds)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names, kinds)

    schema = "record_id string, record_type string, url string, payload_bytes long, payload_digest string, refers_to_id string, payload binary"
    return archives.select("path").repartition(max(1, archives.sparkSession.sparkContext.defaultParallelism)).mapInArrow(each, schema)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def with_revisits(pages: DataFrame, min_payload: int = MIN_PAYLOAD, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """`page_id`, `url`, `payload`, `revisit`, `refers_to` of every page.

    Of pages with equal payloads of at least `min_payload` bytes, the one with the smallest id (null
    last, then the first in the files) is the response that the others revisit. Payloads are compared by
    SHA-256 and length; only ids and digests are grouped, and the join back of a payload that very many
    pages share is split by AQE. A null page counts as empty.
    """
    rows = numbered(pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload")))
    keyed = rows.withColumn("_key", F.sha2("payload", 256))
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "_row"))
    groups = keyed.filter(F.length("payload") >= min_payload).groupBy("_key").agg(first.alias("f"), F.count(F.lit(1)).alias("n"))
    shared = materialise(groups.filter("n > 1").select("_key", F.col("f.page_id").alias("_first"), F.col("f._row").alias("_first_row")), "payloads")
    # Payloads stay where they are: what is joined to ids and digests decides, and only revisits leave
    # their payload behind.
    return keyed.join(shared, "_key", "left").withColumn("revisit", F.coalesce(F.col("_first_row") != F.col("_row"), F.lit(False))).select(
        "page_id", "url", "payload", "revisit", F.when(F.col("revisit"), F.col("_first")).alias("refers_to")
    )


def archived(pages: DataFrame, min_payload: int = MIN_PAYLOAD, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the pages as archives below the shared folder and read them back."""
    folder = scratch_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(with_revisits(pages, min_payload), folder, archive_bytes), folder)


def digest(records: DataFrame, id_type: str = "long") -> DataFrame:
    number = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(.*)>$", 1), F.lit("")).cast(id_type)
    return records.select(
        number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number(F.col("refers_to_id")).alias("refers_to"),
    )
