import base64
import hashlib
import time

import pytest
import zstandard
from corpus import table
from helpers import collected

from freshet.llm import warc
from freshet.llm.frames import materialise
from freshet.llm.warc import BadRecord, encode_archive, encode_record, parse_record, read_archive

RECORDS = [encode_record(i, f"https://e.org/{i}", f"<p>page {i}</p>".encode() * 5, None, False) for i in range(30)]


def test_round_trip():
    data = encode_archive([*RECORDS, encode_record(99, None, b"gone", 3, True)])
    found = list(read_archive(data))
    assert [r.payload for r in found[:-1]] == [f"<p>page {i}</p>".encode() * 5 for i in range(30)]
    assert found[-1].headers["WARC-Type"] == "revisit" and found[-1].headers["WARC-Refers-To"] == "<urn:page:3>"
    assert found[-1].http["Content-Length"] == "4" and "WARC-Target-URI" not in found[-1].headers
    # A record can be read by its offset alone, with the dictionary.
    at = found[7].offset
    words = zstandard.ZstdCompressionDict(data[8 : 8 + int.from_bytes(data[4:8], "little")])
    raw = zstandard.ZstdDecompressor(dict_data=words).decompressobj().decompress(data[at:])
    assert parse_record(raw).payload == found[7].payload


def test_urls_cannot_break_headers():
    record = parse_record(encode_record(None, "http://a/\r\nX: y z", b"", None, False))
    assert record.headers["WARC-Target-URI"] == "http://a/%0D%0AX:%20y%20z" and "X" not in record.headers


@pytest.mark.parametrize(
    "change",
    [
        lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"),
        lambda r: r.replace(b"WARC-Type: response\r\n", b""),
        lambda r: r.replace(b"WARC-Date", b"WARC-Type"),
        lambda r: r.replace(b"Content-Length: ", b"Content-Length: 1", 1),
        lambda r: r[:-4],
        lambda r: r.replace(b"page 3", b"page 4"),
        lambda r: r.replace(b"HTTP/1.1 200", b"FTP/1.1 200"),
    ],
)
def test_bad_records_are_refused(change):
    with pytest.raises(BadRecord):
        parse_record(change(RECORDS[3]))


@pytest.mark.parametrize("change", [lambda d: d[:5], lambda d: b"\0" * 4 + d[4:], lambda d: d[:-9], lambda d: d[:-20] + b"\0" * 20])
def test_bad_archives_are_refused(change):
    with pytest.raises(BadRecord):
        list(read_archive(change(encode_archive(RECORDS))))


def plain(rows):
    first = {}
    for page_id, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(html or "", page_id)
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        revisit = first[html or ""] != page_id
        out.append((page_id, len(raw), digest, "revisit" if revisit else "response", first[html or ""] if revisit else None))
    return sorted(out, key=repr)


def test_pages_through_archives(spark):
    rows = table("pages")
    rows += [(10_000 + r[0], None, r[2]) for r in rows[:40]] + [(20_000, "u", None), (20_001, None, ""), (None, None, "alone")]
    pages = materialise(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), "pages")
    assert collected(warc.digest(warc.archived(pages, archive_bytes=100_000))) == plain(rows)


def test_small_payloads_and_repeated_rows(spark):
    rows = [(1, "u", "abc"), (2, "u", "abc"), (2, "u", "abc"), (3, "u", "a" * 50), (4, "u", "a" * 50), (4, "u", "a" * 50)]
    pages = spark.createDataFrame([(*r, b"x", 3) for r in rows], "page_id long, url string, html string, payload binary, _row int")
    kinds = [(r["page_id"], r["record_type"]) for r in warc.digest(warc.archived(pages, min_payload=10)).collect()]
    assert sorted(kinds) == [(1, "response"), (2, "response"), (2, "response"), (3, "response"), (4, "revisit"), (4, "revisit")]
    assert warc.digest(warc.archived(pages.limit(0))).count() == 0
    bodies = warc.archived(pages).filter("record_type = 'response'").select("payload").collect()
    assert sorted(bytes(r["payload"]) for r in bodies) == [b"a" * 50, b"abc"]


def raw(kind, block, *fields, crlf=b"\r\n"):
    head = [b"WARC/1.0", b"warc-type: " + kind, b"warc-record-id: <urn:x:1>", b"WARC-DATE: 2024-01-01T00:00:00Z", *fields]
    return crlf.join([*head, b"content-length: " + str(len(block)).encode(), b"", b""]) + block + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nset-cookie: b=2\r\nX-Long: one\r\n two\r\n"


def test_records_of_other_writers():
    plain = parse_record(raw(b"response", HTTP + b"\r\nbody", b"content-type: application/http; msgtype=response"))
    assert plain.payload == b"body" and plain.http["SET-COOKIE"] == "a=1, b=2" and plain.http.get("x-long") == "one two"
    chunked = parse_record(raw(b"response", HTTP + b"Transfer-Encoding: chunked\r\n\r\n4;x=y\r\nbody\r\n3\r\n ok\r\n0\r\n\r\n"))
    assert chunked.payload == b"body ok"
    stored = parse_record(raw(b"response", HTTP + b"Transfer-Encoding: chunked\r\n\r\nnot in chunks"))
    assert stored.payload == b"not in chunks"
    digest = base64.b32encode(hashlib.sha1(b"body").digest()).lower()
    assert parse_record(raw(b"response", HTTP + b"\r\nbody", b"Warc-Payload-Digest: SHA1:" + digest)).payload == b"body"
    assert parse_record(raw(b"response", HTTP + b"\r\nbody", b"WARC-Payload-Digest: md5:abc")).payload == b"body"
    assert parse_record(raw(b"response", b"1.2.3.4", b"Content-Type: text/dns")).payload == b"1.2.3.4"
    assert parse_record(raw(b"revisit", b"")).payload == b""
    for bad in (raw(b"response", HTTP + b"\r\nbody", b"WARC-Payload-Digest: sha1:AAAA"), raw(b"response", HTTP + b"Content-Length: 9\r\n\r\nbody"), raw(b"revisit", HTTP + b"\r\nbody")):
        with pytest.raises(BadRecord):
            parse_record(bad)


def mixed_archive(records, compressed_dictionary):
    words = warc.dictionary(records * 9)
    given = zstandard.ZstdCompressor().compress(words) if compressed_dictionary else words
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(words))
    skipped = (0x184D2A50).to_bytes(4, "little") + (3).to_bytes(4, "little") + b"any"
    return warc.SKIPPABLE.to_bytes(4, "little") + len(given).to_bytes(4, "little") + given + skipped.join(map(packer.compress, records))


@pytest.mark.parametrize("compressed_dictionary", [False, True])
def test_a_mixed_archive_reads(spark, tmp_path, compressed_dictionary):
    records = [
        raw(b"warcinfo", b"software: x\r\n"), raw(b"request", b"GET / HTTP/1.1\r\n\r\n"), raw(b"response", HTTP + b"\r\nbody"),
        raw(b"metadata", b"k: v"), raw(b"revisit", b"", b"WARC-Refers-To: <urn:x:9>"), raw(b"conversion", b"text"),
    ]
    data = mixed_archive(records, compressed_dictionary)
    assert [r.headers["WARC-Type"] for r in read_archive(data)] == ["warcinfo", "request", "response", "metadata", "revisit", "conversion"]
    path = tmp_path / "a.warc.zst"
    path.write_bytes(data)
    listed = spark.createDataFrame([(str(path),)], "path string")
    rows = warc.read_archives(listed, str(tmp_path)).select("record_type", "payload_bytes", "payload_digest", "refers_to_id", "payload")
    assert collected(rows) == sorted([("response", 4, warc.sha1_base32(b"body"), None, bytearray(b"body")), ("revisit", None, None, "<urn:x:9>", None)], key=repr)


def test_an_archive_without_dictionary_reads():
    packer = zstandard.ZstdCompressor()
    assert [r.payload for r in read_archive(b"".join(map(packer.compress, RECORDS)))] == [r.payload for r in map(parse_record, RECORDS)]


def test_reading_takes_time_by_bytes():
    """Eight times the records take some eight times as long, not 64 times."""
    times = []
    for n in (2_500, 20_000):
        data = encode_archive(RECORDS * (n // 30))
        started = time.process_time()
        assert sum(1 for _ in read_archive(data)) == n // 30 * 30
        times.append(time.process_time() - started)
    assert times[1] < 20 * times[0]


def test_large_records_span_windows():
    body = bytes(range(256)) * 4_000
    data = encode_archive([encode_record(1, None, body, None, False), *RECORDS])
    assert next(read_archive(data)).payload == body and sum(1 for _ in read_archive(data)) == 31


def test_archives_lie_in_the_folder_as_they_are(spark, tmp_path):
    """The bytes of a file are those of an archive: nothing compresses them once more by its name."""
    rows = spark.createDataFrame([(i, "u", f"page {i}".encode(), False, None) for i in range(5)], "page_id long, url string, payload binary, revisit boolean, refers_to long")
    (path,) = [r["path"] for r in warc.write_archives(rows.coalesce(1), str(tmp_path)).collect()]
    with open(path, "rb") as file:
        assert [r.payload for r in read_archive(file.read())] == [f"page {i}".encode() for i in range(5)]
