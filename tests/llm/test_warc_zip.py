import hashlib
import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from floe.llm import warc_zip
from floe.session import scratch_path


def package(records, **kw):
    raw = io.BytesIO()
    warc_zip.write_package(raw, iter(records), kw.get("max_bytes", 1 << 30))
    return raw


RECORDS = [("1", "http://a/ü?q=1", b"hello", hashlib.sha1(b"hello").hexdigest(), None), ("2", None, b"", hashlib.sha1(b"").hexdigest(), None),
           ("3", "http://b/\r\nX: y", b"z" * 2000, hashlib.sha1(b"z" * 2000).hexdigest(), "9"), ("4", "", b"\r\n\r\n\0\xff", hashlib.sha1(b"\r\n\r\n\0\xff").hexdigest(), None)]


def test_directory_as_zipfile_reads_it():
    raw = package(RECORDS)
    ours = {m.name: m for m in warc_zip.members(raw, len(raw.getvalue()))}
    with zipfile.ZipFile(raw) as z:
        assert list(ours) == z.namelist()
        for i in z.infolist():
            m = ours[i.filename]
            assert (m.method, m.size, m.packed, m.header) == (0, i.file_size, i.compress_size, i.header_offset)
            assert warc_zip.read_at(raw, warc_zip.stored_at(raw, m), m.size) == z.read(i)
            assert b"\n".join(warc_zip.member_lines(raw, m, 7)) == z.read(i).rstrip(b"\n")


def test_zip64_directory():
    """A package whose every size and offset is in the ZIP64 fields."""
    name, data = b"archive/x", b"0123456789"
    local = struct.pack("<4s5H3I2H", b"PK\3\4", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, 10, 10)
    central = struct.pack("<4s6H3I5H2I", b"PK\1\2", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 28, 0, 0, 0, 0, 0xFFFFFFFF) + name + struct.pack("<HHQQQ", 1, 24, 10, 10, 5)
    body = b"junk!" + local + data
    end64 = struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, 45, 45, 0, 0, 1, 1, len(central), len(body))
    locator = struct.pack("<4sIQI", b"PK\6\7", 0, len(body) + len(central), 1)
    end = struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 7) + b"PK\5\6..."[:7]
    raw = io.BytesIO(body + central + end64 + locator + end)
    m, = warc_zip.members(raw, len(raw.getvalue()))
    assert (m.name, m.size, m.header) == ("archive/x", 10, 5)
    assert warc_zip.read_at(raw, warc_zip.stored_at(raw, m), 10) == data


def test_broken_and_compressed_packages_are_refused():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/data.warc.gz", b"a" * 1000)
    m, = warc_zip.members(raw, len(raw.getvalue()))
    with pytest.raises(ValueError, match="compressed"):
        warc_zip.stored_at(raw, m)
    with pytest.raises(ValueError, match="central directory"):
        warc_zip.members(io.BytesIO(b"not a zip"), 9)


def test_records_round_trip_and_tampering_is_found():
    for page, url, payload, digest, refers_to in RECORDS:
        r = warc_zip.parse_record(warc_zip.warc_record(page, url, payload, digest, refers_to))
        assert (r["page"], r["url"], r["digest"], r["refers_to"], r["payload_bytes"]) == (page, url, digest, refers_to, len(payload))
        assert r["payload"] == (None if refers_to else payload) and r["type"] == ("revisit" if refers_to else "response")
    with pytest.raises(ValueError, match="digest"):
        warc_zip.parse_record(warc_zip.warc_record("1", None, b"x", hashlib.sha1(b"y").hexdigest(), None))


def test_packages_are_closed_at_their_size(spark):
    rows = [(str(i), None, f"{i} ".encode() * 400, hashlib.sha1(f"{i} ".encode() * 400).hexdigest(), None) for i in range(50)]
    df = spark.createDataFrame(rows, "page string, url string, payload binary, digest string, refers_to string").coalesce(2)
    packages = warc_zip.write_packages(df, scratch_path(spark, "warc-test"), max_bytes=1500)
    assert packages.count() > 4 and packages.agg(F.sum("records")).first()[0] == 50
    got = warc_zip.read_records(warc_zip.record_ranges(packages)).collect()
    assert sorted((r.page, bytes(r.payload)) for r in got) == sorted((r[0], r[2]) for r in rows)


def test_messy_pages(spark):
    big, other = "b" * 1500, "ü" * 600
    rows = [(1, "u1", big), (2, "u2", big), (5, None, big), (5, None, big), (None, "u\n3", big), (3, "u", other), (4, "u", other), (6, "s", "small"), (7, "s", "small"),
            (8, None, None), (9, "e", ""), (None, None, other + "!"), (None, None, other + "!"), (10, "l", "long " * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("page", "digest", "n", "id", "payload", "path", "size")})
    got = warc_zip.round_trip(spark, df, payload=True).collect()
    best = {big: 5, other: 4}
    want = []
    for i, u, h in rows:
        data = (h or "").encode()
        refers = best.get(h) if best.get(h) != i else None
        want.append(("" if i is None else str(i), u, "revisit" if refers else "response", hashlib.sha1(data).hexdigest(), str(refers) if refers else None, len(data),
                     None if refers else data))
    assert sorted(((r.page, r.url, r.type, r.digest, r.refers_to, r.payload_bytes, None if r.payload is None else bytes(r.payload)) for r in got), key=str) == sorted(want, key=str)
    assert warc_zip.round_trip(spark, df.limit(0)).count() == 0
