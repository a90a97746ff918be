"""WARC records in ZIP packages, read in place.

A package holds ``archive/data.warc.gz`` (one gzip member per record) and ``indexes/index.cdxj``, both stored
without further compression, so that a record is a byte range of the package. The reader parses the end of
central directory, its ZIP64 counterpart where sizes or offsets ask for it, and the central directory;
finds the stored members through their local headers; reads the index; and range-reads records.
Nothing is extracted.

Writing: each task writes its own packages in the shared folder and returns a row for each; a package of a
lost or repeated attempt is in no such row and is never read. Packages are closed at ``max_bytes``.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floe.operators.joins import fits_broadcast
from floe.session import materialize, scratch_path

MIN_REVISIT_BYTES = 1000
MAX_PACKAGE_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records next to each other are read together up to this many bytes.
READ_BYTES = 4 << 20
#: Bytes of a package that one task reads in a row.
STRETCH_BYTES = 32 << 20


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


# -- ZIP ----------------------------------------------------------------------------------------------

@dataclass
class Member:
    name: str
    method: int
    size: int
    packed: int
    header: int  # offset of the local header


def read_at(f, offset: int, n: int) -> bytes:
    f.seek(offset)
    data = f.read(n)
    if len(data) != n:
        raise ValueError(f"{n} bytes asked for at {offset}, {len(data)} there")
    return data


def members(f, size: int) -> list[Member]:
    """Entries of the central directory of an open package of ``size`` bytes."""
    tail = read_at(f, max(0, size - 65_557), min(size, 65_557))
    at = tail.rfind(b"PK\5\6")
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(b"PK\5\6", 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    end = size - len(tail) + at
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        sign, _, where, _ = struct.unpack("<4sIQI", read_at(f, end - 20, 20))
        if sign != b"PK\6\7":
            raise ValueError("no ZIP64 locator")
        record = read_at(f, where, 56)
        if record[:4] != b"PK\6\6":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, at, out = read_at(f, start, length), 0, []
    for _ in range(count):
        if directory[at: at + 4] != b"PK\1\2":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, full, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", directory, at + 20)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46: at + 46 + n_name]
        extra = directory[at + 46 + n_name: at + 46 + n_name + n_extra]
        e = 0
        while e + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, e)
            if kind == 1:  # ZIP64: only the fields that are full, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, e + 4))
                full = next(wide) if full == 0xFFFFFFFF else full
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            e += 4 + n
        out.append(Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, full, packed, header))
        at += 46 + n_name + n_extra + n_note
    return out


def stored_at(f, m: Member) -> int:
    """Offset of the first byte of a stored member."""
    if m.method != 0 or m.size != m.packed:
        raise ValueError(f"{m.name} is compressed in its package and can't be read in ranges")
    head = read_at(f, m.header, 30)
    if head[:4] != b"PK\3\4":
        raise ValueError("no local header")
    return m.header + 30 + sum(struct.unpack_from("<HH", head, 26))


def member_lines(f, m: Member, piece: int = 1 << 20) -> Iterator[bytes]:
    at, left, rest = stored_at(f, m), m.size, b""
    while left:
        data = rest + read_at(f, at, min(piece, left))
        at, left = at + min(piece, left), left - min(piece, left)
        lines = data.split(b"\n")
        rest = lines.pop()
        yield from lines
    if rest:
        yield rest


# -- WARC ----------------------------------------------------------------------------------------------

def warc_record(page: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str = DATE) -> bytes:
    """One gzip member: a response with its payload, or a revisit of another record without it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {date}"]
    if url is not None:
        plain = "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in url)
        head.append(f"WARC-Target-URI: {plain}")
        if plain != url:
            head.append(f"X-Target-Verbatim: {json.dumps(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", compresslevel=3, mtime=0)


def parse_record(packed: bytes) -> dict:
    """A record's page, url, type, digest, refers_to, payload and payload_bytes (of the full payload)."""
    data = zlib.decompress(packed, wbits=31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    field = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(field["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a WARC record of another length than it says")
    http, _, payload = block.partition(b"\r\n\r\n")
    full = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    if field["WARC-Type"] == "response" and (len(payload) != full or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {field['WARC-Record-ID']} differs from its digest")
    url = json.loads(field["X-Target-Verbatim"]) if "X-Target-Verbatim" in field else field.get("WARC-Target-URI")
    page = lambda key: field[key][len("<urn:page:"):-1] if key in field else None
    return {"page": page("WARC-Record-ID"), "url": url, "type": field["WARC-Type"], "digest": digest, "refers_to": page("WARC-Refers-To"),
            "payload": payload if field["WARC-Type"] == "response" else None, "payload_bytes": full}


class _Counted(io.RawIOBase):
    """A write-only stream that knows its position (some stores' streams don't), for ``zipfile``."""

    def __init__(self, raw):
        self.raw, self.at = raw, 0

    def writable(self):
        return True

    def write(self, data):
        self.raw.write(bytes(data))
        self.at += len(data)
        return len(data)


def write_package(raw, records: Iterator[tuple[str, str | None, bytes, str, str | None]], max_bytes: int) -> int:
    """Writes records until ``max_bytes`` of them are written or none is left; returns their number."""
    out, index, done = _Counted(raw), [], 0
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        with z.open(zipfile.ZipInfo(WARC_MEMBER, (2024, 1, 1, 0, 0, 0)), "w", force_zip64=True) as m:
            for page, url, payload, digest, refers_to in records:
                data = warc_record(page, url, payload, digest, refers_to)
                m.write(data)
                index.append(f"{url or '-'} 20240101000000 ".replace("\n", "%0A").encode() + json.dumps(
                    {"offset": done, "length": len(data), "digest": f"sha1:{digest}", "recordid": page, "filename": WARC_MEMBER}).encode())
                done += len(data)
                if done >= max_bytes:
                    break
        z.writestr(zipfile.ZipInfo(INDEX_MEMBER, (2024, 1, 1, 0, 0, 0)), b"\n".join(index))
        z.writestr(zipfile.ZipInfo("datapackage.json", (2024, 1, 1, 0, 0, 0)), json.dumps({"profile": "data-package", "resources": [{"path": WARC_MEMBER}, {"path": INDEX_MEMBER}]}))
    return len(index)


# -- Spark -----------------------------------------------------------------------------------------------

def with_revisits(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``(page, url, payload, digest, refers_to)``: which page each page's record revisits, if any.

    Of equal payloads of ``min_bytes`` or more the largest id has the response. Null payloads are empty. Rows
    that share the largest id are all responses, as are rows whose group has null ids only; other rows with a null
    id revisit. Equality is that of length and SHA-1.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string").cast("binary"), F.lit(b""))
    d = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"))
    d = d.withColumns({"digest": F.sha1("payload"), "n": F.octet_length("payload")})
    first = (d.where(F.col("n") >= min_bytes).groupBy("digest", "n").agg(F.max("id").alias("best"), F.count("*").alias("m"))
             .where((F.col("m") > 1) & F.col("best").isNotNull()).select("digest", "n", "best"))
    first = materialize(first, "responses")
    # a broadcast only after its size is known; else a join whose hot digests Spark splits
    side = F.broadcast(first) if fits_broadcast(first, 16 << 20) else first
    d = d.join(side, ["digest", "n"], "left")
    refers = F.when(F.col("best").isNotNull() & ~F.col("id").eqNullSafe(F.col("best")), F.col("best").cast("string"))
    return d.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("page"), "url", "payload", "digest", refers.alias("refers_to"))


def write_packages(records: DataFrame, folder: str, *, max_bytes: int = MAX_PACKAGE_BYTES) -> DataFrame:
    """Writes ``(page, url, payload, digest, refers_to)`` rows to packages; returns ``(path, size, records)``, one row for each."""
    def rows(batches):
        for b in batches:
            for r in zip(*(b.column(c) for c in ("page", "url", "payload", "digest", "refers_to"))):
                yield tuple(x.as_py() for x in r)

    def run(batches):
        store, root = open_fs(folder)
        source, k = rows(batches), 0
        context = TaskContext.get()
        for head in source:
            def rest(head=head):
                yield head
                for r in source:  # not "yield from": a package that is full closes this generator, not the source
                    yield r
            name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{k:04d}-{uuid.uuid4().hex[:8]}.wacz"
            store.create_dir(root, recursive=True)
            with store.open_output_stream(f"{root}/{name}") as raw:
                n = write_package(raw, rest(), max_bytes)
            info = store.get_file_info(f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "size": [info.size], "records": [n]})
            k += 1
    return materialize(records.mapInArrow(run, "path string, size long, records long"), "packages")


def record_ranges(packages: DataFrame) -> DataFrame:
    """``(path, size)`` of packages -> ``(path, offset, length)`` of every record that an index member lists."""
    def run(batches):
        for b in batches:
            for path, size in zip(b.column("path").to_pylist(), b.column("size").to_pylist()):
                store, name = open_fs(path)
                with store.open_input_file(name) as f:
                    listed = {m.name: m for m in members(f, size)}
                    base: dict[str, int] = {}
                    at, n = [], []
                    for m in listed.values():
                        if not m.name.startswith("indexes/"):
                            continue
                        for line in member_lines(f, m):
                            if not line:
                                continue
                            entry = json.loads(line[line.index(b" {") + 1:])
                            archive = entry["filename"]
                            if archive not in base:
                                base[archive] = stored_at(f, listed[archive])
                            at.append(base[archive] + entry["offset"])
                            n.append(entry["length"])
                            if len(at) >= 50_000:
                                yield pa.RecordBatch.from_pydict({"path": [path] * len(at), "offset": at, "length": n})
                                at, n = [], []
                    if at:
                        yield pa.RecordBatch.from_pydict({"path": [path] * len(at), "offset": at, "length": n})
    return packages.select("path", "size").mapInArrow(run, "path string, offset long, length long")


_FIELDS = ("page", "url", "type", "digest", "refers_to", "payload_bytes", "payload")


def read_records(ranges: DataFrame, *, payload: bool = True, total_bytes: int = 0) -> DataFrame:
    """Records at ``(path, offset, length)``: page, url, type, digest, refers_to, payload_bytes and, if wanted, payload.

    Ranges are dealt out by stretches of a package, and neighbours are read together. ``total_bytes`` (of the
    packages) sets the number of tasks, as the ranges themselves are too small for Spark to tell.
    """
    tasks = max(ranges.sparkSession.sparkContext.defaultParallelism, -(-total_bytes // STRETCH_BYTES))
    want = _FIELDS if payload else _FIELDS[:-1]

    def stretches(batches):
        """(path, ranges that lie close together)"""
        path, held, end = None, [], 0
        for b in batches:
            for p, o, n in zip(*(b.column(c).to_pylist() for c in ("path", "offset", "length"))):
                if held and (p != path or o != end or o + n - held[0][0] > READ_BYTES):
                    yield path, held
                    held = []
                path, end = p, o + n
                held.append((o, n))
        if held:
            yield path, held

    def run(batches):
        opened, f = None, None
        for path, held in stretches(batches):
            if path != opened:
                if f is not None:
                    f.close()
                store, name = open_fs(path)
                f, opened = store.open_input_file(name), path
            first = held[0][0]
            data = read_at(f, first, held[-1][0] + held[-1][1] - first)
            rows = [parse_record(data[o - first: o - first + n]) for o, n in held]
            yield pa.RecordBatch.from_pydict({c: pa.array([r[c] for r in rows], {"payload": pa.binary(), "payload_bytes": pa.int64()}.get(c, pa.string())) for c in want})
        if f is not None:
            f.close()

    dealt = (ranges.withColumn("_s", F.floor(F.col("offset") / STRETCH_BYTES))
             .repartition(tasks, "path", "_s").sortWithinPartitions("path", "offset").select("path", "offset", "length"))
    kinds = {"payload": "binary", "payload_bytes": "long"}
    return dealt.mapInArrow(run, ", ".join(f"{c} {kinds.get(c, 'string')}" for c in want))


def round_trip(spark: SparkSession, pages: DataFrame, *, payload: bool = False, max_bytes: int = MAX_PACKAGE_BYTES, **columns: str) -> DataFrame:
    """Writes a record per page to packages in the shared folder and reads all of them back; see ``read_records``.

    One record per row, repeated rows too; other columns of ``pages`` are ignored; an empty table gives no record.
    """
    packages = write_packages(with_revisits(pages, **columns), scratch_path(spark, "warc"), max_bytes=max_bytes)
    total = packages.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    return read_records(record_ranges(packages), payload=payload, total_bytes=total)
