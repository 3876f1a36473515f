"""WARC records in ZIP archives: write them, and read single records by range.

An archive is a ZIP of two stored (uncompressed) members: ``archive/data.warc.gz``,
one gzip member a record, and ``indexes/index.cdxj``, one line a record with its
offset and length inside the first. Archives are written through
``pyarrow.fs`` to the shared folder (any file system that it opens).

The reader never unpacks an archive. It reads the tail, finds the end record
(and, behind its locator, the ZIP64 one), parses the central directory, finds
where each stored member's bytes begin from its local header, reads the index
member, and then each record by its own byte range.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.session import materialize, scratch_path

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
ARCHIVE_BYTES, MIN_REVISIT = 16 << 20, 100
#: Fixed: record signatures and the values that send a reader to the ZIP64 fields.
END, END64, LOCATOR64, CENTRAL, LOCAL = 0x06054B50, 0x06064B50, 0x07064B50, 0x02014B50, 0x04034B50
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF
TAIL = 22 + MAX16 + 20


class BadArchive(ValueError):
    """The bytes are not a ZIP archive that this reader can range-read."""


@dataclass
class Member:
    name: str
    method: int
    packed: int
    size: int
    header: int


def _at(f, start: int, length: int) -> bytes:
    f.seek(start)
    data = f.read(length)
    if len(data) != length:
        raise BadArchive(f"{length} bytes at {start} are not there")
    return data


def directory(f, size: int) -> list[Member]:
    """The members named by the central directory of an open file."""
    start = max(0, size - TAIL)
    tail = _at(f, start, size - start)
    at = len(tail)
    while True:  # a comment may hold the signature: the record must end with the file
        at = tail.rfind(struct.pack("<I", END), 0, at + 3 if at < len(tail) else at)
        if at < 0:
            raise BadArchive("no end of central directory")
        if len(tail) - at >= 22 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
        at -= 1
    count, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if count == MAX16 or length == MAX32 or offset == MAX32:
        where = start + at - 20
        if where < 0 or struct.unpack("<I", _at(f, where, 4))[0] != LOCATOR64:
            raise BadArchive("no ZIP64 locator")
        where = struct.unpack("<Q", _at(f, where + 8, 8))[0]
        end = _at(f, where, 56)
        if struct.unpack_from("<I", end)[0] != END64:
            raise BadArchive("no ZIP64 end record")
        count, length, offset = struct.unpack_from("<QQQ", end, 32)
    raw, at, out = _at(f, offset, length), 0, []
    for _ in range(count):
        if at + 46 > len(raw) or struct.unpack_from("<I", raw, at)[0] != CENTRAL:
            raise BadArchive("central directory is cut short")
        flags, method = struct.unpack_from("<HH", raw, at + 8)
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", raw, at + 20)
        header = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = raw[at + 46 + n_name:at + 46 + n_name + n_extra]
        wide = _zip64(extra, [full == MAX32, packed == MAX32, header == MAX32])
        full, packed, header = (w if w is not None else v for w, v in zip(wide, (full, packed, header), strict=True))
        out.append(Member(name, method, packed, full, header))
        at += 46 + n_name + n_extra + n_comment
    return out


def _zip64(extra: bytes, wanted: list[bool]) -> list[int | None]:
    """The 64-bit values of an extra field, for those that the header leaves out."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{min(length // 8, sum(wanted))}Q", extra, at + 4))
            return [next(values, None) if w else None for w in wanted]
        at += 4 + length
    if any(wanted):
        raise BadArchive("no ZIP64 extra field")
    return [None] * len(wanted)


def begin(f, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != 0:
        raise BadArchive(f"{member.name} is compressed; only stored members can be range-read")
    head = _at(f, member.header, 30)
    if struct.unpack_from("<I", head)[0] != LOCAL:
        raise BadArchive(f"{member.name} has no local header")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + n_name + n_extra


def _open(path: str):
    from pyarrow import fs
    system, inner = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
    return system, inner


def _field(value: str) -> str:
    """A header value on one line: control characters and non-ASCII percent-encoded."""
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP header of its payload, not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}"]
    head += [f"WARC-Target-URI: {_field(url)}"] if url else []
    head += [f"Page-ID: {page_id}"] if page_id is not None else []
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}:{digest}')}>",
                 f"Refers-To-Page-ID: {refers_to}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and HTTP body of one record."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise BadArchive("no WARC record")
    warc = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(warc["Content-Length"])]
    http, body = block.split(b"\r\n\r\n", 1)
    return warc, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), body


def _gzip(data: bytes) -> bytes:
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class _Writer:
    """Records in memory up to a bounded size, then one archive under a name of its own."""

    def __init__(self, folder: str):
        self.folder, self.data, self.index = folder, io.BytesIO(), []

    def add(self, page_id, url, payload: bytes, digest: str, refers_to) -> None:
        at = self.data.tell()
        self.data.write(_gzip(record(page_id, url, payload, digest, refers_to)))
        self.index.append(json.dumps({"page": page_id, "offset": at, "length": self.data.tell() - at}))

    def close(self) -> tuple[str, int, int]:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            z.writestr(zipfile.ZipInfo(DATA), self.data.getbuffer().tobytes())
            z.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.index).encode())
        path = f"{self.folder}/{uuid.uuid4().hex}.zip"  # a task that runs twice leaves a file nobody lists
        system, inner = _open(path)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        with system.open_output_stream(inner) as f:
            f.write(out.getbuffer())
        n, size = len(self.index), out.tell()
        self.data, self.index = io.BytesIO(), []
        return path, n, size


def roles(pages: DataFrame, id_col: str, url_col: str, html_col: str, least: int = MIN_REVISIT) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: of equal payloads of at least
    ``least`` bytes, the smallest page id (combined on the map side) is the response."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long_ = F.octet_length("payload") >= least
    firsts = (rows.where(long_).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    again = long_ & (F.col("page_id") != F.col("first"))
    return rows.join(firsts, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(again, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives and returns their manifest ``path, n_records, n_bytes``.

    The manifest is written at once: it alone says which archives count, so a
    task that is repeated after a loss does no harm."""
    target = folder or scratch_path(pages.sparkSession, "warc")

    def run(batches):
        w = _Writer(target)
        for b in batches:
            done = []
            for r in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")),
                         strict=True):
                w.add(*r)
                if w.data.tell() >= archive_bytes:
                    done.append(w.close())
            if done:
                yield _manifest(done)
        if w.index:
            yield _manifest([w.close()])

    rows = roles(pages, id_col, url_col, html_col)
    return materialize(rows.mapInArrow(run, "path string, n_records long, n_bytes long"), "warc-manifest")


def _manifest(done: list[tuple[str, int, int]]) -> pa.RecordBatch:
    paths, n, size = zip(*done, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(n, pa.int64()), pa.array(size, pa.int64())],
                                      names=["path", "n_records", "n_bytes"])


def records(path: str) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """The records of one archive, each read by its own range."""
    system, inner = _open(path)
    size = system.get_file_info(inner).size
    with system.open_input_file(inner) as f:
        members = {m.name: m for m in directory(f, size)}
        index, data = members[INDEX], members[DATA]
        start = begin(f, data)
        for line in _at(f, begin(f, index), index.size).decode().splitlines():
            entry = json.loads(line)
            if entry["offset"] + entry["length"] > data.size:
                raise BadArchive("the index points outside its member")
            yield parse(zlib.decompress(_at(f, start + entry["offset"], entry["length"]), 31))


_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                   ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("payload", pa.binary())])


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row a record of the archives in ``path``: ``page_id, url, record_type,
    refers_to, payload_bytes, payload_digest`` (both of the full payload)``,
    payload`` (null for a revisit). A response whose payload has not the digest
    of its header raises."""
    from hashlib import sha256

    def run(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                rows, held = [], 0
                for warc, http, body in records(path):
                    digest, kind = warc["WARC-Payload-Digest"].removeprefix("sha256:"), warc["WARC-Type"]
                    if kind == "response" and sha256(body).hexdigest() != digest:
                        raise BadArchive(f"{path}: payload of page {warc.get('Page-ID')} has another digest")
                    page, refers = warc.get("Page-ID"), warc.get("Refers-To-Page-ID")
                    rows.append((page and int(page), warc.get("WARC-Target-URI"), kind, refers and int(refers),
                                 int(http["Content-Length"]), digest, body if kind == "response" else None))
                    held += len(body)
                    if held >= 4 << 20:
                        yield _rows(rows)
                        rows, held = [], 0
                if rows:
                    yield _rows(rows)

    return manifest.select("path").mapInArrow(
        run, "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
             "payload_digest string, payload binary")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _READ, strict=True)],
                                      schema=_READ)


def list_archives(spark, folder: str) -> DataFrame:
    """The archives under a folder, listed by Spark (their contents are not read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true")
            .load(folder).select("path"))


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Every row of ``pages`` written to archives and read back (see ``read_archives``).

    A null html is an empty payload. A null url has no target. Of equal payloads
    of at least 100 bytes the smallest page id is the response and repeated rows
    of that id are responses too; a null page id is a response of its own. An
    empty table gives no rows. Other columns are not read."""
    manifest = write_archives(pages, **options)
    n = max(1, manifest.count())
    return read_archives(manifest.repartition(n, "path"))
