r"""WARC records in ZIP-packaged web archives: a writer, and a reader by ranges.

An archive is a ZIP file whose members are *stored*: ``archive/data-*.warc.gz`` (each record a gzip
member of its own), each followed by its ``indexes/index-*.cdxj`` (a line a record: the escaped url,
a date, and JSON with the record's file, offset and length).

Reading: the end-of-central-directory record (and its ZIP64 form) leads to the central directory,
that to the stored members' data; indexes give each record's range in the file; ranges that lie next
to each other are read together (up to ``READ``), and nothing is extracted. A WARC member that no
index names is walked through record by record, gzipped or not, a range at a time. Files are opened
by ranges where a worker can open the file system (``file:`` paths, or what pyarrow knows); where
only Spark can, an archive's bytes come through Spark's binary file source, and archives are written
with a single member so that one fits in memory.

Writing: each task packs its rows into archives of about ``ARCHIVE`` bytes, ``MEMBER`` bytes at a
time: a member with its index is one row of Spark's text writer, the central directory another, and
``maxRecordsPerFile`` is their number. So writing goes to any file system that Spark writes to, a
worker holds one member, and Spark's protocol commits the files: a task that is lost is run again and
leaves no half archive. The line end that this writer adds after each row lies between members, which
offsets count, and the last one is the ZIP file's one-byte comment.

Of records with equal payloads of at least ``min_revisit`` bytes the one with the smallest page_id
is a ``response``, the others are ``revisit`` records without payload that refer to it.

Defined results: null html is an empty payload; a null url is written as empty; rows without a
page_id are responses if no row of their group has one, else revisits; rows that repeat page_id and
payload have the same type; other columns are passed over; an empty table gives no records. Archives
of others: responses, resources and revisits are returned, with a null page_id where the record's id
is none of ours; other kinds of records (warcinfo, request, metadata, ...) are passed over; a missing
digest is computed from the payload, a wrong SHA-1 is an error; a WARC member that is not stored, or
an index that names a member which is not there, is an error; files of no bytes are passed over.

Scale: equal payloads meet as digests only (SHA-256, counted map-side first), so a payload that a
third of all pages share is no hot key for html; html is read once and joined at most once.
"""

from __future__ import annotations

import base64
import gzip
import io
import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from hashlib import sha1
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright import scratch

ARCHIVE = 1 << 30
#: Bytes of records that a worker holds, and of an archive that cannot be read by ranges.
MEMBER = 8 << 20
READ = 4 << 20
DATE = "2024-01-01T00:00:00Z"
ZIP_DATE = (2024 - 1980) << 9 | 1 << 5 | 1
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
#: The largest size and offset that ZIP's own fields hold; larger ones go to ZIP64's.
ZIP_MAX, ZIP_COUNT = 0xFFFFFFFE, 0xFFFE
OWN_ID = re.compile(r"<urn:page:(-?\d+)>")


# Writing


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A gzip member that holds one WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {url.replace(chr(13), '%0D').replace(chr(10), '%0A')}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", compresslevel=4, mtime=0)


class Zip:
    """The parts of a ZIP file of stored members, with one byte after each part that belongs to none."""

    def __init__(self, zip64: bool = False):
        self.zip64, self.offset, self.entries = zip64, 0, []

    def part(self, *members: tuple[str, bytes]) -> bytes:
        out = bytearray()
        for name, data in members:
            n, at, own = len(data), self.offset + len(out), name.encode()
            wide = self.zip64 or max(n, at) > ZIP_MAX
            version, size, crc = (45, 0xFFFFFFFF, zlib.crc32(data)) if wide else (20, n, zlib.crc32(data))
            more = struct.pack("<HHQQ", 1, 16, n, n) if wide else b""
            out += struct.pack("<4s5H3I2H", b"PK\x03\x04", version, 0, 0, 0, ZIP_DATE, crc, size, size, len(own), len(more)) + own + more + data
            more = struct.pack("<HHQQQ", 1, 24, n, n, at) if wide else b""
            entry = struct.pack("<4s6H3I5H2I", b"PK\x01\x02", version, version, 0, 0, 0, ZIP_DATE, crc, size, size, len(own), len(more), 0, 0, 0, 0, 0xFFFFFFFF if wide else at)
            self.entries.append(entry + own + more)
        self.offset += len(out) + 1
        return bytes(out)

    def end(self) -> bytes:
        """The central directory and its end, without the one byte of comment that follows."""
        directory, n, at = b"".join(self.entries), len(self.entries), self.offset
        size = len(directory)
        end = directory
        if self.zip64 or max(at, size) > ZIP_MAX or n > ZIP_COUNT:
            end += struct.pack("<4sQ2H2I4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, n, n, size, at) + struct.pack("<4sIQI", b"PK\x06\x07", 0, at + size, 1)
            n, size, at = 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF
        return end + struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, n, n, size, at, 1)


def index_lines(records: list[tuple[str, bytes]], name: str) -> bytes:
    """The index of a member that holds the records ``(url, record)`` one after another."""
    lines, offset = [], 0
    for url, data in records:
        entry = {"offset": str(offset), "length": str(len(data)), "filename": name.rsplit("/", 1)[-1], "url": url}
        key = quote(url.split("#")[0].lower(), safe="/:?&=+,;@$'()*[]~-._%") or "-"
        lines.append(f"{key} {DATE[:4]}0101000000 {json.dumps(entry)}\n".encode())
        offset += len(data)
    return b"".join(sorted(lines))


def pack(records: list[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """An archive of one member of ``(url, record)``, without the one byte of comment that the text writer adds."""
    archive = Zip(zip64)
    part = archive.part((WARC_MEMBER, b"".join(r for _, r in records)), (INDEX_MEMBER, index_lines(records, WARC_MEMBER)))
    return part + b"\n" + archive.end()


def with_types(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """``page_id, url, payload, revisit, refers_to``."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    )
    keyed = rows.withColumn("key", F.sha2("payload", 256))
    groups = keyed.where(F.length("payload") >= min_revisit).groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    groups = scratch.table(groups.where("n > 1").select("key", "first"), "warc-groups")
    narrow = keyed.select("page_id", "key").distinct().join(groups, "key").where(~F.col("page_id").eqNullSafe(F.col("first")))
    again = scratch.table(narrow.select(F.col("page_id").alias("again_id"), F.col("key").alias("again_key"), F.col("first").alias("refers_to")), "warc-revisits")
    same = F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("key") == F.col("again_key"))
    return keyed.join(again, same, "left").select("page_id", "url", "payload", F.col("again_key").isNotNull().alias("revisit"), "refers_to")


def write(pages: DataFrame, path: str, min_revisit: int = 0, archive_bytes: int = ARCHIVE) -> None:
    """Write a record for each row of ``page_id, url, html`` into archives under ``path``."""
    member_bytes = min(MEMBER, archive_bytes)
    members = max(1, archive_bytes // member_bytes)

    def rows(parts: Iterator[list[tuple[str, bytes]]]) -> Iterator[bytes]:
        archive = Zip()
        for held in parts:
            k = len(archive.entries) // 2
            name = WARC_MEMBER.replace(".", f"-{k:05}.", 1)
            yield archive.part((name, b"".join(r for _, r in held)), (INDEX_MEMBER.replace(".", f"-{k:05}.", 1), index_lines(held, name)))
            if k + 1 == members:
                yield archive.end()
                archive = Zip()
        if archive.entries:
            yield archive.end()

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple[str, bytes]]]:
        held, size = [], 0
        for batch in batches:
            for page_id, url, payload, revisit, refers_to in zip(*batch.columns, strict=True):
                data = record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py(), revisit.as_py())
                held.append((url.as_py(), data))
                size += len(data)
                if size >= member_bytes:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows(parts(batches)):
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], names=["archive"])

    archives = with_types(pages, min_revisit).mapInArrow(run, "archive binary")
    archives.select(F.col("archive").cast("string")).write.option("maxRecordsPerFile", members + 1).mode("overwrite").text(path)


# Reading


class Ranges:
    """Bytes of a file by offset and length, wherever the file is."""

    def __init__(self, path: str, content: bytes | None = None):
        if content is not None:
            self.file, self.size = io.BytesIO(content), len(content)
        elif path.startswith(("file:", "/")):
            self.file = open("/" + path.removeprefix("file:").lstrip("/"), "rb")  # noqa: SIM115
            self.size = self.file.seek(0, io.SEEK_END)
        else:
            store, inside = fs.FileSystem.from_uri(path)
            self.file = store.open_input_file(inside)
            self.size = self.file.size()

    def read(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        data = self.file.read(length)
        if len(data) != length:
            raise EOFError(f"{length} bytes at {offset}, {len(data)} read")
        return data

    def close(self) -> None:
        self.file.close()


def members(file: Ranges) -> list[tuple[str, int, int, int]]:
    """``(name, method, data offset, stored size)`` of a ZIP file's members, from its central directory."""
    tail_size = min(file.size, 22 + 65535)
    tail = file.read(file.size - tail_size, tail_size)
    at = len(tail)
    while True:
        at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("no end of central directory")
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    count, size, offset = struct.unpack_from("<HII", tail, at + 10)
    end = file.size - tail_size + at
    if end >= 20 and (count == 0xFFFF or 0xFFFFFFFF in (size, offset)):
        locator = file.read(end - 20, 20)
        if locator[:4] == b"PK\x06\x07":
            record64 = file.read(struct.unpack_from("<Q", locator, 8)[0], 56)
            if record64[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end of central directory")
            count, size, offset = struct.unpack_from("<QQQ", record64, 32)
    directory, out, at = file.read(offset, size), [], 0
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("no central directory entry")
        method, packed, whole = struct.unpack_from("<H", directory, at + 10)[0], *struct.unpack_from("<II", directory, at + 20)
        n, extra, comment = struct.unpack_from("<HHH", directory, at + 28)
        begin = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + n].decode("utf-8", "replace")
        k, stop = at + 46 + n, at + 46 + n + extra
        while k + 4 <= stop:  # the ZIP64 field holds, in this order, what did not fit
            tag, length = struct.unpack_from("<HH", directory, k)
            if tag == 1:
                wide = iter(struct.unpack_from(f"<{length // 8}Q", directory, k + 4))
                whole = next(wide) if whole == 0xFFFFFFFF else whole
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                begin = next(wide) if begin == 0xFFFFFFFF else begin
            k += 4 + length
        local = file.read(begin, 30)
        data = begin + 30 + sum(struct.unpack_from("<HH", local, 26))
        out.append((name, method, data, packed))
        at = stop + comment
    return out


def locate(file: Ranges) -> Iterator[tuple[int, int]]:
    """``(offset, length)`` in the file of each WARC record, by the archive's indexes."""
    found = members(file)
    warcs = {}
    for name, method, data, size in found:
        if name.endswith((".warc.gz", ".warc")):
            if method:
                raise ValueError(f"{name} is not stored")
            warcs[name.rsplit("/", 1)[-1]] = (data, size)
    indexed = set()
    for name, method, data, size in found:
        if name.startswith("indexes/") and name.endswith((".cdxj", ".cdxj.gz")):
            lines = file.read(data, size)
            lines = zlib.decompress(lines, -15) if method == 8 else lines
            for line in (gzip.decompress(lines) if name.endswith(".gz") else lines).decode().splitlines():
                fields = line.split(" ", 2)  # key, date, entry; keys hold no spaces
                if len(fields) < 3 or fields[0].startswith("!"):
                    continue
                entry = json.loads(fields[2])
                own = entry["filename"].rsplit("/", 1)[-1]
                if own not in warcs:
                    raise ValueError(f"{name} names {own}, which is not in the archive")
                indexed.add(own)
                yield warcs[own][0] + int(entry["offset"]), int(entry["length"])
    for name, (data, size) in warcs.items():
        if name not in indexed:
            yield from (_walk if name.endswith(".gz") else _walk_plain)(file, data, data + size)


def _walk(file: Ranges, start: int, stop: int) -> Iterator[tuple[int, int]]:
    """The gzip members between two offsets."""
    at, begin, unpack = start, start, zlib.decompressobj(31)
    while at < stop:
        data = file.read(at, min(1 << 16, stop - at))
        at += len(data)
        while data:
            unpack.decompress(data)
            data = unpack.unused_data
            if unpack.eof:
                yield begin, at - len(data) - begin
                begin, unpack = at - len(data), zlib.decompressobj(31)
    if begin < stop:
        raise EOFError(f"half a gzip member at {begin}")


def _walk_plain(file: Ranges, start: int, stop: int) -> Iterator[tuple[int, int]]:
    """The records between two offsets of a WARC file without compression."""
    at = start
    while at < stop:
        window, head = 1 << 12, b""
        while b"\r\n\r\n" not in head and len(head) < stop - at:
            head = file.read(at, min(window, stop - at))
            window *= 4
        head, found, _ = head.partition(b"\r\n\r\n")
        if not found:
            raise EOFError(f"half a record at {at}")
        length = len(head) + 4 + int(_fields(head)["content-length"])
        yield at, length
        at += length + 4


def _fields(head: bytes) -> dict[str, str]:
    """A record's or response's fields by their names in lower case."""
    lines = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in lines}


def _own_id(text: str) -> int | None:
    found = OWN_ID.fullmatch(text)
    return int(found.group(1)) if found else None


def records_in(data: bytes) -> Iterator[dict]:
    """Fields and payload of the records that a range holds; digests are checked where the payload is there."""
    raw = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = _fields(head)
        length = int(fields["content-length"])
        block, raw = rest[:length], rest[length:].lstrip(b"\r\n")
        kind = fields.get("warc-type", "")
        if kind not in ("response", "resource", "revisit"):
            continue
        http, payload = {}, block
        if kind != "resource" and block.startswith(b"HTTP/"):
            top, _, payload = block.partition(b"\r\n\r\n")
            http = _fields(top)
        stated = fields.get("warc-payload-digest", "")
        own = stated.removeprefix("sha1:").upper() if stated.lower().startswith("sha1:") else None
        if kind == "revisit":
            size = http.get("content-length", "")
            size, digest, payload = int(size) if size.isdigit() else None, own, None
        else:
            size, digest = len(payload), payload_digest(payload)
            if own and own != digest and "transfer-encoding" not in http:
                raise ValueError(f"digest of {fields.get('warc-record-id')} does not match its payload")
        yield {
            "page_id": _own_id(fields.get("warc-record-id", "")), "url": fields.get("warc-target-uri", ""), "record_type": kind, "payload_digest": digest,
            "payload_bytes": size, "refers_to": _own_id(fields.get("warc-refers-to", "")), "payload": payload,
        }


def parse(data: bytes) -> dict | None:
    """The first record of a range; None where it holds none of the kinds that are read."""
    return next(records_in(data), None)


def _opens_by_range(path: str) -> bool:
    if path.startswith(("file:", "/")):
        return True
    try:
        fs.FileSystem.from_uri(path)
        return True
    except (pa.ArrowException, OSError):  # a scheme that pyarrow does not know, or whose native library is not there
        return False


def read(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The records of all archives under ``path``: ``page_id, url, record_type, payload_bytes, payload_digest, refers_to[, payload]``."""
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"] + ["payload"] * payload
    types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long" + ", payload binary" * payload
    by_range = _opens_by_range(path)
    files = spark.read.format("binaryFile").load(path).where("length > 0")

    def records(found: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], types.get(n, pa.string())) for n in names], names=names)

    def ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                file = Ranges(name)
                found = sorted(locate(file))
                file.close()
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["path", "offset", "length"])

    def from_ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, opened = None, None
        for batch in batches:
            wanted = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            k = 0
            while k < len(wanted):
                name, begin, length = wanted[k]
                m, stop = k + 1, begin + length
                while m < len(wanted) and wanted[m][0] == name and wanted[m][1] == stop and stop - begin < READ:
                    stop += wanted[m][2]
                    m += 1
                if opened != name:
                    if file:
                        file.close()
                    file, opened = Ranges(name), name
                data = file.read(begin, stop - begin)
                yield records([r for _, o, n in wanted[k:m] for r in records_in(data[o - begin : o - begin + n])])
                k = m

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*batch.columns, strict=True):
                file = Ranges(name.as_py(), content.as_py())
                for o, n in sorted(locate(file)):
                    yield records(list(records_in(file.read(o, n))))

    if not by_range:
        return files.select("path", "content").mapInArrow(whole, schema)
    located = scratch.table(files.select("path").mapInArrow(ranges, "path string, offset long, length long"), "warc-ranges")
    # ranges of a file that follow each other stay together and in order
    dealt = located.repartition("path", F.floor(F.col("offset") / F.lit(READ))).sortWithinPartitions("path", "offset")
    return dealt.mapInArrow(from_ranges, schema)


def round_trip(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """Write archives to the shared folder and read their records back."""
    path = scratch.path(pages.sparkSession, "warc")
    write(pages, path, min_revisit, ARCHIVE if _opens_by_range(path) else MEMBER)
    return read(pages.sparkSession, path)
