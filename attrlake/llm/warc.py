"""WARC records in ZIP packages, written and read by byte range.

``write_archives`` packs records (each its own gzip member) into one stored
member of a ZIP file per batch, beside a stored CDXJ index of record offsets,
and returns a manifest of the files.  ``read_archives`` parses a package's end
record, ZIP64 locator and central directory itself, finds the members, and
range-reads each record at its offset: nothing is extracted, and one record is
held at a time.  Files go to any file system that pyarrow's ``FileSystem``
opens, under the shared folder.

Packages of other writers (``packages`` lists a folder's) are read too: any
``archive/*.warc`` or ``.warc.gz`` member, by the CDXJ indexes beside it or,
where an archive has none, record by record.  Only responses, revisits and
resources give rows.  An archive or index that is not a stored member is
refused, since it can't be read by range.

Of records with equal payloads the one with the largest page_id is the
response and the others revisit it.

Edge cases: a null html is an empty payload (empty payloads are equal like any
other); a null url becomes ``urn:page:<id>``; control characters in a url are
percent-encoded; rows with a null page_id are written without that field, and
are responses only if no equal payload has an id; of rows that repeat the
largest page_id all are responses; an empty table makes no file.  Extra
columns are ignored.  A task that is run again writes new files, and only
files in the manifest are read.  Records of other writers have no page_id, and
a revisit's length is null where its HTTP head doesn't tell it.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrlake.llm.common import looked_up, stored, texts
from attrlake.session import run_dir

#: Bytes of records in a package before a new one begins.
PACKAGE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
STAMP = re.sub(r"\D", "", DATE)
ARCHIVE, INDEXES = "archive/", "indexes/"
DATA, INDEX = ARCHIVE + "data.warc.gz", INDEXES + "index.cdxj"
#: Record types that carry or point to a page.
PAGES = ("response", "revisit", "resource")
#: Bytes of an archive without an index that are read at once.
STEP = 1 << 20

# Signatures and fixed sizes of the ZIP format.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def file_uri(folder: str) -> str:
    """A folder as a URI that pyarrow opens: plain paths and ``file:/x`` get
    the full form."""
    return re.sub(r"^(?:file:)?/+(?!/)", "file:///", folder)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{name}')}>"


def target(page_id: int | None, url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url) or f"urn:page:{page_id}"


def warc_record(page_id: int | None, url: str, payload: bytes, sha: str, refers_to: int | None) -> bytes:
    """One record; a revisit keeps the HTTP head, which tells the full
    payload's length, and leaves out the payload."""
    url = target(page_id, url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
            f"WARC-Record-ID: {record_id(page_id, sha)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}",
            f"WARC-Payload-Digest: sha1:{sha}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to, sha)}", f"Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (names in lower case) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    return fields, rest[:int(fields["content-length"])]


class ZipWriter:
    """Stored members written one after another; ``zip64`` writes the large
    form even where the small one would do."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.zip64, self.at, self.entries = out, zip64, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, parts: list[bytes]) -> None:
        size, crc, start, raw = sum(map(len, parts)), 0, self.at, name.encode()
        for p in parts:
            crc = zlib.crc32(p, crc)
        large = self.zip64 or size >= FULL32
        extra = struct.pack("<HHQQ", 1, 16, size, size) if large else b""
        short = FULL32 if large else size
        self._put(LOCAL + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 33, crc, short, short, len(raw), len(extra)) + raw + extra)
        for p in parts:
            self._put(p)
        self.entries.append((raw, crc, size, start))

    def close(self) -> None:
        start = self.at
        for raw, crc, size, at in self.entries:
            large = self.zip64 or size >= FULL32 or at >= FULL32
            extra = struct.pack("<HHQQQ", 1, 24, size, size, at) if large else b""
            short, place = (FULL32, FULL32) if large else (size, at)
            self._put(CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 33, crc, short, short, len(raw),
                                            len(extra), 0, 0, 0, 0, place) + raw + extra)
        size, n = self.at - start, len(self.entries)
        if self.zip64 or start >= FULL32 or n >= FULL16:
            place = self.at
            self._put(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, start))
            self._put(LOCATOR64 + struct.pack("<IQI", 0, place, 1))
            n, size, start = FULL16, FULL32, FULL32
        self._put(END + struct.pack("<HHHHIIH", 0, 0, n, n, size, start, 0))


def _range(file, start: int, size: int) -> bytes:
    file.seek(start)
    data = file.read(size)
    if len(data) != size:
        raise ValueError("the archive ends early")
    return data


def _end(tail: bytes) -> int:
    """Where the end record begins: the last signature whose comment reaches
    the end of the file (a comment may hold signatures itself)."""
    at = tail.rfind(END)
    while at >= 0:
        if at + 22 <= len(tail) and at + 22 + int.from_bytes(tail[at + 20:at + 22], "little") == len(tail):
            return at
        at = tail.rfind(END, 0, at)
    raise ValueError("no end of central directory")


def directory(file, length: int) -> dict[str, tuple[int, int] | None]:
    """(offset of the data, size) of each member, from the central directory,
    None for compressed or encrypted ones; only directories and member heads
    are read."""
    tail = _range(file, max(0, length - 65557), min(length, 65557))
    end = _end(tail)
    n, size, start = struct.unpack("<HII", tail[end + 10:end + 20])
    place = length - len(tail) + end
    if (n == FULL16 or size == FULL32 or start == FULL32) and place >= 20:
        locator = _range(file, place - 20, 20)
        if locator[:4] == LOCATOR64:
            record = _range(file, struct.unpack("<Q", locator[8:16])[0], 56)
            if record[:4] != END64:
                raise ValueError("no ZIP64 end record where the locator points")
            n, size, start = struct.unpack("<QQQ", record[32:56])
    central, at, members = _range(file, start, size), 0, {}
    for _ in range(n):
        if central[at:at + 4] != CENTRAL:
            raise ValueError("the central directory is damaged")
        flags, method = struct.unpack("<HH", central[at + 8:at + 12])
        packed, whole, n_name, n_extra, n_comment = struct.unpack("<IIHHH", central[at + 20:at + 34])
        local, = struct.unpack("<I", central[at + 42:at + 46])
        name = central[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, k = central[at + 46 + n_name:at + 46 + n_name + n_extra], 0
        while k + 4 <= len(extra):
            tag, width = struct.unpack("<HH", extra[k:k + 4])
            if tag == 1:  # values stand only for fields that are full, in this order
                wide = iter(struct.unpack(f"<{width // 8}Q", extra[k + 4:k + 4 + width // 8 * 8]))
                whole = next(wide) if whole == FULL32 else whole
                packed = next(wide) if packed == FULL32 else packed
                local = next(wide) if local == FULL32 else local
            k += 4 + width
        at += 46 + n_name + n_extra + n_comment
        members[name] = None
        if method == 0 and not flags & 1:
            head = _range(file, local, 30)
            if head[:4] != LOCAL:
                raise ValueError("no member where the directory points")
            members[name] = local + 30 + sum(struct.unpack("<HH", head[26:30])), packed
    return members


def _places(pages: DataFrame) -> DataFrame:
    """Each page with its payload and the page it revisits, if any."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1("html"))
    # Only payloads that several rows share are looked up.
    last = (rows.groupBy("sha").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
            .where("n > 1 and last is not null").select("sha", "last"))
    revisit = F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return looked_up(rows, last, "sha", F.xxhash64("page_id", "url"), "left").select("page_id", "url", "html", revisit.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, package_bytes: int = PACKAGE_BYTES,
                   zip64: bool | None = False) -> DataFrame:
    """Write every page as a record; the manifest (path, length, records) is
    stored before it is returned, so files are written once.  With ``zip64``
    None a task's packages take the ZIP64 form and the small one in turn."""
    folder = folder or file_uri(run_dir(pages.sparkSession, "warc"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0

        def package(records: list[bytes], index: list[bytes]) -> pa.RecordBatch:
            nonlocal written
            files, root = fs.FileSystem.from_uri(folder)
            files.create_dir(root, recursive=True)
            path = f"{root}/{uuid.uuid4().hex}.zip"
            with files.open_output_stream(path) as out:
                packed = ZipWriter(out, (TaskContext.get().partitionId() + written) % 2 == 0 if zip64 is None else zip64)
                packed.add(DATA, records)
                packed.add(INDEX, sorted(index))
                packed.close()
            written += 1
            return pa.RecordBatch.from_pylist([{"path": path, "length": packed.at, "records": len(index)}])

        records, index, at = [], [], 0
        for batch in batches:
            rows = zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), texts(batch, "html"),
                       batch.column("refers_to").to_pylist())
            for page_id, url, html, refers_to in rows:
                sha = digest(html)
                squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)  # a gzip member of its own
                data = squeeze.compress(warc_record(page_id, url or "", html, sha, refers_to)) + squeeze.flush()
                told = {"url": target(page_id, url or ""), "digest": f"sha1:{sha}", "length": str(len(data)), "offset": str(at),
                        "filename": DATA.removeprefix(ARCHIVE)}
                index.append(f"{told['url']} {STAMP} {json.dumps(told)}\n".encode())
                records.append(data)
                at += len(data)
                if at >= package_bytes:
                    yield package(records, index)
                    records, index, at = [], [], 0
        if records:
            yield package(records, index)

    return stored(_places(pages).mapInArrow(write, "path string, length bigint, records bigint"), "warc-manifest")


RECORD_SCHEMA = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
                 "refers_to bigint, payload binary")


def packages(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest (path, length) of the ``.zip`` files under ``folder``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true")
    return files.load(folder).select("path", "length")


def _wanted(members: dict, folder: str, ends: tuple[str, ...]) -> dict[str, tuple[int, int]]:
    """Members of a package's folder by their name in it."""
    found = {n: m for n, m in members.items() if n.startswith(folder) and n.endswith(ends)}
    for name, member in found.items():
        if member is None:
            raise ValueError(f"{name} is not a stored member")
    return {n.removeprefix(folder): m for n, m in found.items()}


def _index_lines(file, member: tuple[int, int]) -> Iterator[tuple[str, int, int]]:
    """(archive, offset, length) of each CDXJ line."""
    for line in _range(file, *member).splitlines():
        at = line.find(b"{")
        if at >= 0 and not line.startswith(b"!"):
            told = json.loads(line[at:])
            yield told["filename"].rpartition("/")[2], int(told["offset"]), int(told["length"])


def _in_turn(file, start: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of an archive without an index, one record held."""
    if size and _range(file, start, min(size, 2)) == b"\x1f\x8b":
        at = 0
        while at < size:
            member, record, step = zlib.decompressobj(31), bytearray(), at
            while not member.eof and step < size:
                data = _range(file, start + step, min(STEP, size - step))
                record += member.decompress(data)
                step += len(data) - len(member.unused_data)
            if not member.eof:
                raise ValueError("the archive ends within a record")
            yield at, bytes(record)
            at = step
        return
    at = 0
    while at < size:
        head = b""
        while b"\r\n\r\n" not in head and at + len(head) < size:
            head += _range(file, start + at + len(head), min(4096, size - at - len(head)))
        told = re.search(rb"(?im)^content-length: *(\d+)", head.partition(b"\r\n\r\n")[0])
        if not told:
            raise ValueError(f"no WARC record at {at}")
        n = head.index(b"\r\n\r\n") + 4 + int(told.group(1)) + 4
        yield at, _range(file, start + at, min(n, size - at))
        at += n


def _records(file, length: int) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of every record of a package's archives."""
    members = directory(file, length)
    archives = _wanted(members, ARCHIVE, (".warc", ".warc.gz"))
    indexed = set()
    for member in _wanted(members, INDEXES, (".cdx", ".cdxj")).values():
        for name, at, n in sorted(set(_index_lines(file, member))):
            if name not in archives:
                raise ValueError(f"the index names {name}, which the package lacks")
            indexed.add(name)
            data = _range(file, archives[name][0] + at, n)
            yield at, zlib.decompress(data, 31) if data[:2] == b"\x1f\x8b" else data
    for name in sorted(set(archives) - indexed):
        yield from _in_turn(file, *archives[name])


def _joined_chunks(body: bytes) -> bytes:
    """A chunked HTTP body in one piece."""
    out, at = [], 0
    while (line := body.find(b"\r\n", at)) >= 0 and (n := int(body[at:line].partition(b";")[0], 16)):
        out.append(body[line + 2:line + 2 + n])
        at = line + 4 + n
    return b"".join(out)


def _page(data: bytes) -> dict | None:
    """The row of one record, None if it carries no page."""
    fields, block = parse_record(data)
    kind = fields.get("warc-type")
    if kind not in PAGES:
        return None
    head, body = b"", block
    if "http" in fields.get("content-type", "application/http"):
        head, _, body = block.partition(b"\r\n\r\n")
    told = re.search(rb"(?im)^content-length: *(\d+)", head)
    told = int(told.group(1)) if told else None
    alg, _, own = fields.get("warc-payload-digest", "").partition(":")
    own = own if alg.lower() == "sha1" else None
    page, refers = fields.get("page-id"), fields.get("refers-to-page-id")
    row = {"page_id": page and int(page), "url": fields.get("warc-target-uri", "").strip("<>"), "payload_bytes": told,
           "payload_digest": own, "record_type": kind, "refers_to": refers and int(refers), "payload": None}
    if kind == "revisit":
        return row
    raw = digest(body)
    if re.search(rb"(?im)^transfer-encoding: *chunked", head):
        whole = _joined_chunks(body)
    else:
        whole = body
        if told is not None and told != len(body):
            raise ValueError("a record's payload has another length than it tells")
    if own and own not in (raw, digest(whole)):
        raise ValueError("a record's payload has another digest than it tells")
    return row | {"payload_bytes": len(whole), "payload_digest": digest(whole), "payload": whole}


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Every page record of the manifest's packages: page_id, url, the full
    payload's length and digest, type, the page it revisits, and the payload
    (null for revisits, or for all with ``payloads=False``).  Paths of the
    manifest are URIs or lie on the file system of ``folder``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                files, place = fs.FileSystem.from_uri(file_uri(path)) if re.match(r"[a-z0-9]+:", path) else (base, path)
                with files.open_input_file(place) as file:
                    rows, size = [], 0
                    for at, data in _records(file, length):
                        try:
                            row = _page(data)
                        except ValueError as e:
                            raise ValueError(f"{path}: the record at {at} is damaged: {e}") from e
                        if row is None:
                            continue
                        size += len(row["payload"] or b"")
                        rows.append(row if payloads else row | {"payload": None})
                        if len(rows) == 1024 or size > 1 << 24:
                            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_ARROW)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_ARROW)

    n = max(1, manifest.count())
    return manifest.select("path", "length").repartition(min(n, 10_000)).mapInArrow(read, RECORD_SCHEMA)


_RECORD_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                           ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to packages under the shared folder, in the ZIP64 form
    and the small one in turn, and read them back."""
    folder = file_uri(run_dir(pages.sparkSession, "warc"))
    return read_archives(write_archives(pages, folder, zip64=None), folder, payloads=False).drop("payload", "url")
