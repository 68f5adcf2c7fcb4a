"""WARC records in ZIP packages: written record by record, and read by ranges through the central directory."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relweave.llm.common import dropped, fresh_path, read_blobs, slices, stored, tidied, write_blobs

#: Record bytes in a package before the next one begins (a longer record is still whole).
PACKAGE_BYTES = 8 << 20
#: Payloads whose first record a task remembers.
REMEMBERED = 500_000
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: A package ends with a comment of one byte.
TAIL = "\n"

# Fixed values of the ZIP format: signatures of a local header, a central entry, the end record, its ZIP64 form and that one's locator.
LOCAL, CENTRAL, END, END64, LOCATOR64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
BIG = 0xFFFFFFFF


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page_id: int | None, url: str | None, digest: str, payload_bytes: int, payload: bytes | None, refers_to: int | None = None) -> bytes:
    """One WARC record as a gzip member of its own. Page ids are in the record's id; line breaks in a url are percent-encoded."""
    name = lambda x: f"<urn:page:{'null' if x is None else x}>"
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {payload_bytes}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        head += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block = b"" if payload is None else payload
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress(("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n") + pack.flush()


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record's gzip member."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


def package(members: list[tuple[str, bytes]], zip64: bool = True) -> bytes:
    """A ZIP file of stored members with ZIP64 records, but its last byte, which is a comment of one."""
    out, central, at = [], [], 0
    for name, data in members:
        n, crc, size = name.encode(), zlib.crc32(data), len(data)
        extra = struct.pack("<HHQQ", 1, 16, size, size) if zip64 else b""
        short = BIG if zip64 else size
        local = struct.pack("<IHHHHHIIIHH", LOCAL, 45, 0x800, 0, 0, 33, crc, short, short, len(n), len(extra)) + n + extra
        more = struct.pack("<HHQQQ", 1, 24, size, size, at) if zip64 else b""
        central.append(struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 0x800, 0, 0, 33, crc, short, short, len(n), len(more), 0, 0, 0, 0, BIG if zip64 else at) + n + more)
        out += [local, data]
        at += len(local) + size
    directory = b"".join(central)
    end = b""
    if zip64:
        end = struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, len(members), len(members), len(directory), at) + struct.pack("<IIQI", LOCATOR64, 0, at + len(directory), 1)
    short = (0xFFFF, BIG, BIG) if zip64 else (len(members), len(directory), at)
    return b"".join([*out, directory, end, struct.pack("<IHHHHIIH", END, 0, 0, short[0], short[0], short[1], short[2], 1)])


class Package:
    """Reads a ZIP file through read_at(offset, size): the end records, the central directory, and ranges of stored members, which are never extracted."""

    def __init__(self, size: int, read_at: Callable[[int, int], bytes]) -> None:
        self.read_at = read_at
        back = min(size, 22 + 0xFFFF)
        tail = read_at(size - back, back)
        at = len(tail)
        while True:
            at = tail.rfind(struct.pack("<I", END), 0, at)
            if at < 0:
                raise ValueError("no ZIP package: its end record is missing")
            if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
                break
        count, length, offset = struct.unpack_from("<HII", tail, at + 10)
        if count == 0xFFFF or BIG in (length, offset):
            place = size - back + at - 20
            sign, _, where, _ = struct.unpack("<IIQI", read_at(place, 20))
            if sign != LOCATOR64:
                raise ValueError("the ZIP64 locator is missing")
            sign, _, _, _, _, _, _, count, length, offset = struct.unpack("<IQHHIIQQQQ", read_at(where, 56))
            if sign != END64:
                raise ValueError("the ZIP64 end record is missing")
        self.members: dict[str, tuple[int, int, int, int]] = {}
        data, at = read_at(offset, length), 0
        for _ in range(count):
            sign, _, _, _, method, _, _, crc, packed, full, n, m, k, _, _, _, start = struct.unpack_from("<IHHHHHHIIIHHHHHII", data, at)
            if sign != CENTRAL:
                raise ValueError("the central directory is damaged")
            name, extra = data[at + 46 : at + 46 + n].decode(), data[at + 46 + n : at + 46 + n + m]
            x = 0
            while x + 4 <= len(extra):
                tag, width = struct.unpack_from("<HH", extra, x)
                if tag == 1:  # ZIP64: those of the three that don't fit above, in this order
                    wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, x + 4))
                    full = next(wide) if full == BIG else full
                    packed = next(wide) if packed == BIG else packed
                    start = next(wide) if start == BIG else start
                x += 4 + width
            self.members[name] = (start, packed, method, crc)
            at += 46 + n + m + k

    def range(self, name: str, at: int = 0, size: int | None = None) -> bytes:
        """Bytes of a stored member."""
        start, packed, method, _ = self.members[name]
        if method:
            raise ValueError(f"{name} is not stored, but compressed by method {method}")
        sign, *_, n, m = struct.unpack("<IHHHHHIIIHH", self.read_at(start, 30))
        if sign != LOCAL:
            raise ValueError(f"the local header of {name} is damaged")
        size = packed - at if size is None else size
        if at < 0 or size < 0 or at + size > packed:
            raise ValueError(f"{name} has no bytes {at} to {at + size}")
        return self.read_at(start + 30 + n + m + at, size)

    def index(self) -> list[dict]:
        """The index's entries: offset and length of each record, with its page id and url."""
        return [json.loads(x) for name in self.members if name.startswith("indexes/") for x in self.range(name).splitlines() if x]

    def records(self, wanted: Callable[[dict], bool] | None = None) -> Iterator[tuple[dict[str, str], bytes]]:
        """Records whose index entries are wanted; others are not read."""
        for e in self.index():
            if wanted is None or wanted(e):
                yield parse_record(self.range(e["filename"], e["offset"], e["length"]))


def _members(least: int):
    """A row with its compressed record for each page that may be its payload's response: of equal payloads in a task, the first and those that come before all earlier ones. So a payload with a third of all rows is compressed and sent on a few times a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[bytes, tuple] = {}
        for b in slices(batches, "html"):
            rows = []
            for page, url, html in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                payload = (html or "").encode()
                sha = hashlib.sha1(payload).digest()
                if len(payload) >= least:
                    key = (page is None, page or 0, url is not None, url or "")
                    if sha in best and best[sha] <= key:
                        continue
                    if len(best) >= REMEMBERED:
                        best.clear()
                    best[sha] = key
                rows.append((page, url, sha.hex(), len(payload), record("response", page, url, base64.b32encode(sha).decode(), len(payload), payload)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()), strict=True)], ["page_id", "url", "hex", "bytes", "member"])

    return run


def _packages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def done() -> pa.RecordBatch:
        blob = package([(ARCHIVE, b"".join(members)), (INDEX, "".join(json.dumps(e) + "\n" for e in index).encode())])
        return pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["blob"])

    members, index, at = [], [], 0
    for b in batches:
        for page, url, sha, n, member, refers in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "hex", "bytes", "member", "refers_to")), strict=True):
            data = member if member is not None else record("revisit", page, url, base64.b32encode(bytes.fromhex(sha)).decode(), n, None, refers)
            index.append({"page_id": page, "url": url, "filename": ARCHIVE, "offset": at, "length": len(data)})
            members.append(data)
            at += len(data)
            if at >= PACKAGE_BYTES:
                yield done()
                members, index, at = [], [], 0
    if members:
        yield done()


def write(pages: DataFrame, path: str, least: int = 0) -> None:
    """Write a record for each row of pages (page_id, url, html; other columns are ignored) into packages at path.

    The payload is the html in UTF-8 (null: empty). Of records with equal payloads of `least` bytes or more, the one with the smallest page_id (null last; then by url, null first) is a response and the others are revisits that refer to it, without a payload of their own; smaller payloads are all responses. Rows that are equal in all: one of them is the response. A null url has no header. An empty table writes no file.

    Which record is a response is decided on ids and hashes alone; a revisit's payload never travels. The first records are stored, a row for each payload that comes again, so that the join reads plain rows and Spark can divide a frequent payload's revisits among tasks."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    key = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("page_id"), F.col("url").alias("url"))
    ids = rows.select("page_id", "url", F.octet_length("html").cast("bigint").alias("bytes"), F.sha1(F.col("html").cast("binary")).alias("hex")).where(F.col("bytes") >= least)
    groups = stored(ids.groupBy("hex").agg(F.min(key).alias("first"), F.count("*").alias("n")).where("n > 1").select("hex", "first"), "groups")
    met = ids.join(groups, "hex").withColumn("same", key.eqNullSafe(F.col("first")))
    # Rows equal in all to a response are revisits but for one.
    again = met.where("same").groupBy("hex", "bytes", "page_id", "url").agg(F.count("*").alias("n")).where("n > 1").withColumn("copy", F.explode(F.sequence(F.lit(2).cast("bigint"), F.col("n"))))
    thin = ["page_id", "url", "hex", "bytes"]
    revisits = met.where("not same").select(*thin, F.col("first.page_id").alias("refers_to")).unionByName(again.select(*thin, F.col("page_id").alias("refers_to")))
    members = rows.mapInArrow(tidied(_members(least)), "page_id bigint, url string, hex string, bytes bigint, member binary")
    whole = F.struct("page_id", "url", "hex", "bytes", "member")
    first = members.where(F.col("bytes") >= least).groupBy(F.col("hex").alias("h")).agg(F.min_by(whole, key).alias("r")).select("r.*")
    responses = first.unionByName(members.where(F.col("bytes") < least)) if least > 0 else first
    records = responses.withColumn("refers_to", F.lit(None).cast("bigint")).unionByName(revisits.withColumn("member", F.lit(None).cast("binary")))
    write_blobs(records.select(*thin, "member", "refers_to").mapInArrow(tidied(_packages), "blob binary"), path, TAIL)
    dropped(groups)


def _pages(wanted: frozenset[int] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ident = lambda x: None if x in (None, "<urn:page:null>") else int(x.removeprefix("<urn:page:").removesuffix(">"))
        for b in batches:
            for k in range(b.num_rows):
                data = memoryview(b.column("content")[k].as_buffer())
                if not len(data):
                    continue
                rows = []
                file = Package(len(data), lambda at, n, data=data: bytes(data[at : at + n]))
                for head, block in file.records(None if wanted is None else lambda e: e["page_id"] in wanted):
                    kind, digest, n = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:"), int(head["x-payload-length"])
                    if kind == "response" and (base32_sha1(block) != digest or len(block) != n):
                        raise ValueError(f"record {head['warc-record-id']} is damaged")
                    rows.append((ident(head["warc-record-id"]), n, digest, kind, ident(head.get("warc-refers-to"))))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return run


def read(spark: SparkSession, path: str, wanted: Iterable[int] | None = None) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each record in the packages at path, or of the wanted page ids alone, whose other records are not decompressed; the payloads of responses are verified."""
    only = None if wanted is None else frozenset(wanted)
    return read_blobs(spark, path).select("content").mapInArrow(tidied(_pages(only)), "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def written(pages: DataFrame, least: int = 0, path: str | None = None) -> DataFrame:
    """Write pages into packages (in a new folder in the shared one by default) and read them back."""
    path = path or fresh_path(pages.sparkSession, "warc")
    write(pages, path, least)
    return read(pages.sparkSession, path)
