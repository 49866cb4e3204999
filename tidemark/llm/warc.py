"""WARC records in ZIP packages: a writer, and a reader that parses the ZIP directories and reads single records by range.

A package has the stored (uncompressed) members ``archive/data.warc.gz``, one gzip member for each record, ``indexes/index.cdxj``, one line for each record with
its offset and length in the archive, and ``datapackage.json``. The reader takes the end-of-central-directory record (and its
ZIP64 forms) from the file's end, then the central directory, then an index, and then the byte ranges of single records.
Equal payloads are written once: the record with the smallest id is a response, the others are revisits of it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._arrow import bounded_batches, filesystem, tidy
from ._shared import written
from ._skew import lookup

ARCHIVE, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
ID = "urn:x-page:"
# Fixed values of the ZIP format.
EOCD, EOCD64, LOCATOR64, CENTRAL, LOCAL, EXTRA64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04", 1
# Fixed value of the WARC format.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(kind: str, page: str, uri: str, date: str, digest: str, size: int, payload: bytes | None, refers_to: str | None) -> bytes:
    """One WARC/1.1 record of an HTTP response; a revisit has the HTTP header alone, with the full payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{ID}{page}>"), ("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if kind == "revisit":
        head += [("WARC-Refers-To", f"<{ID}{refers_to}>"), ("WARC-Profile", REVISIT)]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


def safe_uri(url: str | None, page: str) -> str:
    """The url, or for a null or empty one the record's own name, with control characters and blanks percent-encoded."""
    return re.sub(r"[\x00-\x20\x7F]", lambda m: f"%{ord(m[0]):02X}", url or f"{ID}{page}")


@dataclass
class Member:
    name: str
    method: int
    packed: int
    plain: int
    header_at: int


class ZipIndex:
    """The members of a ZIP file that can only be read by range; nothing is extracted."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size
        self.members = {m.name: m for m in self._central(*self._directory())}

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def _directory(self) -> tuple[int, int, int]:
        """Offset, length and number of entries of the central directory."""
        tail_at = max(0, self.size - 22 - 0xFFFF)
        tail = self._read(tail_at, self.size - tail_at)
        at = tail.rfind(EOCD)
        while at >= 0 and (len(tail) < at + 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] > len(tail)):
            at = tail.rfind(EOCD, 0, at)
        if at < 0:
            raise ValueError("no end of central directory")
        n, length, offset = struct.unpack_from("<HII", tail, at + 10)
        if 0xFFFF == n or 0xFFFFFFFF in (length, offset):
            sign, _, at64, _ = struct.unpack("<4sIQI", self._read(tail_at + at - 20, 20))
            if sign != LOCATOR64:
                raise ValueError("no ZIP64 locator")
            end = self._read(at64, 56)
            if end[:4] != EOCD64:
                raise ValueError("no ZIP64 end of central directory")
            n, length, offset = struct.unpack_from("<QQQ", end, 32)
        return offset, length, n

    def _central(self, offset: int, length: int, n: int) -> Iterator[Member]:
        raw, at = self._read(offset, length), 0
        for _ in range(n):
            if raw[at : at + 4] != CENTRAL:
                raise ValueError("damaged central directory")
            flags, method = struct.unpack_from("<HH", raw, at + 8)
            packed, plain, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", raw, at + 20)
            (header_at,) = struct.unpack_from("<I", raw, at + 42)
            name = raw[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra, x = raw[at + 46 + n_name : at + 46 + n_name + n_extra], 0
            while x + 4 <= len(extra):
                kind, size = struct.unpack_from("<HH", extra, x)
                if kind == EXTRA64:
                    wide = iter(struct.unpack_from(f"<{size // 8}Q", extra, x + 4))
                    plain = next(wide) if plain == 0xFFFFFFFF else plain
                    packed = next(wide) if packed == 0xFFFFFFFF else packed
                    header_at = next(wide) if header_at == 0xFFFFFFFF else header_at
                x += 4 + size
            yield Member(name, method, packed, plain, header_at)
            at += 46 + n_name + n_extra + n_note

    def begin(self, m: Member) -> int:
        """Where the member's bytes begin."""
        head = self._read(m.header_at, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header for {m.name}")
        n_name, n_extra = struct.unpack_from("<HH", head, 26)
        return m.header_at + 30 + n_name + n_extra

    def read(self, m: Member) -> bytes:
        """A whole member, such as an index."""
        raw = self._read(self.begin(m), m.packed)
        return raw if m.method == 0 else zlib.decompress(raw, -15)

    def ranges(self, m: Member, wanted: list[tuple[int, int]]) -> Iterator[bytes]:
        """Byte ranges (offset, length) of a stored member."""
        if m.method:
            raise ValueError(f"{m.name} isn't stored")
        at = self.begin(m)
        for offset, length in wanted:
            if offset < 0 or offset + length > m.packed:
                raise ValueError("range outside the member")
            yield self._read(at + offset, length)


def index_entries(package: ZipIndex) -> Iterator[tuple[Member, int, int]]:
    """Archive member, offset and length of every record that the package's indexes (CDXJ lines, gzipped or not) list; one listed twice comes once.

    Secondary indexes (.idx) name no records; any other index or line raises.
    """
    seen = set()
    for name, m in sorted(package.members.items()):
        if not name.startswith("indexes/") or name.endswith(("/", ".idx")):
            continue
        if not name.endswith((".cdx", ".cdxj", ".cdx.gz", ".cdxj.gz")):
            raise ValueError(f"unknown index {name}")
        raw = package.read(m)
        for line in (gzip.decompress(raw) if name.endswith(".gz") else raw).decode().split("\n"):
            if not line.strip() or line.startswith("!"):
                continue
            fields = line.split(" ", 2)
            if len(fields) < 3 or not fields[2].startswith("{"):
                raise ValueError(f"{name} has a line that isn't CDXJ: {line[:80]}")
            entry = json.loads(fields[2])
            place = "archive/" + entry["filename"], int(entry["offset"])
            if place not in seen:
                seen.add(place)
                yield package.members[place[0]], place[1], int(entry["length"])


def read_package(source, size: int) -> Iterator[tuple[dict[str, str], bytes]]:
    package = ZipIndex(source, size)
    for m, offset, length in index_entries(package):
        for raw in package.ranges(m, [(offset, length)]):
            yield parse_record(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw)


def roles(pages: DataFrame, id_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """``pages`` with sha1 (hex), payload_bytes and refers_to: the smallest id of an equal payload, null for a response."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    df = pages.withColumns({"sha1": F.sha1(payload), "payload_bytes": F.octet_length(payload).cast("long")})
    groups = df.filter(F.col("payload_bytes") >= least_bytes).groupBy("sha1").agg(F.min(id_col).alias("first_id"), F.count("*").alias("n_equal"))
    groups = written(groups.filter("n_equal > 1"), "warc")
    total = pages.count()
    found = lookup(df, groups, "sha1", "n_equal", total)
    return found.withColumn("refers_to", F.when(F.col("first_id") != F.col(id_col), F.col("first_id"))).drop("first_id", "n_equal")


FILES = "path string, n_records long"


def write_packages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes a record for every row, a package for every task, and returns the packages' paths.

    Payloads of at least ``least_bytes`` bytes that are equal are written once, with the smallest id; a row that repeats this id
    with this payload is a response too. A null payload is empty; a null url becomes the record's own name; a row with a null id is
    written as '' and is a response. Extra columns are ignored; an empty table gives packages without records.
    Files are named after task attempts, and only those of successful attempts are listed.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    light = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(payload_col).cast("binary").alias("payload"))
    light = roles(light, "id", "payload", least_bytes)
    rows = light.select(F.col("id").cast("string").alias("id"), "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "sha1", "payload_bytes", F.col("refers_to").cast("string").alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        fs, root = filesystem(folder)
        path = f"{root}/pages-{context.partitionId():06d}-{context.taskAttemptId()}.wacz"
        index, at = [], 0
        with fs.open_output_stream(path, compression=None) as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as package:
            with package.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True) as archive:
                for batch in batches:
                    for page, url, payload, sha1, size, refers_to in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "payload", "sha1", "payload_bytes", "refers_to")), strict=True):
                        name = "" if page is None else page
                        digest, uri = base32_sha1(sha1), safe_uri(url, name)
                        kind = "response" if refers_to is None else "revisit"
                        raw = gzip.compress(record(kind, name, uri, date, digest, size, payload, refers_to), 6, mtime=0)
                        archive.write(raw)
                        entry = {"url": uri, "mime": "text/html" if kind == "response" else "warc/revisit", "digest": f"sha1:{digest}", "filename": ARCHIVE.partition("/")[2], "offset": at, "length": len(raw)}
                        index.append(f"{uri} {re.sub(r'[^0-9]', '', date)} {json.dumps(entry)}\n")
                        at += len(raw)
            package.writestr(INDEX, "".join(index))
            package.writestr(PACKAGE, json.dumps({"profile": "data-package", "resources": [{"path": ARCHIVE}, {"path": INDEX}]}))
        yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [len(index)]})

    manifest = f"{folder}/manifest"
    rows.mapInArrow(tidy(write), FILES).write.parquet(manifest)
    return spark.read.schema(FILES).parquet(manifest)


def read_packages(files: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """A row for every record: page, url, record_type, payload_bytes, payload_digest, refers_to and, if asked for, payload (null for revisits).

    A response's digest is computed anew and must be what its header says; a revisit's length and digest are its headers'.
    """
    schema = "page string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string" + ", payload binary" * with_payload

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        for path in (p for b in batches for p in b.column("path").to_pylist()):
            rows, held = [], 0
            with fs.open_input_file(path) as source:
                for head, block in read_package(source, fs.get_file_info(path).size):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = head["warc-payload-digest"].partition(":")[2]
                    revisit = head["warc-type"] == "revisit"
                    if revisit:
                        size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
                    else:
                        size = len(payload)
                        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"damaged payload of {head['warc-record-id']}")
                    page = head["warc-record-id"].strip("<>").removeprefix(ID)
                    first = head["warc-refers-to"].strip("<>").removeprefix(ID) if revisit else None
                    rows.append((page, head["warc-target-uri"], head["warc-type"], size, digest, first, *([None if revisit else payload] if with_payload else [])))
                    held += len(payload) if with_payload else 200
                    if held > 4 << 20:
                        yield as_batch(rows, with_payload)
                        rows, held = [], 0
            yield as_batch(rows, with_payload)

    return files.repartition(max(1, files.count())).mapInArrow(tidy(read), schema)


def as_batch(rows: list[tuple], with_payload: bool) -> pa.RecordBatch:
    kinds = [("page", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string())] + [("payload", pa.binary())] * with_payload
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds, strict=True)], schema=pa.schema(kinds))
