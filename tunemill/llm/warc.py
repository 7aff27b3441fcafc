"""Web archives in ZIP packages: written by Spark tasks, located through their directories, read in ranges.

A package is a ZIP file with stored members: ``archive/data.warc.gz`` (each record a gzip member of its own),
``indexes/index.cdx`` (a JSON line per record with its place) and ``datapackage.json``. The reader looks at the end of the
file for the central directory, with the ZIP64 records where they are needed, finds where a stored member's bytes begin,
and reads its index and any range of its records straight from the package; nothing is extracted.

Of records with equal payloads of at least ``MIN_PAYLOAD`` bytes the one with the smallest key is a response and the others
revisit it. Tasks write packages under names of their own, and only those in the written manifest are read, so a repeated
task does no harm.

Defined cases: a null payload is empty; a null key is never the smallest (equal payloads with null keys only are all
responses); repeated rows with the smallest key are all responses; null urls leave the header out; further columns are
ignored; an empty table gives no packages and no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import filesystem, map_lists, partitions, written
from tunemill.session import scratch_path

MIN_PAYLOAD, PACKAGE_BYTES, RANGE_BYTES, LEVEL = 100, 1 << 26, 1 << 22, 4
RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
EPOCH = "1970-01-01T00:00:00Z"
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
#: Bytes that are handed to the decompressor at once.
PORTION = 1 << 14
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


# ---- records ----

def record(key: int | None, url: str | None, payload: bytes, digest: str, first: int | None, size: int, date: str = EPOCH) -> bytes:
    """One WARC record; ``first`` makes it a revisit, which holds no payload but its digest and size."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + (payload if first is None else b"")
    kind = "response" if first is None else "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} {key} {digest}')}>",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}"]
    lines += [f"X-Key: {key}"] * (key is not None)
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url))
    if first is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Key: {first}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers in lower case and the payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {name.lower(): value for name, _, value in (x.partition(": ") for x in lines)}
    block = rest[:int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


# ---- packages ----

def directory(file) -> dict[str, tuple[int, int, int]]:
    """Members by name: (offset of their bytes, size in the package, compression method), from the central directory."""
    length = file.size()
    tail_at = max(0, length - 22 - FULL16)
    tail = file.read_at(length - tail_at, tail_at)
    at = tail.rfind(END)
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20:at + 22], "little") != len(tail):  # a mark within the comment
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP package")
    count, size, start = struct.unpack("<HII", tail[at + 10:at + 20])
    wide = tail[max(0, at - 20):max(0, at - 16)] == LOCATOR64
    if (size == FULL32 or start == FULL32) and not wide:
        raise ValueError("the ZIP64 locator is missing")
    if wide:
        (end64,) = struct.unpack("<Q", tail[at - 12:at - 4])
        data = file.read_at(56, end64)
        if data[:4] != END64:
            raise ValueError("the ZIP64 directory end is missing")
        count, size, start = struct.unpack("<QQQ", data[32:56])
    data, members, at = file.read_at(size, start), {}, 0
    for _ in range(count):
        if data[at:at + 4] != ENTRY:
            raise ValueError("damaged directory")
        method, packed, unpacked = struct.unpack("<H8xII", data[at + 10:at + 28])
        name_n, extra_n, comment_n = struct.unpack("<HHH", data[at + 28:at + 34])
        (local,) = struct.unpack("<I", data[at + 42:at + 46])
        name = data[at + 46:at + 46 + name_n].decode()
        packed, local = _wide(data[at + 46 + name_n:at + 46 + name_n + extra_n], unpacked, packed, local)
        members[name] = (local, packed, method)
        at += 46 + name_n + extra_n + comment_n
    return {name: (_data_at(file, local), packed, method) for name, (local, packed, method) in members.items()}


def _wide(extra: bytes, unpacked: int, packed: int, local: int) -> tuple[int, int]:
    """Size and offset from the ZIP64 field where the directory has no room for them."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack("<HH", extra[at:at + 4])
        if kind == 1:
            values = iter(struct.unpack(f"<{n // 8}Q", extra[at + 4:at + 4 + n // 8 * 8]))
            if unpacked == FULL32:
                next(values)
            packed = next(values) if packed == FULL32 else packed
            local = next(values) if local == FULL32 else local
        at += 4 + n
    return packed, local


def _data_at(file, local: int) -> int:
    head = file.read_at(30, local)
    if head[:4] != LOCAL:
        raise ValueError("damaged member")
    name_n, extra_n = struct.unpack("<HH", head[26:30])
    return local + 30 + name_n + extra_n


def stored(members: dict, name: str) -> tuple[int, int]:
    """Place and size of a member that can be read in ranges."""
    offset, size, method = members[name]
    if method != zipfile.ZIP_STORED:
        raise ValueError(f"{name} is not stored as it is")
    return offset, size


def read_range(file, offset: int, length: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """All records whose gzip members fill a range of the package."""
    data, at = memoryview(file.read_at(length, offset)), 0
    while at < length:
        unpacker, parts = zlib.decompressobj(wbits=31), []
        while not unpacker.eof:
            if at >= length:
                raise ValueError("the range ends within a record")
            portion = data[at:at + PORTION]  # what is left over of a portion is copied, so it is kept small
            parts.append(unpacker.decompress(portion))
            at += len(portion)
        at -= len(unpacker.unused_data)
        yield parse(b"".join(parts))


class PackageWriter:
    """A package that grows record by record; the index follows when it is closed."""

    def __init__(self, folder: str):
        system, home = filesystem(folder)
        system.create_dir(home, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        self.path, self.index, self.size = f"{folder}/{name}", [], 0
        self.out = system.open_output_stream(f"{home}/{name}")
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(RECORDS), "w", force_zip64=True)

    def add(self, key: int | None, data: bytes) -> None:
        packed = gzip.compress(data, LEVEL, mtime=0)
        self.index.append(json.dumps({"key": key, "offset": self.size, "length": len(packed)}))
        self.member.write(packed)
        self.size += len(packed)

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.index))
        self.zip.writestr(zipfile.ZipInfo("datapackage.json"), json.dumps(
            {"profile": "data-package", "wacz_version": "1.1.1", "resources": [{"path": RECORDS}, {"path": INDEX}]}))
        self.zip.close()
        self.out.close()
        return self.path, len(self.index)


# ---- Spark ----

MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64())])


def write_packages(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
                   package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write every row as a record; the manifest (path, records) of the packages comes back.

    First keys of repeated payloads are a small table; if it fits Spark's broadcast bound the pages are not shuffled, else
    both sides are and hot payloads are split.
    """
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"),
                        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long"))
    firsts = written(rows.where(F.col("size") >= MIN_PAYLOAD).groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n"))
                     .where("n > 1").select("digest", "first"), "first-payloads")
    marked = (rows.join(firsts, "digest", "left")
              .withColumn("first", F.when((F.col("key") == F.col("first")), None).otherwise(F.col("first")))
              .select("key", "url", F.when(F.col("first").isNull(), F.col("payload")).alias("payload"), "digest", "first", "size"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = None
        done = lambda path, n: pa.RecordBatch.from_pydict({"path": [path], "records": [n]}, schema=MANIFEST)
        for batch in batches:
            for row in zip(*batch.columns):
                k, u, payload, digest, first, size = (x.as_py() for x in row)
                package = package or PackageWriter(folder)
                package.add(k, record(k, u, payload or b"", digest, first, size))
                if package.size >= package_bytes:
                    yield done(*package.close())
                    package = None
        if package:
            yield done(*package.close())

    return written(marked.mapInArrow(run, "path string, records long"), "packages")


RANGES = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def ranges(paths: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, offset, length): runs of whole records, from the indexes of the packages."""
    def make():
        def locate(rows):
            out = {"path": [], "offset": [], "length": []}
            for path in rows["path"]:
                system, name = filesystem(path)
                with system.open_input_file(name) as file:
                    members = directory(file)
                    base, _ = stored(members, RECORDS)
                    index_at, index_n = stored(members, INDEX)
                    begin = end = 0
                    for line in file.read_at(index_n, index_at).splitlines():
                        place = json.loads(line)
                        if end - begin >= range_bytes:
                            for c, v in zip(out, (path, base + begin, end - begin)):
                                out[c].append(v)
                            begin = place["offset"]
                        end = place["offset"] + place["length"]
                    if end > begin:
                        for c, v in zip(out, (path, base + begin, end - begin)):
                            out[c].append(v)
            return out
        return locate

    return map_lists(paths.select("path").repartition(partitions(paths.sparkSession)), make, RANGES)


READ = pa.schema([("key", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                  ("refers_to", pa.int64()), ("url", pa.string())])


def read_records(paths: DataFrame, key: str = "page_id", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to, url) of every record in the packages.

    A response's size and digest are taken of its payload and must match its header; a revisit has those of its header.
    """
    def make():
        def read(rows):
            out = {name: [] for name in READ.names}
            for path, offset, length in zip(rows["path"], rows["offset"], rows["length"]):
                system, name = filesystem(path)
                with system.open_input_file(name) as file:
                    for head, payload in read_range(file, offset, length):
                        digest, first = head["warc-payload-digest"].removeprefix("sha256:"), head.get("x-refers-to-key")
                        size = int(head["x-payload-length"])
                        if first is None and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                            raise ValueError(f"damaged record in {path}")
                        values = (int(head["x-key"]) if "x-key" in head else None, size, digest, head["warc-type"],
                                  None if first is None else int(first), head.get("warc-target-uri"))
                        for column, value in zip(READ.names, values):
                            out[column].append(value)
            return out
        return read

    work = ranges(paths, range_bytes).repartition(partitions(paths.sparkSession), "path", "offset")
    return map_lists(work, make, READ).withColumnRenamed("key", key)


def package_folder(spark) -> str:
    return scratch_path(spark, "packages")
