"""Token files coded with a range asymmetric numeral system (rANS), in blocks that decode on their own.

A file holds a run of documents in order: a header, the blocks, and an index in JSON lines at its end. One frequency table
per file is shared by its blocks. Each block interleaves ``LANES`` states of 64 bits that give off words of 32 bits, so
numpy codes all lanes at once; the final states stand at its head. The index is the list of checkpoints (offset, number of
ids and CRC-32 of each block) with the key and length of each document, so any run of documents is decoded from its own
blocks, in parallel with others.

Tasks write files under names of their own; only the files named in the written manifest of finished tasks are read, so a
repeated task does no harm. Defined cases: null and empty texts have the end id alone; null keys come first; rows with one
key are ordered by hash and text; an empty table gives no files and no rows. Further columns are ignored.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunemill.llm.common import filesystem, map_lists, partitions, written
from tunemill.llm.wordids import ID_BYTES, library_ids, pack
from tunemill.session import scratch_path

MAGIC = b"RANS0001"
SCALE, LOW = 20, 1 << 31
LANES, BLOCK_IDS, FILE_IDS = 2048, 1 << 17, 1 << 22
#: Ids of whole documents that one reading task takes at a time.
SPLIT_IDS = 1 << 20


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of ``1 << SCALE``, at least 1 for what occurs; what is over goes to the largest."""
    total, size = int(counts.sum()), 1 << SCALE
    scaled = np.where(counts > 0, np.maximum(1, counts.astype(np.float64) * size // max(1, total)), 0).astype(np.int64)
    over = int(scaled.sum()) - size
    for at in np.argsort(-scaled, kind="stable"):
        if over <= 0:
            break
        take = min(over, int(scaled[at]) - 1)
        scaled[at] -= take
        over -= take
    if total:
        scaled[int(np.argmax(scaled))] -= over
    return scaled


class Coder:
    """Coding and decoding with one frequency table."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray):
        self.symbols = symbols.astype(np.uint32)
        self.freqs = freqs.astype(np.uint64)
        self.starts = (np.cumsum(freqs) - freqs).astype(np.uint64)
        self.slots = None
        size = int(symbols.max()) + 1
        self.freq_of, self.start_of = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.freq_of[symbols], self.start_of[symbols] = self.freqs, self.starts

    def encode(self, ids: np.ndarray) -> bytes:
        """Final states of the lanes, then the words in the order in which decoding asks for them."""
        freq, start = self.freq_of[ids], self.start_of[ids]
        states = np.full(LANES, LOW, np.uint64)
        shift, words = np.uint64(SCALE), []
        for row in range((len(ids) - 1) // LANES * LANES, -1, -LANES):
            f, s = freq[row:row + LANES], start[row:row + LANES]
            x = states[:len(f)]
            full = x >= (f << np.uint64(63 - SCALE))
            words.append(x[full].astype("<u4"))
            x = np.where(full, x >> np.uint64(32), x)
            q = x // f
            states[:len(f)] = (q << shift) + (x - q * f) + s
        return states.astype("<u8").tobytes() + b"".join(w.tobytes() for w in reversed(words))

    def decode(self, data: bytes, n: int) -> np.ndarray:
        if self.slots is None:
            self.slots = np.repeat(np.arange(len(self.freqs), dtype=np.uint32), self.freqs.astype(np.int64))
        states = np.frombuffer(data, "<u8", LANES).astype(np.uint64)
        words = np.frombuffer(data, "<u4", offset=8 * LANES).astype(np.uint64)
        mask, shift, taken = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), 0
        out = np.empty(n, np.uint32)
        for row in range(0, n, LANES):
            x = states[:min(LANES, n - row)]
            slot = x & mask
            at = self.slots[slot]
            out[row:row + len(x)] = at
            x = self.freqs[at] * (x >> shift) + slot - self.starts[at]
            low = x < LOW
            k = int(low.sum())
            x[low] = (x[low] << np.uint64(32)) | words[taken:taken + k]
            taken += k
            states[:len(x)] = x
        return self.symbols[out]


def file_bytes(ids: np.ndarray, docs: list[tuple[int | None, int]]) -> bytes:
    """A whole file for documents of (key, length) whose ids follow one another."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    freqs = frequencies(counts[symbols])
    coder = Coder(symbols, freqs)
    table = zlib.compress(np.stack([symbols, freqs]).astype("<u4").tobytes())
    parts = [MAGIC, struct.pack("<I", len(table)), table]
    offset, blocks = sum(map(len, parts)), []
    for at in range(0, len(ids), BLOCK_IDS):
        own = ids[at:at + BLOCK_IDS]
        data = coder.encode(own)
        blocks.append([offset, len(data), len(own), zlib.crc32(own.astype("<u4").tobytes())])
        parts.append(data)
        offset += len(data)
    index = zlib.compress(json.dumps({"blocks": blocks, "docs": docs}).encode())
    return b"".join([*parts, index, struct.pack("<QI", offset, len(index)), MAGIC])


class TokenFile:
    """Reads the index of a file once, then any run of documents by range reads."""

    def __init__(self, uri: str):
        system, path = filesystem(uri)
        self.file = system.open_input_file(path)
        end = self.file.size()
        offset, length = struct.unpack("<QI", self._at(end - 20, 12))
        if self._at(end - 8, 8) != MAGIC or self._at(0, 8) != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        index = json.loads(zlib.decompress(self._at(offset, length)))
        self.docs, self.blocks = index["docs"], index["blocks"]
        self.doc_starts = np.cumsum([0] + [n for _, n in self.docs])
        self.block_starts = np.cumsum([0] + [b[2] for b in self.blocks])
        (size,) = struct.unpack("<I", self._at(8, 4))
        self.coder = Coder(*np.frombuffer(zlib.decompress(self._at(12, size)), "<u4").reshape(2, -1))
        self.last = (-1, np.empty(0, np.uint32))

    def _at(self, offset: int, length: int) -> bytes:
        return self.file.read_at(length, offset)

    def block(self, i: int) -> np.ndarray:
        if self.last[0] != i:
            offset, length, n, crc = self.blocks[i]
            ids = self.coder.decode(self._at(offset, length), n)
            if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
                raise ValueError(f"block {i} is damaged")
            self.last = (i, ids)
        return self.last[1]

    def parts(self, doc: int) -> Iterator[np.ndarray]:
        """The ids of a document, block by block."""
        at, end = int(self.doc_starts[doc]), int(self.doc_starts[doc + 1])
        i = int(np.searchsorted(self.block_starts, at, "right")) - 1
        while at < end:
            upto = min(end, int(self.block_starts[i + 1]))
            yield self.block(i)[at - int(self.block_starts[i]):upto - int(self.block_starts[i])]
            at, i = upto, i + 1

    def close(self) -> None:
        self.file.close()


MANIFEST = pa.schema([("part", pa.int64()), ("number", pa.int64()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())])


def write_files(docs: DataFrame, folder: str, vocabulary: str, key: str = "doc_id", text: str = "text",
                file_ids: int = FILE_IDS) -> DataFrame:
    """Write all documents in ascending key order; the manifest (part, number, path, docs, ids) of the files comes back."""
    rows = (docs.select(F.col(key).cast("long").alias("doc_key"), F.col(text).alias("body"))
            .repartitionByRange(partitions(docs.sparkSession), "doc_key")
            .sortWithinPartitions("doc_key", F.xxhash64("body"), "body"))
    end = pack([0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = library_ids(vocabulary), TaskContext.get().partitionId(), 0
        system, home = filesystem(folder)
        system.create_dir(home, recursive=True)
        held, size = [], 0

        def flush():
            ids = np.frombuffer(b"".join(x for _, x in held), "<u4")
            name = f"{part:06d}-{number:05d}-{uuid.uuid4().hex}.rans"
            with system.open_output_stream(f"{home}/{name}") as out:
                out.write(file_bytes(ids, [(k, len(x) // ID_BYTES) for k, x in held]))
            return pa.RecordBatch.from_pydict({"part": [part], "number": [number], "path": [f"{folder}/{name}"],
                                               "docs": [len(held)], "ids": [len(ids)]}, schema=MANIFEST)

        for batch in batches:
            for k, ids in zip(batch.column(0), encoder.many(body.as_py() for body in batch.column(1))):
                ids += end
                held.append((k.as_py(), ids))
                size += len(ids) // ID_BYTES
                if size >= file_ids:
                    yield flush()
                    held, size, number = [], 0, number + 1
        if held:
            yield flush()

    return written(rows.mapInArrow(run, "part long, number long, path string, docs long, ids long"), "manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """``start``: ids in all files before. Sums run within parts, and over one number per part."""
    parts = manifest.groupBy("part").agg(F.sum("ids").alias("part_ids"))
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(F.col("part"), F.coalesce(F.sum("part_ids").over(whole), F.lit(0)).alias("part_start"))
    own = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return (manifest.withColumn("in_part", F.coalesce(F.sum("ids").over(own), F.lit(0))).join(before, "part")
            .withColumn("start", F.col("part_start") + F.col("in_part")))


READ = pa.schema([("doc_key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_documents(manifest: DataFrame, key: str = "doc_id", split_ids: int = SPLIT_IDS) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, decoded from the files in splits of whole documents."""
    pieces = F.explode(F.sequence(F.lit(0), F.floor((F.col("ids") - 1) / split_ids)))
    splits = with_starts(manifest).select("path", "start", pieces.alias("split")).repartition(
        partitions(manifest.sparkSession), "path", "split")

    def make():
        def read(rows):
            out = {name: [] for name in READ.names}
            for path, start, split in zip(rows["path"], rows["start"], rows["split"]):
                file = TokenFile(path)
                first, last = np.searchsorted(file.doc_starts[:-1], [split * split_ids, (split + 1) * split_ids])
                for d in range(int(first), int(last)):
                    crc = 0
                    for ids in file.parts(d):
                        crc = zlib.crc32(np.ascontiguousarray(ids, "<u4"), crc)
                    for name, value in zip(READ.names, (file.docs[d][0], start + int(file.doc_starts[d]), file.docs[d][1], crc)):
                        out[name].append(value)
                file.close()
            return out
        return read

    return map_lists(splits, make, READ).withColumnRenamed("doc_key", key)


def token_folder(spark) -> str:
    return scratch_path(spark, "token-files")
