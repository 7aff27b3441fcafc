"""Lines that many documents share, dropped from all documents but one, with two Bloom filters ahead of the shuffle.

Each task notes the hashes of its lines in two filters of equal size: those seen once, and those seen again. Filters of two
tasks merge into the union of the first ones, and the union of the second ones with what the first ones have in common;
they travel as compressed segments, so a segment is merged as a stream in one task. A line whose bits are all in the merged
second filter is a suspect. Only the 32-byte digests of suspects are shuffled, to count their documents exactly and to find
the document that keeps the line; only documents with a suspect line are shuffled to be cut.

The filters grow with the number of lines up to ``MAX_BITS``, which every Python worker can hold. Beyond, they only suspect
more lines; the result does not depend on them.

Defined cases: a document is a row; a null or empty text is one empty line; rows that share the largest key all keep the line;
a null key is smaller than any other, and rows that all have null keys lose nothing; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import filesystem, forget_worker_state, map_lists, partitions, release_memory, worker_state, written
from tunemill.session import scratch_path

MIN_CHARS, MIN_DOCS = 40, 5
#: Characters that are no part of a line's key at its ends.
BLANKS = " \t\n\v\f\r"
HASHES, BITS_PER_LINE, MIN_BITS, MAX_BITS = 4, 8, 1 << 16, 1 << 29
SEGMENT = 1 << 16
#: A digest is hot if more than one in so many suspects has it; there are at most as many hot ones.
HOT = 1000


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """The line without blanks at its ends and A-Z in lower case; null if it is too short to count."""
    if len(line) < min_chars:
        return None
    core = line.strip(BLANKS)
    return core.encode().lower() if len(core) >= min_chars else None


def line_hashes(text: str, min_chars: int) -> set[int]:
    return {xxhash.xxh3_64_intdigest(k) for line in text.split("\n") if (k := line_key(line, min_chars)) is not None}


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """``HASHES`` places in a filter of ``bits`` (a power of two) for each hash."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return (hashes[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(bits - 1)


def holds(filter_: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each row of places: are all its bits set?"""
    return ((filter_[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def put(filter_: np.ndarray, at: np.ndarray) -> None:
    at = at.ravel()
    np.bitwise_or.at(filter_, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


class Filters:
    """Hashes seen once and hashes seen again, in one task."""

    def __init__(self, bits: int):
        self.bits, self.once, self.again = bits, np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    def add(self, hashes: list[int]) -> None:
        """Hashes of some documents, each document's own without repeats."""
        own, counts = np.unique(np.array(hashes, np.uint64), return_counts=True)
        at = places(own, self.bits)
        put(self.again, at[holds(self.once, at) | (counts > 1)])
        put(self.once, at)


_SEGMENTS = pa.schema([("segment", pa.int64()), ("once", pa.binary()), ("again", pa.binary())])
_SEGMENTS_DDL = "segment long, once binary, again binary"


def _packed(segment: int, once: np.ndarray, again: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"segment": [segment], "once": [zlib.compress(once.tobytes(), 1)],
                                       "again": [zlib.compress(again.tobytes(), 1)]}, schema=_SEGMENTS)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by number; those of one number become one."""
    segment, once, again = None, None, None
    for batch in batches:
        for number, a, b in zip(*[batch.column(i) for i in range(3)]):
            a, b = (np.frombuffer(zlib.decompress(x.as_py()), np.uint8) for x in (a, b))
            if number.as_py() != segment:
                if segment is not None:
                    yield _packed(segment, once, again)
                segment, once, again = number.as_py(), a, b
            else:
                again = again | b | (once & a)
                once = once | a
    if segment is not None:
        yield _packed(segment, once, again)


def seen_again(rows: DataFrame, bits: int, min_chars: int) -> str:
    """Path of the merged filter of hashes that more than one document may have."""
    size = min(SEGMENT, bits // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_worker_state()
        filters = Filters(bits)
        for batch in batches:
            hashes = []
            for body in batch.column(0):
                hashes += line_hashes(body.as_py(), min_chars)
                if len(hashes) > 1 << 16:
                    filters.add(hashes)
                    hashes = []
            filters.add(hashes)
        for at in range(0, bits // 8, size):
            once = filters.once[at:at + size]
            if once.any():
                yield _packed(at // size, once, filters.again[at:at + size])

    path = scratch_path(rows.sparkSession, "line-filter")
    merged = (rows.select("body").mapInArrow(run, _SEGMENTS_DDL).repartition(partitions(rows.sparkSession), "segment")
              .sortWithinPartitions("segment").mapInArrow(_merge, _SEGMENTS_DDL))
    merged.select("segment", "again").write.parquet(path)
    return path


def load_filter(path: str, bits: int) -> np.ndarray:
    system, home = filesystem(path)
    table, size = pq.read_table(home, filesystem=system), min(SEGMENT, bits // 8)
    whole = np.zeros(bits // 8, np.uint8)
    for segment, data in zip(table.column("segment"), table.column("again")):
        at = segment.as_py() * size
        whole[at:at + size] = np.frombuffer(zlib.decompress(data.as_py()), np.uint8)
    return whole


_MARKED_DDL = "`row` long, doc_key long, body string, suspects array<binary>"
_MARKED = pa.schema([("row", pa.int64()), ("doc_key", pa.int64()), ("body", pa.string()), ("suspects", pa.list_(pa.binary()))])


def _marked(rows: DataFrame, path: str, bits: int, min_chars: int) -> DataFrame:
    """Rows with the digests of their suspect lines, each once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_worker_state()
        release_memory()
        again = worker_state("line filter", lambda: load_filter(path, bits))
        for batch in batches:
            suspects = []
            for body in batch.column("body"):
                keys = list({k for line in body.as_py().split("\n") if (k := line_key(line, min_chars)) is not None})
                found = holds(again, places(np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64), bits))
                suspects.append([hashlib.sha256(keys[i]).digest() for i in np.flatnonzero(found)])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("row", "doc_key", "body")], pa.array(suspects, _MARKED.field("suspects").type)],
                                             schema=_MARKED)

    return written(rows.select("row", "doc_key", "body").mapInArrow(run, _MARKED_DDL), "marked-lines")


_CUT = pa.schema([("doc_key", pa.int64()), ("body", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])


def _cut(rows: DataFrame, min_chars: int) -> DataFrame:
    """(doc_key, body, n_lines, n_dropped) of rows with the digests to ``drop``."""
    def make():
        def cut(columns):
            out = {name: [] for name in _CUT.names}
            for key, body, drop in zip(columns["doc_key"], columns["body"], columns["drop"]):
                lines, drop = body.split("\n"), set(drop or ())
                kept = [x for x in lines if (k := line_key(x, min_chars)) is None or hashlib.sha256(k).digest() not in drop] if drop else lines
                for name, value in zip(_CUT.names, (key, "\n".join(kept), len(lines), len(lines) - len(kept))):
                    out[name].append(value)
            return out
        return cut

    return map_lists(rows.select("doc_key", "body", "drop"), make, _CUT)


def filter_bits(rows: DataFrame, min_chars: int, max_bits: int) -> int:
    """Size of the filters for the lines that can be long enough to count."""
    breaks = F.length("body") - F.length(F.replace("body", F.lit("\n"), F.lit(""))) + 1
    found = rows.agg(F.sum(F.least(breaks, F.length("body") / max(min_chars, 1))).alias("n")).first().n or 0
    return min(max_bits, max(MIN_BITS, 1 << (int(found * BITS_PER_LINE).bit_length())))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 max_bits: int = MAX_BITS) -> DataFrame:
    """(key, text, n_lines, n_dropped): each row's text without lines that ``min_docs`` rows share, kept by the largest key.

    ``min_docs`` is at least 2, as the filters tell lines seen again from others.
    """
    if min_docs < 2:
        raise ValueError("min_docs must be at least 2")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc_key"),
                       F.coalesce(F.col(text), F.lit("")).alias("body"))
    bits = filter_bits(rows, min_chars, max_bits)
    marked = _marked(rows, seen_again(rows, bits, min_chars), bits, min_chars)
    suspect = F.size("suspects") > 0
    pairs = marked.where(suspect).select("row", "doc_key", F.explode("suspects").alias("digest"))
    shared = written(pairs.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_key").alias("keep")), "suspect-lines")
    total = shared.agg(F.sum("n")).first()[0] or 0
    shared = shared.where(F.col("n") >= min_docs).select("digest", "keep", (F.col("n") * HOT > total).alias("hot"))
    hot = F.broadcast(shared.where("hot"))
    found = pairs.join(hot, "digest").unionByName(pairs.join(hot, "digest", "left_anti").join(shared.where("NOT hot"), "digest"))
    lost = found.where("keep IS NOT NULL AND (doc_key IS NULL OR doc_key < keep)")
    drops = lost.groupBy("row").agg(F.collect_list("digest").alias("drop"))
    touched = _cut(marked.where(suspect).select("row", "doc_key", "body").join(drops, "row", "left"), min_chars)
    lines = (F.length("body") - F.length(F.replace("body", F.lit("\n"), F.lit(""))) + 1).cast("long")
    plain = marked.where(~suspect).select("doc_key", "body", lines.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"))
    return plain.unionByName(touched).select(F.col("doc_key").alias(key), F.col("body").alias(text), "n_lines", "n_dropped")
