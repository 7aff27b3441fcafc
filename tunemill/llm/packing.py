"""Best-fit packing of documents into sequences, online and in bounded space.

Each task packs the documents of its partition in their order. It holds at most a fixed number of open sequences, in a
bitset over their free space: the lowest set bit at or above a length is the best fit. If nothing fits and all are open
that may be, the fullest is closed. A placed piece is final at once, so nothing is kept but the free space of the open
sequences, and no row is shuffled.

Defined cases: a null or empty text is its end id alone; documents longer than a sequence are cut, the first piece taking
the remainder; ids may be null or repeat; further columns are ignored; an empty table gives an empty result. Sequence
numbers hold the partition in their upper bits, so a repeated task gives the same numbers.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import map_lists
from tunemill.llm.wordids import ID_BYTES, REMEMBERED, library_ids, pack

CAPACITY, OPEN = 2048, 1024
END = pack([0])
PIECES = pa.schema([("doc_key", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


class OpenSequences:
    """Open sequences by free space; ``place`` gives a piece its sequence and offset."""

    def __init__(self, capacity: int, limit: int, first: int = 0):
        self.capacity, self.limit, self.next, self.count = capacity, limit, first, 0
        self.bits, self.by_free = 0, [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        own = self.by_free[free]
        sequence = own.pop()
        if not own:
            self.bits ^= 1 << free
        self.count -= 1
        return sequence

    def _put(self, sequence: int, free: int) -> None:
        if free:
            self.by_free[free].append(sequence)
            self.bits |= 1 << free
            self.count += 1

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            if self.count >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
            sequence, free = self.next, self.capacity
            self.next += 1
        self._put(sequence, free - length)
        return sequence, self.capacity - free


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def packed(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           limit: int = OPEN, remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece with its place; see the module. ``remembered`` words are kept for encoding."""
    def make():
        encoder = library_ids(vocabulary, remembered)
        context = TaskContext.get()
        sequences = OpenSequences(capacity, limit, (context.partitionId() if context else 0) << 36)

        def pack_rows(rows):
            out = {name: [] for name in PIECES.names}
            for doc, ids in zip(rows["doc_key"], encoder.many(rows["body"])):
                ids += END
                for piece, (start, length) in enumerate(cut(len(ids) // ID_BYTES, capacity)):
                    crc = zlib.crc32(ids[start * ID_BYTES:(start + length) * ID_BYTES])
                    for name, value in zip(PIECES.names, (doc, piece, start, length, crc, *sequences.place(length))):
                        out[name].append(value)
            return out
        return pack_rows

    rows = docs.select(F.col(key).cast("long").alias("doc_key"), F.col(text).alias("body"))
    return map_lists(rows, make, PIECES).withColumnRenamed("doc_key", key)
