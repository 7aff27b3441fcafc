"""Token counts of whole texts, huge ones in overlapping chunks that are spliced where the cut is proven safe.

A piece vocabulary with byte fallback merges neighbouring characters only into pieces it has. Where two neighbouring
characters stand side by side in no piece, no merge can ever cross: such a place is a token boundary in every encoding that
holds both characters, and what follows does not depend on what came before. A huge text is cut into chunks that overlap
to both sides; each chunk is encoded with offsets in its own task and reports the proven boundaries in its overlaps with
the number of tokens before them. Neighbours are spliced at a boundary both report. Texts with a seam that has none are
done again with overlaps and chunks four times as wide, at the end in one piece.

Defined cases: null and empty texts have no tokens; rows may repeat and ids be null; further columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunemill.llm.common import map_lists, partitions, worker_state, written

CHUNK, OVERLAP, WIDER, LIMIT = 16_384, 64, 4, 4096
#: Chunks that are sent on together.
CHUNKS_EACH = 64
SPACE = "▁"


class Pieces:
    """A sentencepiece vocabulary, and the pairs of characters that its pieces hold side by side."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        names = [m.id_to_piece(i) for i in range(m.vocab_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))]
        self.pairs = {p[i:i + 2] for p in names for i in range(len(p) - 1)}

    def stable(self, text: str, at: int) -> bool:
        """Can no merge cross the place before character ``at``?"""
        return text[at - 1:at + 1].replace(" ", SPACE) not in self.pairs

    def count(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1, return_type="numpy")]

    def boundaries(self, text: str, zones: list[tuple[int, int]]) -> tuple[int, list[list[tuple[int, int]]]]:
        """Number of tokens, and for each zone of characters its proven boundaries as (character, tokens before)."""
        offsets = self.model.encode(text, return_type="offset_mapping")["offsets"]
        found = [[] for _ in zones]
        for n, (at, _) in enumerate(offsets):
            for zone, (low, high) in zip(found, zones):
                if low < at < high and (not zone or zone[-1][0] < at) and self.stable(text, at):
                    zone.append((at, n))
        return len(offsets), found


def pieces(path: str) -> Pieces:
    return worker_state(f"pieces {path}", lambda: Pieces(path))


CHUNKS = pa.schema([("row", pa.int64()), ("chunk", pa.int64()), ("last", pa.bool_()), ("start", pa.int64()),
                    ("core", pa.int64()), ("end", pa.int64()), ("part", pa.string())])
_SEAMS = pa.schema([("row", pa.int64()), ("chunk", pa.int64()), ("last", pa.bool_()), ("n", pa.int64()),
                    *[(f"{side}_{what}", pa.list_(pa.int64())) for side in ("left", "right") for what in ("at", "n")]])
_SEAMS_DDL = ("row long, chunk long, last boolean, n long, left_at array<long>, left_n array<long>, right_at array<long>, "
              "right_n array<long>")


def _sliced(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Each text as overlapping parts; ``core`` to ``end`` is the part's own range of characters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, body in zip(batch.column(0), batch.column(1)):
                text, number = body.as_py(), row.as_py()
                cores = range(0, len(text), chunk)
                for first in range(0, len(cores), CHUNKS_EACH):
                    own = [(c, min(c + chunk, len(text))) for c in cores[first:first + CHUNKS_EACH]]
                    starts = [max(0, c - overlap) for c, _ in own]
                    yield pa.RecordBatch.from_pydict({
                        "row": [number] * len(own), "chunk": [c // chunk for c, _ in own],
                        "last": [e == len(text) for _, e in own], "start": starts, "core": [c for c, _ in own],
                        "end": [e for _, e in own], "part": [text[s:e + overlap] for s, (_, e) in zip(starts, own)]}, schema=CHUNKS)

    return rows.mapInArrow(run, "row long, chunk long, last boolean, start long, core long, end long, part string")


def _encoded(parts: DataFrame, vocabulary: str, overlap: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(vocabulary)
        for batch in batches:
            out = {name: [] for name in _SEAMS.names}
            for r in batch.to_pylist():
                zones = [(c - overlap - r["start"], c + overlap - r["start"]) for c in (r["core"], r["end"])]
                n, (left, right) = model.boundaries(r["part"], zones)
                for name, value in (("row", r["row"]), ("chunk", r["chunk"]), ("last", r["last"]), ("n", n),
                                    ("left_at", [r["start"] + a for a, _ in left]), ("left_n", [b for _, b in left]),
                                    ("right_at", [r["start"] + a for a, _ in right]), ("right_n", [b for _, b in right])):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=_SEAMS)

    return parts.mapInArrow(run, _SEAMS_DDL)


def _spliced(seams: DataFrame) -> DataFrame:
    """(row, n_tokens): null where two neighbours have no boundary in common."""
    order = Window.partitionBy("row").orderBy("chunk")
    before = lambda c: F.lag(c).over(order)
    joined = seams.select("*", before("right_at").alias("before_at"), before("right_n").alias("before_n"))
    common = F.array_min(F.array_intersect("before_at", "left_at"))
    upto = lambda n, at: F.get(F.col(n), (F.array_position(F.col(at), common) - 1).cast("int"))
    joined = joined.withColumn("step", F.when(F.col("chunk") == 0, F.lit(0)).otherwise(
        upto("before_n", "before_at") - upto("left_n", "left_at")) + F.when(F.col("last"), F.col("n")).otherwise(0))
    return joined.groupBy("row").agg(F.when(F.count("step") == F.count("*"), F.sum("step")).alias("n_tokens"))


def _huge(long: DataFrame, vocabulary: str, chunk: int, overlap: int) -> DataFrame:
    """(row, doc_key, n_bytes, n_tokens) of long texts with numbers, by one width of overlap, written."""
    parts = _sliced(long.select("row", "body"), chunk, overlap).repartition(partitions(long.sparkSession), "row", "chunk")
    counted = _spliced(_encoded(parts, vocabulary, overlap))
    known = long.select("row", "doc_key", F.octet_length("body").cast("long").alias("n_bytes"))
    return written(known.join(counted, "row"), "token-counts")


def token_counts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every document."""
    whole = docs.select(F.col(key).alias("doc_key"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    schema = pa.schema([("doc_key", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def make():
        model = pieces(vocabulary)

        def count(rows):
            return {"doc_key": rows["doc_key"], "n_bytes": rows["n_bytes"], "n_tokens": model.count(rows["body"])}
        return count

    size: Column = F.length("body")
    short = map_lists(whole.where(size <= chunk).select(F.col("doc_key").cast("long"), "body", F.octet_length("body").cast("long").alias("n_bytes")),
                      make, schema)
    # Row numbers hold only for rows that are written: the input may come in another order when it is read again.
    numbered = whole.where(size > chunk).select(F.col("doc_key").cast("long"), "body", F.monotonically_increasing_id().alias("row"))
    result, long = short, written(numbered, "long-texts")
    while True:
        done = _huge(long, vocabulary, chunk, overlap)
        result = result.unionByName(done.where("n_tokens IS NOT NULL").select("doc_key", "n_bytes", "n_tokens"))
        failed = done.where("n_tokens IS NULL").select("row")
        if failed.isEmpty():
            break
        long = long.join(failed, "row", "left_semi")
        overlap, chunk = overlap * WIDER, max(chunk, overlap * WIDER * 4)
    return result.select(F.col("doc_key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
