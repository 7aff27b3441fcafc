"""Merkle manifest of a table: one tree per source, a tree over the sources, and a proof for every row.

A leaf is the SHA-256 of a row's columns. Leaves are ordered by range partitions that number themselves; one offset per
partition makes the numbers global. Trees grow by chunks of 81 neighbours, four levels at a time. Every node starts
with the siblings of its own run and a pointer to its parent. Proofs come from pointer jumping: each node is joined with the
node it points at, takes over its pointer and appends its segment, so the distance doubles with each round until all
leaves point beyond the root. Nodes that no leaf can ask for again are left out of the next round. Texts are read once, as
digests; only digests are shuffled.

Defined cases: a null column is the mark ``-``; an empty text is a text of 0 bytes; null sources form the first tree; null
keys come first in theirs; rows with one key are ordered by their leaf, and equal rows have equal leaves and each a proof; a
lone leaf is its own subroot; an empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import partitions, written
from tunemill.operators.sides import checked

FANOUT, LEVELS_EACH = 3, 4
CHUNK = FANOUT ** LEVELS_EACH
#: Number of the tree over the sources. Subroots are its leaves, in the order of the sources.
TOP = -1
#: Nodes that are broadcast at most; with more, there are as many different join keys, so a shuffle is even.
MAX_BROADCAST_NODES = 50_000
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(*columns: Column) -> Column:
    """Lower-case hex SHA-256 of the columns, each as its number of bytes, a colon and its value."""
    marks = []
    for column in columns:
        value = column.cast("string")
        marks.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*marks), 256)


def _hash(parts: list[bytes]) -> bytes:
    return hashlib.sha256("".join([p.hex() for p in parts]).encode()).digest()


_NUMBERED = "source string, doc_key long, leaf binary, claimed binary, part long, nth long, place long"


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the number of their source in this partition (``nth``) and their place within it."""
    part, nth, seen, last = TaskContext.get().partitionId(), -1, 0, None
    for batch in batches:
        runs = pc.run_end_encode(batch.column(0))
        at, nths, places = 0, [], []
        for end, source in zip(runs.run_ends.to_pylist(), runs.values.to_pylist()):
            if nth < 0 or source != last:
                nth, seen, last = nth + 1, 0, source
            nths.append(np.full(end - at, nth))
            places.append(np.arange(seen, seen + end - at))
            seen, at = seen + end - at, end
        if at:
            own = [pa.array(np.full(at, part)), pa.array(np.concatenate(nths)), pa.array(np.concatenate(places))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=[*batch.schema.names, "part", "nth", "place"])


def _numbered(leaves: DataFrame) -> DataFrame:
    """(tree, idx, doc_key, leaf, claimed): sources numbered in their order, leaves in the order of their keys."""
    spark = leaves.sparkSession
    order = ["source", "doc_key", "leaf", "row"]
    rows = leaves.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).drop("row")
    rows = written(rows.mapInArrow(_number, _NUMBERED), "ordered-leaves")
    last = F.struct("nth", "place")
    ends = rows.groupBy("part").agg(F.min_by("source", "nth").alias("first"), F.max_by("source", last).alias("last"),
                                    F.max(last).alias("end"))
    offsets, trees, before, count = [], -1, None, 0
    for r in sorted(ends.collect(), key=lambda r: r.part):  # one row per partition
        goes_on = trees >= 0 and r["first"] == before
        tree, idx = (trees, count) if goes_on else (trees + 1, 0)
        offsets.append((r.part, tree, idx))
        trees, before = tree + r.end.nth, r["last"]
        count = r.end.place + 1 + (idx if r.end.nth == 0 else 0)
    offsets = spark.createDataFrame(offsets, "part long, tree long, idx long")
    idx = F.col("place") + F.when(F.col("nth") == 0, F.col("idx")).otherwise(0)
    return rows.join(F.broadcast(offsets), "part").select((F.col("tree") + F.col("nth")).alias("tree"), idx.alias("idx"),
                                                          "doc_key", "leaf", "claimed")


_STEP = pa.struct([("left", pa.binary()), ("right", pa.binary()), ("top", pa.bool_())])
_ID = pa.struct([("tree", pa.int64()), ("level", pa.int64()), ("idx", pa.int64())])
_GROWN = pa.schema([("id", _ID), ("digest", pa.binary()), ("doc_key", pa.int64()), ("claimed", pa.binary()),
                    ("steps", pa.list_(_STEP)), ("up", _ID), ("above", pa.bool_()), ("done", pa.bool_())])
_ID_DDL = "struct<tree: long, level: long, idx: long>"
_GROWN_DDL = (f"id {_ID_DDL}, digest binary, doc_key long, claimed binary, "
              f"steps array<struct<left: binary, right: binary, top: boolean>>, up {_ID_DDL}, above boolean, done boolean")


def _grow(base: int):
    """Chunks of neighbours at level ``base`` to their nodes, and to the one node above each (``above``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for chunk in batch.to_pylist():
                tree, number, more = chunk["tree"], chunk["chunk"], chunk["more"]
                level, first, height = [m["digest"] for m in chunk["members"]], number * CHUNK, 0
                while more and height < LEVELS_EACH or not more and len(level) > 1 or not (height or base or more):
                    lone = not more and len(level) == 1
                    ends = not more and len(level) <= FANOUT
                    for i, digest in enumerate(level):
                        at = i % FANOUT
                        run_ = level[i - at:i - at + FANOUT]
                        up = {"tree": tree, "level": base + height + 1, "idx": (first + i) // FANOUT}
                        if ends:
                            up = None if tree == TOP else {"tree": TOP, "level": 0, "idx": tree}
                        steps = [] if lone else [{"left": b"".join(run_[:at]), "right": b"".join(run_[at + 1:]), "top": tree == TOP}]
                        row = {"id": {"tree": tree, "level": base + height, "idx": first + i}, "steps": steps, "up": up, "above": False}
                        if not base and not height:
                            member = chunk["members"][i]
                            row |= {"digest": digest, "doc_key": member["doc_key"], "claimed": member["claimed"]}
                        out.append(row)
                    if lone:
                        break
                    level = [_hash(level[i:i + FANOUT]) for i in range(0, len(level), FANOUT)]
                    first, height = first // FANOUT, height + 1
                out.append({"id": {"tree": tree, "level": base + height, "idx": number}, "digest": level[0], "above": True,
                            "done": not more})
            yield pa.RecordBatch.from_pylist(out, schema=_GROWN)

    return run


def _trees(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes of the trees over (tree, idx, digest, doc_key, claimed), written, and (tree, digest) of their roots."""
    base, now, grown = 0, leaves, []
    while True:
        members = F.sort_array(F.collect_list(F.struct("idx", "digest", "doc_key", "claimed")))
        chunks = now.groupBy("tree", F.floor(F.col("idx") / CHUNK).alias("chunk")).agg(members.alias("members"))
        # Only the first chunk of a tree must learn whether there is another; that is one row per tree on either side.
        others = now.where(F.col("idx") == CHUNK).select("tree", F.lit(0).cast("long").alias("chunk"), F.lit(True).alias("other"))
        chunks = chunks.join(others, ["tree", "chunk"], "left").select(
            "tree", "chunk", (F.col("other").isNotNull() | (F.col("chunk") > 0)).alias("more"), "members")
        grown.append(written(chunks.mapInArrow(_grow(base), _GROWN_DDL), "grown-trees"))
        base += LEVELS_EACH
        now = grown[-1].where("above AND NOT done").select(
            "id.tree", "id.idx", "digest", F.lit(None).cast("long").alias("doc_key"), F.lit(None).cast("binary").alias("claimed"))
        if now.isEmpty():
            break
    whole = grown[0]
    for part in grown[1:]:
        whole = whole.unionByName(part)
    return whole.where("NOT above"), whole.where("above AND done").select("id.tree", "digest")


def _jumped(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` after one jump: the segment of the node each points at is appended, its pointer taken over."""
    target = checked(nodes.select(F.col("id.tree").alias("t"), F.col("id.level").alias("l"), F.col("id.idx").alias("i"),
                                  F.col("steps").alias("more"), F.col("up").alias("next")), MAX_BROADCAST_NODES)
    joined = rows.join(target, (F.col("up.tree") == F.col("t")) & (F.col("up.level") == F.col("l")) & (F.col("up.idx") == F.col("i")))
    return joined.select(*[c for c in rows.columns if c not in ("steps", "up")], F.concat("steps", "more").alias("steps"),
                         F.col("next").alias("up"))


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf (hex) leads to with the siblings of a proof."""
    return F.aggregate(steps, leaf, lambda own, s: F.sha2(F.concat(F.lower(F.hex(s["left"])), own, F.lower(F.hex(s["right"]))), 256))


def siblings(steps: Column) -> Column:
    """All siblings of a proof as hex text, level by level, left to right."""
    return F.array_join(F.transform(steps, lambda s: F.lower(F.concat(F.hex(s["left"]), F.hex(s["right"])))), "")


def proofs(docs: DataFrame, key: str = "doc_id", group: str = "source", columns: tuple[str, ...] = COLUMNS,
           claimed: Column | None = None) -> DataFrame:
    """(key, leaf, claimed, subroot, root, steps) of every row; ``steps`` is its proof, see ``folded``.

    ``claimed``, a leaf in hex computed from the row, is carried along to be verified; without it, it is null.
    """
    claim = F.lit(None).cast("string") if claimed is None else claimed
    rows = docs.select(F.col(group).cast("string").alias("source"), F.col(key).cast("long").alias("doc_key"),
                       F.unhex(leaf_hash(*[F.col(c) for c in columns])).alias("leaf"), F.unhex(claim).alias("claimed"),
                       F.monotonically_increasing_id().alias("row"))
    leaves = _numbered(written(rows, "leaves")).withColumnRenamed("leaf", "digest")
    nodes, subroots = _trees(leaves)
    over, top = _trees(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest",
                                       F.lit(None).cast("long").alias("doc_key"), F.lit(None).cast("binary").alias("claimed")))
    first = top.first()
    root = first.digest.hex() if first else None
    now = nodes.where("id.level = 0").select("doc_key", F.col("digest").alias("leaf"), "claimed", "steps", "up")
    inner = nodes.where("id.level > 0").select("id", "steps", "up").unionByName(over.select("id", "steps", "up"))
    found, distance = None, 1
    while True:
        now = written(_jumped(now, inner.where((F.col("id.tree") == TOP) | (F.col("id.level") == distance))), "leaf-paths")
        ready = now.where("up IS NULL")
        found = ready if found is None else found.unionByName(ready)
        now = now.where("up IS NOT NULL")
        if now.isEmpty():
            break
        jumped = _jumped(inner.where("up IS NOT NULL"), inner).unionByName(inner.where("up IS NULL").select("id", "steps", "up"))
        distance *= 2
        inner = written(jumped.where((F.col("id.tree") == TOP) | (F.col("id.level") % distance == 0)), "node-paths")
    leaf, in_tree = F.lower(F.hex("leaf")), F.filter("steps", lambda s: ~s["top"])
    return found.select(F.col("doc_key").alias(key), leaf.alias("leaf"), F.lower(F.hex("claimed")).alias("claimed"),
                        folded(leaf, in_tree).alias("subroot"), F.lit(root).alias("root"), "steps")


def verified(docs: DataFrame, claimed: Column | None = None, key: str = "doc_id", group: str = "source",
             columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified): each row, or what is claimed of it, against the root."""
    found = proofs(docs, key, group, columns, claimed)
    again = folded(F.coalesce("claimed", "leaf"), F.col("steps"))
    return found.select(key, "leaf", "subroot", "root", F.sha2(siblings(F.col("steps")), 256).alias("proof_sha256"),
                        again.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
