"""Near-duplicates by SimHash, found by exact comparison of tiles of fingerprints.

Equal fingerprints are one node. Nodes are dealt into tiles by the population counts of the two halves of the fingerprint;
two tiles are compared only if their counts can differ by no more than the radius. Inside a task numpy takes the exclusive
or of a tile pair and counts bits, and keeps a spanning forest of the links, so a group of copies never leaves as all its
pairs. Components of the links are found by star contraction.

Defined cases: a null or empty text has fingerprint zero and links like any other; fewer words than a shingle make one
shingle; equal fingerprints always share a component; the component is the smallest id that can be reached, null ids do
not count (null if there is no other). Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tunemill.llm.common import forget_worker_state, map_lists, written
from tunemill.llm.components import components

SEED = 42
#: Mean number of fingerprints in a tile of a crowded cell.
TILE = 16_384
#: Compared at once in a task: rows of one tile times the other tile.
BLOCK = 1 << 21


def shingle_hashes(text: str | None, words_each: int) -> np.ndarray:
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= words_each:
        return np.array([digest(line, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(words) - words_each + 1]
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[words_each - 1:].tolist())),
                       np.uint64, len(starts))


def simhash(text: str | None, words_each: int = 4, numbers: int = 1) -> bytes:
    """Majority of the shingles' hash bits, most significant first; each further number of 64 bits mixes the hashes anew."""
    return majority(shingle_hashes(text, words_each), numbers)


def majority(hashes: np.ndarray, numbers: int) -> bytes:
    out = []
    for i in range(numbers):
        mixed = hashes if i == 0 else _mix(hashes, i)
        set_bits = np.zeros(64, np.int64)
        for at in range(0, len(mixed), 1 << 15):
            part = mixed[at:at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
            set_bits += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        out.append(np.packbits(set_bits * 2 > len(mixed)).tobytes())
    return b"".join(out)


def _mix(hashes: np.ndarray, i: int) -> np.ndarray:
    x = hashes + np.uint64(i * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(text: Column, words_each: int = 4, numbers: int = 1) -> Column:
    @pandas_udf("binary")
    def run(texts):
        forget_worker_state()
        return pd.Series([simhash(t, words_each, numbers) for t in texts], dtype=object)

    return run(text)


def _ones(half: int, size: int) -> Column:
    """Set bits in one half of a binary fingerprint of ``size`` bytes, four bytes at a time."""
    at = range(half * (size // 2) + 1, (half + 1) * (size // 2), 4)
    counts = [F.bit_count(F.conv(F.hex(F.substring(F.col("fp"), i, 4)), 16, 10).cast("long")) for i in at]
    return sum(counts[1:], counts[0])


def tiles(nodes: DataFrame, numbers: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """(cell_a, cell_b, part, prints) and the cells with their number of parts.

    A cell is a band of population counts of each half; the bands are at most ``32 * numbers + 1`` a half, so the cells are
    few whatever the size of the corpus.
    """
    band = max(1, radius // 4)
    celled = nodes.select("fp", *[F.floor(_ones(h, 8 * numbers) / band).cast("int").alias(c) for h, c in enumerate(("cell_a", "cell_b"))])
    cells = written(celled.groupBy("cell_a", "cell_b").agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts")), "cells")
    dealt = (celled.join(F.broadcast(cells), ["cell_a", "cell_b"])
             .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")))
    return (written(dealt.groupBy("cell_a", "cell_b", "part").agg(F.array_join(F.collect_list(F.hex("fp")), "").alias("prints"))
                    .withColumn("prints", F.unhex("prints")), "tiles"), cells)


def tile_pairs(cells: DataFrame, radius: int) -> DataFrame:
    """Pairs of tiles whose population counts can differ by no more than ``radius``; each pair once, a tile with itself too."""
    band = max(1, radius // 4)
    reach = radius // band + 1
    gap = lambda d: max(0, (abs(d) - 1) * band + 1) if d else 0
    near = [(i, j) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1) if gap(i) + gap(j) <= radius and (i, j) >= (0, 0)]
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in near]))
    left = (cells.select(F.col("cell_a").alias("a1"), F.col("cell_b").alias("b1"), F.col("parts").alias("n1"), steps.alias("s"))
            .select("a1", "b1", "n1", (F.col("a1") + F.col("s.i")).alias("a2"), (F.col("b1") + F.col("s.j")).alias("b2")))
    right = cells.select(F.col("cell_a").alias("a2"), F.col("cell_b").alias("b2"), F.col("parts").alias("n2"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    return (left.join(right, ["a2", "b2"]).select("*", upto("n1").alias("p1")).select("*", upto("n2").alias("p2"))
            .where("a1 <> a2 OR b1 <> b2 OR p1 <= p2").drop("n1", "n2"))


def forest(one: np.ndarray, other: np.ndarray, radius: int, same: bool, first: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``one`` and ``other`` of links that connect all that is linked, with few links more.

    Rows are numbers of 64 bits; they link if all differ in at most ``radius`` bits and the first numbers in at most
    ``first``. Links from one row of ``one`` leave only to groups of ``other`` not yet joined with it.
    """
    n = len(other)
    group = np.arange(n)
    found_a, found_b = [], []
    rows = max(1, BLOCK // max(1, n))
    for at in range(0, len(one), rows):
        block = one[at:at + rows]
        i, j = np.nonzero(np.bitwise_count(block[:, :1] ^ other[None, :, 0]) <= min(radius, first))
        if one.shape[1] > 1:
            near = np.bitwise_count(block[i] ^ other[j]).sum(axis=1, dtype=np.int64) <= radius
            i, j = i[near], j[near]
        if same:
            i, j = i[i + at < j], j[i + at < j]
        if not len(i):
            continue
        firsts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
        for s, e in zip(firsts, np.r_[firsts[1:], len(i)]):
            row, near = int(i[s]) + at, j[s:e]
            if same:
                near = np.r_[row, near]
            labels, where = np.unique(group[near], return_index=True)
            if same:
                own = group[row]
                ends = [int(near[w]) for label, w in zip(labels, where) if label != own]
            else:
                ends = near[where].tolist()
            found_a += [row] * len(ends)
            found_b += ends
            if len(labels) > 1:
                group[np.isin(group, labels[1:])] = labels[0]
    return np.array(found_a, np.int64), np.array(found_b, np.int64)


def links(tiled: DataFrame, pairs: DataFrame, radius: int, numbers: int, first: int = 64) -> DataFrame:
    """(u, v): a spanning forest of the links of each tile pair, as fingerprints."""
    left = tiled.select(F.col("cell_a").alias("a1"), F.col("cell_b").alias("b1"), F.col("part").alias("p1"), F.col("prints").alias("x"))
    right = tiled.select(F.col("cell_a").alias("a2"), F.col("cell_b").alias("b2"), F.col("part").alias("p2"), F.col("prints").alias("y"))
    work = (pairs.join(left, ["a1", "b1", "p1"]).join(right, ["a2", "b2", "p2"])
            .select("x", "y", F.expr("a1 = a2 AND b1 = b2 AND p1 = p2").alias("same")))
    schema = pa.schema([("u", pa.binary()), ("v", pa.binary())])

    def make():
        def compare(rows):
            out = {"u": [], "v": []}
            for x, y, same in zip(rows["x"], rows["y"], rows["same"]):
                a = np.frombuffer(x, ">u8").astype(np.uint64).reshape(-1, numbers)
                b = np.frombuffer(y, ">u8").astype(np.uint64).reshape(-1, numbers)
                size = 8 * numbers
                for i, j in zip(*forest(a, b, radius, same, first)):
                    out["u"].append(x[i * size:(i + 1) * size])
                    out["v"].append(y[j * size:(j + 1) * size])
            return out
        return compare

    return map_lists(work, make, schema)


def clustered(docs: DataFrame, key: str = "doc_id", text: str = "text", words_each: int = 4, numbers: int = 1,
              radius: int = 4, first: int = 64) -> DataFrame:
    """(key, fingerprint, component_id) of every document; see the module for the cases.

    Fingerprints have ``numbers`` times 64 bits and link if they differ in at most ``radius`` of all and in at most
    ``first`` of the first 64. ``key`` may be any column that has an order, a struct too.
    """
    prints = written(docs.select(F.col(key).alias("doc_key"), fingerprint(F.col(text), words_each, numbers).alias("fp")), "prints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_key").alias("rep")), "nodes")
    tiled, cells = tiles(nodes, numbers, radius)
    roots = components(links(tiled, tile_pairs(cells, radius), radius, numbers, first))
    member = nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = member.groupBy("root").agg(F.min("rep").alias("component_id"))
    known = written(member.join(smallest, "root").select("fp", "component_id"), "known")
    return (prints.join(known, "fp").select(F.col("doc_key").alias(key), F.lower(F.hex("fp")).alias("fingerprint"), "component_id"))
