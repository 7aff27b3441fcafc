"""Ranked search by words over an index whose documents are grouped by equal length normaliser.

A stratum holds the documents with one normaliser ``m``, in blocks of bounded size; a row of the index is one block. For each
of its terms the postings lie together by term frequency, so the impact of a term in a stratum is computed once per frequency.
The largest frequency of each term in a stratum bounds what an item can score there. Items visit strata in the order of their
bounds, a few at first and then ever more, and leave out all strata whose bound is below the last place they have filled.
Only terms that some item asks for enter the index, as long as there are at most ``MAX_TERMS`` of them; with more, all do.

Items are searched in groups of about ``PAIRS`` pairs of item and term, which each task holds. Leaders of a block, at most
``k`` per item, leave the task; Spark limits them again before the shuffle.

Defined cases: null texts and texts without terms count nowhere and are never found; rows of items with one id are one
item; null item ids are an item; rows of documents with one id are several documents and may all be found; null document ids
come before others of equal score; items without a term in any document have no rows, as has an empty table on either
side; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunemill.llm.common import forget_worker_state, map_lists, partitions, written
from tunemill.operators.sides import checked

TOP, BLOCK = 20, 4096
MAX_TERMS, PAIRS = 500_000, 500_000
#: Strata an item visits at first, and how many times more it has visited after each further round.
FIRST_VISITS, MORE_VISITS = 8, 8
#: Terms in UTF-8: a byte above 0x7F is part of a character beyond ASCII.
TERMS = re.compile(rb"[0-9a-z\x80-\xff]+")


def term_counts(text: str | None) -> Counter:
    return Counter(TERMS.findall((text or "").encode().lower()))


_COUNTED = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.string())),
                      ("tfs", pa.list_(pa.int64()))])
_COUNTED_DDL = "id long, `key` long, n long, terms array<string>, tfs array<long>"


def counted(rows: DataFrame, key: str, text: str, only: frozenset[bytes] | None = None) -> DataFrame:
    """(id, key, n, terms, tfs) of rows with a term; ``terms`` are those in ``only``, ``n`` counts all."""
    wanted = rows.sparkSession.sparkContext.broadcast(only) if only is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_worker_state()
        for batch in batches:
            out = {name: [] for name in _COUNTED.names}
            for number, own, body in zip(*[batch.column(i) for i in range(3)]):
                found = term_counts(body.as_py())
                n = sum(found.values())
                if wanted is not None:
                    found = {t: found[t] for t in found.keys() & wanted.value}
                if n:
                    for name, value in zip(_COUNTED.names, (number.as_py(), own.as_py(), n, [t.decode() for t in found], list(found.values()))):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=_COUNTED)

    chosen = rows.select(F.monotonically_increasing_id().alias("id"), F.col(key).cast("long").alias("key"), F.col(text).alias("body"))
    return chosen.mapInArrow(run, _COUNTED_DDL)


_BLOCKS = pa.schema([("m", pa.int64()), ("docs", pa.list_(pa.int64())), ("terms", pa.list_(pa.string())), ("most", pa.list_(pa.int64())),
                     ("firsts", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32())),
                     ("places", pa.list_(pa.int32()))])
_BLOCKS_DDL = ("m long, docs array<long>, terms array<string>, most array<long>, firsts array<int>, tfs array<long>, starts array<int>, "
               "places array<int>")


def _block(rows: pa.Table) -> pa.Table:
    """One block of a stratum: postings by term, in it by frequency (highest first), in it by document."""
    rows = rows.sort_by([("key", "ascending")]).combine_chunks()
    order = np.argsort(np.array([k is not None for k in rows["key"].to_pylist()]), kind="stable")  # null keys first
    rows = rows.take(pa.array(order))
    terms, tfs = (rows[c].combine_chunks() for c in ("terms", "tfs"))
    place = np.repeat(np.arange(len(rows)), terms.value_lengths().to_numpy())
    coded = terms.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    by_name = np.argsort(np.array(names, object), kind="stable")
    number = np.empty(len(names), np.int64)
    number[by_name] = np.arange(len(names))
    term, tf = number[coded.indices.to_numpy()], tfs.flatten().to_numpy()
    order = np.lexsort((place, -tf, term))
    term, tf, place = term[order], tf[order], place[order]
    starts = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])])
    firsts = np.flatnonzero(np.r_[True, term[starts][1:] != term[starts][:-1]])
    return pa.Table.from_pydict({
        "m": [rows["m"][0].as_py()], "docs": [rows["key"].to_pylist()], "terms": [[names[i] for i in by_name]],
        "most": [tf[starts][firsts]], "firsts": [np.r_[firsts, len(starts)].astype(np.int32)], "tfs": [tf[starts]],
        "starts": [np.r_[starts, len(tf)].astype(np.int32)], "places": [place.astype(np.int32)]}, schema=_BLOCKS)


class Index:
    """``blocks``: the index. ``terms``: (term, df). ``strata``: (m, term, most), the largest frequency of each term."""

    def __init__(self, blocks: DataFrame, terms: DataFrame, strata: DataFrame, documents: int):
        self.blocks, self.terms, self.strata, self.documents = blocks, terms, strata, documents


def build(docs: DataFrame, key: str = "doc_id", text: str = "text", only: frozenset[bytes] | None = None, block: int = BLOCK) -> Index:
    """The index of all documents, written; of all terms, or of those in ``only`` (UTF-8)."""
    spark = docs.sparkSession
    found = written(counted(docs, key, text, only), "term-counts")
    total = found.agg(F.count("*").alias("n"), F.sum("n").alias("terms")).first()
    rows = found.where(F.size("terms") > 0).withColumn("m", F.expr(f"75 + (25L * n * {total.n}L) div {total.terms or 1}L"))
    sizes = checked(rows.groupBy("m").agg(F.ceil(F.count("*") / block).alias("blocks")))
    dealt = rows.join(sizes, "m").select("m", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), "key", "terms", "tfs")
    groups = dealt.repartition(partitions(spark), "m", "block").groupBy("m", "block")
    blocks = written(groups.applyInArrow(_block, _BLOCKS_DDL), "index-blocks")
    terms = written(rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")), "index-terms")
    each = blocks.select("m", F.explode(F.arrays_zip("terms", "most")).alias("t")).select("m", F.col("t.terms").alias("term"), "t.most")
    strata = written(each.groupBy("m", "term").agg(F.max("most").alias("most")), "index-strata")
    return Index(blocks, terms, strata, total.n)


_HITS = pa.schema([("item", pa.int64()), ("doc_key", pa.int64()), ("score", pa.int64())])
_HITS_DDL = "item long, doc_key long, score long"


def _scored(index: Index, visits: DataFrame, weights: dict, k: int) -> DataFrame:
    """(item, doc_key, score): the best ``k`` of each visited block for each item, none below the item's ``least``."""
    held = visits.sparkSession.sparkContext.broadcast(weights)

    def make():
        forget_worker_state()

        def score(rows):
            out = {name: [] for name in _HITS.names}
            for m, docs, terms, firsts, tfs, starts, places, items in zip(*[rows[c] for c in (
                    "m", "docs", "terms", "firsts", "tfs", "starts", "places", "items")]):
                number = {t: i for i, t in enumerate(terms)}
                tfs, starts, places = np.array(tfs, np.int64), np.array(starts), np.array(places)
                bounds = starts[firsts]
                impacts = np.repeat(1_000_000_000 * tfs // (1000 * tfs + 12 * m), np.diff(starts))
                for item in items:
                    own = [(number[t], w) for t, w in held.value[item["item"]] if t in number]
                    if not own:
                        continue
                    at, weight = (np.array(x, np.int64) for x in zip(*own))
                    sizes = bounds[at + 1] - bounds[at]
                    flat = np.repeat(bounds[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                    scores = np.zeros(len(docs), np.int64)
                    np.add.at(scores, places[flat], np.repeat(weight, sizes) * impacts[flat])
                    least = max(1, item["least"])
                    if len(scores) > k:
                        least = max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                    best = np.flatnonzero(scores >= least)
                    best = best[np.argsort(-scores[best], kind="stable")][:k]
                    out["item"] += [item["item"]] * len(best)
                    out["doc_key"] += [docs[i] for i in best]
                    out["score"] += scores[best].tolist()
            return out
        return score

    plan = visits.groupBy("m").agg(F.collect_list(F.struct("item", "least")).alias("items"))
    rows = index.blocks.join(checked(plan), "m").drop("most")
    return map_lists(rows, make, _HITS, slice_rows=16)


def _group(index: Index, weights: DataFrame, k: int) -> DataFrame:
    """(item, doc_key, score, rank) of some items, given as (item, term, weight)."""
    strata = index.strata.join(checked(weights), "term")
    bound = F.sum(F.expr("weight * ((1000000000L * most) div (1000 * most + 12 * m))")).alias("bound")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "m")
    visits = written(strata.groupBy("item", "m").agg(bound).withColumn("nth", F.row_number().over(order)), "visits")
    held: dict = {}
    for r in weights.toLocalIterator():
        held.setdefault(r.item, []).append((r.term, r.weight))
    best, low, high = None, 0, FIRST_VISITS
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_key")))
    left = visits.withColumn("least", F.lit(0).cast("long"))
    while True:
        hits = _scored(index, left.where((F.col("nth") > low) & (F.col("nth") <= high)), held, k)
        if best is not None:
            hits = hits.unionByName(best.drop("rank"))
        best = written(hits.withColumn("rank", rank).where(F.col("rank") <= k), "leaders")
        last = checked(best.where(F.col("rank") == k).select(F.col("item").alias("full"), F.col("score").alias("least")))
        left = visits.join(last, F.col("item").eqNullSafe(F.col("full")), "left").select(
            "item", "m", "bound", "nth", F.coalesce("least", F.lit(0)).alias("least")).where((F.col("bound") > 0) & (F.col("bound") >= F.col("least")))
        low, high = high, high * MORE_VISITS
        if left.where(F.col("nth") > low).isEmpty():
            return best


def search(docs: DataFrame, items: DataFrame, k: int = TOP, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """(item key, rank, key, score): the ``k`` best documents of every item."""
    asked = counted(items, item_key, item_text).select("key", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
    asked = written(asked.groupBy(F.col("key").alias("item"), F.col("t.terms").alias("term")).agg(F.sum("t.tfs").alias("times")), "item-terms")
    names = asked.select("term").distinct()
    few = names.limit(MAX_TERMS + 1).count() <= MAX_TERMS
    index = build(docs, key, text, frozenset(r.term.encode() for r in names.collect()) if few else None, block)
    weight = F.floor(1000 * F.log((2.0 * index.documents + 2) / (2.0 * F.col("df") + 1))).cast("long") * F.col("times")
    weights = written(asked.join(index.terms, "term").select("item", "term", weight.alias("weight")).where("weight > 0"), "item-weights")
    groups, found = -(-weights.count() // PAIRS), None
    for g in range(groups):
        own = weights.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == g) if groups > 1 else weights
        part = _group(index, own, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], _HITS_DDL + ", `rank` int")
    return found.select(F.col("item").alias(item_key), F.col("rank").cast("int").alias("rank"), F.col("doc_key").alias(key), "score")
