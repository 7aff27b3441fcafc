"""Ranked search against a plain version."""

import math
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tunemill.llm import ranked
from tunemill.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return Counter("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or ""))


def plain(docs, items, k=20):
    """{item: [score, ...]} and {(item, doc): scores} of (id, text) rows."""
    counts = [(i, terms_of(t)) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, total = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    asked = {}
    for i, text in items:
        asked.setdefault(i, Counter()).update(terms_of(text))
    out = {}
    for item, want in asked.items():
        found = []
        for i, c, n in counts:
            m = 75 + 25 * n * n_docs // total
            s = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t, times in want.items() if t in c)
            if s > 0:
                found.append((-s, i is not None, i or 0))
        if found:
            out[item] = [(i if known else None, -s) for s, known, i in sorted(found)[:k]]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return out


def table(sf, name, key):
    return list(pq.read_table(f"{sf}/{name}.parquet").to_pandas()[[key, "text"]].itertuples(index=False, name=None))


def test_registered(spark, sf):
    assert result(QUERIES["op12_ranked_search"](spark, sf)) == plain(table(sf, "documents", "doc_id"), table(sf, "benchmark", "item_id"))


@pytest.fixture(scope="module")
def odd(spark):
    docs = [(1, None), (2, ""), (3, " -- \x7f"), (4, "One two THREE"), (4, "One two THREE"), (None, "one two three"), (5, "été Été ÉTÉ x2 x2"),
            (6, "wort " * 40_000 + "one"), (7, "a_b a.b A"), *[(100 + i, "same line of words " + "pad " * (i % 7)) for i in range(60)],
            *[(200 + i, " ".join(f"t{j}" for j in range(i, i * 3))) for i in range(40)]]
    items = [(1, "one"), (1, "TWO two"), (2, None), (3, "nothing here"), (None, "x2 Été"), (4, "same words t20 t30 wort"), (5, "t39 a b"), (6, "")]
    return docs, items


@pytest.mark.parametrize("block, terms, pairs, first", [(4096, 500_000, 500_000, 8), (7, 2, 4, 1)])
def test_odd_rows(spark, odd, monkeypatch, block, terms, pairs, first):
    for name, value in (("MAX_TERMS", terms), ("PAIRS", pairs), ("FIRST_VISITS", first), ("MORE_VISITS", 3)):
        monkeypatch.setattr(ranked, name, value)
    docs, items = odd
    extra = [F.lit(1).alias(c) for c in ("m", "key", "score", "rank", "item", "n")]
    left = spark.createDataFrame(docs, "doc_id long, text string").select("*", *extra)
    right = spark.createDataFrame(items, "item_id long, text string").select("*", *extra)
    got = result(ranked.search(left.repartition(5), right, k=4, block=block))
    assert got == plain(docs, items, 4)


def test_empty_tables(spark, odd):
    docs, items = (spark.createDataFrame(r, f"{k} long, text string") for r, k in zip(odd, ("doc_id", "item_id")))
    for left, right in ((docs.where("false"), items), (docs, items.where("false"))):
        found = ranked.search(left, right)
        assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]


def test_some_strata_are_left_out(spark):
    """A long document cannot beat the last place that short ones fill."""
    docs = [(i, "rare word " + "x " * (i % 3)) for i in range(60)] + [(1000 + i, "rare " + "pad " * (500 + 40 * i)) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    index = ranked.build(df)
    weights = spark.createDataFrame([(1, "rare", 100), (1, "word", 900)], "item long, term string, weight long")
    visited, scored = [], ranked._scored

    def counted(index, visits, held, k):
        visited.append(visits.count())
        return scored(index, visits, held, k)

    ranked._scored, best = counted, None
    try:
        best = ranked._group(index, weights, 20).count()
    finally:
        ranked._scored = scored
    assert best == 20 and sum(visited) < index.strata.select("m").distinct().count()
