"""Shared lines against a plain version."""

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tunemill.llm import linededup
from tunemill.llm.queries import QUERIES

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def plain(rows, least_docs=5):
    """[(text, n_lines, n_dropped)] of (doc_id, text)."""
    where = defaultdict(set)
    for n, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            where[key_of(line)].add(n)
    rank = lambda n: -1 if rows[n][0] is None else rows[n][0]
    keep = {k: max(map(rank, own)) for k, own in where.items() if len(k) >= 40 and len(own) >= least_docs}
    out = []
    for n, (_, text) in enumerate(rows):
        lines = (text or "").split("\n")
        kept = [x for x in lines if keep.get(key_of(x), rank(n)) == rank(n)]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_registered(spark, sf):
    rows = list(pq.read_table(f"{sf}/documents.parquet").to_pandas()[["doc_id", "text"]].itertuples(index=False, name=None))
    got = {r.doc_id: r for r in QUERIES["op11_line_dedup"](spark, sf).collect()}
    assert len(got) == len(rows)
    for (i, _), (text, n_lines, n_dropped) in zip(rows, plain(rows)):
        assert (got[i].n_lines, got[i].n_dropped, got[i].kept_sha256) == (n_lines, n_dropped, hashlib.sha256(text.encode()).hexdigest())
    assert any(r.n_dropped for r in got.values())


LINE, OTHER = "This line of forty characters is SHARED by all", "é" * 39 + "Ä"


@pytest.fixture(scope="module")
def odd():
    rows = [(i, f"own {i}\n  {LINE}\t\nend" if i % 3 else f"{LINE.lower()}\n{LINE}\nmine {i} " + "x" * i) for i in range(60)]
    rows += [(59, LINE), (None, LINE), (None, None), (70, ""), (71, "\n\n"), (72, "wort " * 30_000 + "\n" + OTHER), (73, OTHER[:39])]
    rows += [(80 + i, f"{OTHER}\n\x0b{OTHER}\x0c\n\xa0{OTHER}") for i in range(4)] + [(90, "y" * 40)] * 4 + [(91, "z" * 40)] * 5
    return rows + [(None, "n" * 50)] * 6


@pytest.mark.parametrize("max_bits", [1 << 16, linededup.MAX_BITS])
def test_odd_rows(spark, odd, max_bits):
    df = spark.createDataFrame(odd, "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in ("row", "body", "drop", "digest", "keep", "n_lines")])
    want = sorted((str(i), *p) for (i, _), p in zip(odd, plain(odd)))
    for table in (df, df.repartition(7)):
        got = linededup.deduplicated(table, max_bits=max_bits).collect()
        assert sorted((str(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in got) == want


def test_crowded_filter_and_empty_table(spark, monkeypatch):
    rows = [(i, "\n".join(f"line {j % 977} of many lines that fill the filters {j % 977}" for j in range(i, i + 400))) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    monkeypatch.setattr(linededup, "MIN_BITS", 64)
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in linededup.deduplicated(df, max_bits=64).collect()}
    assert [got[i] for i, _ in rows] == plain(rows)
    assert linededup.deduplicated(df.where("false")).collect() == []


def test_filters_tell_once_from_again():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 1 << 63, 1000).astype(np.uint64) for _ in range(2))
    filters = linededup.Filters(1 << 16)
    filters.add(a.tolist())
    filters.add(b[:500].tolist())
    filters.add([*b[:250].tolist(), *b[900:].tolist(), *b[900:].tolist()])
    again = linededup.holds(filters.again, linededup.places(np.concatenate([b[:250], b[900:]]), 1 << 16))
    once = linededup.holds(filters.again, linededup.places(np.concatenate([a, b[250:500]]), 1 << 16))
    assert again.all() and once.mean() < 0.01
