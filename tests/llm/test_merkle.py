"""The manifest against a plain tree in Python."""

import hashlib
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tunemill.llm import merkle
from tunemill.llm.queries import QUERIES


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grow(level):
    """Root, and for each leaf its siblings as (left, right) level by level."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for k, path in enumerate(paths):
            low = at[k] - at[k] % 3
            path.append(("".join(level[low:at[k]]), "".join(level[at[k] + 1:low + 3])))
            at[k] //= 3
        level = [digest("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
    return level[0], paths


def plain(rows):
    """{row number: (leaf, subroot, root, siblings)} of (doc_id, source, lang, n_chars, text)."""
    first = lambda v: (v is not None, v.encode() if isinstance(v, str) else v if v is not None else 0)
    trees, out = {}, {}
    for n, row in enumerate(rows):
        trees.setdefault(row[1], []).append((first(row[0]), leaf(row), n))
    order = sorted(trees, key=first)
    grown = {s: grow([x[1] for x in sorted(trees[s])]) for s in order}
    root, over = grow([grown[s][0] for s in order])
    for s, up in zip(order, over):
        for (_, own, n), path in zip(sorted(trees[s]), grown[s][1]):
            out[n] = (own, grown[s][0], root, path + up)
    return out


def climb(own, path):
    for left, right in path:
        own = digest(left + own + right)
    return own


def test_registered(spark, sf):
    rows = [tuple(r) for r in pq.read_table(f"{sf}/documents.parquet").to_pandas()[list(merkle.COLUMNS)].itertuples(index=False)]
    rows = [tuple(None if v != v else v for v in r) for r in rows]
    want = plain(rows)
    got = {r.doc_id: r for r in QUERIES["op13_merkle_proofs"](spark, sf).collect()}
    assert len(got) == len(rows)
    changed = 0
    for n, row in enumerate(rows):
        own, subroot, root, path = want[n]
        shown = (*row[:4], row[4].replace("\n", "")) if zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None else row
        end, r = climb(leaf(shown), path), got[row[0]]
        assert (r.leaf, r.subroot, r.root) == (own, subroot, root)
        assert r.proof_sha256 == digest("".join(a + b for a, b in path))
        assert (r.folded_root, r.verified) == (end, end == root) and r.verified == (shown == row)
        changed += not r.verified
    assert changed


def made(sizes):
    rows = []
    for s, n in enumerate(sizes):
        source = None if s == 0 else ["b", "a", "é", "Z", "aa"][s % 5] + str(s)
        rows += [(i * 7 % 1000, source, None, i, f"text {s} {i}") for i in range(n)]
    return rows


@pytest.mark.parametrize("sizes", [(1,), (0, 1, 1), (81, 82, 1, 3, 4, 27, 28, 243, 244, 730), (1,) * 90])
def test_tree_sizes(spark, sizes):
    rows = made(sizes)
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    want = sorted((x[0], x[1], x[2], "".join(a + b for a, b in x[3])) for x in plain(rows).values())
    got = merkle.proofs(df).select("leaf", "subroot", "root", merkle.siblings(F.col("steps")).alias("s"),
                                   merkle.folded(F.col("leaf"), F.col("steps")).alias("end")).collect()
    assert sorted((r.leaf, r.subroot, r.root, r.s) for r in got) == want
    assert all(r.end == r.root for r in got)


def test_odd_rows(spark):
    long = "wort " * 50_000
    rows = [(1, "s", None, 1, None), (1, "s", None, 1, None), (1, "s", "en", None, ""), (None, "s", "en", 1, "a\nb"), (2, None, None, None, long),
            (3, "", "en", 3, "x"), (None, None, None, None, None)] + [(5, "hot", "en", 1, "same")] * 200
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    df = spark.createDataFrame(rows, schema)
    clash = df.select("*", *[F.lit(9).alias(c) for c in ("leaf", "row", "steps", "up", "tree", "idx", "part", "doc_key")])
    want = sorted((x[0], x[1], x[2]) for x in plain(rows).values())
    for table in (df, clash.repartition(7)):
        got = merkle.verified(table).collect()
        assert sorted((r.leaf, r.subroot, r.root) for r in got) == want and all(r.verified for r in got)
    assert merkle.verified(spark.createDataFrame([], schema)).collect() == []
