"""The pipeline's near-duplicate stage against all pairs of fingerprints."""

import random

import corpus_pipeline
from tunemill.llm.simhash import simhash


def kept(rows):
    """Positions of the rows that stay: the first by (id, position), nulls last, of each component of links."""
    prints, root = [int.from_bytes(simhash(t, 4)) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 4 and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    order = lambda i: (rows[i][0] is None, rows[i][0] or 0, i)
    return sorted(min((i for i, r in enumerate(root) if r == k), key=order) for k in set(root))


def check(spark, rows):
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n_chars long").coalesce(1)
    got = corpus_pipeline.near_duplicates(spark, df, "")
    assert got.columns == df.columns
    assert sorted(r.n_chars for r in got.collect()) == kept(rows)


def test_one_document_of_each_component_stays(spark):
    rng, rows = random.Random(7), []
    for _ in range(40):
        base = [f"w{rng.randrange(10**9)}" for _ in range(rng.choice([3, 60, 300]))]
        rows.append((rng.randrange(1000), " ".join(base)))
        for _ in range(rng.randint(0, 5)):
            words = base.copy()
            for at in rng.sample(range(len(words)), rng.randint(0, min(3, len(words)))):
                words[at] = f"v{rng.randrange(10**9)}"
            rows.append((rng.randrange(1000), " ".join(words).upper()))
    check(spark, rows)


def test_nulls_ties_and_repeated_rows(spark):
    long = "a b c d e f " * 5000
    check(spark, [(None, "one"), (3, "one"), (3, "ONE"), (None, None), (None, ""), (7, None), (None, long), (None, long), (1, "two")])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert corpus_pipeline.near_duplicates(spark, df, "").count() == 0
