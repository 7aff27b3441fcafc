"""Likeness and arithmetic of multiset fingerprints on very long texts."""

from pyspark.sql import functions as F

from tunemill.llm import multiset


def likeness(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string").select(*[multiset.fingerprint(F.col(c)).alias(c) for c in "ab"])
    return df.select(multiset.likeness(F.col("a"), F.col("b"))).first()[0]


def test_lanes_of_very_long_texts(spark):
    a, b = ("\n".join(f"{name} {i}" for i in range(70_000)) for name in "ab")
    assert likeness(spark, a, b) < 0.35
    assert likeness(spark, "one line\n" * 70_000, "other line\n" * 70_000) < 0.35
    assert likeness(spark, "one line\n" * 70_000, "one line\n" * 69_000 + "other line\n" * 1000) > 0.9


def test_paragraphs_with_trailing_blanks(spark):
    """Order does not count, and add and subtract give the document, for CRLF and blanks at the end or start of a line."""
    cases = [("a. ", " b"), ("a.\r\nb\r", "c.\r"), ("x!\t", ""), ("", "y? "), ("a. ", "  b. c.  ")]
    df = spark.createDataFrame([(x, y, f"{x}\n{y}", f"{y}\n{x}") for x, y in cases], "x string, y string, xy string, yx string")
    x, y, xy, yx = (multiset.fingerprint(F.col(c)) for c in ("x", "y", "xy", "yx"))
    for r in df.select("xy", (xy == yx).alias("order"), (multiset.add(x, y) == xy).alias("add"), (multiset.subtract(xy, y) == x).alias("cut")).collect():
        assert r.order and r.add and r.cut, r.xy


def test_likeness_without_whole_sentences(spark):
    """Texts of one sentence, with any mark or none, with or without blanks, keep about half of their runs when edited."""
    texts = []
    for n in (12, 13, 20, 40, 100, 700):
        for mark in ("", ".", " ॥"):
            texts.append(" ".join(f"w{len(texts)}x{i}" for i in range(n)) + mark)
        texts.append("".join(chr(0x4E00 + (len(texts) * 997 + i * 31) % 20_000) for i in range(8 * n)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in multiset.fingerprints(df).collect():
        assert r.near_edited > 0.1 and r.near_edited > r.near_next, texts[r.doc_id][:60]


def test_sum_of_signs(spark):
    """Lanes are sums of hash bits, whatever the number of runs in a chunk."""
    for n in (0, 1, 14, 15, 16, 45, 100):
        runs = [f"r{i}" for i in range(n)]
        df = spark.createDataFrame([(runs,)], "runs array<string>")
        got, hashes = df.select(multiset.sign_sum(F.col("runs")), F.transform("runs", lambda x: F.array(
            *[F.xxhash64(F.lit(100 + i), x) for i in range(multiset.WORDS)]))).first()
        assert got == [sum((h[w] >> i & 1) + ((h[w] >> (i + 30) & 1) << 30) for h in hashes) for w in range(4) for i in range(30)]
