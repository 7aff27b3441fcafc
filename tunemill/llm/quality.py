"""Quality rules with thresholds learned from the corpus itself, per language and source.

Each document gets whole-number measures; each group of language and source gets a quantile sketch of every measure. A
sketch is a histogram over buckets that grow with the value (exact below 64, then within 1/32), so sketches merge by
adding counts, in any order and with one result. Small groups take the merged sketch of their language, or of everything.
Fences beyond two percentiles of each measure, read from the sketches, are joined to the documents and decide.

Defined cases: a null text has no words; null languages and sources form groups of their own; documents that fail the base
rule teach nothing and are rejected; an empty table gives an empty result; repeated rows count each. Further columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tunemill.llm.common import forget_worker_state, written

SYMBOLS = b"#*$%&|<>"
NO_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Documents that a group needs for thresholds of its own.
MIN_DOCS = 200
#: measure: (lower and upper percentile read from the sketch, their distances from there to the fence, least distance of the
#: fence in the measure's unit, is there a lower fence). Symbols and word length take quartiles, since a tenth of a source may
#: be junk; repeated lines and words, which most texts lack and some good ones have, take the median and a far percentile.
FENCES = {"symbols": (25, 75, 4, 100, False), "dup_lines": (50, 99, 2, 200, False), "repeats": (50, 98, 4, 150, False),
          "word_length": (25, 75, 6, 80, True)}


def count_words(text: str | None) -> tuple[int, ...]:
    """The counts of ``COUNTS`` for one text."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode())
    repeats = 0
    if n > 3:
        ids = pd.factorize(np.array(words, object))[0].astype(np.int64)
        pairs = pd.factorize(ids[:-1] * n + ids[1:])[0].astype(np.int64)
        windows = pd.factorize(pairs[:-1] * n + ids[2:])[0]
        again = np.bincount(windows)[windows] > 1
        covered = np.zeros(n, bool)
        for shift in range(3):
            covered[shift:n - 2 + shift] |= again
        repeats = int(covered.sum())
    return n, chars, len(data.translate(None, NO_SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeats


def measured(text: Column) -> Column:
    """struct of ``COUNTS``. Declared as not deterministic, so that a filter on a count never counts the text a second time."""
    @pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def run(texts: pd.Series) -> pd.DataFrame:
        forget_worker_state()
        return pd.DataFrame([count_words(t) for t in texts], columns=COUNTS, dtype="int64")

    return run.asNondeterministic()(text)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Key columns of the documents, their counts as struct ``q`` and the base verdict."""
    n, repeats = F.col("q.n_words"), F.col("q.n_repeat_words")
    return docs.withColumn("q", measured(F.col(text))).withColumn(
        "base_failed", (n < MIN_WORDS) | (repeats * 100 > n * MAX_REPEAT_PERCENT))


def _measures() -> dict[str, Column]:
    q = lambda name: F.col(f"q.{name}")
    share = lambda a, b, unit: F.floor(a * unit / F.greatest(b, F.lit(1))).cast("long")
    return {"symbols": share(q("n_symbols"), q("n_words"), 1000), "dup_lines": share(q("n_dup_lines"), q("n_lines"), 1000),
            "repeats": share(q("n_repeat_words"), q("n_words"), 1000),
            "word_length": share(q("word_chars"), q("n_words"), 100)}


def bucket_of(value: Column) -> Column:
    """The value below 64; then its six leading bits and its size."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return (shift * 32 + F.floor(value / F.pow(F.lit(2.0), shift))).cast("long")


def largest_in(bucket: Column) -> Column:
    shift = F.greatest(F.floor(bucket / 32) - 1, F.lit(0))
    return ((bucket - shift * 32 + 1) * F.pow(F.lit(2.0), shift) - 1).cast("long")


def sketches(counted: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, measure, bucket, n): mergeable by adding n; counts are combined before the shuffle."""
    values = F.explode(F.array(*[F.struct(F.lit(name).alias("measure"), bucket_of(v).alias("bucket"))
                                 for name, v in _measures().items()]))
    return (counted.where(~F.col("base_failed")).select(*groups, values.alias("v"))
            .groupBy(*groups, "v.measure", "v.bucket").agg(F.count("*").alias("n")))


def percentiles(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, measure, docs, low, high): the two percentiles of ``FENCES``; a group has a bounded number of buckets."""
    by = Window.partitionBy(*groups, "measure")
    ranked = (sketch.withColumn("docs", F.sum("n").over(by))
              .withColumn("upto", F.sum("n").over(by.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))))
    at = lambda i: F.min(F.when(F.col("upto") * 100 >= F.col("docs") * _by_measure(i), F.col("bucket")))
    return (ranked.groupBy(*groups, "measure").agg(F.max("docs").alias("docs"), at(0).alias("b_low"), at(1).alias("b_high"))
            .select(*groups, "measure", "docs", largest_in(F.col("b_low")).alias("low"), largest_in(F.col("b_high")).alias("high")))


def _by_measure(i: int) -> Column:
    """The i-th number of ``FENCES`` for the measure of a row."""
    found = F.lit(None).cast("long")
    for name, numbers in FENCES.items():
        found = F.when(F.col("measure") == name, F.lit(numbers[i])).otherwise(found)
    return found


def _limits(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, limits) of one level of groups, from merged sketches."""
    own = percentiles(sketch.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n")), groups)
    own = own.withColumn("fence", F.greatest(_by_measure(3), (F.col("high") - F.col("low")) * _by_measure(2)))
    found = own.groupBy(*groups).agg(
        F.max("docs").alias("docs"),
        *[F.max(F.when(F.col("measure") == m, F.col("high") + F.col("fence"))).alias(f"high_{m}") for m in FENCES],
        *[F.max(F.when(F.col("measure") == m, F.col("low") - F.col("fence"))).alias(f"low_{m}")
          for m, numbers in FENCES.items() if numbers[4]])
    return found.select(*groups, F.struct(*found.columns[len(groups):]).alias("limits"))


def thresholds(counted: DataFrame, groups: list[str]) -> DataFrame:
    """One row per group with ``low_<measure>`` and ``high_<measure>``; ``groups`` go from wide to narrow.

    A group below ``MIN_DOCS`` documents takes the merged sketch of the next wider group that is large enough. The one row
    of the whole table becomes a literal.
    """
    sketch = written(sketches(counted, groups), "sketches")
    found = _limits(sketch, groups).withColumnRenamed("limits", f"t{len(groups)}")
    for depth in range(len(groups) - 1, 0, -1):
        level = groups[:depth]
        other = _limits(sketch, level).select(*[F.col(c).alias(f"o_{c}") for c in level], F.col("limits").alias(f"t{depth}"))
        on = [F.col(c).eqNullSafe(F.col(f"o_{c}")) for c in level]
        found = found.join(other, on, "left").drop(*[f"o_{c}" for c in level])
    whole = _limits(sketch, []).first().limits.asDict()
    enough = [F.when(F.col(f"t{d}.docs") >= MIN_DOCS, F.col(f"t{d}")) for d in range(len(groups), 0, -1)]
    rest = F.struct(*[F.lit(v).cast("long").alias(c) for c, v in whole.items()])
    return written(found.select(*groups, F.coalesce(*enough, rest).alias("limits")), "thresholds")


def verdict() -> Column:
    """Is every measure inside its fences? Without thresholds (nothing passed the base rule) only the base rule holds."""
    inside = F.lit(True)
    for name, value in _measures().items():
        inside = inside & F.coalesce(value <= F.col(f"limits.high_{name}"), F.lit(True))
        if FENCES[name][4]:
            inside = inside & F.coalesce(value >= F.col(f"limits.low_{name}"), F.lit(True))
    return ~F.col("base_failed") & inside


def judged(counted: DataFrame, limits: DataFrame, groups: list[str]) -> DataFrame:
    """``counted`` with ``kept``: documents joined with the thresholds of their group, nulls meeting nulls."""
    other = limits.select(*[F.col(c).alias(f"group_{i}") for i, c in enumerate(groups)], "limits")
    on = [F.col(c).eqNullSafe(F.col(f"group_{i}")) for i, c in enumerate(groups)]
    return counted.join(other, on, "left").withColumn("kept", verdict()).drop("limits", *[f"group_{i}" for i in range(len(groups))])
