"""Repeatable samples and splits of exact size.

Rows are ordered by a seeded hash of their key. A sample or split is a range of that order, so it is described by a few
cut points, and the wide rows are only filtered, never shuffled. The cut points are found on the key column alone: count
rows per leading bits of the hash, which every task combines to a few thousand rows, find the bucket that holds
the wanted position, and rank inside that bucket, after narrowing it by further bits when it is large.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunemill.operators.sides import checked
from tunemill.session import shared_dir

LEVEL_BITS = 12
MAX_RANKED_ROWS = 2_000_000


def hash_order(key: list[str], seed: int) -> Column:
    return F.struct(F.xxhash64(*key, F.lit(seed)).alias("h"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(key)])


def _matching(rows: DataFrame, targets: DataFrame, on: list[str]) -> DataFrame:
    """Rows in the buckets of ``targets``; null strata match each other."""
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")) for c in on]
    extra = [c for c in targets.columns if c not in on]
    joined = rows.alias("r").join(targets.alias("t"), same)
    return joined.select("r.*", *[F.col(f"t.{c}").alias(c) for c in extra])


def hash_cuts(df: DataFrame, key: list[str], seed: int, sizes: dict[str, Column], strata: list[str] = (),
              max_ranked: int = MAX_RANKED_ROWS) -> DataFrame:
    """Last row, in hash order, of each leading part whose cumulative size is given.

    ``sizes`` maps a name to an expression over ``n``, the rows of the stratum. Returns (strata, cut, last).
    """
    strata = list(strata)
    shared_dir(df.sparkSession)
    leading = F.shiftright(F.col("o.h"), 64 - LEVEL_BITS)
    rows = df.select(*strata, hash_order(key, seed).alias("o")).withColumn("bucket", leading)
    group = W.partitionBy(*(strata or [F.lit(0)]))
    totals = (rows.groupBy(*strata, "bucket").agg(F.count(F.lit(1)).alias("cnt"))
              .withColumns({"before": F.sum("cnt").over(group.orderBy("bucket")) - F.col("cnt"),
                            "n": F.sum("cnt").over(group)}))
    wanted = F.array(*[F.struct(F.lit(name).alias("cut"), size.cast("long").alias("size"))
                       for name, size in sizes.items()])
    inside = (F.col("before") < F.col("size")) & (F.col("size") <= F.col("before") + F.col("cnt"))
    targets = (totals.select("*", F.inline(wanted)).where(inside)
               .select(*strata, "bucket", "cut", "cnt", (F.col("size") - F.col("before")).alias("nth")).checkpoint())
    largest = targets.agg(F.max("cnt")).first()[0] or 0
    found = _matching(rows, checked(targets.drop("cnt")), [*strata, "bucket"])  # a row per stratum and cut
    if largest > max_ranked:
        following = F.shiftright(F.col("o.h"), 64 - 2 * LEVEL_BITS).bitwiseAND(F.lit((1 << LEVEL_BITS) - 1))
        found = found.withColumn("bucket", following)
        part = W.partitionBy(*strata, "cut")
        narrowed = (found.groupBy(*strata, "cut", "nth", "bucket").agg(F.count(F.lit(1)).alias("cnt"))
                    .withColumn("before", F.sum("cnt").over(part.orderBy("bucket")) - F.col("cnt"))
                    .withColumn("size", F.col("nth")).where(inside)
                    .select(*strata, "cut", "bucket", (F.col("nth") - F.col("before")).alias("nth")))
        found = _matching(found.drop("nth"), checked(narrowed.checkpoint()), [*strata, "cut", "bucket"])
    ranked = found.withColumn("rn", F.row_number().over(W.partitionBy(*strata, "cut").orderBy("o")))
    return ranked.where(F.col("rn") == F.col("nth")).select(*strata, "cut", F.col("o").alias("last"))


def _literal(row, key: list[str]) -> Column:
    return F.struct(F.lit(row[0]).alias("h"), *[F.lit(v).alias(f"k{i}") for i, v in enumerate(row[1:len(key) + 1])])


def sample_n(df: DataFrame, n: int, seed: int, key: list[str]) -> DataFrame:
    """Exactly ``n`` rows (all rows if there are fewer); ``key`` must identify rows.

    A smaller sample with the same seed is a subset of a larger one.
    """
    if n <= 0:
        return df.limit(0)
    cut = hash_cuts(df, key, seed, {"sample": F.lit(n)}).first()
    return df if cut is None else df.where(hash_order(key, seed) <= _literal(cut.last, key))


def split_sizes(n: Column, scheme: str) -> dict[str, Column]:
    """Sizes of the parts in the order train, val, test; held-out sizes are rounded up."""
    def up(size: Column, share: float) -> Column:
        return F.ceil(size * F.lit(share)).cast("long")
    if scheme == "80/20":
        test = up(n, 0.2)
        return {"train": n - test, "test": test}
    if scheme == "64/16/20":
        test = up(n, 0.2)
        val = up(n - test, 0.2)
        return {"train": n - test - val, "val": val, "test": test}
    if scheme == "70/15/15":
        held = up(n, 0.3)
        test = up(held, 0.5)
        return {"train": n - held, "val": held - test, "test": test}
    raise ValueError(f"unknown split scheme {scheme}")


def split(df: DataFrame, scheme: str, key: list[str], seed: int = 42, strata: list[str] = ()) -> DataFrame:
    """Add ``split`` with parts of exact size, repeatable for a key and seed; per stratum when ``strata`` is given."""
    strata = list(strata)
    parts = list(split_sizes(F.col("n"), scheme).items())
    ends, total = {}, F.lit(0)
    for name, size in parts[:-1]:
        total = total + size
        ends[name] = total
    cuts = hash_cuts(df, key, seed, ends, strata)
    order, last_part = hash_order(key, seed), parts[-1][0]
    if not strata:
        found = {r.cut: r["last"] for r in cuts.collect()}
        label = None
        for name in ends:
            if name in found:
                here = order <= _literal(found[name], key)
                label = F.when(here, name) if label is None else label.when(here, name)
        return df.withColumn("split", F.lit(last_part) if label is None else label.otherwise(last_part))
    wide = cuts.groupBy(*strata).pivot("cut", list(ends)).agg(F.first("last"))
    wide = wide.select(*[F.col(s).alias(f"_s{i}") for i, s in enumerate(strata)],
                       *[F.col(c).alias(f"_end_{c}") for c in ends])
    joined = df.join(checked(wide.checkpoint()), [df[s].eqNullSafe(F.col(f"_s{i}")) for i, s in enumerate(strata)], "left")
    label = None
    for name in ends:
        here = order <= F.col(f"_end_{name}")
        label = F.when(here, name) if label is None else label.when(here, name)
    return joined.withColumn("split", label.otherwise(last_part)).select(*df.columns, "split")


def split_summary(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.avg(target).alias("mean"),
                                   F.stddev(target).alias("std"))


def expected_sizes(n: int, scheme: str) -> dict[str, int]:
    """The same sizes for a known row count, as plain numbers."""
    up = lambda size, share: math.ceil(size * share)
    if scheme == "80/20":
        return {"train": n - up(n, 0.2), "test": up(n, 0.2)}
    if scheme == "64/16/20":
        test = up(n, 0.2)
        val = up(n - test, 0.2)
        return {"train": n - test - val, "val": val, "test": test}
    held = up(n, 0.3)
    test = up(held, 0.5)
    return {"train": n - held, "val": held - test, "test": test}
