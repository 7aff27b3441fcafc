"""Exact quantiles by selection: a sketch says where they lie, one pass counts, and only the values nearby are looked at.

One aggregate takes a quantile sketch of all columns. Each wanted quantile gets an interval whose ends lie further from it than
the sketch can be wrong. A second aggregate counts the rows between the intervals and, inside them, the rows of every value, so
next to nothing is shuffled and no column is sorted. Running counts of what is left give the exact ranks. If a rank should fall
outside its interval the query fails; it never gives a wrong value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunemill.functions.sqltext import as_double, number
from tunemill.operators.sides import checked
from tunemill.session import shared_dir

#: The sketch is wrong by one in so many rows at most. Intervals reach twice as far to either side.
ACCURACY, MARGIN = 10_000, 2


def _begun_and_ended(value: str, edges: list[str]) -> tuple[Column, Column]:
    """Number of intervals that begin at or below a value, and of those that end below it.

    ``edges`` holds the lower and the upper end of each interval in turn, as SQL text. Intervals may overlap: a value lies in
    one if more have begun than ended, and the sum of both numbers is the range between two ends that it lies in. Plain sums
    of comparisons become compiled code, which functions over arrays do not.
    """
    sums = [" + ".join(["0", *[f"CAST({value} {test} {e} AS INT)" for e in own]]) for test, own in ((">=", edges[::2]), (">", edges[1::2]))]
    return F.expr(sums[0]), F.expr(sums[1])


def selected(df: DataFrame, cols: list[str], probs: dict[str, float], keys: list[str] = (), accuracy: int = ACCURACY) -> DataFrame:
    """(keys, feature, one column per quantile), exact and linearly interpolated.

    Missing values and rows with a null key are left out; a column without values has no row.
    """
    slots = [f"_k{j}" for j in range(len(keys))]
    rows = df.select(*[F.col(k).alias(s) for k, s in zip(keys, slots)], *[F.expr(f"{as_double(c)} AS _v{i}") for i, c in enumerate(cols)])
    for s in slots:
        rows = rows.where(F.col(s).isNotNull())
    reach = MARGIN / accuracy
    shares = [x for p in probs.values() for x in (max(0.0, p - reach), min(1.0, p + reach))]
    sketch = rows.groupBy(*slots).agg(*[F.percentile_approx(f"_v{i}", shares, accuracy).alias(f"_e{i}") for i in range(len(cols))])
    if slots:
        placed = rows.join(checked(sketch), slots)
        edges = [[f"get(_e{i}, {j})" for j in range(len(shares))] for i in range(len(cols))]
    else:
        found = sketch.first()
        placed = rows
        edges = [[number(x) for x in found[i] or []] for i in range(len(cols))]
    each = []
    for i, own in enumerate(edges):
        begun, ended = _begun_and_ended(f"_v{i}", own)
        each.append(F.struct(F.lit(i).alias("feature"), begun.alias("begun"), ended.alias("ended"), F.col(f"_v{i}").alias("value")))
    group = [*slots, "feature"]
    long = placed.select(*slots, F.inline(F.array(*each))).where(F.col("value").isNotNull()).select(
        *group, (F.col("begun") + F.col("ended")).alias("slot"), F.when(F.col("begun") > F.col("ended"), F.col("value")).alias("kept"), "value")
    shared_dir(df.sparkSession)
    # Both the offsets and the ranks are made of the counts, which are far fewer than the rows.
    counts = long.groupBy(*group, "slot", "kept").agg(F.count(F.lit(1)).alias("cnt"), F.min("value").alias("least"), F.max("value").alias("most")).checkpoint()
    whole, order = W.partitionBy(*group), W.partitionBy(*group).orderBy("slot")
    offsets = counts.groupBy(*group, "slot").agg(F.sum("cnt").alias("own")).select(
        *group, "slot", (F.sum("own").over(order) - F.col("own")).alias("offset"), F.sum("own").over(whole).alias("n"))
    inside = W.partitionBy(*group, "slot").orderBy("kept")
    ranked = (counts.join(offsets, [*group, "slot"])
              .withColumn("before", F.col("offset") + F.sum("cnt").over(inside) - F.col("cnt")))
    wanted, out = [], []
    for label, p in probs.items():
        at = (F.col("n") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            value = F.coalesce("kept", F.when(rank == F.col("before"), F.col("least")).when(rank == F.col("before") + F.col("cnt") - 1, F.col("most")))
            wanted.append(F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("cnt")), value)).alias(f"_{side}_{label}"))
        lo, hi = (F.coalesce(f"_{side}_{label}", F.raise_error(F.lit("a quantile lies outside its interval")).cast("double")) for side in ("lo", "hi"))
        out.append(F.when(at == F.floor(at), lo).otherwise(lo + (hi - lo) * (at - F.floor(at))).alias(label))
    table = ranked.groupBy(*group).agg(F.max("n").alias("n"), *wanted)
    names = F.array(*[F.lit(c) for c in cols])
    return table.select(*[F.col(s).alias(k) for k, s in zip(keys, slots)], F.get(names, F.col("feature")).alias("feature"), *out)
