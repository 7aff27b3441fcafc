"""Exact order statistics without putting a whole column into one task.

A column is first reduced to its distinct values with counts (partial aggregation keeps hot values small). These are sorted by
ranges, which number their rows on their own; the totals of the ranges give the offsets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill.functions.sqltext import as_double, number, text
from tunemill.operators.selection import selected
from tunemill.operators.sides import checked
from tunemill.session import shared_dir


#: Ranges at most. Their bounds come from rows of every range that the driver holds, so their number must not grow with the table.
MAX_RANGES = 1024


def value_counts_long(df: DataFrame, cols: list[str], keys: list[str] = (), carry: str | None = None) -> DataFrame:
    """(keys, feature, value, cnt) over the non-missing values; rows with a null key are left out.

    With ``carry`` the sum and the count of that column per value are added as ``total`` and ``seen``.
    """
    ids = [F.col(k) for k in keys]
    sums = []
    if carry:
        ids.append(F.col(carry).cast("double").alias("_carry"))
        sums = [F.sum("_carry").alias("total"), F.count("_carry").alias("seen")]
    # Value columns travel under a number, so that a key or the carried column may also be a value column.
    wide = df.select(*ids, *[F.expr(f"{as_double(c)} AS _v{i}") for i, c in enumerate(cols)])
    long = wide.unpivot([c for c in wide.columns if not c.startswith("_v")], [f"_v{i}" for i in range(len(cols))],
                        "slot", "value").where(F.col("value").isNotNull())
    for key in keys:
        long = long.where(F.col(key).isNotNull())
    counts = long.groupBy(*keys, "slot", "value").agg(F.count(F.lit(1)).alias("cnt"), *sums)
    names = ", ".join(f"'_v{i}', {text(c)}" for i, c in enumerate(cols))
    return counts.select(*keys, F.expr(f"element_at(map({names}), slot) AS feature"), "value", "cnt",
                         *(["total", "seen"] if carry else []))


def _running(group: int):
    """Sorted rows whose first ``group`` columns name their group and whose last is a count, with the counts before them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, below = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            counts = batch.column(batch.num_columns - 1).to_numpy()
            sums = np.cumsum(counts) - counts
            starts = np.zeros(batch.num_rows, bool)
            for column in batch.columns[:group]:
                starts[1:] |= pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            first = tuple(column[0].as_py() for column in batch.columns[:group])
            starts[0] = True
            heads = np.flatnonzero(starts)
            offset = np.repeat(sums[heads], np.diff(np.r_[heads, batch.num_rows]))
            before = sums - offset
            goes_on = heads[1] if len(heads) > 1 else batch.num_rows
            if first == last:
                before[:goes_on] += below
            last = tuple(column[batch.num_rows - 1].as_py() for column in batch.columns[:group])
            below = int(before[-1] + counts[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part)), pa.array(before)],
                                             names=[*batch.schema.names, "_part", "_below"])

    return run


def rank_counts(counts: DataFrame, group: list[str], value: str = "value", max_values: int | None = None) -> DataFrame:
    """Add ``before`` (rows below the value), ``n`` (rows) and ``n_values`` (distinct values) of each group.

    ``counts`` has one row per group and value, with the rows in ``cnt``; groups and values are not null. One range exchange
    sorts them; ranges number their rows as a stream, and a table with one row per range and group brings in what lies before.
    ``max_values`` asks for ranges of about so many values, in up to ``MAX_RANGES`` ranges; longer ranges are streamed alike.
    The numbered rows are checkpointed in the shared folder, so both agree even after an executor is lost.
    """
    spark = counts.sparkSession
    shared_dir(spark)
    carried = counts.columns
    chosen = counts.select(*group, *[c for c in carried if c not in (*group, "cnt")], F.col("cnt").cast("long").alias("cnt"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if max_values is not None:
        parts = min(MAX_RANGES, max(2, math.ceil(counts.count() / max_values)))
    ordered = chosen.repartitionByRange(parts, *group, value).sortWithinPartitions(*group, value)
    schema = T.StructType([*chosen.schema.fields, T.StructField("_part", T.LongType()), T.StructField("_below", T.LongType())])
    placed = ordered.mapInArrow(_running(len(group)), schema).checkpoint()
    whole = W.partitionBy(*group)
    offsets = (placed.groupBy(*group, "_part").agg(F.sum("cnt").alias("_cnt"), F.count(F.lit(1)).alias("_values"))
               .select(*group, "_part", (F.sum("_cnt").over(whole.orderBy("_part")) - F.col("_cnt")).alias("_offset"),
                       F.sum("_cnt").over(whole).alias("n"), F.sum("_values").over(whole).alias("n_values")))
    return (placed.join(checked(offsets), [*group, "_part"]).withColumn("before", F.col("_offset") + F.col("_below"))
            .select(*carried, "before", "n", "n_values"))


def value_ranks(df: DataFrame, cols: list[str], keys: list[str] = (), max_values: int | None = None,
                carry: str | None = None) -> DataFrame:
    """(keys, feature, value, cnt, before, n, n_values): how many rows of the group lie below each distinct value."""
    counts = value_counts_long(df, cols, keys, carry)
    return rank_counts(counts, [*keys, "feature"], max_values=max_values)


def quantiles_from_ranks(ranks: DataFrame, probs: dict[str, float | str], keys: list[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles, one column per entry of ``probs``.

    A share is a number, or SQL text over ``n_values`` when it depends on the number of distinct values.
    """
    found, out = [], []
    for label, share in probs.items():
        pos = f"((n - 1) * {share if isinstance(share, str) else number(share)})"
        for side, at in (("lo", f"floor({pos})"), ("hi", f"ceil({pos})")):
            found.append(F.expr(f"max(CASE WHEN before <= {at} AND {at} < before + cnt THEN value END) AS _{side}_{label}"))
        out.append(F.expr(f"_lo_{label} + (_hi_{label} - _lo_{label}) * ({pos} - floor({pos})) AS {label}"))
    table = ranks.groupBy(*keys, "feature").agg(F.max("n").alias("n"), F.max("n_values").alias("n_values"), *found)
    return table.select(*keys, "feature", *out)


def quantiles(df: DataFrame, cols: list[str], probs: dict[str, float], keys: list[str] = (),
              max_values: int | None = None) -> DataFrame:
    """(keys, feature, one column per quantile), exact: by selection, or with ``max_values`` from the ranks of all values."""
    if max_values is None:
        return selected(df, cols, probs, keys)
    return quantiles_from_ranks(value_ranks(df, cols, keys, max_values), probs, keys)


def global_index(df: DataFrame, order: list, label: str = "position", start: int = 0) -> DataFrame:
    """Number every row in sort order by a range-partitioned sort.

    The sorted rows are checkpointed in the shared folder, so that the per-partition offsets and the rows agree even
    after an executor is lost. ``order`` should identify rows, which keeps the ranges balanced.
    """
    shared_dir(df.sparkSession)
    placed = df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_slot", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_part", (F.sum("_size").over(W.orderBy("_part")) - F.col("_size")).alias("_offset"))
    # One row per sort partition, which the session bounds.
    return (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(label, F.col("_offset") + F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1)) + F.lit(start))
            .drop("_slot", "_part", "_offset"))
