"""Reports on zero-score rows, repeated titles, retention and yearly trends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunemill.functions.names import members_of
from tunemill.functions.scalars import harmonic_mean
from tunemill.presets import TARGET


def _zero(col: str = TARGET):
    return F.col(col) == 0


def zero_share_by(df: DataFrame, key: str, k: int) -> DataFrame:
    """Groups with the highest share of zero-score rows."""
    groups = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count_if(_zero()).alias("zero_rows"), F.count(F.lit(1)).alias("rows"))
    share = groups.withColumn("zero_pct", 100.0 * F.col("zero_rows") / F.col("rows"))
    return share.orderBy(F.desc("zero_pct"), key).limit(k)


def mostly_zero_groups(df: DataFrame, key: str, min_pct: float = 90.0) -> DataFrame:
    """Groups in which more than ``min_pct`` percent of the rows score zero."""
    groups = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count_if(_zero()).alias("zero_rows"), F.count(F.lit(1)).alias("rows"))
    return groups.where(100.0 * F.col("zero_rows") / F.col("rows") > min_pct)


def repeated_titles(df: DataFrame, title: str, features: list[str], k: int) -> DataFrame:
    """Most repeated titles among zero-score rows, with the largest number that share one feature tuple."""
    tuples = df.where(_zero() & F.col(title).isNotNull()).groupBy(title, *features).agg(
        F.count(F.lit(1)).alias("same"))
    titles = tuples.groupBy(title).agg(F.sum("same").alias("zero_rows"), F.max("same").alias("same_features"))
    return titles.orderBy(F.desc("zero_rows"), title).limit(k)


def zero_vs_nonzero(df: DataFrame, cols: list[str]) -> DataFrame:
    """Feature means of zero-score and other rows, with their difference."""
    zero, other = F.when(_zero(), F.lit(1)), F.when(~_zero(), F.lit(1))
    row = df.agg(*[F.avg(F.when(zero.isNotNull(), F.col(c))).alias(f"z{i}") for i, c in enumerate(cols)],
                 *[F.avg(F.when(other.isNotNull(), F.col(c))).alias(f"o{i}") for i, c in enumerate(cols)])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"z{i}").alias("zero_mean"),
                               F.col(f"o{i}").alias("nonzero_mean")) for i, c in enumerate(cols)])
    return row.select(F.inline(cells)).withColumn("difference", F.col("zero_mean") - F.col("nonzero_mean"))


def shared_fingerprint(df: DataFrame, features: list[str]) -> DataFrame:
    """Share of zero-score rows whose feature tuple occurs in another row; counted per tuple, without a window."""
    tuples = df.groupBy(*features).agg(F.count(F.lit(1)).alias("rows"), F.count_if(_zero()).alias("zero_rows"))
    shared = F.coalesce(F.sum(F.when(F.col("rows") > 1, F.col("zero_rows"))), F.lit(0))
    total = F.coalesce(F.sum("zero_rows"), F.lit(0))
    return tuples.agg(total.alias("zero_rows"), shared.alias("shared_rows"),
                      (100.0 * F.try_divide(shared, total)).alias("shared_pct"))


def retention_by(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows per group before and after cleaning."""
    a = before.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows_before"))
    b = after.groupBy(key).agg(F.count(F.lit(1)).alias("rows_after"))
    joined = a.join(b, key, "left").withColumn("rows_after", F.coalesce("rows_after", F.lit(0)))
    return joined.withColumn("retained_pct", 100.0 * F.col("rows_after") / F.col("rows_before"))


def rolling_by_year(df: DataFrame, key: str, year: str, val: str, span: int = 3) -> DataFrame:
    """Mean per group and year, and the mean of the last ``span`` yearly means."""
    yearly = df.where(F.col(key).isNotNull() & F.col(year).isNotNull()).groupBy(key, year).agg(
        F.avg(val).alias(f"mean_{val}"), F.count(F.lit(1)).alias("rows"))
    frame = W.partitionBy(key).orderBy(year).rowsBetween(-(span - 1), 0)
    return yearly.withColumn("rolling_mean", F.avg(f"mean_{val}").over(frame))


def spec_features(df: DataFrame, year: str = "release_year", tempo_step: int = 10) -> DataFrame:
    """Decade, tempo bucket, number of artists and the harmonic mean of valence and energy."""
    return df.withColumns({
        "decade": (F.floor(F.col(year) / 10) * 10).cast("int"),
        "tempo_bucket": (F.floor(F.col("tempo") / tempo_step) * tempo_step).cast("int"),
        "artist_count": F.size(members_of(F.col("artists"))),
        "mood_score": harmonic_mean(F.col("valence"), F.col("energy")),
    })
