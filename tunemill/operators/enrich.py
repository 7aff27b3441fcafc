"""Keyed enrichment, the metadata cache and name lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.functions.bins import cut
from tunemill.functions.names import members_of, primary_of
from tunemill.operators.clean import keep_best
from tunemill.operators.ranks import quantiles
from tunemill.operators.sides import checked
from tunemill.presets import ENRICH_DEFAULTS, TIER_BINS


def distinct_members(df: DataFrame, col: str, name: str = "member") -> DataFrame:
    """Sorted distinct names over all lists; equal lists are split once."""
    lists = df.select(col).where(F.col(col).isNotNull()).distinct()
    return lists.select(F.explode(members_of(F.col(col))).alias(name)).distinct().orderBy(name)


def with_primary(df: DataFrame, col: str = "artists", name: str = "primary_artist") -> DataFrame:
    return df.withColumn(name, primary_of(F.col(col)))


def unique_by(dim: DataFrame, key: str, order: list[Column] | None = None) -> DataFrame:
    """One row per key, so that a join cannot multiply rows."""
    if order:
        return keep_best(dim.where(F.col(key).isNotNull()), [key], order)
    return dim.where(F.col(key).isNotNull()).dropDuplicates([key])


def enrich(facts: DataFrame, dim: DataFrame, left_key: str, right_key: str, order: list[Column] | None = None) -> DataFrame:
    """Left join to a dimension that is first made unique on its key.

    The unique dimension is counted and broadcast only within a bound; beyond it both sides are shuffled and adaptive
    execution splits hot keys of the fact side (skew join).
    """
    dim = checked(unique_by(dim, right_key, order))
    return facts.join(dim, facts[left_key] == dim[right_key], "left")


def match_rate(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count(col).alias("matched"), F.count(F.lit(1)).alias("rows"),
                  (100.0 * F.try_divide(F.count(col), F.count(F.lit(1)))).alias("match_pct"))


def fill_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Fill columns with a value, or with the median of the joined rows where the default is None."""
    defaults = {c: v for c, v in (ENRICH_DEFAULTS if defaults is None else defaults).items() if c in df.columns}
    by_median = [c for c, v in defaults.items() if v is None]
    values = {c: v for c, v in defaults.items() if v is not None}
    if by_median:
        values |= {r.feature: r.median for r in quantiles(df, by_median, {"median": 0.5}).collect()}
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double") if isinstance(v, float) else F.col(c), F.lit(v))
        for c, v in values.items()})


def with_artist_features(df: DataFrame, followers: str = "artist_followers", target: str = "popularity") -> DataFrame:
    """Log of followers, tier (0 followers has none) and the gap between track and artist score."""
    df = df.withColumns({"artist_followers_log": F.log1p(followers), "artist_tier": cut(F.col(followers), *TIER_BINS)})
    if "artist_popularity" in df.columns:
        df = df.withColumn("popularity_vs_artist", F.col(target) - F.col("artist_popularity"))
    return df


def missing_keys(keys: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    return keys.select(key).distinct().join(cache, key, "left_anti")


def upsert_cache(cache: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Union of old and new rows with one row per key; new rows win."""
    both = cache.withColumn("_age", F.lit(1)).unionByName(new.withColumn("_age", F.lit(0)), allowMissingColumns=True)
    return keep_best(both, [key], [F.asc("_age"), *[F.asc(c) for c in cache.columns if c != key]]).drop("_age")
