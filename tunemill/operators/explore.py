"""The queries behind an interactive explorer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_in(df: DataFrame, col: str, values: list) -> DataFrame:
    """Rows whose value is listed; an empty list keeps all rows."""
    return df.where(F.col(col).isin(list(values))) if values else df


def between(df: DataFrame, col: str, low, high) -> DataFrame:
    return df.where(F.col(col).between(low, high))


def preview(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, score: str, k: int, *tie_break: str) -> DataFrame:
    return df.orderBy(F.desc(score), *tie_break).limit(k)


def playlist(df: DataFrame, order: list, n: int = 10, cut: float = 0.5) -> DataFrame:
    """First ``n`` energetic and danceable items."""
    return preview(df.where((F.col("energy") > cut) & (F.col("danceability") > cut)), order, n)


def similar_hits(df: DataFrame, genre: str, key: str, min_score: int = 70, n: int = 5) -> DataFrame:
    """Best-scored items of a genre."""
    hits = df.where((F.col("track_genre") == genre) & (F.col("popularity") >= min_score))
    return hits.orderBy(F.desc("popularity"), key).limit(n)


def export_filtered(df: DataFrame, path: str, categories: dict[str, list], spans: dict[str, tuple]) -> None:
    """Write the filtered table as CSV."""
    for col, values in categories.items():
        df = filter_in(df, col, values)
    for col, (low, high) in spans.items():
        df = between(df, col, low, high)
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
