"""Recommendation rules as data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.presets import RECOMMENDATIONS

MAX_RECOMMENDATIONS = 5


def recommend(df: DataFrame, key: list[str], ruleset: str = "full") -> DataFrame:
    """(key, rank, factor, current_value, current, suggestion, impact, tip): the rules each row meets, in rule order."""
    found = F.array(*[
        F.when(F.expr(f"{col} {condition}"), F.struct(
            F.lit(factor).alias("factor"), F.col(col).cast("double").alias("current_value"),
            F.format_string(fmt, F.col(col).cast("double")).alias("current"), F.lit(suggestion).alias("suggestion"),
            F.lit(impact).alias("impact"), F.lit(tip).alias("tip")))
        for factor, col, condition, fmt, suggestion, impact, tip in RECOMMENDATIONS[ruleset]])
    met = F.slice(F.filter(found, lambda rule: rule.isNotNull()), 1, MAX_RECOMMENDATIONS)
    return (df.select(*key, F.posexplode(met).alias("pos", "rule"))
            .select(*key, (F.col("pos") + 1).alias("rank"), "rule.*"))
