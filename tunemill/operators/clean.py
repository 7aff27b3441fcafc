"""Deduplication, filters, imputation, validation and the cleaning report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill.functions.scalars import finite
from tunemill.functions.sqltext import name
from tunemill.operators.columns import available, numeric_cols, string_cols
from tunemill.operators.ranks import quantiles
from tunemill.presets import AUDIO_FEATURES, CLEAN_RULES, TARGET
from tunemill.session import shared_dir


def missing_sql(df: DataFrame, col: str) -> str:
    """SQL text that is true where a value is null or, for floats, NaN."""
    test = f"{name(col)} IS NULL"
    return f"({test} OR isnan({name(col)}))" if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)) else test


def missing(df: DataFrame, col: str) -> Column:
    return F.expr(missing_sql(df, col))


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.expr(f"CASE WHEN NOT isnan({name(c)}) THEN {name(c)} END") for c in floats}) if floats else df


def drop_exact(df: DataFrame) -> DataFrame:
    """One copy of each fully identical row."""
    return df.dropDuplicates()


def keep_best(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key tuple in ``order``, which should break every tie.

    Spark keeps only each task's leading row per key before the shuffle, so a hot group of copies stays small.
    """
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def drop_copies(df: DataFrame, tie_break: list[str], keys: list[str] | None = None, by: str = TARGET) -> DataFrame:
    """One row per feature tuple, the one with the highest score."""
    keys = available(df, keys or AUDIO_FEATURES)
    if not keys:
        return df
    order = ([F.desc(by)] if by in df.columns else []) + [F.asc(c) for c in tie_break]
    return keep_best(df, keys, order)


def drop_zero(df: DataFrame, col: str = TARGET) -> DataFrame:
    return df.where(F.col(col) > 0)


def zero_stats(df: DataFrame, col: str = TARGET) -> DataFrame:
    """Zero rows, their share, and the mean, median and deviation of the remaining rows."""
    kept = F.when(F.col(col) > 0, F.col(col))
    median = medians(drop_zero(df, col), [col]).get(col)
    return df.agg(
        F.count_if(F.col(col) == 0).alias("zero_rows"),
        (100.0 * F.try_divide(F.count_if(F.col(col) == 0), F.count(F.lit(1)))).alias("zero_pct"),
        F.avg(kept).alias("new_mean"), F.lit(median).cast("double").alias("new_median"), F.stddev(kept).alias("new_std"))


def zero_top_categories(df: DataFrame, by: str, col: str = TARGET, k: int = 5) -> DataFrame:
    counts = df.where(F.col(col) == 0).groupBy(by).agg(F.count(F.lit(1)).alias("zero_rows"))
    return counts.orderBy(F.desc("zero_rows"), by).limit(k)


def complete_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=available(df, cols))


def finite_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    kept = df
    for c in available(df, cols):
        kept = kept.where(finite(F.col(c).cast("double")))
    return kept


def drop_all_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows that miss every one of ``cols``."""
    return df.dropna(how="all", subset=cols)


def modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value): the most frequent text per column, the smallest among ties."""
    counts = (df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "feature", "value")
              .where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt")))
    return counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("cnt"), F.col("value"))).alias("value"))


def medians(df: DataFrame, cols: list[str]) -> dict[str, float]:
    if not cols:
        return {}
    return {r.feature: r.median for r in quantiles(df, cols, {"median": 0.5}).collect()}


def impute(df: DataFrame, rules: dict[str, object] | None = None) -> DataFrame:
    """Fill missing numbers with the median and missing texts with the mode.

    ``rules`` replaces the default per column: "median", "mode" or a literal. One job finds the columns that need
    filling; only those are fitted.
    """
    rules = rules or {**{c: "median" for c in numeric_cols(df)}, **{c: "mode" for c in string_cols(df)}}
    holes = df.agg(*[F.count_if(missing(df, c)).alias(c) for c in rules]).first()
    needy = [c for c in rules if holes[c]]
    fills: dict[str, object] = {c: rules[c] for c in needy if rules[c] not in ("median", "mode")}
    fills |= medians(df, [c for c in needy if rules[c] == "median"])
    modal = [c for c in needy if rules[c] == "mode"]
    if modal:
        fills |= {r.feature: r.value for r in modes(df, modal).collect()}
    filled = {}
    for c, value in fills.items():
        # An integer column whose median lies between two integers becomes a double.
        fractional = isinstance(value, float) and not value.is_integer()
        dtype = T.DoubleType() if fractional else df.schema[c].dataType
        filled[c] = F.when(missing(df, c), F.lit(value).cast(dtype)).otherwise(F.col(c).cast(dtype))
    return df.withColumns(filled) if filled else df


def quantile_clip(df: DataFrame, cols: list[str], low: float = 0.005, high: float = 0.995) -> DataFrame:
    bounds = {r.feature: (r.low, r.high) for r in quantiles(df, cols, {"low": low, "high": high}).collect()}
    return df.withColumns({
        c: F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.lit(a)), F.lit(b)))
        for c, (a, b) in bounds.items()})


def validate(df: DataFrame, rules: dict[str, str] | None = None, strict: bool = False) -> DataFrame:
    """(rule, violations) in one pass, including one "no nulls" rule; ``strict`` raises on broken value rules."""
    rules = CLEAN_RULES if rules is None else rules
    nulls = F.expr(" + ".join(f"CAST({missing_sql(df, c)} AS BIGINT)" for c in df.columns))
    counts = df.agg(
        *[F.count_if(~F.coalesce(F.expr(cond), F.lit(False))).alias(name) for name, cond in rules.items()],
        F.coalesce(F.sum(nulls), F.lit(0)).alias("no_nulls"))
    result = counts.unpivot([], [*rules, "no_nulls"], "rule", "violations")
    if strict:
        broken = result.where((F.col("violations") > 0) & (F.col("rule") != "no_nulls")).collect()
        if broken:
            raise ValueError("rules broken: " + ", ".join(f"{r.rule} ({r.violations} rows)" for r in broken))
    return result


#: Repeated hashes (8 bytes each) that are broadcast at most.
MAX_REPEATED = 1_000_000


def spare_copies(df: DataFrame, cols: list[str]) -> DataFrame:
    """(spare): rows beyond the first of each group of rows that are equal in ``cols``.

    Equal rows have equal hashes, so only rows whose 64-bit hash occurs again are compared in full; the others send nothing
    but their hash. With more than ``MAX_REPEATED`` repeated hashes, which are checkpointed in the shared folder, all rows
    are grouped.
    """
    shared_dir(df.sparkSession)
    own = F.xxhash64(*cols)
    repeated = df.groupBy(own.alias("_hash")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_hash").checkpoint()
    rows = df
    if repeated.count() <= MAX_REPEATED:
        rows = df.join(F.broadcast(repeated), own == repeated["_hash"], "left_semi")
    groups = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("spare"))


def cleaning_report(df: DataFrame, keys: list[str] | None = None, by: str = TARGET) -> DataFrame:
    """Rows removed per cleaning step: exact copies by their hashes, recordings from one grouping by ``keys``."""
    keys = available(df, keys or AUDIO_FEATURES)
    recordings = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.max(by).alias("_best"))
    counts = recordings.agg(
        F.sum("_rows").alias("initial"), F.count(F.lit(1)).alias("after_copies"), F.count_if(F.col("_best") > 0).alias("final"))
    # Both sides have one row.
    totals = counts.crossJoin(spare_copies(df, df.columns)).withColumn("after_exact", F.col("initial") - F.col("spare"))
    steps = [("exact_duplicates", "initial", "after_exact"), ("feature_duplicates", "after_exact", "after_copies"),
             ("zero_target", "after_copies", "final"), ("total", "initial", "final")]
    entries = F.array(*[
        F.struct(F.lit(s).alias("step"), F.col(a).alias("rows_before"), (F.col(a) - F.col(b)).alias("removed"),
                 (F.col(a) - F.col(b)).cast("double").alias("_r"), F.col(a).cast("double").alias("_a"))
        for s, a, b in steps])
    return totals.select(F.inline(entries)).select(
        "step", "rows_before", "removed", (100.0 * F.try_divide("_r", "_a")).alias("removed_pct"))
