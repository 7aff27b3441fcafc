"""Counts, summaries, frequency tables and group profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.functions.bins import fixed_width_bin
from tunemill.functions.sqltext import as_double, name, rows, text
from tunemill.operators.clean import medians, missing_sql, spare_copies
from tunemill.operators.columns import numeric_cols
from tunemill.operators.ranks import quantiles, value_counts_long
from tunemill.operators.sides import checked

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def per_feature(df: DataFrame, cols: list[str], stats: dict[str, str]) -> DataFrame:
    """One aggregation over all columns, turned into one row per feature.

    ``stats`` maps a result name to SQL text with ``{c}`` for the column, ``{x}`` for its value as a double and ``{m}``
    for the test that it is missing.
    """
    aggregates = [f"{sql.format(c=name(c), x=as_double(c), m=missing_sql(df, c))} AS {label}_{i}"
                  for i, c in enumerate(cols) for label, sql in stats.items()]
    entries = [{"feature": text(c), **{label: f"{label}_{i}" for label in stats}} for i, c in enumerate(cols)]
    return df.selectExpr(*aggregates).selectExpr(rows(entries))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or df.columns
    counts = [f"count_if({missing_sql(df, c)}) AS n{i}" for i, c in enumerate(cols)]
    return df.selectExpr(*counts).selectExpr(rows([{"feature": text(c), "nulls": f"n{i}"} for i, c in enumerate(cols)]))


def duplicate_count(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each group of equal rows."""
    return spare_copies(df, subset or df.columns).select(F.col("spare").alias("duplicates"))


def dtypes_table(df: DataFrame) -> DataFrame:
    return df.sparkSession.range(1).selectExpr(rows([{"feature": text(c), "dtype": text(t)} for c, t in df.dtypes]))


def describe_exact(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max per numeric column."""
    cols = cols or numeric_cols(df)

    moments = per_feature(df, cols, {"count": "count({x})", "mean": "avg({x})", "std": "stddev({x})",
                                     "min": "min({x})", "max": "max({x})"})
    return (moments.join(quantiles(df, cols, QUARTILES), "feature", "left")
            .select("feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def target_stats(df: DataFrame, col: str) -> DataFrame:
    median = medians(df, [col]).get(col)
    return df.agg(F.avg(col).alias("mean"), F.stddev(col).alias("std")).select(
        F.lit(col).alias("feature"), "mean", F.lit(median).cast("double").alias("median"), "std")


def feature_info(df: DataFrame, cols: list[str]) -> DataFrame:
    """dtype, missing, distinct, mean, sample std, min and max per feature."""
    types = dict(df.dtypes)
    info = per_feature(df, cols, {"missing": "count_if({m})", "mean": "avg({x})", "std": "stddev({x})",
                                  "min": "min({x})", "max": "max({x})"})
    distinct = value_counts_long(df, cols).groupBy("feature").agg(F.count(F.lit(1)).alias("unique"))
    dtype = F.element_at(F.create_map(*[F.lit(x) for c in cols for x in (c, types[c])]), F.col("feature"))
    return (info.join(distinct, "feature", "left").withColumns(
        {"dtype": dtype, "unique": F.coalesce("unique", F.lit(0))})
        .select("feature", "dtype", "missing", "unique", "mean", "std", "min", "max"))


def ranges(df: DataFrame, cols: list[str]) -> DataFrame:
    return per_feature(df, cols, {"min": "min({c})", "max": "max({c})", "mean": "avg({c})", "std": "stddev({c})"})


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(col, rows, pct): counts and percentages of each value, most frequent first."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).first()[0] or 1
    return counts.withColumn("pct", 100.0 * F.col("rows") / F.lit(float(total))).orderBy(F.desc("rows"), col)


def top_categories(df: DataFrame, col: str, k: int) -> DataFrame:
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(F.desc("rows"), col).limit(k)


def mean_by(df: DataFrame, key: str, val: str, k: int, min_rows: int = 1) -> DataFrame:
    """Groups of at least ``min_rows`` rows with the highest mean."""
    groups = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.avg(val).alias(f"mean_{val}"), F.count(F.lit(1)).alias("rows"))
    return groups.where(F.col("rows") >= min_rows).orderBy(F.desc(f"mean_{val}"), key).limit(k)


def having_min_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows whose key occurs at least ``n`` times."""
    frequent = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n).select(key)
    return df.join(frequent, key, "left_semi")


def profile_by(df: DataFrame, key: str, cols: list[str], sort: str, k: int) -> DataFrame:
    means = df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.avg(c).alias(c) for c in cols])
    return means.orderBy(F.desc(sort), key).limit(k)


def overview(df: DataFrame, distinct: dict[str, str], target: str, approximate: bool = False) -> DataFrame:
    """Rows, mean target, columns and the distinct counts named in ``distinct`` (result name -> column)."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(F.count(F.lit(1)).alias("rows"), F.avg(target).alias(f"mean_{target}"),
                  *[count(c).alias(name) for name, c in distinct.items()],
                  F.lit(len(df.columns)).cast("long").alias("columns"))


def choices(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def histogram(df: DataFrame, col: str, bins: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """(bin, lower, upper, rows) of equal-width bins; empty bins are left out."""
    x = F.col(col).cast("double")
    if low is None or high is None:
        found = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
        low, high = found.lo if low is None else low, found.hi if high is None else high
    if low is None:
        low = high = 0.0
    width = (high - low) / bins
    return (df.select(fixed_width_bin(x, low, high, bins).alias("bin")).where(F.col("bin").isNotNull())
            .groupBy("bin").agg(F.count(F.lit(1)).alias("rows"))
            .select("bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("lower"),
                    (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("upper"), "rows"))


def density_grid(df: DataFrame, x: str, y: str, nx: int, ny: int) -> DataFrame:
    """Row counts on an equal-width grid spanning both columns."""
    b = df.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")).first()
    if b.x0 is None or b.y0 is None:
        return df.sparkSession.createDataFrame([], "bin_x int, bin_y int, rows long")
    cells = df.select(fixed_width_bin(F.col(x).cast("double"), float(b.x0), float(b.x1), nx).alias("bin_x"),
                      fixed_width_bin(F.col(y).cast("double"), float(b.y0), float(b.y1), ny).alias("bin_y"))
    return cells.dropna().groupBy("bin_x", "bin_y").agg(F.count(F.lit(1)).alias("rows"))


def percentiles(df: DataFrame, col: str, percents: tuple[float, ...] = (0, 10, 25, 50, 75, 90, 100)) -> DataFrame:
    return quantiles(df, [col], {f"p{p:g}": p / 100.0 for p in percents})


def box_stats(df: DataFrame, key: str, val: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR and outlier count per group: quartiles by selection, then one aggregate of the rows."""
    box = quantiles(df, [val], {"q1": 0.25, "median": 0.5, "q3": 0.75}, [key])
    iqr = F.col("q3") - F.col("q1")
    box = box.select(F.col(key).alias("_key"), "q1", "median", "q3", (F.col("q1") - 1.5 * iqr).alias("_lo"), (F.col("q3") + 1.5 * iqr).alias("_hi"))
    data = df.select(F.col(key).alias("_group"), F.expr(as_double(val)).alias("value")).where("_group IS NOT NULL AND value IS NOT NULL")
    inside = (F.col("value") >= F.col("_lo")) & (F.col("value") <= F.col("_hi"))
    joined = data.join(checked(box), F.col("_group") == F.col("_key"))
    return joined.groupBy(F.col("_group").alias(key)).agg(
        *[F.max(c).alias(c) for c in ("q1", "median", "q3")], F.count(F.lit(1)).alias("rows"), F.min("value").alias("min"),
        F.max("value").alias("max"), F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"), F.count_if(~inside).alias("outliers"))


def prediction_profile(df: DataFrame, col: str, low: float = 60, high: float = 70) -> DataFrame:
    """Range, mean, population deviation, share inside a band and share of distinct values of a score."""
    return with_profile_shares(df.agg(*profile_aggregates(col, low, high)))


def profile_aggregates(col: str, low: float = 60, high: float = 70) -> list:
    """The aggregates of :func:`prediction_profile`, for use next to others in one pass."""
    x = F.col(col)
    in_band = F.count_if((x >= low) & (x <= high))
    return [F.count(col).alias("rows"), F.min(col).alias("pred_min"), F.max(col).alias("pred_max"),
            F.avg(col).alias("pred_mean"), F.stddev_pop(col).alias("pred_std"),
            (100.0 * F.try_divide(in_band, F.count(col))).alias("pct_in_band"),
            F.count_distinct(col).alias("unique_values")]


def with_profile_shares(row: DataFrame) -> DataFrame:
    return row.withColumns({
        "pred_range": F.col("pred_max") - F.col("pred_min"),
        "pct_unique": 100.0 * F.try_divide(F.col("unique_values"), F.col("rows"))})


def quality_report(df: DataFrame, key_columns: list[str] | None = None) -> DataFrame:
    """(section, item, value) rows: size, duplicate rows, missing values and types."""
    cols = df.columns
    sizes = df.agg(F.count(F.lit(1)).alias("rows"), *[F.expr(f"count_if({missing_sql(df, c)}) AS n{i}") for i, c in enumerate(cols)])
    totals = sizes.crossJoin(duplicate_count(df, key_columns))  # both sides have one row

    def entry(section, item, value):
        return {"section": text(section), "item": text(item), "value": f"CAST({value} AS STRING)"}

    entries = [entry("summary", "rows", "rows"), entry("summary", "columns", len(cols)),
               entry("summary", "duplicate_rows", "duplicates")]
    entries += [entry("missing", c, f"n{i}") for i, c in enumerate(cols)]
    entries += [entry("dtype", c, text(t)) for c, t in df.dtypes]
    return totals.selectExpr(rows(entries))
