"""Model-quality aggregates over a table with actual and predicted values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunemill.functions.bins import cut
from tunemill.operators.profile import profile_aggregates, with_profile_shares
from tunemill.presets import ERROR_BANDS, HEALTH_RULES, HEALTH_STATUS


def residuals(df: DataFrame, y: str, pred: str) -> DataFrame:
    return df.withColumns({"residual": F.col(y) - F.col(pred), "abs_error": F.abs(F.col(y) - F.col(pred))})


def metric_columns(y: str, pred: str) -> dict[str, Column]:
    """Aggregates for rows, R2, RMSE and MAE; R2 is null for a constant target."""
    a, p = F.col(y).cast("double"), F.col(pred).cast("double")
    n = F.count(F.lit(1))
    squared = F.sum((a - p) * (a - p))
    return {
        "rows": n,
        "r2": F.lit(1.0) - F.try_divide(squared, n * F.var_pop(a)),
        "rmse": F.sqrt(F.try_divide(squared, n)),
        "mae": F.avg(F.abs(a - p)),
    }


def adjusted_r2(r2: float, n: int, k: int) -> float:
    if n <= k + 1:
        raise ValueError(f"{n} rows are too few for {k} features")
    return 1 - (1 - r2) * (n - 1) / (n - k - 1)


def adjusted_r2_col(r2: Column, n: Column, k: int) -> Column:
    return F.when(n > k + 1, F.lit(1.0) - (F.lit(1.0) - r2) * (n - 1) / (n - F.lit(k + 1)))


def regression_metrics(df: DataFrame, y: str, pred: str, features: int | None = None,
                       by: list[str] = ()) -> DataFrame:
    """Rows, R2, RMSE, MAE and the gain over predicting the mean; adjusted R2 when ``features`` is given."""
    table = df.groupBy(*by).agg(*[c.alias(name) for name, c in metric_columns(y, pred).items()])
    table = table.withColumns({"baseline_r2": F.lit(0.0), "gain": F.col("r2")})
    if features is not None:
        table = table.withColumn("adj_r2", adjusted_r2_col(F.col("r2"), F.col("rows"), features))
    return table


def metrics_by(df: DataFrame, y: str, pred: str, split: str = "split") -> DataFrame:
    return regression_metrics(df, y, pred, by=[split]).select(split, "rows", "r2", "rmse", "mae")


def overfit_gap(metrics: DataFrame, split: str = "split", a: str = "train", b: str = "test") -> DataFrame:
    """Difference of R2 between two splits of a metrics table."""
    def of(name):
        return F.max(F.when(F.col(split) == name, F.col("r2")))
    return metrics.agg(of(a).alias(f"{a}_r2"), of(b).alias(f"{b}_r2"), (of(a) - of(b)).alias("gap"))


def error_by_band(df: DataFrame, y: str, pred: str, bands=ERROR_BANDS) -> DataFrame:
    """Mean absolute error per band of the target, with the best and worst band marked.

    Bands are right-closed and the lowest edge is outside: a target of 0 falls in the null band.
    """
    table = (df.groupBy(cut(F.col(y), *bands).alias("band"))
             .agg(F.count(F.lit(1)).alias("rows"), F.avg(F.abs(F.col(y) - F.col(pred))).alias("mae")))
    everything = W.partitionBy(F.col("band").isNull())  # at most one row per band
    named = F.col("band").isNotNull()
    return table.withColumns({
        "is_best": named & (F.col("mae") == F.min("mae").over(everything)),
        "is_worst": named & (F.col("mae") == F.max("mae").over(everything))})


def error_counts(df: DataFrame, y: str, pred: str, tolerance: float = 10) -> DataFrame:
    a, p = F.col(y), F.col(pred)
    near = F.count_if(F.abs(a - p) <= tolerance)
    return df.agg(F.count_if(p > a).alias("over"), F.count_if(p < a).alias("under"),
                  (100.0 * F.try_divide(near, F.count(F.lit(1)))).alias("within_pct"))


def health(df: DataFrame, y: str, pred: str, rules=HEALTH_RULES) -> DataFrame:
    """(check_name, metric, value, level, status): the level reached by each check and the overall status."""
    metrics = [c.alias(n) for n, c in metric_columns(y, pred).items() if n != "rows"]
    row = with_profile_shares(df.agg(*profile_aggregates(pred), *metrics)).withColumn("abs_gain", F.abs("r2"))
    checks: dict[str, tuple[str, Column]] = {}
    for check, metric, condition, level in rules:
        met = F.expr(f"{metric} {condition}")
        column = checks[check][1].when(met, level) if check in checks else F.when(met, level)
        checks[check] = (metric, column)
    findings = F.array(*[
        F.struct(F.lit(c).alias("check_name"), F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"),
                 level.alias("level")) for c, (m, level) in checks.items()])
    worst = (F.when(F.exists("_found", lambda f: f["level"] == "critical"), HEALTH_STATUS["critical"])
             .when(F.exists("_found", lambda f: f["level"] == "warning"), HEALTH_STATUS["warning"])
             .otherwise(HEALTH_STATUS[None]))
    return row.select(findings.alias("_found")).select(F.inline("_found"), worst.alias("status"))


def confidence_tiers(df: DataFrame, std: str) -> DataFrame:
    """Rows and share per tier of prediction uncertainty."""
    tier = F.when(F.col(std) < 5, "high").when(F.col(std) < 10, "medium").when(F.col(std) >= 10, "low")
    counts = df.groupBy(tier.alias("confidence")).agg(F.count(F.lit(1)).alias("rows")).where("confidence IS NOT NULL")
    total = F.sum("rows").over(W.partitionBy(F.lit(0)))  # three rows
    return counts.withColumn("pct", 100.0 * F.col("rows") / total)


def compare_models(models: DataFrame, name: str = "model", baseline: str | None = None) -> DataFrame:
    """Models with rank by R2 and their difference to a baseline model (the worst when none is named), in percent.

    ``models`` holds one row per model.
    """
    everything = W.partitionBy(F.lit(0))
    base = (F.min("r2").over(everything) if baseline is None
            else F.max(F.when(F.col(name) == baseline, F.col("r2"))).over(everything))
    return models.withColumns({
        "rank": F.row_number().over(everything.orderBy(F.desc("r2"), name)),
        "gain": F.col("r2") - base,
        "gain_pct": 100.0 * F.try_divide(F.col("r2") - base, base)}).withColumn("is_best", F.col("rank") == 1)


def runs_match(a: DataFrame, b: DataFrame, key: list[str], r2_tol: float = 1e-4, rmse_tol: float = 1e-2) -> DataFrame:
    """Differences of two sets of runs and whether they agree."""
    joined = a.alias("a").join(b.alias("b"), key)
    r2, rmse = F.abs(F.col("a.r2") - F.col("b.r2")), F.abs(F.col("a.rmse") - F.col("b.rmse"))
    return joined.select(*key, r2.alias("r2_diff"), rmse.alias("rmse_diff"),
                         ((r2 < r2_tol) & (rmse < rmse_tol)).alias("reproducible"))


def predictions_match(a: DataFrame, b: DataFrame, key: list[str], pred: str, rtol: float = 1e-6,
                      atol: float = 1e-8) -> DataFrame:
    """Whether two scorings of the same rows agree."""
    joined = a.select(*key, F.col(pred).alias("pa")).join(b.select(*key, F.col(pred).alias("pb")), key, "full")
    close = F.abs(F.col("pa") - F.col("pb")) <= F.lit(atol) + F.lit(rtol) * F.abs("pb")
    return joined.agg(F.count(F.lit(1)).alias("rows"), F.bool_and(F.coalesce(close, F.lit(False))).alias("same"))


# ---- importance tables: one row per feature ----

def norm_by_max(df: DataFrame, col: str, name: str) -> DataFrame:
    return df.withColumn(name, F.try_divide(F.col(col), F.max(col).over(W.partitionBy(F.lit(0)))))


def compare_importance(a: DataFrame, b: DataFrame, a_col: str, b_col: str, top: int) -> DataFrame:
    """Both importances of the features that lead in ``a``, each also relative to its maximum."""
    leaders = a.orderBy(F.desc(a_col), "feature").limit(top)
    joined = leaders.join(b, "feature")
    return norm_by_max(norm_by_max(joined, a_col, f"{a_col}_norm"), b_col, f"{b_col}_norm")


def importance_by_family(df: DataFrame, families: dict[str, str], default: str = "other") -> DataFrame:
    pairs = [F.lit(x) for kv in families.items() for x in kv]
    family = F.coalesce(F.try_element_at(F.create_map(*pairs), "feature"), F.lit(default))
    return df.groupBy(family.alias("family")).agg(F.sum("importance").alias("importance"),
                                                  F.count(F.lit(1)).alias("features"))


def top_share(df: DataFrame, k: int, col: str = "importance") -> DataFrame:
    """Share of the total held by the ``k`` largest entries."""
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.desc(col), "feature")))
    top = F.sum(F.when(F.col("_rn") <= k, F.col(col)))
    return ranked.agg(top.alias("top_importance"), (100.0 * F.try_divide(top, F.sum(col))).alias("top_pct"))


def unused_features(df: DataFrame, threshold: float = 0.001) -> DataFrame:
    return df.where(F.col("importance") < threshold)
