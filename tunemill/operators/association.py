"""Correlation, trend, quantile-binned means and normal-plot data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.functions.normal import correlation_pvalue, inverse_normal
from tunemill.functions.scalars import correlation
from tunemill.functions.sqltext import as_double, name, number, rows, text
from tunemill.operators.clean import missing
from tunemill.operators.ranks import global_index, quantiles, rank_counts
from tunemill.operators.sides import checked
from tunemill.session import shared_dir


def _as_double(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.selectExpr(*[f"{as_double(c)} AS {name(c)}" for c in cols])


def correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """One row with the pairwise-complete correlation of each pair, in the columns ``c0, c1, ...``.

    A first job finds the mean, range and holes of every column. Pairs without holes then need one sum of centred
    products each, and constant columns give null; pairs with holes have their own means per pair.
    """
    cols = list(dict.fromkeys(c for pair in pairs for c in pair))
    data = _as_double(df, cols)
    slot = {c: i for i, c in enumerate(cols)}
    stats = data.selectExpr("count(1) AS n", *[
        f"{fn}({name(c)}) AS {fn}{i}" for c, i in slot.items() for fn in ("count", "avg", "min", "max")]).first()
    whole = {c for c, i in slot.items() if stats[f"count{i}"] == stats["n"]}
    constant = {c for c, i in slot.items() if stats[f"min{i}"] == stats[f"max{i}"]}
    centred = data.selectExpr("*", *[
        f"{name(c)} - {number(stats[f'avg{i}'])} AS _d{i}" for c, i in slot.items() if c not in constant])
    sums, out = {"n": "count(1)"}, []
    for k, (a, b) in enumerate(pairs):
        if a in constant or b in constant:
            out.append(f"CAST(NULL AS DOUBLE) AS c{k}")
        elif a in whole and b in whole:
            products = []
            for x, y in ((a, b), (a, a), (b, b)):
                i, j = sorted((slot[x], slot[y]))
                sums[f"s{i}_{j}"] = f"sum(_d{i} * _d{j})"
                products.append(f"s{i}_{j}")
            out.append("try_divide({}, sqrt({}) * sqrt({})) AS c{}".format(*products, k))
        else:
            x, y = (f"CASE WHEN {name(q)} IS NOT NULL THEN {name(p)} END" for p, q in ((a, b), (b, a)))
            sums[f"r{k}"] = f"try_divide(covar_pop({x}, {y}), stddev_pop({x}) * stddev_pop({y}))"
            out.append(f"r{k} AS c{k}")
    return centred.selectExpr(*[f"{expr} AS {label}" for label, expr in sums.items()]).selectExpr(*out)


def corr_matrix(df: DataFrame, cols: list[str], lower_only: bool = False) -> DataFrame:
    """(feature_x, feature_y, corr) over rows where both are present."""
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1)]
    place = {pair: k for k, pair in enumerate(pairs)}
    cells = [{"feature_x": text(cols[i]), "feature_y": text(cols[j]), "corr": f"c{place[max(i, j), min(i, j)]}"}
             for i in range(len(cols)) for j in range(len(cols)) if i > j or not lower_only]
    return correlations(df, [(cols[i], cols[j]) for i, j in pairs]).selectExpr(rows(cells))


def corr_with(df: DataFrame, cols: list[str], target: str, by_magnitude: bool = False,
              k: int | None = None) -> DataFrame:
    """(feature, corr) with the target, strongest first."""
    row = correlations(df, [(c, target) for c in cols])
    table = row.selectExpr(rows([{"feature": text(c), "corr": f"c{i}"} for i, c in enumerate(cols)]))
    strength = F.abs("corr") if by_magnitude else F.col("corr")
    table = table.orderBy(strength.desc_nulls_last(), "feature")
    return table if k is None else table.limit(k)


def spearman_with(df: DataFrame, cols: list[str], target: str, threshold: float = 0.05) -> DataFrame:
    """Rank correlation per feature with p-value and a flag for |rho| >= threshold.

    Works on counts of distinct (value, target) pairs, made once; average ranks come from the counts of distinct values, with
    one range exchange for the features and one for the target.
    """
    cols = [c for c in cols if c != target]
    data = _as_double(df, [*cols, target]).where(F.col(target).isNotNull())
    pairs = (data.withColumnRenamed(target, "goal").unpivot(["goal"], cols, "feature", "value")
             .where(F.col("value").isNotNull()).groupBy("feature", "value", "goal").agg(F.count(F.lit(1)).alias("w")))
    shared_dir(df.sparkSession)
    pairs = pairs.checkpoint()
    rank = F.col("before") + (F.col("cnt") + 1) / 2.0
    x_counts = pairs.groupBy("feature", "value").agg(F.sum("w").alias("cnt"))
    x_ranks = rank_counts(x_counts, ["feature"]).select("feature", "value", rank.alias("rx"), "n")
    # The target is ranked among the rows that have the feature.
    y_counts = pairs.groupBy("feature", "goal").agg(F.sum("w").alias("cnt"))
    y_ranks = rank_counts(y_counts, ["feature"], "goal").select("feature", "goal", rank.alias("ry"))
    mid = (F.col("n") + 1) / 2.0
    dx, dy, w = F.col("rx") - mid, F.col("ry") - mid, F.col("w")
    sums = (pairs.join(checked(x_ranks), ["feature", "value"]).join(checked(y_ranks), ["feature", "goal"])
            .groupBy("feature").agg(F.max("n").alias("n"), F.sum(w * dx * dy).alias("xy"),
                                    F.sum(w * dx * dx).alias("xx"), F.sum(w * dy * dy).alias("yy")))
    rho = F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy"))
    return (sums.select("feature", "n", rho.alias("rho"))
            .withColumn("p_value", correlation_pvalue("rho", "n"))
            .withColumn("practical", F.abs("rho") >= threshold)
            .orderBy(F.abs("rho").desc_nulls_last(), "feature"))


def _bins(df: DataFrame, cols: list[str], q: int) -> dict[str, int]:
    """Number of quantile bins per column: ``q``, or the number of distinct values if that is less."""
    near = df.selectExpr(*[f"approx_count_distinct({as_double(c)})" for c in cols]).first()
    few = [c for c, n in zip(cols, near) if n < 100 * q]  # the estimate is off by a few per cent
    exact = df.selectExpr(*[f"count(DISTINCT {as_double(c)})" for c in few]).first() if few else []
    return {**{c: q for c in cols}, **{c: min(q, n) for c, n in zip(few, exact)}}


def qcut_mean(df: DataFrame, cols: list[str], target: str, q: int = 10) -> DataFrame:
    """Mean target per quantile bin of each column; equal edges are merged.

    (feature, bin, lower, upper, rows, mean_target); the first bin is closed on both sides, and a column with fewer
    than ``q`` distinct values gets that many bins. Edges come from selection, means from one aggregate of the rows.
    """
    bins = _bins(df, cols, q)
    edges = {}
    for n in sorted({n for n in bins.values() if n}):
        own = [c for c in cols if bins[c] == n]
        for r in quantiles(df, own, {f"e{i}": i / n for i in range(n + 1)}).collect():
            found = sorted({r[f"e{i}"] for i in range(n + 1)})
            if len(found) > 1:
                edges[r.feature] = found
    if not edges:
        return df.sparkSession.createDataFrame([], "feature string, bin int, lower double, upper double, rows long, mean_target double")
    each = []
    for c, own in edges.items():
        inner = " + ".join(["0", *[f"CAST(v > {number(e)} AS INT)" for e in own[1:-1]]]).replace("v >", f"{as_double(c)} >")
        each.append({"feature": text(c), "bin": f"CASE WHEN {as_double(c)} IS NOT NULL THEN {inner} END", "goal": as_double(target)})
    table = (df.selectExpr(rows(each)).where("bin IS NOT NULL").groupBy("feature", "bin")
             .agg(F.count(F.lit(1)).alias("rows"), F.avg("goal").alias("mean_target")))
    bounds = F.expr("CASE feature " + " ".join(f"WHEN {text(c)} THEN array({', '.join(map(number, own))})" for c, own in edges.items()) + " END")
    return table.select("feature", "bin", F.get(bounds, F.col("bin")).alias("lower"), F.get(bounds, F.col("bin") + 1).alias("upper"), "rows", "mean_target")


def trend(df: DataFrame, x: str, y: str, strong: float = 0.5) -> DataFrame:
    """Slope, intercept, correlation and whether it is strong."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    r = correlation(a, b)
    return df.agg(F.regr_slope(b, a).alias("slope"), F.regr_intercept(b, a).alias("intercept"), r.alias("corr"),
                  (F.abs(r) > strong).alias("is_strong"))


def qq_points(df: DataFrame, col: str, key: list[str]) -> DataFrame:
    """Ordered values against normal quantiles: (position, value, theoretical).

    ``key`` identifies rows, so that ties are spread over the sort ranges.
    """
    values = df.where(~missing(df, col)).select(F.col(col).cast("double").alias("value"), *key)
    n = values.count()
    placed = global_index(values, ["value", *key], "position", start=1)
    i, end = F.col("position"), 0.5 ** (1.0 / n) if n else 0.5
    share = (F.when(i == n, F.lit(end)).when(i == 1, F.lit(1 - end))
             .otherwise((i - F.lit(0.3175)) / F.lit(n + 0.365)))
    return placed.select("position", "value", inverse_normal(share).alias("theoretical"))


def qq_line(points: DataFrame) -> DataFrame:
    """Fitted line and correlation of a normal plot."""
    return trend(points, "theoretical", "value")
