"""Model-quality queries over the stand-in predictions."""

import re

from pyspark.sql import functions as F

from catalog.registry import TRACK_FEATURES, preds, query, rd, rounded, table, tracks, with_preds
from tunemill.operators import evaluate as Q
from tunemill.operators.association import corr_with
from tunemill.operators.columns import column_difference
from tunemill.plans.models import predict_tier
from tunemill.plans.rules import recommend
from tunemill.operators.encode import with_duration_min
from tunemill.presets import RECOMMENDATIONS

R2 = "1 - sum((popularity - prediction) ** 2) / nullif(count(*) * var_pop(popularity), 0)"
RMSE, MAE = "sqrt(avg((popularity - prediction) ** 2))", "avg(abs(popularity - prediction))"


@query("residuals", with_preds(f"""
SELECT track_id, {rd('popularity - prediction')} AS residual, {rd('abs(popularity - prediction)')} AS abs_error FROM preds"""))
def residuals(spark, sf):
    return rounded(Q.residuals(preds(spark, sf), "popularity", "prediction").select("track_id", "residual", "abs_error"))


@query("regression_metrics", with_preds(f"""
SELECT count(*) AS rows, {rd(R2)} AS r2, {rd(RMSE)} AS rmse, {rd(MAE)} AS mae, CAST(0 AS DOUBLE) AS baseline_r2, {rd(R2)} AS gain,
       {rd(f'1 - (1 - ({R2})) * (count(*) - 1) / (count(*) - 10)')} AS adj_r2 FROM preds"""))
def regression_metrics(spark, sf):
    return rounded(Q.regression_metrics(preds(spark, sf), "popularity", "prediction", features=9))


@query("metrics_by_split", with_preds(f"""
SELECT split, count(*) AS rows, {rd(R2)} AS r2, {rd(RMSE)} AS rmse, {rd(MAE)} AS mae FROM preds GROUP BY 1"""))
def metrics_by_split(spark, sf):
    return rounded(Q.metrics_by(preds(spark, sf), "popularity", "prediction"))


@query("overfit_gap", with_preds(f"""
, m AS (SELECT split, {R2} AS r2 FROM preds GROUP BY 1)
SELECT {rd("max(r2) FILTER (WHERE split = 'train')")} AS train_r2, {rd("max(r2) FILTER (WHERE split = 'test')")} AS test_r2,
       {rd("max(r2) FILTER (WHERE split = 'train') - max(r2) FILTER (WHERE split = 'test')")} AS gap FROM m"""))
def overfit_gap(spark, sf):
    return rounded(Q.overfit_gap(Q.metrics_by(preds(spark, sf), "popularity", "prediction")))


@query("error_by_band", with_preds(f"""
, b AS (SELECT CASE WHEN popularity <= 0 THEN NULL WHEN popularity <= 20 THEN '0-20' WHEN popularity <= 40 THEN '20-40'
        WHEN popularity <= 60 THEN '40-60' WHEN popularity <= 80 THEN '60-80' ELSE '80-100' END AS band,
        abs(popularity - prediction) AS e FROM preds), m AS (SELECT band, count(*) AS rows, avg(e) AS mae FROM b GROUP BY 1)
SELECT band, rows, {rd('mae')} AS mae, band IS NOT NULL AND mae = (SELECT min(mae) FROM m WHERE band IS NOT NULL) AS is_best,
       band IS NOT NULL AND mae = (SELECT max(mae) FROM m WHERE band IS NOT NULL) AS is_worst FROM m"""))
def error_by_band(spark, sf):
    return rounded(Q.error_by_band(preds(spark, sf), "popularity", "prediction"))


@query("error_counts", with_preds(f"""
SELECT count(*) FILTER (WHERE prediction > popularity) AS over, count(*) FILTER (WHERE prediction < popularity) AS under,
       {rd('100.0 * count(*) FILTER (WHERE abs(popularity - prediction) <= 10) / count(*)')} AS within_pct FROM preds"""))
def error_counts(spark, sf):
    return rounded(Q.error_counts(preds(spark, sf), "popularity", "prediction"))


HEALTH_SQL = with_preds(f"""
, m AS (SELECT {R2} AS r2, stddev_pop(prediction) AS s, max(prediction) - min(prediction) AS rg,
        100.0 * count(*) FILTER (WHERE prediction BETWEEN 60 AND 70) / count(*) AS band,
        100.0 * count(DISTINCT prediction) / count(*) AS u FROM preds),
c AS (SELECT 'r2' AS check_name, 'r2' AS metric, r2 AS value, CASE WHEN r2 < 0 THEN 'critical' WHEN r2 <= 0.15 THEN 'warning' END AS level FROM m
 UNION ALL SELECT 'prediction_std', 'pred_std', s, CASE WHEN s < 3 THEN 'critical' WHEN s < 5 THEN 'warning' END FROM m
 UNION ALL SELECT 'prediction_range', 'pred_range', rg, CASE WHEN rg < 20 THEN 'critical' WHEN rg < 40 THEN 'warning' END FROM m
 UNION ALL SELECT 'share_60_70', 'pct_in_band', band, CASE WHEN band > 80 THEN 'critical' WHEN band > 50 THEN 'warning' END FROM m
 UNION ALL SELECT 'unique_share', 'pct_unique', u, CASE WHEN u < 10 THEN 'critical' WHEN u < 30 THEN 'warning' END FROM m
 UNION ALL SELECT 'baseline_gain', 'abs_gain', abs(r2), CASE WHEN abs(r2) < 0.05 THEN 'warning' END FROM m)
SELECT check_name, metric, {rd('value')} AS value, level,
       CASE WHEN (SELECT count(*) FROM c WHERE level = 'critical') > 0 THEN 'FAILED'
            WHEN (SELECT count(*) FROM c WHERE level = 'warning') > 0 THEN 'PASSED WITH WARNINGS' ELSE 'PASSED' END AS status FROM c""")


@query("health_rules", HEALTH_SQL)
def health_rules(spark, sf):
    return rounded(Q.health(preds(spark, sf), "popularity", "prediction"))


@query("confidence_tiers", with_preds(f"""
SELECT CASE WHEN pred_std < 5 THEN 'high' WHEN pred_std < 10 THEN 'medium' ELSE 'low' END AS confidence, count(*) AS rows,
       {rd('100.0 * count(*) / sum(count(*)) OVER ()')} AS pct FROM preds GROUP BY 1"""))
def confidence_tiers(spark, sf):
    return rounded(Q.confidence_tiers(preds(spark, sf), "pred_std"))


MODELS_SQL = f"""models AS (
SELECT 'blend' AS model, {R2} AS r2, {RMSE} AS rmse FROM preds
UNION ALL SELECT 'energy', {R2.replace('prediction', '(30 + 10 * energy)')}, {RMSE.replace('prediction', '(30 + 10 * energy)')} FROM preds
UNION ALL SELECT 'half', {R2.replace('prediction', '(25 + 0.5 * popularity)')}, {RMSE.replace('prediction', '(25 + 0.5 * popularity)')} FROM preds)"""


def models(spark, sf):
    p = preds(spark, sf)
    guesses = {"blend": F.col("prediction"), "energy": 30 + 10 * F.col("energy"), "half": 25 + 0.5 * F.col("popularity")}
    tables = [Q.regression_metrics(p.withColumn("guess", g), "popularity", "guess").select(
        F.lit(name).alias("model"), "r2", "rmse") for name, g in guesses.items()]
    return tables[0].union(tables[1]).union(tables[2])


@query("compare_models", with_preds(f""", {MODELS_SQL},
b AS (SELECT r2 AS base FROM models WHERE model = 'blend')
SELECT model, {rd('r2', 4)} AS r2, {rd('rmse', 4)} AS rmse, row_number() OVER (ORDER BY r2 DESC, model) AS rank,
       {rd('r2 - base', 4)} AS gain, {rd('100.0 * (r2 - base) / base', 4)} AS gain_pct,
       row_number() OVER (ORDER BY r2 DESC, model) = 1 AS is_best FROM models, b"""))
def compare_models(spark, sf):
    return rounded(Q.compare_models(models(spark, sf), "model", "blend"), 4)


@query("runs_match", with_preds(f"""
, a AS (SELECT album_name, {R2} AS r2, {RMSE} AS rmse FROM preds GROUP BY 1),
b AS (SELECT album_name, {R2} AS r2, {RMSE} AS rmse FROM preds WHERE split <> 'val' GROUP BY 1)
SELECT album_name, {rd('abs(a.r2 - b.r2)')} AS r2_diff, {rd('abs(a.rmse - b.rmse)')} AS rmse_diff,
       abs(a.r2 - b.r2) < 1e-4 AND abs(a.rmse - b.rmse) < 1e-2 AS reproducible FROM a JOIN b USING (album_name)"""))
def runs_match(spark, sf):
    p = preds(spark, sf)
    a = Q.regression_metrics(p, "popularity", "prediction", by=["album_name"])
    b = Q.regression_metrics(p.where(F.col("split") != "val"), "popularity", "prediction", by=["album_name"])
    return rounded(Q.runs_match(a, b, ["album_name"]))


SIDES = {"missing": ("lineitem", "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
                                 "l_returnflag l_linestatus l_shipdate"),
         "extra": ("orders", "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority")}


@query("schema_diff", " UNION ALL ".join(f"""
SELECT '{side}' AS side, '{c}' AS "column", count({c}) AS filled FROM {name}""" for side, (name, cols) in SIDES.items() for c in cols.split()))
def schema_diff(spark, sf):
    return column_difference(table(spark, sf, "lineitem"), table(spark, sf, "orders"))


# ---- importance tables read off the data: strength of the link to the target and to the prediction ----

IMPORTANCE_SQL = "a AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(abs(corr({c}, popularity)), 6) AS importance FROM preds" for c in TRACK_FEATURES) + \
    "), b AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(abs(corr({c}, prediction)), 6) AS other FROM preds" for c in TRACK_FEATURES) + ")"


def importance_tables(spark, sf):
    p = preds(spark, sf)
    a = corr_with(p, TRACK_FEATURES, "popularity").select("feature", F.round(F.abs("corr"), 6).alias("importance"))
    b = corr_with(p, TRACK_FEATURES, "prediction").select("feature", F.round(F.abs("corr"), 6).alias("other"))
    return a, b


@query("importance_compare", with_preds(f""", {IMPORTANCE_SQL},
t AS (SELECT * FROM a ORDER BY importance DESC, feature LIMIT 5), j AS (SELECT * FROM t JOIN b USING (feature))
SELECT feature, {rd('importance', 4)} AS importance, {rd('other', 4)} AS other, {rd('importance / max(importance) OVER ()', 4)} AS importance_norm,
       {rd('other / max(other) OVER ()', 4)} AS other_norm FROM j"""))
def importance_compare(spark, sf):
    return rounded(Q.compare_importance(*importance_tables(spark, sf), "importance", "other", 5), 4)


@query("importance_family", with_preds(f""", {IMPORTANCE_SQL}
SELECT CASE WHEN feature IN ('energy', 'valence', 'danceability') THEN 'mood' WHEN feature IN ('tempo', 'loudness') THEN 'sound'
       ELSE 'other' END AS family, {rd('sum(importance)')} AS importance, count(*) AS features FROM a GROUP BY 1"""))
def importance_family(spark, sf):
    families = {"energy": "mood", "valence": "mood", "danceability": "mood", "tempo": "sound", "loudness": "sound"}
    return rounded(Q.importance_by_family(importance_tables(spark, sf)[0], families))


@query("top_share", with_preds(f""", {IMPORTANCE_SQL},
r AS (SELECT *, row_number() OVER (ORDER BY other DESC, feature) AS rn FROM b)
SELECT {rd('sum(other) FILTER (WHERE rn <= 3)')} AS top_importance,
       {rd('100.0 * sum(other) FILTER (WHERE rn <= 3) / sum(other)', 4)} AS top_pct FROM r"""))
def top_share(spark, sf):
    b = importance_tables(spark, sf)[1].withColumnRenamed("other", "importance")
    return rounded(Q.top_share(b, 3).withColumn("top_pct", F.round("top_pct", 4)))


@query("unused_features", with_preds(f", {IMPORTANCE_SQL} SELECT feature, {rd('importance')} AS importance FROM a WHERE importance < 0.005"))
def unused_features(spark, sf):
    return rounded(Q.unused_features(importance_tables(spark, sf)[0], 0.005))


@query("predict_tier", with_preds(f"""
, s AS (SELECT track_id, least(greatest(prediction * 1.5 - 30, 0), 100) AS score FROM preds)
SELECT track_id, {rd('score')} AS score, CASE WHEN score >= 70 THEN 'Excellent' WHEN score >= 50 THEN 'Good'
       WHEN score >= 30 THEN 'Moderate' ELSE 'Challenging' END AS tier FROM s"""))
def predict_tier_q(spark, sf):
    p = preds(spark, sf).withColumn("prediction", F.col("prediction") * 1.5 - 30)
    return rounded(predict_tier(p).select("track_id", "score", "tier"))


def _shown(col, fmt):
    """A number in a text, its decimals rounded half up as they are written."""
    before, digits, after = re.fullmatch(r"(.*)%\.(\d)f(.*)", fmt).groups()
    return f"'{before}' || CAST(CAST(round(CAST(CAST({col} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DECIMAL(18, {digits})) AS VARCHAR) || '{after}'"


def _recommend_sql(ruleset):
    branches = " UNION ALL ".join(f"""
SELECT rid, track_id, {i} AS pos, '{factor}' AS factor, {col} AS current_value, {_shown(col, fmt)} AS current, '{suggestion}' AS suggestion, '{impact}' AS impact, '{tip}' AS tip
FROM t WHERE {col} {cond}""" for i, (factor, col, cond, fmt, suggestion, impact, tip) in enumerate(RECOMMENDATIONS[ruleset]))
    return with_preds(f""", t AS (SELECT *, row_number() OVER () AS rid, duration_ms / 60000.0 AS duration_min FROM preds), r AS ({branches})
SELECT track_id, row_number() OVER (PARTITION BY rid ORDER BY pos) AS rank, factor, {rd('current_value')} AS current_value,
       current, suggestion, impact, tip FROM r""")


def _register_recommend(name, ruleset):
    @query(name, _recommend_sql(ruleset))
    def run(spark, sf):
        r = recommend(with_duration_min(tracks(spark, sf)), ["track_id"], ruleset)
        return rounded(r.select("track_id", "rank", "factor", "current_value", "current", "suggestion", "impact", "tip"))
    return run


_register_recommend("recommend_rules", "full")
_register_recommend("recommend_rules_compact", "compact")
