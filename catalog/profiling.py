"""Summaries, frequency tables, correlations and ranks."""

from pyspark.sql import functions as F

from catalog.cleaning import HOLES_SQL, MOOD, holes
from catalog.registry import (
    FEATURE_KEY, TRACK_FEATURES, preds, query, rd, rounded, table, tracks, with_preds, with_tracks,
)
from tunemill.operators import association as A
from tunemill.operators import profile as P
from tunemill.operators.encode import with_mood
from tunemill.operators.reports import rolling_by_year


@query("scan_count", "SELECT count(*) AS rows, count(DISTINCT l_partkey) AS parts FROM lineitem")
def scan_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("l_partkey").alias("parts"))


HOLED = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "q", "d", "genre"]


@query("null_counts", f"WITH {HOLES_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM holes" for c in HOLED))
def null_counts(spark, sf):
    return P.null_counts(holes(spark, sf))


@query("duplicate_count", with_tracks("""
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (
    SELECT count(*) AS n FROM tracks GROUP BY danceability, energy, valence)"""))
def duplicate_count(spark, sf):
    return P.duplicate_count(tracks(spark, sf), FEATURE_KEY)


DESCRIBED = ["popularity", "danceability", "energy", "tempo", "duration_ms", "loudness"]


@query("describe", with_tracks(" UNION ALL ".join(f"""
SELECT '{c}' AS feature, count({c}) AS count, {rd(f'avg({c})')} AS mean, {rd(f'stddev_samp({c})', 4)} AS std,
       {rd(f'min({c})')} AS min, {rd(f'quantile_cont({c}, 0.25)')} AS p25, {rd(f'quantile_cont({c}, 0.5)')} AS p50,
       {rd(f'quantile_cont({c}, 0.75)')} AS p75, {rd(f'max({c})')} AS max FROM tracks""" for c in DESCRIBED)))
def describe(spark, sf):
    return rounded(P.describe_exact(tracks(spark, sf), DESCRIBED).withColumn("std", F.round("std", 4)))


@query("target_stats", with_tracks(f"""
SELECT 'popularity' AS feature, {rd('avg(popularity)')} AS mean, {rd('quantile_cont(popularity, 0.5)')} AS median,
       {rd('stddev_samp(popularity)')} AS std FROM tracks"""))
def target_stats(spark, sf):
    return rounded(P.target_stats(tracks(spark, sf), "popularity"))


@query("overview", with_tracks(f"""
SELECT count(*) AS rows, {rd('avg(popularity)')} AS mean_popularity, count(DISTINCT track_genre) AS genres,
       count(DISTINCT artists) AS artists, count(DISTINCT album_name) AS albums, CAST(19 AS BIGINT) AS columns FROM tracks"""))
def overview(spark, sf):
    return rounded(P.overview(tracks(spark, sf), {"genres": "track_genre", "artists": "artists", "albums": "album_name"},
                              "popularity"))


@query("top_genres", with_tracks("""
SELECT track_genre, count(*) AS rows FROM tracks GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""))
def top_genres(spark, sf):
    return P.top_categories(tracks(spark, sf), "track_genre", 5)


@query("genre_popularity", with_tracks(f"""
SELECT track_genre, {rd('avg(popularity)')} AS mean_popularity, count(*) AS rows FROM tracks GROUP BY 1
ORDER BY avg(popularity) DESC, 1 LIMIT 10"""))
def genre_popularity(spark, sf):
    return rounded(P.mean_by(tracks(spark, sf), "track_genre", "popularity", 10))


@query("artist_popularity", with_tracks(f"""
SELECT artists, {rd('avg(popularity)')} AS mean_popularity, count(*) AS rows FROM tracks GROUP BY 1
ORDER BY avg(popularity) DESC, 1 LIMIT 20"""))
def artist_popularity(spark, sf):
    return rounded(P.mean_by(tracks(spark, sf), "artists", "popularity", 20))


@query("artists_10plus", f"""
SELECT o_custkey, {rd('avg(o_totalprice)')} AS mean_o_totalprice, count(*) AS rows FROM orders
GROUP BY 1 HAVING count(*) >= 10 ORDER BY avg(o_totalprice) DESC, 1 LIMIT 20""")
def artists_10plus(spark, sf):
    return rounded(P.mean_by(table(spark, sf, "orders"), "o_custkey", "o_totalprice", 20, min_rows=10))


@query("rows_of_frequent_keys", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
    SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 10)""")
def rows_of_frequent_keys(spark, sf):
    return P.having_min_rows(table(spark, sf, "orders"), "o_custkey", 10).select("o_orderkey", "o_custkey")


@query("genre_profile", with_tracks("SELECT track_genre, " + ", ".join(
    rd(f"avg({c})") + f" AS {c}" for c in TRACK_FEATURES) + """ FROM tracks GROUP BY 1
ORDER BY avg(tracks.danceability) DESC, 1 LIMIT 10"""))
def genre_profile(spark, sf):
    return rounded(P.profile_by(tracks(spark, sf), "track_genre", TRACK_FEATURES, "danceability", 10))


CORR_COLS = ["popularity", "danceability", "energy", "valence", "instrumentalness", "duration_ms"]


@query("corr_matrix", with_tracks(" UNION ALL ".join(
    f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, {rd(f'corr({a}, {b})', 4)} AS corr FROM tracks"
    for a in CORR_COLS for b in CORR_COLS)))
def corr_matrix(spark, sf):
    return rounded(A.corr_matrix(tracks(spark, sf), CORR_COLS), 4)


@query("corr_target", with_tracks(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {rd(f'corr({c}, popularity)', 4)} AS corr FROM tracks" for c in TRACK_FEATURES)))
def corr_target(spark, sf):
    return rounded(A.corr_with(tracks(spark, sf), TRACK_FEATURES, "popularity"), 4)


@query("corr_pairwise_nulls", f"""WITH {HOLES_SQL}
SELECT 'q' AS feature_x, 'd' AS feature_y, {rd('corr(q, d)', 4)} AS corr FROM holes
UNION ALL SELECT 'l_suppkey', 'd', {rd('corr(l_suppkey, d)', 4)} FROM holes
UNION ALL SELECT 'l_suppkey', 'q', {rd('corr(l_suppkey, q)', 4)} FROM holes""")
def corr_pairwise_nulls(spark, sf):
    return rounded(A.corr_matrix(holes(spark, sf), ["d", "q", "l_suppkey"], lower_only=True), 4)


SPEARMAN_COLS = ["danceability", "energy", "valence", "instrumentalness", "duration_ms"]


@query("spearman", with_tracks(", r AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}"
    for c in [*SPEARMAN_COLS, "popularity"]) + " FROM tracks) " + " UNION ALL ".join(f"""
SELECT '{c}' AS feature, count(*) AS n, {rd(f'corr({c}, popularity)', 4)} AS rho,
       abs(corr({c}, popularity)) >= 0.05 AS practical FROM r""" for c in SPEARMAN_COLS)))
def spearman(spark, sf):
    result = A.spearman_with(tracks(spark, sf), SPEARMAN_COLS, "popularity")
    return rounded(result.select("feature", "n", "rho", "practical"), 4)


@query("spearman_pvalues")
def spearman_pvalues(spark, sf):
    return A.spearman_with(tracks(spark, sf), SPEARMAN_COLS, "popularity")


@query("histogram", with_tracks(f"""
, b AS (SELECT min(duration_ms)::DOUBLE AS lo, max(duration_ms)::DOUBLE AS hi FROM tracks),
x AS (SELECT least(floor((duration_ms - lo) / ((hi - lo) / 30)), 29) AS bin, lo, (hi - lo) / 30 AS w FROM tracks, b)
SELECT CAST(bin AS BIGINT) AS bin, {rd('any_value(lo) + bin * any_value(w)')} AS lower,
       {rd('any_value(lo) + (bin + 1) * any_value(w)')} AS upper, count(*) AS rows FROM x GROUP BY bin"""))
def histogram(spark, sf):
    return rounded(P.histogram(tracks(spark, sf), "duration_ms", 30))


@query("histogram_values", f"""
WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
x AS (SELECT least(floor((value - lo) / ((hi - lo) / 50)), 49) AS bin, lo, (hi - lo) / 50 AS w FROM events, b)
SELECT CAST(bin AS BIGINT) AS bin, {rd('any_value(lo) + bin * any_value(w)')} AS lower,
       {rd('any_value(lo) + (bin + 1) * any_value(w)')} AS upper, count(*) AS rows FROM x GROUP BY bin""")
def histogram_values(spark, sf):
    return rounded(P.histogram(table(spark, sf, "events"), "value", 50))


def _qcut_sql(feature, q):
    probs = ", ".join(repr(i / q) for i in range(q + 1))
    return f"""
SELECT '{feature}' AS feature, CAST(len(list_filter(e[2:], lambda t: x > t)) AS BIGINT) AS bin, count(*) AS rows,
       {rd('avg(popularity)')} AS mean_popularity
FROM (SELECT {feature} AS x, popularity, (SELECT list_sort(list_distinct(quantile_cont({feature}, [{probs}]))) FROM tracks)
      AS e FROM tracks) GROUP BY 2"""


QCUT = {"danceability": 10, "energy": 10, "valence": 9, "time_signature": 3, "duration_ms": 10}


@query("qcut_mean", with_tracks(" UNION ALL ".join(_qcut_sql(c, q) for c, q in QCUT.items())))
def qcut_mean(spark, sf):
    result = A.qcut_mean(tracks(spark, sf), list(QCUT), "popularity", 10)
    return rounded(result.select("feature", "bin", "rows", F.col("mean_target").alias("mean_popularity")))


@query("box_stats", with_tracks(f"""
, q AS (SELECT track_genre, quantile_cont(duration_ms, 0.25) AS q1, quantile_cont(duration_ms, 0.5) AS median,
               quantile_cont(duration_ms, 0.75) AS q3 FROM tracks GROUP BY 1)
SELECT track_genre, {rd('any_value(q1)')} AS q1, {rd('any_value(median)')} AS median, {rd('any_value(q3)')} AS q3,
       count(*) AS rows, {rd('min(duration_ms)')} AS min, {rd('max(duration_ms)')} AS max,
       {rd('min(duration_ms) FILTER (WHERE duration_ms BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_low,
       {rd('max(duration_ms) FILTER (WHERE duration_ms BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_high,
       count(*) FILTER (WHERE duration_ms < q1 - 1.5 * (q3 - q1) OR duration_ms > q3 + 1.5 * (q3 - q1)) AS outliers
FROM tracks JOIN q USING (track_genre) GROUP BY 1"""))
def box_stats(spark, sf):
    return rounded(P.box_stats(tracks(spark, sf), "track_genre", "duration_ms"))


@query("box_stats_moods", with_tracks(f"""
, m AS (SELECT {MOOD} AS mood_energy, popularity AS v FROM tracks),
q AS (SELECT mood_energy, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
      FROM m GROUP BY 1)
SELECT mood_energy, {rd('any_value(q1)')} AS q1, {rd('any_value(median)')} AS median, {rd('any_value(q3)')} AS q3,
       count(*) AS rows, count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
FROM m JOIN q USING (mood_energy) GROUP BY 1"""))
def box_stats_moods(spark, sf):
    result = P.box_stats(with_mood(tracks(spark, sf)), "mood_energy", "popularity")
    return rounded(result.select("mood_energy", "q1", "median", "q3", "rows", "outliers"))


@query("percentiles", "SELECT 'o_totalprice' AS feature, " + ", ".join(
    rd(f"quantile_cont(o_totalprice, {p / 100})") + f" AS p{p}" for p in (0, 10, 25, 50, 75, 90, 100)) + " FROM orders")
def percentiles(spark, sf):
    return rounded(P.percentiles(table(spark, sf, "orders"), "o_totalprice"))


@query("percentiles_bucketed", "SELECT 'o_totalprice' AS feature, " + ", ".join(
    rd(f"quantile_cont(o_totalprice, {p / 100})") + f" AS p{p}" for p in (0, 10, 25, 50, 75, 90, 100)) + " FROM orders")
def percentiles_bucketed(spark, sf):
    """The same through range buckets, as for a column too wide for one task."""
    probs = {f"p{p}": p / 100 for p in (0, 10, 25, 50, 75, 90, 100)}
    return rounded(P.quantiles(table(spark, sf, "orders"), ["o_totalprice"], probs, max_values=500))


@query("density_grid", with_preds(f"""
, b AS (SELECT min(popularity)::DOUBLE AS x0, max(popularity)::DOUBLE AS x1, min(prediction) AS y0, max(prediction) AS y1 FROM preds)
SELECT CAST(least(floor((popularity - x0) / ((x1 - x0) / 20)), 19) AS BIGINT) AS bin_x,
       CAST(least(floor((prediction - y0) / ((y1 - y0) / 20)), 19) AS BIGINT) AS bin_y, count(*) AS rows
FROM preds, b GROUP BY 1, 2"""))
def density_grid(spark, sf):
    return rounded(P.density_grid(preds(spark, sf), "popularity", "prediction", 20, 20))


@query("prediction_profile", with_preds(f"""
SELECT count(*) AS rows, {rd('min(prediction)')} AS pred_min, {rd('max(prediction)')} AS pred_max, {rd('avg(prediction)')} AS pred_mean,
       {rd('stddev_pop(prediction)')} AS pred_std,
       {rd('100.0 * count(*) FILTER (WHERE prediction >= 60 AND prediction <= 70) / count(*)')} AS pct_in_band,
       count(DISTINCT prediction) AS unique_values, {rd('max(prediction) - min(prediction)')} AS pred_range,
       {rd('100.0 * count(DISTINCT prediction) / count(*)')} AS pct_unique FROM preds"""))
def prediction_profile(spark, sf):
    return rounded(P.prediction_profile(preds(spark, sf), "prediction"))


INFO = ["popularity", "energy", "tempo", "duration_ms", "explicit"]
INFO_TYPES = {"popularity": "int", "energy": "double", "tempo": "double", "duration_ms": "bigint", "explicit": "boolean"}


@query("feature_info", with_tracks(" UNION ALL ".join(f"""
SELECT '{c}' AS feature, '{INFO_TYPES[c]}' AS dtype, count(*) FILTER (WHERE {c} IS NULL) AS missing,
       count(DISTINCT {c}) AS "unique", {rd(f'avg({c}::DOUBLE)', 4)} AS mean, {rd(f'stddev_samp({c}::DOUBLE)', 4)} AS std,
       {rd(f'min({c}::DOUBLE)', 4)} AS min, {rd(f'max({c}::DOUBLE)', 4)} AS max FROM tracks""" for c in INFO)))
def feature_info(spark, sf):
    return rounded(P.feature_info(tracks(spark, sf), INFO), 4)


#: Columns of the table and their types in Spark.
TYPES = {"track_id": "string", "popularity": "int", "track_genre": "string", "album_name": "string", "track_name": "string", "artists": "string",
         "duration_ms": "bigint", "explicit": "boolean", "danceability": "double", "energy": "double", "valence": "double",
         "acousticness": "double", "instrumentalness": "double", "loudness": "double", "tempo": "double", "key": "int", "mode": "int",
         "time_signature": "int", "release_date": "timestamp_ntz"}


@query("quality_report", with_tracks(f"""
, g AS (SELECT count(*) AS n FROM tracks GROUP BY ALL, {', '.join(TYPES)})
SELECT 'summary' AS section, 'rows' AS item, CAST(sum(n) AS VARCHAR) AS value FROM g
UNION ALL SELECT 'summary', 'columns', '{len(TYPES)}' UNION ALL SELECT 'summary', 'duplicate_rows', CAST(CAST(sum(n - 1) AS BIGINT) AS VARCHAR) FROM g
UNION ALL """.replace("GROUP BY ALL, ", "GROUP BY ") + " UNION ALL ".join(
    f"SELECT 'missing', '{c}', CAST(count(*) FILTER (WHERE {c} IS NULL) AS VARCHAR) FROM tracks UNION ALL SELECT 'dtype', '{c}', '{t}'"
    for c, t in TYPES.items())))
def quality_report(spark, sf):
    return P.quality_report(tracks(spark, sf))


@query("choices", with_tracks("SELECT DISTINCT track_genre FROM tracks"))
def choices(spark, sf):
    return P.choices(tracks(spark, sf), "track_genre")


@query("trend", with_preds(f"""
, x AS (SELECT pred_std AS x, abs(popularity - prediction) AS y FROM preds)
SELECT {rd('regr_slope(y, x)')} AS slope, {rd('regr_intercept(y, x)')} AS intercept, {rd('corr(x, y)')} AS corr,
       abs(corr(x, y)) > 0.5 AS is_strong FROM x"""))
def trend(spark, sf):
    p = preds(spark, sf).withColumn("abs_error", F.abs(F.col("popularity") - F.col("prediction")))
    return rounded(A.trend(p, "pred_std", "abs_error"))


@query("qq_points")
def qq_points(spark, sf):
    p = preds(spark, sf).withColumn("residual", F.col("popularity") - F.col("prediction"))
    return A.qq_points(p, "residual", ["track_id"])


@query("rolling_year", with_tracks(f"""
, y AS (SELECT track_genre, year(release_date) AS release_year, avg(popularity) AS m, count(*) AS rows FROM tracks GROUP BY 1, 2)
SELECT track_genre, release_year, {rd('m')} AS mean_popularity, rows,
       {rd('avg(m) OVER (PARTITION BY track_genre ORDER BY release_year ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)')} AS rolling_mean
FROM y"""))
def rolling_year(spark, sf):
    t = tracks(spark, sf).withColumn("release_year", F.year("release_date"))
    return rounded(rolling_by_year(t, "track_genre", "release_year", "popularity"))
