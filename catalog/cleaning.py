"""Cleaning, filters, imputation and the flagship summary."""

from pyspark.sql import functions as F

from catalog.registry import (
    FEATURE_KEY, query, rd, rounded, table, tracks, with_clean, with_tracks,
)
from tunemill.operators import clean as C
from tunemill.operators.encode import with_mood
from tunemill.operators.explore import between, filter_in, playlist, preview, similar_hits
from tunemill.operators.profile import value_counts
from tunemill.operators.reports import (
    mostly_zero_groups, repeated_titles, retention_by, shared_fingerprint, zero_share_by, zero_vs_nonzero,
)


def deduped(spark, sf):
    return C.drop_copies(tracks(spark, sf), ["track_id"], FEATURE_KEY)


def clean_tracks(spark, sf):
    return C.drop_zero(deduped(spark, sf))


MOOD = """CASE WHEN valence > 0.5 AND energy > 0.5 THEN 'Happy/High Energy' WHEN valence <= 0.5 AND energy > 0.5
    THEN 'Energetic/Sad' WHEN valence > 0.5 AND energy <= 0.5 THEN 'Chill/Happy' ELSE 'Sad/Low Energy' END"""


@query("clean_mood_summary", with_clean(f"""
SELECT {MOOD} AS mood_energy, count(*) AS rows, {rd('avg(popularity)')} AS mean_popularity,
       {rd('100.0 * count(*) / sum(count(*)) OVER ()')} AS pct FROM clean GROUP BY 1"""))
def clean_mood_summary(spark, sf):
    t = with_mood(clean_tracks(spark, sf))
    groups = t.groupBy("mood_energy").agg(F.count(F.lit(1)).alias("rows"), F.avg("popularity").alias("mean_popularity"))
    total = F.sum("rows").over(C.W.partitionBy(F.lit(0)))  # at most four rows
    return rounded(groups.withColumn("pct", 100.0 * F.col("rows") / total)).orderBy(F.desc("rows"), "mood_energy")


@query("exact_dedup", """
SELECT DISTINCT * REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem""")
def exact_dedup(spark, sf):
    """The whole rows of a table that holds a part of itself twice."""
    lines = table(spark, sf, "lineitem")
    kept = C.drop_exact(lines.unionByName(lines.where(F.col("l_linenumber") == 1)))
    return rounded(kept.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd")), 9)


@query("audio_dedup", with_tracks("""
SELECT track_id, popularity FROM (
    SELECT *, row_number() OVER (PARTITION BY danceability, energy, valence ORDER BY popularity DESC, track_id) AS rn
    FROM tracks) WHERE rn = 1"""))
def audio_dedup(spark, sf):
    return rounded(deduped(spark, sf).select("track_id", "popularity"))


@query("composite_dedup", with_tracks("""
SELECT track_id, track_name, artists, album_name FROM (
    SELECT *, row_number() OVER (PARTITION BY track_name, artists, album_name ORDER BY popularity DESC, track_id) AS rn
    FROM tracks) WHERE rn = 1"""))
def composite_dedup(spark, sf):
    t = C.drop_copies(tracks(spark, sf), ["track_id"], ["track_name", "artists", "album_name"])
    return t.select("track_id", "track_name", "artists", "album_name")


@query("zero_filter", with_tracks(f"""
SELECT count(*) FILTER (WHERE popularity = 0) AS zero_rows,
       {rd('100.0 * count(*) FILTER (WHERE popularity = 0) / count(*)')} AS zero_pct,
       {rd('avg(popularity) FILTER (WHERE popularity > 0)')} AS new_mean,
       {rd('quantile_cont(popularity, 0.5) FILTER (WHERE popularity > 0)')} AS new_median,
       {rd('stddev_samp(popularity) FILTER (WHERE popularity > 0)')} AS new_std FROM tracks"""))
def zero_filter(spark, sf):
    return rounded(C.zero_stats(tracks(spark, sf)))


@query("zero_top_genres", with_tracks("""
SELECT track_genre, count(*) AS zero_rows FROM tracks WHERE popularity = 0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""))
def zero_top_genres(spark, sf):
    return C.zero_top_categories(tracks(spark, sf), "track_genre")


@query("cleaning_report", with_tracks(f"""
, d AS (SELECT DISTINCT * FROM tracks),
b AS (SELECT max(popularity) AS best FROM d GROUP BY danceability, energy, valence),
n AS (SELECT (SELECT count(*) FROM tracks) AS a, (SELECT count(*) FROM d) AS b, (SELECT count(*) FROM b) AS c,
             (SELECT count(*) FROM b WHERE best > 0) AS f)
SELECT 'exact_duplicates' AS step, a AS rows_before, a - b AS removed, {rd('100.0 * (a - b) / a')} AS removed_pct FROM n
UNION ALL SELECT 'feature_duplicates', b, b - c, {rd('100.0 * (b - c) / b')} FROM n
UNION ALL SELECT 'zero_target', c, c - f, {rd('100.0 * (c - f) / c')} FROM n
UNION ALL SELECT 'total', a, a - f, {rd('100.0 * (a - f) / a')} FROM n"""))
def cleaning_report(spark, sf):
    return rounded(C.cleaning_report(tracks(spark, sf), FEATURE_KEY))


@query("validate_rules", with_tracks("""
SELECT 'popularity_1_100' AS rule, count(*) FILTER (WHERE NOT (popularity BETWEEN 1 AND 100)) AS violations FROM tracks
UNION ALL SELECT 'danceability_0_1', count(*) FILTER (WHERE NOT (danceability BETWEEN 0 AND 1)) FROM tracks
UNION ALL SELECT 'energy_0_1', count(*) FILTER (WHERE NOT (energy BETWEEN 0 AND 1)) FROM tracks
UNION ALL SELECT 'no_nulls', 0 FROM (SELECT 1)""").replace("'no_nulls', 0", "'no_nulls', CAST(0 AS BIGINT)"))
def validate_rules(spark, sf):
    return C.validate(tracks(spark, sf))


@query("explorer_filter", with_tracks("""
SELECT track_id, track_genre, popularity, energy FROM tracks
WHERE track_genre IN ('ECONOMY', 'PROMO', 'STANDARD') AND popularity BETWEEN 40 AND 90 AND energy BETWEEN 0.2 AND 0.8
ORDER BY popularity DESC, track_id LIMIT 100""").replace("popularity, energy FROM",
                                                         "CAST(popularity AS BIGINT) AS popularity, round(energy, 6) AS energy FROM"))
def explorer_filter(spark, sf):
    t = filter_in(filter_in(tracks(spark, sf), "track_genre", ["ECONOMY", "PROMO", "STANDARD"]), "album_name", [])
    t = between(between(t, "popularity", 40, 90), "energy", 0.2, 0.8)
    return rounded(preview(t, [F.desc("popularity"), "track_id"], 100)
                   .select("track_id", "track_genre", "popularity", "energy"))


@query("playlist", with_tracks(f"""
SELECT track_id, artists, {rd('energy')} AS energy, {rd('danceability')} AS danceability FROM tracks
WHERE energy > 0.5 AND danceability > 0.5 ORDER BY popularity DESC, track_id LIMIT 10"""))
def playlist_q(spark, sf):
    t = playlist(tracks(spark, sf), [F.desc("popularity"), "track_id"], 10)
    return rounded(t.select("track_id", "artists", "energy", "danceability"))


@query("similar_hits", with_tracks("""
SELECT track_id, track_name, CAST(popularity AS BIGINT) AS popularity FROM tracks
WHERE track_genre = 'ECONOMY' AND popularity >= 70 ORDER BY tracks.popularity DESC, track_id LIMIT 5"""))
def similar_hits_q(spark, sf):
    return rounded(similar_hits(tracks(spark, sf), "ECONOMY", "track_id").select("track_id", "track_name", "popularity"))


# ---- holes: the given tables have no nulls, so both engines make the same ones ----

HOLES_SQL = """holes AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, NULLIF(l_quantity, 7) AS q,
    NULLIF(l_discount, 0.05) AS d, NULLIF(p_type, 'ECONOMY') AS genre FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def holes(spark, sf):
    t = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.nullif("l_quantity", F.lit(7.0)).alias("q"), F.nullif("l_discount", F.lit(0.05)).alias("d"),
                    F.nullif("p_type", F.lit("ECONOMY")).alias("genre"))


IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
ID_SQL = "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey"


@query("impute_median", f"""WITH {HOLES_SQL}
SELECT {ID_SQL}, {rd('coalesce(q, (SELECT quantile_cont(q, 0.5) FROM holes))')} AS q,
       {rd('coalesce(d, (SELECT quantile_cont(d, 0.5) FROM holes))')} AS d FROM holes""")
def impute_median(spark, sf):
    t = holes(spark, sf).drop("genre")
    return rounded(C.impute(t, {"q": "median", "d": "median"}).select(*IDS, "q", "d"))


@query("impute_mode", f"""WITH {HOLES_SQL},
m AS (SELECT genre FROM holes WHERE genre IS NOT NULL GROUP BY genre ORDER BY count(*) DESC, genre LIMIT 1)
SELECT {ID_SQL}, coalesce(genre, (SELECT genre FROM m)) AS genre FROM holes""")
def impute_mode(spark, sf):
    return rounded(C.impute(holes(spark, sf), {"genre": "mode"}).select(*IDS, "genre"))


@query("impute_rules", f"""WITH {HOLES_SQL}
SELECT {ID_SQL}, {rd('coalesce(q, (SELECT quantile_cont(q, 0.5) FROM holes))')} AS q, {rd('coalesce(d, 0)')} AS d
FROM holes""")
def impute_rules(spark, sf):
    return rounded(C.impute(holes(spark, sf), {"q": "median", "d": 0.0}).select(*IDS, "q", "d"))


@query("complete_rows", f"""WITH {HOLES_SQL}
SELECT {ID_SQL} FROM holes WHERE q IS NOT NULL AND d IS NOT NULL AND genre IS NOT NULL""")
def complete_rows(spark, sf):
    return rounded(C.complete_rows(holes(spark, sf), ["q", "d", "genre"]).select(*IDS))


@query("finite_rows", """
SELECT event_id FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN CAST('infinity' AS DOUBLE)
    WHEN event_type = 'view' THEN CAST('nan' AS DOUBLE) ELSE value END AS x FROM events)
WHERE NOT isnan(x) AND NOT isinf(x)""")
def finite_rows(spark, sf):
    x = (F.when(F.col("event_type") == "error", F.lit(float("inf"))).when(F.col("event_type") == "view", F.lit(float("nan")))
         .otherwise(F.col("value")))
    return C.finite_rows(table(spark, sf, "events").withColumn("x", x), ["x"]).select("event_id")


@query("drop_all_null", f"""WITH {HOLES_SQL}
SELECT {ID_SQL} FROM holes WHERE q IS NOT NULL OR d IS NOT NULL OR genre IS NOT NULL""")
def drop_all_null(spark, sf):
    return rounded(C.drop_all_null(holes(spark, sf), ["q", "d", "genre"]).select(*IDS))


@query("quantile_clip", f"""
WITH b AS (SELECT quantile_cont(c_acctbal, 0.005) AS lo, quantile_cont(c_acctbal, 0.995) AS hi FROM customer)
SELECT c_custkey, {rd('least(greatest(c_acctbal, lo), hi)')} AS c_acctbal FROM customer, b""")
def quantile_clip(spark, sf):
    return rounded(C.quantile_clip(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"]))


# ---- reports on zero-score rows ----

@query("zero_share_by_genre", with_tracks(f"""
SELECT track_genre, count(*) FILTER (WHERE popularity = 0) AS zero_rows, count(*) AS rows,
       {rd('100.0 * count(*) FILTER (WHERE popularity = 0) / count(*)')} AS zero_pct
FROM tracks GROUP BY 1 ORDER BY 4 DESC, 1 LIMIT 5"""))
def zero_share_by_genre(spark, sf):
    return rounded(zero_share_by(tracks(spark, sf), "track_genre", 5))


@query("zero_share_by_artist", with_tracks("""
SELECT artist, zero_rows, rows FROM (
    SELECT album_name || '/' || track_name || '/' || popularity AS artist,
           count(*) FILTER (WHERE popularity = 0) AS zero_rows, count(*) AS rows FROM tracks GROUP BY 1)
WHERE 100.0 * zero_rows / rows > 90"""))
def zero_share_by_artist(spark, sf):
    t = tracks(spark, sf).withColumn("artist", F.concat_ws("/", "album_name", "track_name", "popularity"))
    return mostly_zero_groups(t, "artist")


@query("repeated_titles", with_tracks("""
, t AS (SELECT track_name, energy, valence, count(*) AS same FROM tracks WHERE popularity = 0 GROUP BY ALL)
SELECT track_name, CAST(sum(same) AS BIGINT) AS zero_rows, max(same) AS same_features FROM t
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def repeated_titles_q(spark, sf):
    return repeated_titles(tracks(spark, sf), "track_name", ["energy", "valence"], 10)


@query("zero_vs_nonzero", with_tracks(" UNION ALL ".join(f"""
SELECT '{c}' AS feature, {rd(f'avg({c}) FILTER (WHERE popularity = 0)')} AS zero_mean,
       {rd(f'avg({c}) FILTER (WHERE popularity <> 0)')} AS nonzero_mean,
       {rd(f'avg({c}) FILTER (WHERE popularity = 0) - avg({c}) FILTER (WHERE popularity <> 0)')} AS difference FROM tracks"""
    for c in ["danceability", "energy", "valence", "tempo"])))
def zero_vs_nonzero_q(spark, sf):
    return rounded(zero_vs_nonzero(tracks(spark, sf), ["danceability", "energy", "valence", "tempo"]))


@query("shared_fingerprint", with_tracks(f"""
, f AS (SELECT popularity, count(*) OVER (PARTITION BY danceability, energy, valence) AS n FROM tracks)
SELECT count(*) FILTER (WHERE popularity = 0) AS zero_rows, count(*) FILTER (WHERE popularity = 0 AND n > 1) AS shared_rows,
       {rd('100.0 * count(*) FILTER (WHERE popularity = 0 AND n > 1) / count(*) FILTER (WHERE popularity = 0)')} AS shared_pct
FROM f"""))
def shared_fingerprint_q(spark, sf):
    return rounded(shared_fingerprint(tracks(spark, sf), FEATURE_KEY))


@query("genre_retention", with_clean(f"""
, a AS (SELECT track_genre, count(*) AS n FROM tracks GROUP BY 1), b AS (SELECT track_genre, count(*) AS n FROM clean GROUP BY 1)
SELECT a.track_genre, a.n AS rows_before, coalesce(b.n, 0) AS rows_after,
       {rd('100.0 * coalesce(b.n, 0) / a.n')} AS retained_pct FROM a LEFT JOIN b USING (track_genre)"""))
def genre_retention(spark, sf):
    return rounded(retention_by(tracks(spark, sf), clean_tracks(spark, sf), "track_genre"))


@query("mood_counts", with_tracks(f"""
SELECT {MOOD} AS mood_energy, count(*) AS rows, {rd('100.0 * count(*) / sum(count(*)) OVER ()')} AS pct
FROM tracks GROUP BY 1"""))
def mood_counts(spark, sf):
    return rounded(value_counts(with_mood(tracks(spark, sf)), "mood_energy"))
