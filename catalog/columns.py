"""Derived columns, encodings and scalar functions."""

from pyspark.sql import functions as F

from catalog.registry import (
    query, rd, rounded, table, tracks, with_clean, with_tracks,
)
from tunemill.functions.bins import cut, cut_ordinal
from tunemill.functions.names import members_of
from tunemill.functions.nested import json_first, json_text, lookup
from tunemill.functions.scalars import capitalise, clip, strip_prefix
from tunemill.operators.columns import align_to
from tunemill.operators.encode import (
    apply_scaler, derive, featurize, fit_features, fit_scaler, flags, hash_encode, interactions, label_encode, one_hot, squares,
    with_duration_min, with_mood, with_serving_categories, with_year,
)
from tunemill.operators.enrich import with_primary
from tunemill.operators.reports import spec_features
from tunemill.presets import ENERGY_BINS, POPULARITY_BINS, TEMPO_BINS, TIER_BINS

MOOD_SQL = """CASE WHEN v > 0.5 AND e > 0.5 THEN 'Happy/High Energy' WHEN v <= 0.5 AND e > 0.5 THEN 'Energetic/Sad'
     WHEN v > 0.5 AND e <= 0.5 THEN 'Chill/Happy' ELSE 'Sad/Low Energy' END"""


@query("derived_cols", with_tracks(f"""
SELECT track_id, {rd('duration_ms / 60000.0')} AS duration_min, CAST(explicit AS BIGINT) AS explicit FROM tracks"""))
def derived_cols(spark, sf):
    t = with_duration_min(tracks(spark, sf))
    return rounded(t.select("track_id", "duration_min", F.col("explicit").cast("int").alias("explicit")))


@query("year_parse", """
WITH d AS (SELECT CAST(o_orderkey AS BIGINT) AS id, CASE WHEN o_orderstatus = 'P' THEN 'not a date'
           ELSE strftime(o_orderdate, '%Y-%m-%d') END AS text FROM orders)
SELECT id, CAST(year(try_cast(text AS DATE)) AS BIGINT) AS release_year FROM d""")
def year_parse(spark, sf):
    text = F.when(F.col("o_orderstatus") == "P", "not a date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    d = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), text.alias("text"))
    return rounded(with_year(d, "text").select("id", "release_year"))


@query("mood_quadrant", with_tracks(f"""
, x AS (SELECT track_id, least(greatest(valence * 1.2 - 0.1, 0), 1) AS v, least(greatest(energy, 0), 1) AS e FROM tracks)
SELECT track_id, {MOOD_SQL} AS mood_energy FROM x"""))
def mood_quadrant_q(spark, sf):
    t = tracks(spark, sf).withColumn("valence", F.col("valence") * 1.2 - 0.1)
    return with_mood(t).select("track_id", "mood_energy")


@query("mood_standardised", with_tracks(f"""
, s AS (SELECT avg(valence) AS mv, stddev_pop(valence) AS sv, avg(energy) AS me, stddev_pop(energy) AS se FROM tracks),
x AS (SELECT track_id, (valence - mv) / sv + 0.5 AS v, (energy - me) / se + 0.5 AS e FROM tracks, s)
SELECT track_id, {MOOD_SQL} AS mood_energy FROM x"""))
def mood_standardised(spark, sf):
    t = tracks(spark, sf)
    scaled = apply_scaler(t, fit_scaler(t, ["valence", "energy"]))
    return with_mood(scaled, cut_at=0.0, clamp=False).select("track_id", "mood_energy")


@query("cut_edges", """
SELECT event_id, value, CASE WHEN value < 0 THEN NULL WHEN value <= 5 THEN 'low' WHEN value <= 20 THEN 'mid'
       WHEN value <= 50 THEN 'high' END AS closed,
       CASE WHEN value <= 0 THEN NULL WHEN value <= 5 THEN 0 WHEN value <= 20 THEN 1 WHEN value <= 50 THEN 2 END AS ordinal
FROM (SELECT event_id, round(value, 0) AS value FROM events)""".replace("THEN 0 ", "THEN CAST(0 AS BIGINT) "))
def cut_edges(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.round("value", 0).alias("value"))
    edges = [0, 5, 20, 50]
    return rounded(e.select("event_id", "value", cut(F.col("value"), edges, ["low", "mid", "high"], include_lowest=True)
                            .alias("closed"), cut_ordinal(F.col("value"), edges).alias("ordinal")))


def _bins_query(name, col, spec, source_sql):
    edges, labels = spec
    whens = " ".join(f"WHEN x <= {e} THEN '{lab}'" for e, lab in zip(edges[1:], labels))

    @query(name, with_tracks(f"""
, x AS (SELECT track_id, {source_sql} AS x FROM tracks)
SELECT track_id, CASE WHEN x < {edges[0]} THEN NULL {whens} END AS category FROM x"""))
    def run(spark, sf):
        return tracks(spark, sf).select("track_id", cut(F.col(col), edges, labels, include_lowest=True)
                                        .alias("category"))
    return run


_bins_query("energy_bins", "energy", ENERGY_BINS, "energy")
_bins_query("popularity_bins", "popularity", POPULARITY_BINS, "popularity")
_bins_query("tempo_bins", "tempo", TEMPO_BINS, "tempo")

FOLLOWERS_SQL = "CAST(floor(greatest(c_acctbal, 0)) AS BIGINT) * CAST(power(10, c_nationkey % 4) AS BIGINT)"


def followers_of():
    return (F.floor(F.greatest(F.col("c_acctbal"), F.lit(0.0))).cast("long")
            * F.pow(F.lit(10), F.col("c_nationkey") % 4).cast("long"))


@query("tier_bins", f"""
SELECT c_custkey, f AS followers, CASE WHEN f <= 0 THEN NULL WHEN f <= 1000 THEN 'Unknown' WHEN f <= 10000 THEN 'Emerging'
       WHEN f <= 100000 THEN 'Growing' WHEN f <= 1000000 THEN 'Established' ELSE 'Superstar' END AS tier
FROM (SELECT c_custkey, {FOLLOWERS_SQL} AS f FROM customer)""")
def tier_bins(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", followers_of().alias("followers"))
    return c.withColumn("tier", cut(F.col("followers"), *TIER_BINS))


@query("log_followers", f"""
SELECT c_custkey, {rd('ln(1 + f)')} AS followers_log FROM (SELECT c_custkey, {FOLLOWERS_SQL} AS f FROM customer)""")
def log_followers(spark, sf):
    return rounded(table(spark, sf, "customer").select("c_custkey", F.log1p(followers_of()).alias("followers_log")))


@query("cut_left_closed", with_tracks("""
, x AS (SELECT track_id, valence AS v, energy AS e, tempo FROM tracks)
SELECT track_id, CASE WHEN e < 0.33 THEN 'Low Energy' WHEN e < 0.66 THEN 'Medium Energy' ELSE 'High Energy' END AS energy_narrow,
       CASE WHEN e < 0.33 THEN 'Low Energy' WHEN e < 0.67 THEN 'Medium Energy' ELSE 'High Energy' END AS energy_wide,
       CASE WHEN tempo < 90 THEN 'Slow' WHEN tempo < 120 THEN 'Moderate' WHEN tempo < 150 THEN 'Fast'
            ELSE 'Very Fast' END AS tempo_category,
       CASE WHEN v > 0.5 AND e > 0.5 THEN 'Happy/High Energy' WHEN v <= 0.5 AND e > 0.5 THEN 'Energetic/Sad'
            ELSE 'Calm/Low Energy' END AS mood
FROM x"""))
def cut_left_closed(spark, sf):
    t = tracks(spark, sf)
    narrow = with_serving_categories(t).withColumnRenamed("energy_category", "energy_narrow")
    both = with_serving_categories(narrow.drop("tempo_category", "mood_energy"), wide=True)
    return both.select("track_id", "energy_narrow", F.col("energy_category").alias("energy_wide"), "tempo_category",
                       F.col("mood_energy").alias("mood"))


@query("one_hot", with_clean("""
, x AS (SELECT *, CASE WHEN energy < 0 THEN NULL WHEN energy <= 0.33 THEN 'L' WHEN energy <= 0.66 THEN 'M' WHEN energy <= 1
        THEN 'H' END AS ec FROM clean)
SELECT track_id, CAST(mode = 1 AS BIGINT) AS mode_1, CAST(time_signature = 4 AS BIGINT) AS time_signature_4,
       CAST(time_signature = 5 AS BIGINT) AS time_signature_5, CAST(coalesce(ec = 'M', false) AS BIGINT) AS energy_medium,
       CAST(coalesce(ec = 'H', false) AS BIGINT) AS energy_high FROM x"""))
def one_hot_q(spark, sf):
    t = derive(_clean(spark, sf))
    t = one_hot(one_hot(one_hot(t, "mode"), "time_signature"), "energy_category", ENERGY_BINS[1])
    return rounded(t.select("track_id", "mode_1", "time_signature_4", "time_signature_5",
                            F.col("energy_category_Medium Energy").alias("energy_medium"),
                            F.col("energy_category_High Energy").alias("energy_high")))


def _clean(spark, sf):
    from catalog.cleaning import clean_tracks
    return clean_tracks(spark, sf)


@query("label_encode", with_tracks("""
SELECT track_id, track_genre, CAST(dense_rank() OVER (ORDER BY track_genre) - 1 AS BIGINT) AS track_genre_encoded
FROM tracks"""))
def label_encode_q(spark, sf):
    return label_encode(tracks(spark, sf), "track_genre").select("track_id", "track_genre", "track_genre_encoded")


@query("label_encode_many", """
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_custkey) - 1 AS BIGINT) AS code FROM orders""")
def label_encode_many(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return label_encode(orders, "o_custkey", "code", inline_limit=100).select("o_orderkey", "code")


@query("hash_encode")
def hash_encode_q(spark, sf):
    return hash_encode(tracks(spark, sf), "track_genre").select("track_genre", "track_genre_encoded").distinct()


SCALED = ["duration_ms", "loudness", "tempo", "key"]


@query("standard_scale", with_tracks(
    ", s AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED) + " FROM tracks) "
    "SELECT track_id, " + ", ".join(rd(f"({c} - m_{c}) / s_{c}") + f" AS {c}" for c in SCALED) + " FROM tracks, s"))
def standard_scale(spark, sf):
    t = tracks(spark, sf)
    return rounded(apply_scaler(t, fit_scaler(t, SCALED)).select("track_id", *SCALED))


@query("interactions", with_tracks(f"""
SELECT track_id, {rd('energy * danceability')} AS energy_danceability, {rd('valence * energy')} AS valence_energy,
       {rd('acousticness * energy')} AS acousticness_energy, {rd('energy * energy')} AS energy_squared,
       {rd('danceability * danceability')} AS danceability_squared, {rd('valence * valence')} AS valence_squared
FROM tracks"""))
def interactions_q(spark, sf):
    t = squares(interactions(tracks(spark, sf)))
    return rounded(t.select("track_id", "energy_danceability", "valence_energy", "acousticness_energy", "energy_squared",
                            "danceability_squared", "valence_squared"))


FLAGS_SQL = """CAST(duration_ms / 60000.0 < 3 AS BIGINT) AS is_short_track, CAST(duration_ms / 60000.0 > 5 AS BIGINT) AS is_long_track,
       CAST(energy > 0.7 AND valence > 0.7 AS BIGINT) AS high_energy_happy,
       CAST(energy < 0.3 AND valence < 0.3 AS BIGINT) AS low_energy_sad"""


@query("flags", with_tracks(f"SELECT track_id, {FLAGS_SQL} FROM tracks"))
def flags_q(spark, sf):
    t = flags(with_duration_min(tracks(spark, sf)))
    return rounded(t.select("track_id", "is_short_track", "is_long_track", "high_energy_happy", "low_energy_sad"))


PARTS_SQL = """list_transform(string_split(replace(replace(replace(replace(replace(artists, ';', ','), '&', ','), ' and ', ','),
                ' feat. ', ','), ' ft. ', ','), ','), lambda p: trim(p))"""


@query("primary_artist", with_tracks(f"SELECT track_id, ({PARTS_SQL})[1] AS primary_artist FROM tracks"))
def primary_artist(spark, sf):
    return with_primary(tracks(spark, sf)).select("track_id", "primary_artist")


@query("array_len", with_tracks(f"""
SELECT track_id, CAST(len({PARTS_SQL}) AS BIGINT) AS artist_count FROM tracks
UNION ALL SELECT CAST(vec_id AS VARCHAR), CAST(len(embedding) AS BIGINT) FROM embeddings"""))
def array_len(spark, sf):
    t = tracks(spark, sf).select("track_id", F.size(members_of(F.col("artists"))).alias("artist_count"))
    e = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string"), F.size("embedding"))
    return rounded(t.union(e))


@query("align_columns", with_tracks("""
SELECT CAST(2020 AS BIGINT) AS release_year, round(tempo, 6) AS tempo, CAST(0 AS BIGINT) AS liveness,
       round(energy, 6) AS energy FROM tracks"""))
def align_columns(spark, sf):
    return rounded(align_to(tracks(spark, sf), ["release_year", "tempo", "liveness", "energy"]))


@query("featurize", with_tracks(f"""
, x AS (SELECT *, valence AS v, energy AS e FROM tracks),
y AS (SELECT *, {MOOD_SQL} AS mood, dense_rank() OVER (ORDER BY track_genre) - 1 AS code FROM x)
SELECT track_id, CAST(explicit AS BIGINT) AS explicit, {FLAGS_SQL}, {rd('energy * danceability')} AS energy_danceability,
       CAST(mode = 1 AS BIGINT) AS mode_1, CAST(mood = 'Energetic/Sad' AS BIGINT) AS mood_sad,
       CAST(mood = 'Happy/High Energy' AS BIGINT) AS mood_happy, CAST(mood = 'Sad/Low Energy' AS BIGINT) AS mood_low,
       CAST(energy > 0.33 AND energy <= 0.66 AS BIGINT) AS energy_medium, CAST(energy > 0.66 AS BIGINT) AS energy_high,
       CAST(tempo > 90 AND tempo <= 120 AS BIGINT) AS tempo_moderate,
       CAST(tempo > 150 AND tempo <= 300 AS BIGINT) AS tempo_very_fast, CAST(code AS BIGINT) AS track_genre_encoded
FROM y"""))
def featurize_q(spark, sf):
    t = derive(tracks(spark, sf))
    f = featurize(t, *fit_features(t))
    return rounded(f.select(
        "track_id", "explicit", "is_short_track", "is_long_track", "high_energy_happy", "low_energy_sad",
        "energy_danceability", "mode_1", F.col("mood_energy_Energetic/Sad").alias("mood_sad"),
        F.col("mood_energy_Happy/High Energy").alias("mood_happy"), F.col("mood_energy_Sad/Low Energy").alias("mood_low"),
        F.col("energy_category_Medium Energy").alias("energy_medium"),
        F.col("energy_category_High Energy").alias("energy_high"),
        F.col("tempo_category_Moderate").alias("tempo_moderate"),
        F.col("tempo_category_Very Fast").alias("tempo_very_fast"), "track_genre_encoded"))


@query("featurize_many_levels", f"""
SELECT track_id, CAST(dense_rank() OVER (ORDER BY track_genre) - 1 AS BIGINT) AS track_genre_encoded, {rd('energy * energy')} AS energy_squared
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS track_id, CAST(o_custkey AS VARCHAR) AS track_genre, o_orderkey % 10 / 10.0 AS energy
      FROM orders)""")
def featurize_many_levels(spark, sf):
    """A code for each of more values than a literal map holds."""
    energy = F.col("o_orderkey") % 10 / F.lit(10.0)
    t = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("track_id"), F.col("o_custkey").cast("string").alias("track_genre"),
        energy.alias("energy"), energy.alias("danceability"), energy.alias("valence"), energy.alias("acousticness"),
        F.lit(4.0).alias("duration_min"))
    return rounded(featurize(t, *fit_features(t)).select("track_id", "track_genre_encoded", "energy_squared"))


@query("clip", """
SELECT c_custkey, least(greatest(c_acctbal, 0), 100) AS clipped FROM customer""")
def clip_q(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", clip(F.col("c_acctbal"), 0.0, 100.0).alias("clipped"))


@query("string_fns", """
SELECT p_partkey, upper(substring(p_type, 1, 1)) || lower(substring(p_type, 2)) AS capitalised,
       substring(p_brand, 7) AS stripped, substring(p_name, 1, 8) AS head,
       p_brand || ', ' || p_type || ', ' || p_name AS joined FROM part""")
def string_fns(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", capitalise(F.col("p_type")).alias("capitalised"),
        strip_prefix(F.col("p_brand"), "Brand#").alias("stripped"), F.substring("p_name", 1, 8).alias("head"),
        F.array_join(F.array("p_brand", "p_type", "p_name"), ", ").alias("joined"))


@query("json_fallback", """
SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.rank') AS BIGINT),
       try_cast(json_extract_string(props, '$.k') AS BIGINT), -1) AS k,
       CASE event_type WHEN 'click' THEN 'pointer' WHEN 'view' THEN 'page' ELSE 'other' END AS family,
       '{"type":"' || event_type || '","user":' || user_id || '}' AS packed FROM events""")
def json_fallback(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", json_first(F.col("props"), ["$.rank", "$.k"], "bigint", -1).alias("k"),
        lookup(F.col("event_type"), {"click": "pointer", "view": "page"}, "other").alias("family"),
        json_text(F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"))).alias("packed"))


@query("spec_features", with_tracks(f"""
SELECT track_id, CAST(floor(year(release_date) / 10.0) * 10 AS BIGINT) AS decade,
       CAST(floor(tempo / 10) * 10 AS BIGINT) AS tempo_bucket, CAST(len({PARTS_SQL}) AS BIGINT) AS artist_count,
       CASE WHEN valence + energy <> 0 THEN {rd('2 * valence * energy / (valence + energy)')} END AS mood_score
FROM tracks"""))
def spec_features_q(spark, sf):
    t = tracks(spark, sf).withColumn("release_year", F.year("release_date"))
    return rounded(spec_features(t).select("track_id", "decade", "tempo_bucket", "artist_count", "mood_score"))


