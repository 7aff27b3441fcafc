"""Column names, bin edges, rule tables and search ranges of the music domain.

Fixed values: the numbers, labels and texts below are part of the expected results.
"""

from __future__ import annotations

INF = float("inf")

TARGET = "popularity"

# Features that identify a recording; rows equal on all of them are copies of one recording.
AUDIO_FEATURES = [
    "danceability", "energy", "loudness", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence", "tempo",
]
EDA_FEATURES = ["danceability", "energy", "loudness", "acousticness", "tempo", "valence", "instrumentalness"]
ARTIST_FEATURES = ["artist_followers_log", "artist_popularity", "artist_genre_count", "artist_album_count"]

# Candidate column names for tables with unknown headers.
COLUMN_CANDIDATES = {
    "track": ["track_name", "track", "song", "title"],
    "artist": ["artist_name", "artist", "artists"],
    "genre": ["genre", "genres"],
    "popularity": ["popularity", "pop"],
    "duration": ["duration_ms", "duration"],
    "release": ["release_date", "year", "release"],
}

# Right-closed bins.
ENERGY_BINS = ([0, 0.33, 0.66, 1.0], ["Low Energy", "Medium Energy", "High Energy"])
POPULARITY_BINS = ([0, 33, 66, 100], ["Low Popularity", "Medium Popularity", "High Popularity"])
TEMPO_BINS = ([0, 90, 120, 150, 300], ["Slow", "Moderate", "Fast", "Very Fast"])
TIER_BINS = ([0, 1000, 10000, 100000, 1000000, INF], ["Unknown", "Emerging", "Growing", "Established", "Superstar"])
ERROR_BANDS = ([0, 20, 40, 60, 80, 100], ["0-20", "20-40", "40-60", "60-80", "80-100"])

# Left-closed bins used when one request row is scored.
SERVING_ENERGY_BINS = ([-INF, 0.33, 0.66, INF], ["Low Energy", "Medium Energy", "High Energy"])
SERVING_ENERGY_BINS_WIDE = ([-INF, 0.33, 0.67, INF], ["Low Energy", "Medium Energy", "High Energy"])
SERVING_TEMPO_BINS = ([-INF, 90, 120, 150, INF], ["Slow", "Moderate", "Fast", "Very Fast"])

# (high valence, high energy) -> label
MOODS = {
    (True, True): "Happy/High Energy",
    (False, True): "Energetic/Sad",
    (True, False): "Chill/Happy",
    (False, False): "Sad/Low Energy",
}
CALM_MOOD = "Calm/Low Energy"
UNKNOWN_MOOD = "Unknown"

# Separators of an artists list, replaced by a comma in this order.
ARTIST_SEPARATORS = [",", ";", "&", " and ", " feat. ", " ft. "]

# Text tokens that count as missing in a CSV file.
MISSING_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
                  "NULL", "NaN", "None", "n/a", "nan", "null"]

# Model matrix.
ONE_HOT_LEVELS = {
    "mode": [0, 1],
    "time_signature": None,
    "mood_energy": None,
    "energy_category": ENERGY_BINS[1],
    "tempo_category": TEMPO_BINS[1],
}
SCALED_FEATURES = ["duration_ms", "loudness", "tempo", "duration_min", "track_genre_encoded", "key"]
IDENTIFIER_COLUMNS = ["Unnamed: 0", "track_id", "track_name", "album_name", "artists", "popularity_category"]
DEFAULT_YEAR = 2020

# Post-join defaults; None means the median of the joined rows.
ENRICH_DEFAULTS = {
    "artist_followers": 0,
    "artist_popularity": None,
    "artist_genre_count": 0,
    "artist_album_count": 1,
}

# Checks of a clean table: name -> SQL condition that every row must meet.
CLEAN_RULES = {
    "popularity_1_100": "popularity BETWEEN 1 AND 100",
    "danceability_0_1": "danceability BETWEEN 0 AND 1",
    "energy_0_1": "energy BETWEEN 0 AND 1",
}

# Score tiers, highest first: (lower bound, label).
SCORE_TIERS = [(70, "Excellent"), (50, "Good"), (30, "Moderate"), (None, "Challenging")]

# Health rules: (check, metric, condition, level); the first condition met per check applies.
HEALTH_RULES = [
    ("r2", "r2", "< 0", "critical"),
    ("r2", "r2", "< 0.05", "warning"),
    ("r2", "r2", "<= 0.15", "warning"),
    ("prediction_std", "pred_std", "< 3", "critical"),
    ("prediction_std", "pred_std", "< 5", "warning"),
    ("prediction_range", "pred_range", "< 20", "critical"),
    ("prediction_range", "pred_range", "< 40", "warning"),
    ("share_60_70", "pct_in_band", "> 80", "critical"),
    ("share_60_70", "pct_in_band", "> 50", "warning"),
    ("unique_share", "pct_unique", "< 10", "critical"),
    ("unique_share", "pct_unique", "< 30", "warning"),
    ("baseline_gain", "abs_gain", "< 0.05", "warning"),
]
HEALTH_STATUS = {"critical": "FAILED", "warning": "PASSED WITH WARNINGS", None: "PASSED"}

# Recommendation rules: (factor, column, condition, text format, suggestion, impact, tip).
RECOMMENDATIONS = {
    "full": [
        ("Danceability", "danceability", "< 0.5", "%.2f", "Increase to 0.7+", "+8-12 popularity points",
         "Add a stronger, more rhythmic beat to make the track more danceable"),
        ("Energy", "energy", "< 0.6", "%.2f", "Increase to 0.7+", "+5-10 popularity points",
         "Boost the intensity with louder instruments or faster tempo"),
        ("Positivity", "valence", "< 0.4", "%.2f", "Consider 0.5-0.7 range", "+5-8 popularity points",
         "Happy/upbeat tracks tend to be more popular. Try major key or uplifting melodies"),
        ("Duration", "duration_min", "> 4.5", "%.1f min", "3-4 minutes optimal", "+3-7 popularity points",
         "Shorter tracks perform better. Consider tightening arrangement"),
        ("Loudness", "loudness", "< -8", "%.1f dB", "Target -5 to -3 dB", "+3-5 popularity points",
         "Professional mastering to competitive loudness levels"),
    ],
    "compact": [
        ("Danceability", "danceability", "< 0.5", "%.2f", "Increase to 0.7+", "+8-12 points",
         "Add a stronger, more rhythmic beat pattern"),
        ("Energy", "energy", "< 0.6", "%.2f", "Boost to 0.7+", "+6-10 points",
         "Increase tempo, add dynamic percussion, or louder instruments"),
        ("Valence (Positivity)", "valence", "< 0.4", "%.2f", "Brighten to 0.5+", "+5-8 points",
         "Use major keys, uplifting melodies, or positive lyrics"),
        ("Acousticness", "acousticness", "> 0.7", "%.2f", "Reduce to 0.3-0.5", "+4-7 points",
         "Blend in electronic elements or produced instruments"),
        ("Vocals", "instrumentalness", "> 0.5", "Instrumental: %.2f", "Add vocals", "+7-12 points",
         "Tracks with vocals tend to be more popular - consider featuring a vocalist"),
    ],
}

# Search ranges: name -> (kind, low, high[, step]) or ("choice", options).
BOOSTING_SPACE = {
    "max_depth": ("int", 3, 10, 1),
    "learning_rate": ("log", 0.01, 0.3),
    "n_estimators": ("int", 100, 500, 50),
    "min_child_weight": ("int", 1, 10, 1),
    "subsample": ("uniform", 0.6, 1.0),
    "gamma": ("log", 1e-8, 1.0),
}
FOREST_SPACE = {
    "n_estimators": ("int", 50, 500, 50),
    "max_depth": ("int", 5, 30, 1),  # 30 is the deepest that MLlib trains
    "min_samples_leaf": ("int", 1, 10, 1),
    "max_features": ("choice", ["sqrt", "log2", "0.5", "0.8", "1.0"]),
    "bootstrap": ("choice", [True, False]),
}
