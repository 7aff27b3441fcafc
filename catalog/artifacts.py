"""Files that are written and read back, helpers on columns and names, and properties of sampled and learned results."""

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.files import RUNS_SQL, run_rows
from catalog.modelling import LINEAR, PARTS_SQL, attributions
from catalog.registry import (
    CLEAN_SQL, TRACK_FEATURES, preds, query, rd, rounded, table, tracks, with_preds, with_tracks,
)
from tunemill.functions.scalars import file_stamp, percent_text
from tunemill.operators import association as A
from tunemill.operators import columns as C
from tunemill.operators import profile as P
from tunemill.operators.encode import hash_encode
from tunemill.operators.sampling import sample_n
from tunemill.plans import explain as X
from tunemill.plans import models as M
from tunemill.plans.pipeline import run_all
from tunemill.presets import IDENTIFIER_COLUMNS
from tunemill.session import scratch_path
from tunemill.sources import files as S

NUMBERS = ["popularity", "duration_ms", *TRACK_FEATURES, "key", "mode", "time_signature"]


def through_csv(df, name):
    """``df`` written as CSV and read back with its own types."""
    path = scratch_path(df.sparkSession, name)
    S.write_csv(df, path)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    return S.read_csv(df.sparkSession, path, schema, multi_line=False)


# ---- sinks ----

INFO_TYPES = {"popularity": "int", "duration_ms": "bigint", "key": "int", "mode": "int", "time_signature": "int"}


@query("feature_info_file", with_tracks(" UNION ALL ".join(f"""
SELECT '{c}' AS feature, '{INFO_TYPES.get(c, 'double')}' AS dtype, count(*) FILTER (WHERE {c} IS NULL) AS missing, count(DISTINCT {c}) AS "unique",
       {rd(f'avg({c})', 4)} AS mean, {rd(f'stddev_samp({c})', 4)} AS std, {rd(f'min({c})', 4)} AS min, {rd(f'max({c})', 4)} AS max FROM tracks"""
    for c in NUMBERS)))
def feature_info_file(spark, sf):
    return rounded(through_csv(P.feature_info(tracks(spark, sf), NUMBERS), "feature-info"), 4)


@query("importance_file", with_preds(f""", {PARTS_SQL} """ + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {rd(f'avg(abs({c}))', 5)} AS importance FROM parts" for c in LINEAR)))
def importance_file(spark, sf):
    found = X.mean_abs_attribution(attributions(spark, sf), LINEAR).withColumnRenamed("mean_abs", "importance")
    return rounded(through_csv(found, "importance"), 5)


@query("attribution_file", with_preds(f""", {PARTS_SQL}
SELECT p.track_id, p.duration_ms, {rd('base', 5)} AS base, {rd('p.popularity', 5)} AS actual,
       {rd('base + parts.popularity + parts.energy + parts.valence', 5)} AS predicted, {rd('parts.popularity', 5)} AS popularity,
       {rd('parts.energy', 5)} AS energy, {rd('parts.valence', 5)} AS valence
FROM (SELECT *, row_number() OVER (PARTITION BY track_id) AS k FROM preds) p
JOIN (SELECT *, row_number() OVER (PARTITION BY track_id) AS k FROM parts) parts USING (track_id, k)"""))
def attribution_file(spark, sf):
    """The parts of every prediction with the value known and the value predicted."""
    actual = tracks(spark, sf).select("track_id", "duration_ms", F.col("popularity").cast("double").alias("actual"))
    parts = attributions(spark, sf).withColumnRenamed("prediction", "predicted")
    whole = actual.join(parts, ["track_id", "duration_ms"]).select("track_id", "duration_ms", "base", "actual", "predicted", *LINEAR)
    return rounded(through_csv(whole, "attributions"), 5)


@query("run_table_file", with_preds(f""", {RUNS_SQL}
SELECT run_id, experiment, split, n AS rows, {rd('r2')} AS r2, {rd('rmse')} AS rmse, {rd('mae')} AS mae FROM runs"""))
def run_table_file(spark, sf):
    runs = run_rows(spark, sf).select("run_id", "experiment", "split", "rows", "r2", "rmse", "mae")
    return rounded(through_csv(runs, "run-table"))


# ---- columns, names, texts ----

@query("found_column_counts", with_tracks("SELECT track_genre AS value, count(*) AS rows FROM tracks GROUP BY 1"))
def found_column_counts(spark, sf):
    """The genre column found among several names, whatever its case."""
    t = tracks(spark, sf).withColumnRenamed("track_genre", "Track_Genre")
    found = C.resolve_column(t, ["genre", "track_genre"])
    return t.groupBy(F.col(found).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


TEXTS = ["track_id", "track_genre", "album_name", "track_name", "artists"]


@query("columns_by_type", with_tracks(" UNION ALL ".join(
    [f"SELECT 'number' AS kind, '{c}' AS feature, {rd(f'sum({c})', 2)} AS value FROM tracks" for c in NUMBERS]
    + [f"SELECT 'text', '{c}', CAST(count(DISTINCT {c}) AS DOUBLE) FROM tracks" for c in TEXTS])))
def columns_by_type(spark, sf):
    """Sums of the numeric columns and distinct values of the text columns, both found by type."""
    t = tracks(spark, sf)
    numbers = t.agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in C.numeric_cols(t)])
    texts = t.agg(*[F.count_distinct(c).cast("double").alias(c) for c in C.string_cols(t)])
    long = [d.unpivot([], d.columns, "feature", "value").withColumn("kind", F.lit(k)) for k, d in (("number", numbers), ("text", texts))]
    return rounded(long[0].unionByName(long[1]).select("kind", "feature", "value"), 2)


@query("without_identifiers", with_tracks(f"""
SELECT track_genre, explicit, count(*) AS rows, {rd('sum(duration_ms)', 2)} AS duration_ms, {rd('sum(energy)', 4)} AS energy, 15 AS columns
FROM tracks GROUP BY 1, 2"""))
def without_identifiers(spark, sf):
    t = C.drop_cols(tracks(spark, sf), IDENTIFIER_COLUMNS)
    sums = [F.sum(c).cast("double").alias(c) for c in ("duration_ms", "energy")]
    return rounded(t.groupBy("track_genre", "explicit").agg(F.count(F.lit(1)).alias("rows"), *sums), 4).withColumn("columns", F.lit(len(t.columns)).cast("long"))


@query("value_ranges", with_tracks(" UNION ALL ".join(f"""
SELECT '{c}' AS feature, {rd(f'min({c})', 4)} AS min, {rd(f'max({c})', 4)} AS max, {rd(f'avg({c})', 4)} AS mean, {rd(f'stddev_samp({c})', 4)} AS std
FROM tracks""" for c in TRACK_FEATURES)))
def value_ranges(spark, sf):
    return rounded(P.ranges(tracks(spark, sf), TRACK_FEATURES), 4)


@query("snake_named", "SELECT p_partkey AS part_key, p_name AS part_name, p_retailprice AS retail_price_usd FROM part")
def snake_named(spark, sf):
    odd = table(spark, sf, "part").select(F.col("p_partkey").alias("partKey"), F.col("p_name").alias(" Part  Name"), F.col("p_retailprice").alias("Retail-Price (USD)"))
    return C.snake_names(odd)


@query("number_texts", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, printf('%.1f%%', l_discount * 100) AS share,
       strftime(l_shipdate, '%Y%m%d_%H%M%S') AS stamp FROM lineitem""")
def number_texts(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), percent_text(F.col("l_discount")).alias("share"),
                                               file_stamp(F.col("l_shipdate")).alias("stamp"))


# ---- properties of samples and learned results ----

@query("hash_encode_holds", with_tracks("""
SELECT track_genre, count(*) AS rows, 1 AS codes, true AS below_one, true AS same_alone FROM tracks GROUP BY 1"""))
def hash_encode_holds(spark, sf):
    """Every category has one code in [0, 1), the same when it is coded on its own."""
    t = hash_encode(tracks(spark, sf), "track_genre", name="code")
    alone = hash_encode(tracks(spark, sf).select("track_genre").distinct(), "track_genre", name="own")
    found = t.groupBy("track_genre").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("code").alias("codes"), F.min("code").alias("low"), F.max("code").alias("high"))
    return found.join(alone, "track_genre").select("track_genre", "rows", "codes", ((F.col("low") >= 0) & (F.col("high") < 1)).alias("below_one"),
                                                   (F.col("own") == F.col("low")).alias("same_alone"))


@query("qq_positions", with_preds(f"""
SELECT row_number() OVER (ORDER BY r) AS position, {rd('r')} AS value, true AS mirrored, true AS rising FROM (SELECT popularity - prediction AS r FROM preds)"""))
def qq_positions(spark, sf):
    """Ordered residuals; normal quantiles rise and are mirrored around the middle."""
    p = preds(spark, sf).withColumn("residual", F.col("popularity") - F.col("prediction"))
    points = A.qq_points(p, "residual", ["track_id", "duration_ms"])
    n = points.count()
    other = points.select((F.lit(n + 1) - F.col("position")).alias("position"), F.col("theoretical").alias("mirror"))
    after = points.select((F.col("position") + 1).alias("position"), F.col("theoretical").alias("before"))
    both = points.join(other, "position").join(after, "position", "left")
    return rounded(both.select("position", "value", (F.abs(F.col("theoretical") + F.col("mirror")) < 1e-6).alias("mirrored"),
                               F.coalesce(F.col("theoretical") > F.col("before"), F.lit(True)).alias("rising")))


SAMPLES = (5000, 2000, 500)


@query("nested_samples", "WITH c AS (SELECT count(*) AS n FROM lineitem) " + " UNION ALL ".join(
    f"SELECT least(n, {n}) AS rows, least(n, {n}) AS different, least(n, {n}) AS in_larger, true AS mean_is_near FROM c" for n in SAMPLES))
def nested_samples(spark, sf):
    """Samples of three sizes with one seed, each inside the one before; means lie within five standard errors."""
    key, out, larger = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"], None, None
    t = table(spark, sf, "lineitem").select(*key, "l_quantity")
    whole = t.agg(F.avg("l_quantity").alias("m"), F.stddev("l_quantity").alias("s")).first()
    for n in SAMPLES:
        own = sample_n(t, n, 42, key)
        marked = own.withColumn("inside", F.lit(True)) if larger is None else own.join(larger.select(*key, F.lit(True).alias("inside")), key, "left")
        row = marked.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(*key).alias("different"), F.count("inside").alias("in_larger"),
                         (F.abs(F.avg("l_quantity") - whole.m) < 5 * whole.s / n ** 0.5).alias("mean_is_near"))
        out, larger = row if out is None else out.unionByName(row), own
    return out


@query("projection_holds", with_tracks("SELECT count(*) AS rows, true AS centred_apart, true AS first_is_widest, true AS uncorrelated FROM tracks"))
def projection_holds(spark, sf):
    """Principal components are uncorrelated, the first spreads most, and no column spreads more than it."""
    p = M.project_2d(tracks(spark, sf), TRACK_FEATURES, ["track_id", "duration_ms"])
    row = p.agg(F.count(F.lit(1)).alias("rows"), F.variance("x").alias("vx"), F.variance("y").alias("vy"), F.corr("x", "y").alias("r")).first()
    widest = tracks(spark, sf).agg(F.greatest(*[F.variance(c) for c in TRACK_FEATURES])).first()[0]
    return spark.createDataFrame([(row.rows, row.vy > 0, row.vx >= row.vy and row.vx >= widest * (1 - 1e-9), abs(row.r) < 1e-6)],
                                 "rows long, centred_apart boolean, first_is_widest boolean, uncorrelated boolean")


@query("pipeline_chain", f"""WITH {CLEAN_SQL}
SELECT count(*) AS clean_rows, count(*) AS matrix_rows, ceil(count(*) * 0.2)::BIGINT AS test_rows, 'clean,features,train' AS steps, true AS all_ok, true AS importances_sum_to_1,
       true AS ledger_has_the_test_error FROM clean""")
def pipeline_chain(spark, sf):
    """Cleaning, features and training, each from what the step before has written, judged by the files they leave.

    Importances are shares of the gain of all splits: they sum to 1, or to 0 if the goal never varies and no tree has a split.
    """
    out = scratch_path(spark, "pipeline-chain")
    report = run_all(spark, tracks(spark, sf), out, ["track_id"], {"n_estimators": 5, "max_depth": 4}, ["danceability", "energy", "valence"], csv=False)
    matrix = spark.read.parquet(f"{out}/matrix")
    total = spark.read.option("header", True).csv(f"{out}/feature_importance").agg(F.sum(F.col("importance").cast("double"))).first()[0]
    metrics = {r.key: r.value for r in spark.read.parquet(f"{out}/ledger/metrics").collect()}
    model = GBTRegressionModel.load(f"{out}/model")
    shares = 1.0 if model.totalNumNodes > model.getNumTrees else 0.0
    return spark.createDataFrame([(
        spark.read.parquet(f"{out}/clean").count(), matrix.count(), matrix.where("split = 'test'").count(), ",".join(s.name for s in report.steps), report.ok,
        abs(total - shares) < 1e-6, metrics.get("test_rmse") is not None)],
        "clean_rows long, matrix_rows long, test_rows long, steps string, all_ok boolean, importances_sum_to_1 boolean, ledger_has_the_test_error boolean")
