"""Readers, writers, splits, samples and the run ledger."""

from pyspark.sql import functions as F

from catalog.cleaning import clean_tracks
from catalog.registry import (
    preds, query, rd, rounded, table, tracks, with_clean, with_preds, with_tracks,
)
from tunemill.operators.evaluate import metric_columns
from tunemill.operators.explore import export_filtered
from tunemill.operators.profile import quality_report
from tunemill.operators.ranks import quantiles
from tunemill.operators.sampling import sample_n, split, split_summary
from tunemill.plans.ledger import RunLedger, search_runs
from tunemill.presets import MISSING_TOKENS
from tunemill.session import scratch_path
from tunemill.sources import files as S
from tunemill.sources.runs import latest, read_runs


@query("csv_roundtrip", "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "part-csv")
    S.convert(spark, f"{sf}/part.parquet", path)
    return rounded(S.read_csv(spark, path, table(spark, sf, "part").schema))


@query("csv_documents", "SELECT doc_id, text, lang FROM documents")
def csv_documents(spark, sf):
    """Texts with quotes, commas and line breaks survive a CSV file."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    path = scratch_path(spark, "documents-csv")
    S.write_csv(docs, path)
    return S.read_csv(spark, path, docs.schema)


@query("csv_latin1", "SELECT p_partkey, 'caf' || chr(233) || ' ' || p_name AS title FROM part")
def csv_latin1(spark, sf):
    path = scratch_path(spark, "latin1-csv")
    titled = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("café "), "p_name").alias("title"))
    titled.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return S.read_csv(spark, path, titled.schema, encodings=("UTF-8", "ISO-8859-1"))


@query("parquet_roundtrip", with_tracks("SELECT track_id, track_genre, CAST(popularity AS BIGINT) AS popularity FROM tracks"))
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "tracks")
    S.write_parquet(tracks(spark, sf).select("track_id", "popularity", "track_genre"), path, ["track_genre"])
    return rounded(S.read_parquet(spark, path).select("track_id", "track_genre", "popularity"))


@query("feature_scan", with_tracks(f"""
SELECT {rd('danceability')} AS danceability, {rd('energy')} AS energy, {rd('tempo')} AS tempo,
       CAST(popularity AS BIGINT) AS popularity FROM tracks"""))
def feature_scan(spark, sf):
    return rounded(S.load_features(tracks(spark, sf), ["danceability", "energy", "liveness", "tempo"], "popularity"))


@query("split_partition_scan", with_preds(f"""
SELECT track_id, {rd('energy')} AS energy, CAST(popularity AS BIGINT) AS popularity FROM preds WHERE split = 'val'"""))
def split_partition_scan(spark, sf):
    path = scratch_path(spark, "split")
    S.write_split(preds(spark, sf).select("track_id", "energy", "popularity", "split"), path)
    return rounded(S.load_split(spark, path, "val"))


@query("export_filtered", with_tracks("""
SELECT track_id, CAST(popularity AS BIGINT) AS popularity, track_genre FROM tracks
WHERE track_genre = 'PROMO' AND popularity BETWEEN 50 AND 100"""))
def export_filtered_q(spark, sf):
    path = scratch_path(spark, "export")
    t = tracks(spark, sf).select("track_id", "popularity", "track_genre")
    export_filtered(t, path, {"track_genre": ["PROMO"]}, {"popularity": (50, 100)})
    return rounded(S.read_csv(spark, path, t.schema))


@query("json_params", with_tracks("""
, b AS (SELECT quantile_cont(popularity, 0.5) AS cut FROM tracks)
SELECT track_id FROM tracks, b WHERE popularity > cut"""))
def json_params(spark, sf):
    """Parameters written by one job and read by another."""
    path = scratch_path(spark, "params")
    t = tracks(spark, sf)
    fitted = quantiles(t, ["popularity"], {"cut": 0.5}).select("cut", F.array(F.lit("popularity")).alias("features"))
    fitted.coalesce(1).write.json(path)
    params = S.load_params(spark, path)
    return t.where(F.col(params["features"][0]) > params["cut"]).select("track_id")


@query("cleaned_csv_export", with_clean("SELECT track_id, CAST(popularity AS BIGINT) AS popularity, artists FROM clean"))
def cleaned_csv_export(spark, sf):
    path = scratch_path(spark, "clean")
    t = clean_tracks(spark, sf).select("track_id", "popularity", "artists")
    S.write_csv(t, path)
    return rounded(S.read_csv(spark, path, t.schema))


KINDS = [*MISSING_TOKENS, "NONE"]


@query("missing_tokens", f"""
SELECT event_id, CASE WHEN event_id % {len(KINDS)} = {len(KINDS) - 1} THEN 'NONE' END AS kind FROM events""")
def missing_tokens(spark, sf):
    """Every token becomes null; the text NONE stays."""
    path = scratch_path(spark, "tokens")
    kind = F.get(F.array(*[F.lit(k) for k in KINDS]), (F.col("event_id") % len(KINDS)).cast("int"))
    e = table(spark, sf, "events").select("event_id", kind.alias("kind"))
    S.write_csv(e, path)
    return S.read_csv(spark, path, e.schema)


@query("csv_rejected_cells", """
SELECT 'event_id' AS "column", CAST(0 AS BIGINT) AS rejected
UNION ALL SELECT 'value', count(*) FILTER (WHERE event_id % 7 = 0) FROM events""")
def csv_rejected_cells(spark, sf):
    path = scratch_path(spark, "rejects")
    events = table(spark, sf, "events").select("event_id", "value")
    text = F.when(F.col("event_id") % 7 == 0, "about 5").when(F.col("event_id") % 7 == 1, "N/A").otherwise(F.col("value").cast("string"))
    S.write_csv(events.withColumn("value", text), path)
    return S.rejected_cells(spark, path, events.schema)


@query("quality_report_text", """
SELECT '[summary] rows: ' || count(*) AS line FROM part UNION ALL SELECT '[summary] columns: 6'
UNION ALL SELECT '[summary] duplicate_rows: 0'
UNION ALL SELECT '[missing] ' || c || ': 0' FROM (SELECT unnest(['p_partkey', 'p_name', 'p_brand', 'p_type', 'p_size', 'p_retailprice']) AS c)
UNION ALL SELECT '[dtype] ' || unnest(['p_partkey: bigint', 'p_name: string', 'p_brand: string', 'p_type: string', 'p_size: int', 'p_retailprice: double'])""")
def quality_report_text(spark, sf):
    path = scratch_path(spark, "report")
    S.write_report(quality_report(table(spark, sf, "part")), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


# ---- runs: one per album, with metrics of the stand-in predictions ----

RUNS_SQL = """runs AS (SELECT album_name AS run_id, track_genre AS experiment, split, 1 - sum((popularity - prediction) ** 2)
    / nullif(count(*) * var_pop(popularity), 0) AS r2, sqrt(avg((popularity - prediction) ** 2)) AS rmse,
    avg(abs(popularity - prediction)) AS mae, count(*) AS n FROM preds GROUP BY ALL)"""


def run_rows(spark, sf):
    return preds(spark, sf).groupBy(
        F.col("album_name").alias("run_id"), F.col("track_genre").alias("experiment"), "split").agg(
        *[c.alias(n) for n, c in metric_columns("popularity", "prediction").items()])


def _ledger(spark, sf):
    ledger = RunLedger(spark, scratch_path(spark, "ledger"))
    runs = run_rows(spark, sf).withColumn("run_id", F.concat_ws("/", "run_id", "experiment"))
    names = runs.select("run_id", "experiment").distinct()
    ledger.append_runs(names.withColumns({"status": F.lit("RUNNING"), "event_time": F.timestamp_seconds(F.lit(1))}))
    ledger.append_runs(names.withColumns({"status": F.lit("FINISHED"), "event_time": F.timestamp_seconds(F.lit(2))}))
    ledger.append_params(runs.groupBy("run_id").agg(F.sum("rows").alias("value")).withColumn("key", F.lit("n")))
    ledger.append_metrics(runs.select("run_id", F.inline(F.array(*[
        F.struct(F.concat("split", F.lit(f"_{m}")).alias("key"), F.col(m).alias("value")) for m in ("r2", "rmse")]))))
    return ledger


@query("run_ledger", with_preds(f""", {RUNS_SQL}
SELECT run_id || '/' || experiment AS run_id, experiment, 'FINISHED' AS status,
       {rd("max(r2) FILTER (WHERE split = 'test')")} AS test_r2, {rd("max(rmse) FILTER (WHERE split = 'test')")} AS test_rmse,
       {rd("max(r2) FILTER (WHERE split = 'train')")} AS train_r2, CAST(CAST(sum(n) AS BIGINT) AS VARCHAR) AS n
FROM runs GROUP BY run_id, experiment"""))
def run_ledger(spark, sf):
    wide = _ledger(spark, sf).wide(["test_r2", "test_rmse", "train_r2"], ["n"])
    return rounded(wide.select("run_id", "experiment", "status", "test_r2", "test_rmse", "train_r2", "n"))


@query("run_search", with_preds(f""", {RUNS_SQL}
SELECT run_id || '/' || experiment AS run_id, {rd('rmse')} AS test_rmse FROM runs
WHERE split = 'test' AND rmse > 15 AND experiment IN ('ECONOMY', 'PROMO')"""))
def run_search(spark, sf):
    wide = _ledger(spark, sf).wide(["test_rmse"])
    found = search_runs(wide, "test_rmse > 15", ["test_rmse DESC", "run_id"], ["ECONOMY", "PROMO"])
    return rounded(found.select("run_id", "test_rmse"))


@query("runs_per_experiment", with_preds(f""", {RUNS_SQL}
SELECT experiment, count(DISTINCT run_id) AS runs FROM runs GROUP BY 1"""))
def runs_per_experiment(spark, sf):
    return _ledger(spark, sf).runs_per_experiment()


@query("run_metadata_files", with_preds(f""", {RUNS_SQL}
SELECT run_id || '/' || experiment AS timestamp, n AS n_samples, {rd('coalesce(r2, 0)')} AS test_r2, {rd('rmse')} AS test_rmse,
       {rd('mae')} AS test_mae, {rd("""coalesce((SELECT t.r2 FROM runs t WHERE t.split = 'train' AND t.run_id = runs.run_id
       AND t.experiment = runs.experiment), 0)""")} AS train_r2 FROM runs WHERE split = 'test'"""))
def run_metadata_files(spark, sf):
    """One JSON file per run, in two shapes, read as one table."""
    of = lambda split, c: F.max(F.when(F.col("split") == split, F.col(c)))
    runs = (run_rows(spark, sf).groupBy("run_id", "experiment")
            .agg(*[of("test", c).alias(c) for c in ("rows", "r2", "rmse", "mae")], *[of("train", c).alias(f"train_{c}") for c in ("r2", "rmse", "mae")])
            .where(F.col("rows").isNotNull()).withColumns({
                "timestamp": F.concat_ws("/", "run_id", "experiment"), "file": F.xxhash64("run_id", "experiment")}))
    new = runs.where(F.col("experiment") < "M").select("file", "timestamp", F.col("rows").alias("n_samples"), F.struct(
        F.col("train_r2"), F.col("r2").alias("test_r2"), F.col("rmse").alias("test_rmse"), F.col("mae").alias("test_mae")).alias("metrics"))
    old = runs.where(F.col("experiment") >= "M").select(
        "file", F.col("timestamp").alias("training_date"), F.col("rows").alias("n_train_samples"),
        F.struct(F.struct(*[F.col(f"train_{c}").alias(c) for c in ("rmse", "mae", "r2")]).alias("train"),
                 F.struct("rmse", "mae", "r2").alias("test")).alias("performance"))
    path = scratch_path(spark, "runs")
    for part in (new, old):
        part.repartition("file").write.mode("append").partitionBy("file").json(path)
    read = read_runs(spark, path)
    return rounded(read.select("timestamp", "n_samples", "test_r2", "test_rmse", "test_mae", "train_r2"))


@query("latest_run", with_preds(f""", {RUNS_SQL}
SELECT experiment, max(run_id) AS run_id, {rd('max_by(rmse, run_id)')} AS rmse FROM runs WHERE split = 'test' GROUP BY 1"""))
def latest_run(spark, sf):
    runs = run_rows(spark, sf).where(F.col("split") == "test").select("experiment", "run_id", "rmse")
    return rounded(latest(runs, "run_id", ["experiment"]))


# ---- samples and splits ----

def _sizes_sql(scheme):
    return {
        "80/20": "SELECT 'train' AS split, n - ceil(n * 0.2)::BIGINT AS rows FROM c UNION ALL SELECT 'test', ceil(n * 0.2)::BIGINT FROM c",
        "64/16/20": """SELECT 'test' AS split, t AS rows FROM d UNION ALL SELECT 'val', ceil((n - t) * 0.2)::BIGINT FROM d
                       UNION ALL SELECT 'train', n - t - ceil((n - t) * 0.2)::BIGINT FROM d""",
        "70/15/15": """SELECT 'train' AS split, n - h AS rows FROM e UNION ALL SELECT 'test', ceil(h * 0.5)::BIGINT FROM e
                       UNION ALL SELECT 'val', h - ceil(h * 0.5)::BIGINT FROM e""",
    }[scheme]


SIZES_SQL = "WITH c AS (SELECT count(*) AS n FROM lineitem), d AS (SELECT n, ceil(n * 0.2)::BIGINT AS t FROM c), " \
            "e AS (SELECT n, ceil(n * 0.3)::BIGINT AS h FROM c) "


@query("split_sizes", SIZES_SQL + " UNION ALL ".join(
    f"SELECT '{s}' AS scheme, split, rows FROM ({_sizes_sql(s)})" for s in ("80/20", "64/16/20", "70/15/15")))
def split_sizes(spark, sf):
    t = tracks(spark, sf).select("track_id", "popularity")
    parts = [split(t, s, ["track_id"]).groupBy("split").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(s).alias("scheme"), "split", "rows") for s in ("80/20", "64/16/20", "70/15/15")]
    return parts[0].union(parts[1]).union(parts[2])


@query("split_stratified", with_tracks("""
, g AS (SELECT track_genre, count(*) AS n, ceil(count(*) * 0.2)::BIGINT AS t FROM tracks GROUP BY 1)
SELECT track_genre, 'test' AS split, t AS rows FROM g UNION ALL SELECT track_genre, 'train', n - t FROM g"""))
def split_stratified(spark, sf):
    t = split(tracks(spark, sf).select("track_id", "track_genre"), "80/20", ["track_id"], strata=["track_genre"])
    return t.groupBy("track_genre", "split").agg(F.count(F.lit(1)).alias("rows"))


@query("split_summary", with_preds(f"""
SELECT split, count(*) AS rows, {rd('avg(popularity)')} AS mean, {rd('stddev_samp(popularity)')} AS std FROM preds GROUP BY 1"""))
def split_summary_q(spark, sf):
    return rounded(split_summary(preds(spark, sf), "popularity"))


@query("sample_n")
def sample_n_q(spark, sf):
    return sample_n(tracks(spark, sf), 1000, 42, ["track_id"]).select("track_id", "track_genre", "popularity")


