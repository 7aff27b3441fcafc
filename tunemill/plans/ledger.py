"""Append-only ledger of runs: status, parameters and metrics as three Parquet tables."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS = "run_id string, experiment string, status string, event_time timestamp, tags map<string,string>"
PARAMS = "run_id string, key string, value string"
METRICS = "run_id string, key string, step int, value double, event_time timestamp"
#: What counts as the newest: the event time, and of equal times an ended run before a running one.
NEWEST = ("event_time", "status <> 'RUNNING'")


class RunLedger:
    """Runs below one folder. Every change is an appended row; readers take the newest status of a run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _append(self, table: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.path}/{table}")

    def _read(self, table: str, schema: str) -> DataFrame:
        """The table; empty as long as nothing was logged to it."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    # ---- single runs ----

    def start(self, experiment: str, tags: dict | None = None, run_id: str | None = None) -> str:
        run_id = run_id or uuid.uuid4().hex
        self._status(run_id, experiment, "RUNNING", tags)
        return run_id

    def end(self, run_id: str, experiment: str, status: str = "FINISHED", tags: dict | None = None) -> None:
        self._status(run_id, experiment, status, tags)

    def _status(self, run_id, experiment, status, tags) -> None:
        row = (run_id, experiment, status, dt.datetime.now(), {k: str(v) for k, v in (tags or {}).items()})
        self._append("runs", self.spark.createDataFrame([row], RUNS))

    def log_params(self, run_id: str, params: dict) -> None:
        """Lists and maps are kept as JSON text."""
        rows = [(run_id, k, json.dumps(v) if isinstance(v, (dict, list, tuple)) else str(v)) for k, v in params.items()]
        self._append("params", self.spark.createDataFrame(rows, PARAMS))

    def log_metrics(self, run_id: str, metrics: dict[str, float | None], step: int = 0) -> None:
        """A metric without a value, such as R2 of a goal that never varies, is kept as null."""
        now = dt.datetime.now()
        rows = [(run_id, k, step, None if v is None else float(v), now) for k, v in metrics.items()]
        self._append("metrics", self.spark.createDataFrame(rows, METRICS))

    # ---- many runs at once ----

    def append_runs(self, runs: DataFrame) -> None:
        stamped = runs.withColumns({
            "event_time": F.col("event_time") if "event_time" in runs.columns else F.current_timestamp(),
            "tags": F.col("tags") if "tags" in runs.columns else F.create_map().cast("map<string,string>")})
        self._append("runs", stamped.select("run_id", "experiment", "status", "event_time", "tags"))

    def append_params(self, params: DataFrame) -> None:
        self._append("params", params.select("run_id", "key", F.col("value").cast("string").alias("value")))

    def append_metrics(self, metrics: DataFrame) -> None:
        step = F.col("step").cast("int") if "step" in metrics.columns else F.lit(0)
        time = F.col("event_time") if "event_time" in metrics.columns else F.current_timestamp()
        self._append("metrics", metrics.select("run_id", "key", step.alias("step"), F.col("value").cast("double"),
                                               time.alias("event_time")))

    # ---- reading ----

    def runs(self) -> DataFrame:
        """One row per run with its newest status, start time and newest event time."""
        newest = F.expr(f"struct({', '.join(NEWEST)})")
        return self._read("runs", RUNS).groupBy("run_id").agg(
            F.max_by("experiment", newest).alias("experiment"), F.max_by("status", newest).alias("status"),
            F.min("event_time").alias("start_time"), F.max("event_time").alias("end_time"),
            F.max_by("tags", newest).alias("tags"))

    def params(self) -> DataFrame:
        return self._read("params", PARAMS)

    def metrics(self) -> DataFrame:
        return self._read("metrics", METRICS)

    def wide(self, metrics: list[str], params: list[str] = ()) -> DataFrame:
        """One row per run with its last value of each metric and its parameters as columns."""
        last = self.metrics().where(F.col("key").isin(list(metrics))).groupBy("run_id").pivot("key", list(metrics)).agg(
            F.max_by("value", F.struct("step", "event_time")))
        table = self.runs().join(last, "run_id", "left")
        if params:
            named = self.params().where(F.col("key").isin(list(params))).groupBy("run_id").pivot("key", list(params)).agg(
                F.max("value"))
            table = table.join(named, "run_id", "left")
        return table

    def get(self, run_id: str) -> dict:
        """Status, parameters, metrics and tags of one run; empty if it is unknown."""
        found = self.runs().where(F.col("run_id") == run_id).first()
        if found is None:
            return {}
        params = {r.key: r.value for r in self.params().where(F.col("run_id") == run_id).collect()}
        metrics = self.metrics().where(F.col("run_id") == run_id).groupBy("key").agg(F.max_by("value", F.struct("step", "event_time")).alias("v"))
        return {**found.asDict(), "params": params, "metrics": {r.key: r.v for r in metrics.collect()}}

    def runs_per_experiment(self) -> DataFrame:
        return self.runs().groupBy("experiment").agg(F.count(F.lit(1)).alias("runs"))


def search_runs(table: DataFrame, where: str | None = None, order_by: list[str] = (), experiments: list[str] = ()) -> DataFrame:
    """Runs that meet a SQL condition, ordered by terms such as ``"rmse ASC"``."""
    if experiments:
        table = table.where(F.col("experiment").isin(list(experiments)))
    if where:
        table = table.where(where)
    terms = []
    for term in order_by:
        name, _, direction = term.partition(" ")
        terms.append(F.desc(name) if direction.strip().upper() == "DESC" else F.asc(name))
    return table.orderBy(*terms) if terms else table
