"""The jobs of a deployment, from landing files to answers, over tables below one lake folder.

Stages hand over by table, so each can be run, repeated or scheduled by itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vanewright.functions.columns import columns_named, numeric_columns
from vanewright.functions.text import REQUEST_FIELDS, parse_requests
from vanewright.operators import drift, models
from vanewright.operators.cells import VectorCells
from vanewright.operators.features import hourly_features, training_set
from vanewright.operators.keyed import latest_specifications
from vanewright.operators.metrics import binary_metrics, deploy_gate
from vanewright.operators.prepare import complete_rows
from vanewright.operators.retrieval import report_corpus
from vanewright.operators.split import stratified_split
from vanewright.session import written
from vanewright.sources.landing import infer_schema, read_merged, stream_files, table_path
from vanewright.sources.sinks import append_result
from vanewright.sources.versions import VersionedTable
from vanewright.streaming.hourly import stream_hourly_features, upsert_stream
from vanewright.streaming.upserts import UpsertTable

# The columns of the hourly table and the name models are registered by.
KEY = "turbine_id"
HOUR = "hourly_timestamp"
MODEL = "turbine_hourly"


def bronze(spark: SparkSession, lake: str, name: str) -> DataFrame:
    return read_merged(spark, table_path(lake, name))


def silver_hourly(spark: SparkSession, lake: str) -> UpsertTable:
    """The hourly table, which the batch job rebuilds and the stream upserts into: a day's changes rewrite that day."""
    schema = hourly_features(bronze(spark, lake, "incoming_data"), [KEY]).schema
    path = table_path(lake, "sensor_hourly", "silver")
    return UpsertTable(spark, path, [HOUR, KEY], schema, bucket=F.to_date(HOUR))


def training_table(spark: SparkSession, lake: str) -> VersionedTable:
    return VersionedTable(spark, table_path(lake, "training_dataset", "silver"))


def rebuild_hourly(spark: SparkSession, lake: str) -> int:
    """All hourly features anew from the bronze readings."""
    return silver_hourly(spark, lake).rebuild(hourly_features(bronze(spark, lake, "incoming_data"), [KEY]))


def stream_hourly(
    spark: SparkSession, lake: str, checkpoints: str, drain: bool = False, every: str | None = None,
    max_files: int | None = 1_000,
) -> StreamingQuery:
    """Keep the hourly table current with readings as they reach bronze, a bounded number of files a micro-batch."""
    path = table_path(lake, "incoming_data")
    readings = stream_files(spark, path, "parquet", infer_schema(spark, path, "parquet"), max_files)
    features = stream_hourly_features(readings, [KEY])
    return upsert_stream(
        features, silver_hourly(spark, lake), f"{checkpoints}/silver_sensor_hourly", drain, every
    )


def rebuild_training_set(spark: SparkSession, lake: str) -> int:
    """A new version of the training set."""
    rows = training_set(
        silver_hourly(spark, lake).read(),
        bronze(spark, lake, "turbine"),
        bronze(spark, lake, "historical_turbine_status"),
        KEY,
    )
    return training_table(spark, lake).write(rows)


def model_rows(df: DataFrame) -> DataFrame:
    """Complete rows of the model's columns, and the key to split by."""
    features = [HOUR, *columns_named(df, prefix="std_", names=["avg_energy"]), *models.CATEGORIES, "sensor_status"]
    return complete_rows(df.select(KEY, *features), features)


def training_drift(spark: SparkSession, lake: str) -> tuple[DataFrame, DataFrame] | None:
    """Drift per number and per category between the last two training sets; None while there is only one."""
    table = training_table(spark, lake)
    previous, latest = table.previous_and_latest()
    if previous == latest:
        return None
    before, now = model_rows(table.read(previous)), model_rows(table.read(latest))
    numbers = columns_named(now, prefix="std_", names=["avg_energy"])
    return (
        drift.numeric_drift(before, now, numbers),
        drift.categorical_drift(before, now, [*models.CATEGORIES, "sensor_status"]),
    )


def train(
    spark: SparkSession, lake: str, registry: models.ModelRegistry, results: str, grid: list[dict] | None = None,
    forest=None, name: str = MODEL,
) -> str | None:
    """Search a model on the latest training set, compare it with all registered ones on held-out rows, and register
    it unless one of them is better. Trials, predictions, scores, drift and the decision are added below ``results``, each
    row with the run's id and the version of its training set. Registered models score only rows they have not seen."""
    table, run = training_table(spark, lake), uuid4().hex
    known = {"run_id": F.lit(run), "training_version": F.lit(table.latest_version()).cast("bigint")}

    def kept(df: DataFrame, what: str) -> None:
        append_result(df.withColumns(known), f"{results}/{what}")

    rows = model_rows(table.read())
    place = F.xxhash64(KEY, HOUR)
    placed = written(stratified_split(rows, "sensor_status", place), "split")
    train_rows, test_rows = (placed.filter(side).drop("is_train") for side in (F.col("is_train"), ~F.col("is_train")))
    model, trials = models.search(train_rows, grid=grid, forest=forest)
    kept(trials, "trials")
    scored = written(models.score(model, test_rows), "scored").withColumnRenamed("sensor_status", "real_label")
    kept(scored, "predictions")
    current = binary_metrics(scored, "real_label", "predicted_label")
    kept(current, "scores")
    for drifted, what in zip(training_drift(spark, lake) or (), ("numeric_drift", "categorical_drift")):
        kept(drifted, what)
    store = models.PredictionStore(spark, f"{registry.root}/predictions", [KEY, HOUR])
    store.complete(name, registry, test_rows)
    decision = deploy_gate(store.scores(name, test_rows, "sensor_status"), current).first()
    kept(spark.createDataFrame([decision], "current double, best_prior double, deploy int"), "gate")
    registered = registry.register(name, model, decision["current"], decision["deploy"])
    if registered:
        store.add(name, int(registered.rsplit(":", 1)[1]), scored)
    return registered


def predict(model: PipelineModel, requests: DataFrame, text: str) -> DataFrame:
    """Predicted status for request texts; invalid ones keep their ``status`` and get no prediction."""
    parsed = parse_requests(requests, text)
    features = [n for n, _ in REQUEST_FIELDS]
    typed = parsed.withColumn(HOUR, F.try_to_timestamp(F.col(HOUR)))
    predicted = models.score(model, typed)
    return predicted.select(
        *requests.columns, *features, "status",
        F.when(F.col("status") == "ok", F.col("predicted_label")).alias("predicted_label"),
    )


def specifications(spark: SparkSession, lake: str, turbine_ids: Sequence[str] | DataFrame) -> DataFrame:
    """The latest training row of each turbine asked for."""
    rows = training_table(spark, lake).read()
    columns = [
        KEY, HOUR, "avg_energy", *columns_named(rows, prefix="std_"), *models.CATEGORIES, "maintenance_report",
        "sensor_status",
    ]
    return latest_specifications(rows, turbine_ids, columns, KEY)


def corpus(spark: SparkSession, lake: str) -> DataFrame:
    """Reports with the readings they were written for, to search with ``retrieval.similar_reports``."""
    return report_corpus(
        training_table(spark, lake).read(), "maintenance_report", models.CATEGORIES, [KEY, HOUR]
    )


def report_index(spark: SparkSession, lake: str) -> VectorCells:
    """The stored index of reports, to search with ``retrieval.similar_reports``."""
    return VectorCells(spark, table_path(lake, "report_cells", "silver"))


def refresh_reports(spark: SparkSession, lake: str) -> VectorCells:
    """Add the reports of the latest training set that the index does not have yet; a version already in it adds
    nothing."""
    index = report_index(spark, lake)
    index.add(corpus(spark, lake), training_table(spark, lake).latest_version(), known_apart=False)
    return index


def summary(spark: SparkSession, lake: str) -> DataFrame:
    """Summary of the numbers in the latest training set."""
    rows = training_table(spark, lake).read()
    return drift.summarize(rows, ["avg_energy", *[c for c in numeric_columns(rows, "sensor")]])
