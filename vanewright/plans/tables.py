"""The given tables in the roles of readings, turbines, status and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewright.functions.times import epoch_seconds
from vanewright.operators.features import hourly_features, training_set
from vanewright.operators.keyed import latest_per_key, rows_of
from vanewright.sources.landing import stream_files


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_readings(events: DataFrame) -> DataFrame:
    """Events as sensor readings: the value is both the energy and a sensor, ``k`` in the properties another."""
    return events.select(
        F.col("event_id").alias("reading_id"),
        F.col("user_id").alias("turbine_id"),
        epoch_seconds(F.col("ts")).alias("timestamp"),
        F.col("value").alias("energy"),
        F.col("value").alias("sensor_value"),
        F.get_json_object("props", "$.k").cast("double").alias("sensor_k"),
        "event_type",
    )


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return as_readings(table(spark, folder, "events"))


def streamed_readings(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    schema = table(spark, folder, "events").schema
    # As a glob the path may be one file or a folder of files.
    return as_readings(stream_files(spark, f"{folder}/event[s].parquet", "parquet", schema, max_files))


def turbines(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as turbines: nation is the location, region the state, market segment the model."""
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("turbine_id"),
        F.col("n_name").alias("location"),
        F.col("r_name").alias("state"),
        F.col("c_mktsegment").alias("model"),
    )


def status(rows: DataFrame) -> DataFrame:
    """One status per turbine of the readings: its last event; an error means an abnormal sensor."""
    last = latest_per_key(
        rows.select("turbine_id", "timestamp", "reading_id", "event_type"),
        ["turbine_id"], "timestamp", ["reading_id"],
    )
    abnormal = F.when(F.col("event_type") == "error", "sensor_value").otherwise("ok")
    return last.select("turbine_id", abnormal.alias("abnormal_sensor"))


def hourly_training_set(spark: SparkSession, folder: str, wanted: DataFrame | None = None) -> DataFrame:
    """Hourly features with description and status of all turbines, or of the wanted ones: their readings alone are
    then aggregated."""
    rows, units = readings(spark, folder), turbines(spark, folder)
    if wanted is not None:
        rows, units = rows_of(rows, "turbine_id", wanted), rows_of(units, "turbine_id", wanted)
    return training_set(hourly_features(rows), units, status(rows))


def monthly_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Features per turbine and month with the turbine's description and its two reports: the document of its number and
    the next one."""
    features = hourly_features(readings(spark, folder), grain="month")
    reports = table(spark, folder, "documents").select(
        F.explode(F.array("doc_id", F.col("doc_id") - 1)).alias("turbine_id"),
        F.col("text").alias("maintenance_report"),
    )
    return features.join(turbines(spark, folder), "turbine_id").join(reports, "turbine_id")


def judged_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with their real class."""
    real = F.when(F.col("quality") == 1, "ok").otherwise("faulty")
    return table(spark, folder, "labels").join(table(spark, folder, "documents"), "doc_id").select(
        "doc_id", "lang", "n_chars", real.alias("real_label")
    )


def label_by_length(least_chars: int | Column) -> Column:
    """A one-rule classifier: long documents are ok."""
    return F.when(F.col("n_chars") >= least_chars, "ok").otherwise("faulty")
