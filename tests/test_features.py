import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanewright.operators.features import (
    PERCENTILES,
    hourly_features,
    merged_percentiles,
    sensor_sketches,
    split_percentiles,
    training_set,
)

H = 1704067200


@pytest.fixture(scope="module")
def readings(spark):
    rows = [
        (H + 10, "a", 1.0, 2.0), (H + 20, "a", None, 4.0), (H + 30, "a", 3.0, None),
        (H + 3600, "a", 5.0, 9.0), (H + 10, "b", 7.0, 1.0), (H + 3599, "b", 8.0, 3.0), (H + 20, None, 1.0, 1.0),
    ]
    return spark.createDataFrame(rows, "timestamp bigint, turbine_id string, energy double, sensor_A double")


def test_hourly_features(readings):
    rows = {(str(r[0])[11:13], r[1]): r for r in hourly_features(readings).collect()}
    assert set(rows) == {("00", "a"), ("01", "a"), ("00", "b"), ("00", None)}
    first = rows["00", "a"]
    assert first["avg_energy"] == 2.0
    assert first["std_sensor_A"] == pytest.approx(np.std([2.0, 4.0]))
    assert first["percentiles_sensor_A"] == [2.0, 2.0, 4.0, 4.0, 4.0]
    assert rows["01", "a"]["std_sensor_A"] == 0.0


def test_percentiles_as_columns(readings):
    flat = split_percentiles(hourly_features(readings))
    assert flat.columns == [
        "hourly_timestamp", "turbine_id", "avg_energy", "std_sensor_A",
        "p10_sensor_A", "p30_sensor_A", "p60_sensor_A", "p80_sensor_A", "p95_sensor_A",
    ]


def test_training_set_keeps_only_known_units(spark, readings):
    units = spark.createDataFrame(
        [("a", "52.1", "North"), ("b", "ERROR", "South"), (None, "ERROR", "East"), ("c", "1.0", "West")],
        "turbine_id string, lat string, location string",
    )
    status = spark.createDataFrame([("a", "ok"), ("b", None), ("c", "sensor_A")], "turbine_id string, abnormal_sensor string")
    rows = training_set(hourly_features(readings), units, status).collect()
    assert sorted((r["turbine_id"], r["sensor_status"]) for r in rows) == [("a", "ok"), ("a", "ok"), ("b", "faulty")]
    assert list(rows[0].asDict())[0] == "turbine_id"


def test_each_status_row_repeats_the_features(spark, readings):
    units = spark.createDataFrame([("a", "North")], "turbine_id string, location string")
    status = spark.createDataFrame([("a", "ok"), ("a", "sensor_A")], "turbine_id string, abnormal_sensor string")
    assert training_set(hourly_features(readings), units, status).count() == 4


def test_shape_of_a_small_fleet(spark):
    """Every known unit has a row per hour; readings of unlisted units are left out."""
    readings = spark.createDataFrame(
        [(H + 3600 * h, f"t{u}", 1.0, 2.0) for h in range(7) for u in range(10)],
        "timestamp bigint, turbine_id string, energy double, sensor_A double",
    )
    units = spark.createDataFrame([(f"t{u}", "x") for u in range(8)], "turbine_id string, location string")
    status = spark.createDataFrame([(f"t{u}", "ok") for u in range(8)], "turbine_id string, abnormal_sensor string")
    assert training_set(hourly_features(readings), units, status).count() == 8 * 7


def test_percentiles_of_coarser_grains_from_sketches(spark):
    """Small groups are exact, missing numbers do not count, and a group without numbers has none."""
    rows = spark.range(240).select(
        (F.lit(1704067200) + F.col("id") * 600).alias("timestamp"), F.lit("a").alias("turbine_id"),
        F.when(F.col("id") % 5 > 0, F.col("id").cast("double")).when(F.col("id") % 2 == 0, float("nan")).alias("sensor_A"),
        F.when(F.col("id") < 144, F.col("id")).alias("sensor_B"),
    )
    merged = merged_percentiles(sensor_sketches(rows), "day").orderBy("hourly_timestamp").collect()
    assert [(r.count_sensor_A, r.count_sensor_B) for r in merged] == [(115, 144), (77, 0)]
    values = [i for i in range(144) if i % 5]
    assert merged[0].percentiles_sensor_A == [values[math.ceil(p * len(values)) - 1] for p in PERCENTILES]
    assert merged[1].percentiles_sensor_B is None
