"""Per-unit features of a time grain, and the labelled training set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.functions.columns import columns_named, numeric_columns
from vanewright.functions.labels import health_label
from vanewright.functions.times import hour_of

# The share of readings below each reported percentile.
PERCENTILES = (0.1, 0.3, 0.6, 0.8, 0.95)
#: Numbers that a quantile sketch keeps at its largest level.
SKETCH_SIZE = 400


def sensor_aggregates(df: DataFrame, percentiles: Sequence[float] = PERCENTILES, accuracy: int = 10_000) -> list[Column]:
    """Mean energy, then population deviation and percentiles of every numeric sensor column found in ``df``."""
    out = [F.avg("energy").alias("avg_energy")]
    for c in numeric_columns(df, "sensor"):
        out.append(F.stddev_pop(c).alias(f"std_{c}"))
        out.append(F.percentile_approx(c, list(percentiles), accuracy).alias(f"percentiles_{c}"))
    return out


def hourly_features(
    readings: DataFrame,
    keys: Sequence[str] = ("turbine_id",),
    grain: str = "hour",
    time_column: str = "hourly_timestamp",
    accuracy: int = 10_000,
) -> DataFrame:
    """One row per (hour, unit). All aggregates combine per task first, so a busy unit shuffles as partial rows."""
    return (
        readings.withColumn(time_column, hour_of(F.col("timestamp"), grain))
        .groupBy(time_column, *keys)
        .agg(*sensor_aggregates(readings, accuracy=accuracy))
    )


def sensor_sketches(
    readings: DataFrame, keys: Sequence[str] = ("turbine_id",), grain: str = "hour",
    time_column: str = "hourly_timestamp", size: int = SKETCH_SIZE,
) -> DataFrame:
    """One row per (hour, unit) with a quantile sketch ``sketch_x`` of every numeric sensor column ``x``: stored with the
    hour, it gives the percentiles of any coarser grain without the readings. Missing numbers are not counted."""
    sketches = [
        F.kll_sketch_agg_double(F.nanvl(F.col(c).cast("double"), F.lit(None)), size).alias(f"sketch_{c}")
        for c in numeric_columns(readings, "sensor")
    ]
    return readings.withColumn(time_column, hour_of(F.col("timestamp"), grain)).groupBy(time_column, *keys).agg(*sketches)


def merged_percentiles(
    sketches: DataFrame, grain: str, keys: Sequence[str] = ("turbine_id",), time_column: str = "hourly_timestamp",
    percentiles: Sequence[float] = PERCENTILES,
) -> DataFrame:
    """``count_x`` and ``percentiles_x`` per (grain, unit) from the sketches of a finer grain. The share of readings below
    a percentile is off by about 2.3 / size ** 0.9 at most (99 of 100 times); small groups are exact."""
    out = []
    for c in (c.removeprefix("sketch_") for c in columns_named(sketches, prefix="sketch_")):
        merged = F.kll_merge_agg_double(f"sketch_{c}")
        some = F.kll_sketch_get_n_double(merged)
        shares = F.array(*[F.lit(float(p)) for p in percentiles])
        out += [some.alias(f"count_{c}"), F.when(some > 0, F.kll_sketch_get_quantile_double(merged, shares)).alias(f"percentiles_{c}")]
    return sketches.groupBy(F.date_trunc(grain, time_column).alias(time_column), *keys).agg(*out)


def split_percentiles(df: DataFrame, percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """Replace each ``percentiles_x`` array by scalar columns ``p10_x``, ``p30_x``, …"""
    cols = []
    for c in df.columns:
        if not c.startswith("percentiles_"):
            cols.append(F.col(c))
            continue
        sensor = c.removeprefix("percentiles_")
        cols += [F.get(c, F.lit(i)).alias(f"p{round(p * 100)}_{sensor}") for i, p in enumerate(percentiles)]
    return df.select(*cols)


def training_set(features: DataFrame, units: DataFrame, status: DataFrame, key: str = "turbine_id") -> DataFrame:
    """Features with the unit's description and status, and the label.

    Inner joins, so units without id, description or status drop out, and several status rows of a unit repeat its
    features. No join hint: Spark broadcasts the two tables while they are under its size threshold, and otherwise
    sorts and merges, splitting skewed partitions as it runs.
    """
    joined = features.join(units, key, "inner").join(status, key, "inner")
    return joined.withColumn("sensor_status", health_label(F.col("abnormal_sensor")))
