"""Hourly features as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vanewright.functions.times import event_time
from vanewright.operators.features import sensor_aggregates
from vanewright.streaming.upserts import UpsertTable

# Fixed value: how late a reading may be.
ALLOWED_DELAY = "3 hours"
# Whether Spark counts the rows of a stream's state.
COUNT_STATE = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


def dedup_readings(readings: DataFrame, keys: Sequence[str], delay: str = ALLOWED_DELAY) -> DataFrame:
    """Drop readings delivered again within the allowed delay. State is kept that long per key, then freed.

    Adds ``event_time``, watermarked; ``stream_hourly_features`` takes it from there.
    """
    timed = readings.withColumn("event_time", event_time(F.col("timestamp"))).withWatermark("event_time", delay)
    return timed.dropDuplicatesWithinWatermark(list(keys))


def stream_hourly_features(
    readings: DataFrame, keys: Sequence[str] = ("turbine_id",), delay: str = ALLOWED_DELAY, accuracy: int = 10_000
) -> DataFrame:
    """The batch hourly features over a stream. An hour's state is freed once the watermark has passed it.

    The watermark is on the time of the reading, and the hour window is a grouping column: with only a truncated
    column or the arrival time Spark could never free the state.
    """
    aggregates = sensor_aggregates(readings, accuracy=accuracy)
    if "event_time" not in readings.columns:
        readings = readings.withColumn("event_time", event_time(F.col("timestamp"))).withWatermark("event_time", delay)
    grouped = readings.groupBy(F.window("event_time", "1 hour").alias("hour"), *keys).agg(*aggregates)
    others = [c for c in grouped.columns if c != "hour"]
    return grouped.select(F.col("hour.start").alias("hourly_timestamp"), *others)


def upsert_stream(
    features: DataFrame, table: UpsertTable, checkpoint: str, drain: bool = True, every: str | None = None,
    compact_every: int | None = 50, grouped: bool = False, count_state: bool = True,
) -> StreamingQuery:
    """Keep ``table`` up to date with a stream of changed rows (update mode).

    Runs until all present input is in (``drain``), or on and on: at an interval (``every``) or back to back. After
    every ``compact_every`` micro-batches the changes are folded into a new version, so that reading stays cheap.
    ``grouped`` says that the stream is grouped by the table's keys, so a micro-batch has each key once. Without
    ``count_state`` the stream's progress does not tell how many rows its state has, which spares a look at the state
    for every row that is put or removed.
    """
    stream, session = table.stream_number(checkpoint), table.spark

    def upsert(batch: DataFrame, batch_id: int) -> None:
        table.apply(batch, batch_id, stream=stream, grouped=grouped)
        if compact_every and batch_id % compact_every == compact_every - 1:
            table.compact()

    writer = (
        features.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(upsert)
    )
    if drain:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    before = session.conf.get(COUNT_STATE, None)
    if not count_state:
        session.conf.set(COUNT_STATE, "false")
    try:
        return writer.start()  # takes a copy of the settings
    finally:
        if not count_state:
            session.conf.unset(COUNT_STATE) if before is None else session.conf.set(COUNT_STATE, before)
