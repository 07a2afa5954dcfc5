"""Landing files as streams into bronze tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

# Schemas of the known landing tables. Declaring one (``LandingTable.schema``) spares the pass over all JSON files that
# inference takes, but leaves out columns that are added later.
TABLE_SCHEMAS = {
    "incoming_data": "timestamp bigint, sensor_A double, sensor_B double, sensor_C double, sensor_D double, "
                     "sensor_E double, sensor_F double, energy double, turbine_id string",
    "turbine": "country string, lat string, location string, long string, model string, state string, "
               "turbine_id string",
    "historical_turbine_status": "abnormal_sensor string, end_time bigint, maintenance_report string, "
                                 "start_time bigint, turbine_id string",
    "parts": "EAN string, approvisioning_estimated_days bigint, height bigint, production_time bigint, "
             "sensors array<string>, stock_available bigint, stock_location string, type string, weight bigint, "
             "width bigint",
}


def infer_schema(spark: SparkSession, path: str, fmt: str, sampling_ratio: float = 1.0) -> StructType:
    """Schema of JSON or parquet files, with the columns of all of them. JSON is read through (a ``sampling_ratio``
    below 1 reads that share), of parquet every footer."""
    if fmt == "json":
        return spark.read.option("samplingRatio", sampling_ratio).json(path).schema
    if fmt == "parquet":
        return spark.read.option("mergeSchema", "true").parquet(path).schema
    raise ValueError(f"cannot infer a schema from {fmt!r} files")


def stream_files(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType | str | None = None,
    max_files: int | None = 1,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """Files of a folder (or glob) as a stream, ``max_files`` per micro-batch; None takes all that are there."""
    reader = spark.readStream.format(fmt).schema(
        infer_schema(spark, path, fmt, sampling_ratio) if schema is None else schema
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def append_stream(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", drain: bool = True
) -> StreamingQuery:
    """Append a stream to a table. ``drain`` stops once all present files are in; otherwise it keeps running.

    The checkpoint makes a restart go on where it stopped. A new column goes into new files only; read the table with
    ``read_merged``.
    """
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def read_merged(spark: SparkSession, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """A table whose files may differ in columns; a column a file lacks reads as null."""
    return spark.read.format(fmt).option("mergeSchema", "true").load(path)


@dataclass(frozen=True)
class LandingTable:
    """A table to ingest, ``max_files`` per micro-batch (1 shows progress file by file, more spares micro-batches)."""

    name: str
    fmt: str
    quality: str = "bronze"
    schema: StructType | str | None = None
    max_files: int | None = 1_000


# The tables a deployment ingests, in order. The JSON ones are small; of parquet, inference reads the footers.
LANDING_TABLES = (
    LandingTable("turbine", "json"),
    LandingTable("parts", "json"),
    LandingTable("historical_turbine_status", "json"),
    LandingTable("incoming_data", "parquet"),
)


# Fixed value: where a table of some quality lies in the lake.
def table_path(lake: str, name: str, quality: str = "bronze") -> str:
    return f"{lake}/{quality}/{quality}_{name}"


def ingest(
    spark: SparkSession, table: LandingTable, landing: str, lake: str, checkpoints: str, fmt: str = "parquet"
) -> StreamingQuery:
    """Start ingesting one table from ``{landing}/{name}``. Failures raise."""
    stream = stream_files(spark, f"{landing}/{table.name}", table.fmt, table.schema, table.max_files)
    return append_stream(
        stream, table_path(lake, table.name, table.quality), f"{checkpoints}/{table.quality}_{table.name}", fmt
    )


def ingest_all(
    spark: SparkSession,
    landing: str,
    lake: str,
    checkpoints: str,
    tables: Iterable[LandingTable] = LANDING_TABLES,
    fmt: str = "parquet",
) -> None:
    """Ingest tables side by side and wait for all of them."""
    running: list[StreamingQuery] = []
    try:
        for table in tables:
            running.append(ingest(spark, table, landing, lake, checkpoints, fmt))
        for query in running:
            query.awaitTermination()
    finally:  # when one fails, none is left running
        for query in running:
            query.stop()
