"""CSV files, and results kept as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# Times keep their microseconds.
_FORMAT = {
    "header": "true",
    "escape": '"',
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header."""
    df.write.mode("overwrite").options(**_FORMAT).csv(path)


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool | None = None
) -> DataFrame:
    """CSV files with a header and a declared schema: no pass over the data to guess types.

    An empty field is a missing value. Texts with line breaks need ``multi_line``, which keeps Spark from splitting
    large files: by default it is on where the schema has texts, so that whatever ``write_csv`` wrote reads back.
    """
    if multi_line is None:
        fields = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
        multi_line = any(isinstance(f.dataType, StringType) for f in fields)
    return spark.read.options(**_FORMAT, mode="FAILFAST", multiLine=multi_line).schema(schema).csv(path)


def append_result(df: DataFrame, path: str) -> None:
    """Add result rows (metrics, gate decisions, registered ids) to a table, stamped with the time of writing."""
    df.withColumn("recorded_at", F.current_timestamp()).write.mode("append").parquet(path)
