"""Session settings and shared scratch folders."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

# Settings this package relies on, for whoever builds the session.
# UTC keeps hour truncation and text timestamps free of daylight-saving jumps; RocksDB keeps stream state
# for many (unit, hour) keys off the executor heap, and a commit writes what changed instead of a whole snapshot.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def local_session(name: str, cores: str = "8", settings: dict[str, str] | None = None) -> SparkSession:
    """A session on this machine, for tests and the bench. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SESSION_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path below the cluster's shared checkpoint folder.

    Every executor must reach it, so a machine-local folder is taken only in local mode.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="vanewright-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid4().hex}"


def written(df, purpose: str):
    """``df`` written once to shared storage and read back: reused without recomputing, and it outlives executors."""
    path = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def forget(*tables) -> None:
    """Remove tables that ``written`` returned, when all that reads them has been written itself."""
    for table in tables:
        removed(table.sparkSession, table.scratch_path)


def removed(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing will read again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
