"""What the operators of this subpackage share."""

from __future__ import annotations

import sys
from types import ModuleType

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of one Arrow batch, so that a batch of very long texts stays small.
ARROW_BYTES = 32 * 1024 * 1024


def by_value(module: str) -> None:
    """Send a module's functions to the workers whole, so they need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


#: Caches a worker process keeps: those of the operators it ran last.
_CACHES = 3


def process_cache(name: str) -> dict:
    """A dict that outlives the task: models are loaded and words looked up once a worker process, not once a task.
    Only the caches used last are kept."""
    holder = sys.modules.setdefault("_vanewright_worker", ModuleType("_vanewright_worker")).__dict__
    caches = holder.setdefault("caches", {})
    cache = caches.pop(name, None)
    if cache is None:
        cache = {}
        while len(caches) >= _CACHES:
            del caches[next(iter(caches))]
    caches[name] = cache  # the last used comes last
    return cache


def bounded_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, by bytes and by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def objects(values) -> pd.Series:
    """A column of Python objects: pandas' own text columns may come in chunks, which Arrow's structs refuse."""
    return pd.Series(list(values), dtype=object)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet, whatever extra columns it has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: Column) -> Column:
    """Rows kept out of every fit: crc32 of the id as text leaves 2 when divided by 4. False for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def label_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents outside the held-out part, as (text, label): a bounded sample for fits.

    Chosen by the hash of the id alone, so that it is the same on every run. A document labelled twice counts once a label
    row, one without a label 0 or 1 not at all. Only the chosen ids travel to the texts:
    the broadcast holds ``rows`` rows of two numbers.
    """
    ids = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .orderBy(F.xxhash64(F.col("doc_id")), "doc_id", "label")
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(ids), "doc_id").select("text", "label")
