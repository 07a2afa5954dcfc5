"""Forward and backward fill per entity, safe for entities that hold a large share of all rows.

A distributed prefix scan: rows are range-partitioned by entity and time, each part is filled from its own rows as it is
written, and one carry a part is folded over the parts in their order.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from vanewright.operators.bounded import join_small
from vanewright.session import scratch_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_PART = 2_000_000
#: Kinds of written rows: rows of the table, what a part passes on, and what it asks for.
_ROW, _PASSES, _ASKS = 0, 1, 2


def _sources(valid: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each row the last valid row up to it that is not before its entity's start; -1 if there is none."""
    last = np.maximum.accumulate(np.where(valid, np.arange(len(valid)), -1))
    return np.where(last >= starts, last, -1)


def _taken(values: pa.Array, sources: np.ndarray) -> pa.Array:
    return values.take(pa.array(sources, mask=sources < 0))


def _entity_starts(keys: list[pa.Array]) -> np.ndarray:
    """For each row the first row of its entity, in a block sorted by entity; a missing key equals itself."""
    new = np.r_[True, np.zeros(len(keys[0]) - 1, bool)]
    for key in keys:
        numbers = key.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= numbers[1:] != numbers[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _filling(names: Sequence[str], keys: Sequence[str], columns: Sequence[str]):
    """The task of a part: fill its sorted rows from each other, then say what it passes on and what it asks for."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = None  # the row before, with its values filled

        def marked(rows: pa.RecordBatch, first: bool | np.ndarray, kind: int) -> pa.RecordBatch:
            size = rows.num_rows
            marks = [pa.array(np.full(size, part), pa.int32()), pa.array(np.broadcast_to(first, size)), pa.array(np.full(size, kind), pa.int32())]
            return pa.RecordBatch.from_arrays([*rows.columns, *marks], names=[*names, "_part", "_first", "_kind"])

        in_first = True  # all rows so far belong to the first entity of the part
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.select(names)
            if last is None:
                yield marked(rows.slice(0, 1), True, _ASKS)
            else:
                rows = pa.Table.from_batches([last, rows]).combine_chunks().to_batches()[0]
            starts = _entity_starts([rows.column(k) for k in keys])
            filled = {c: _taken(rows.column(c), _sources(rows.column(c).is_valid().to_numpy(False), starts)) for c in columns}
            rows = pa.RecordBatch.from_arrays([filled.get(n, rows.column(n)) for n in names], schema=rows.schema)
            first = (starts == 0) & in_first
            before = 0 if last is None else 1
            yield marked(rows.slice(before), first[before:], _ROW)
            in_first, last = bool(first[-1]), rows.slice(rows.num_rows - 1)
        if last is not None:
            yield marked(last, False, _PASSES)

    return task


def fill_along_time(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    columns: Sequence[str],
    direction: str = "forward",
    ties: Sequence[str] = (),
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Replace nulls by the entity's last (``forward``) or next (``backward``) value in time order.

    Rows are range-partitioned by entity, time, ``ties`` and their place in the input, into parts of about
    ``rows_per_part`` rows: an entity that holds most rows, even at one and the same time, is spread over many tasks.
    They are shuffled once. A part passes on one row, its last one filled, and asks for the values that its first
    entity had before; these few rows are folded in the order of the parts. Rows of no time come before all others.
    """
    if direction not in ("forward", "backward"):
        raise ValueError(f"unknown direction {direction!r}")
    spark, forward = df.sparkSession, direction == "forward"
    order = [F.col(c).asc_nulls_first() if forward else F.col(c).desc_nulls_last() for c in (time, *ties)]
    order = [*(F.col(k).asc_nulls_first() for k in keys), *order, F.col("_place")]
    parts = max(1, -(-df.count() // rows_per_part))
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_place")
    fields = [StructField(f.name, f.dataType) for f in df.schema]
    marks = [StructField("_part", IntegerType()), StructField("_first", BooleanType()), StructField("_kind", IntegerType())]
    folder, schema = scratch_folder(spark, "fills"), StructType([*fields, *marks])
    dealt.mapInArrow(_filling(df.columns, keys, columns), schema).write.partitionBy("_kind").parquet(folder)

    stored = spark.read.schema(schema).parquet(folder)
    before = Window.partitionBy(F.struct(*keys)).orderBy("_part", F.col("_kind").desc())
    before = before.rowsBetween(Window.unboundedPreceding, -1)  # two rows a part: what it asks for, what it passes on
    carried = stored.where(F.col("_kind") > _ROW).select("_part", "_kind", *[
        F.last(F.when(F.col("_kind") == _PASSES, F.col(c)), ignorenulls=True).over(before).alias(f"_carry_{c}")
        for c in columns
    ]).where(F.col("_kind") == _ASKS).drop("_kind")
    joined = join_small(stored.where(F.col("_kind") == _ROW), carried, ["_part"], "left")
    return joined.withColumns({
        c: F.coalesce(F.col(c), F.when(F.col("_first"), F.col(f"_carry_{c}"))) for c in columns
    }).select(*df.columns)
