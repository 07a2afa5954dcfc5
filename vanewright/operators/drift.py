"""Data drift between two versions of a table, and a summary of one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vanewright.operators.bounded import join_small
from vanewright.operators.quantiles import EXACT_ROWS, exact_quantiles, is_present, present
from vanewright.session import written

# A column has drifted from this distance on, a table from this share of drifted columns on.
# The histogram of a drift run is cut into parts of about so many distinct values.
VALUES_PER_PART = 500_000
COLUMN_THRESHOLD = 0.1
TABLE_THRESHOLD = 0.5


def _value_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """Rows of either side per column and distinct non-null value, combined per task before the shuffle."""
    sides = []
    for df, in_reference, in_current in ((reference, 1, 0), (current, 0, 1)):
        values = df.select(*[F.col(c).cast(kind).alias(c) for c in columns])
        long = values.unpivot([], list(columns), "column_name", "value").filter(F.col("value").isNotNull())
        sides.append(long.withColumns({"r": F.lit(in_reference), "c": F.lit(in_current)}))
    return sides[0].unionByName(sides[1]).groupBy("column_name", "value").agg(
        F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur")
    )


def numeric_drift(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], threshold: float = COLUMN_THRESHOLD
) -> DataFrame:
    """Per column: largest gap between the two distribution functions (``ks``), and the area between them over the
    reference deviation (``wasserstein``, which decides on drift).

    The value histogram is range-partitioned by column and value and written once with its partition number. The
    running totals of a partition then need only the totals of earlier partitions, one row each, so no column is
    ever sorted in one task.
    """
    counts = written(_value_counts(reference, current, columns, "double"), "value-counts")
    size = max(1, -(-counts.count() // VALUES_PER_PART))
    histogram = written(
        counts.repartitionByRange(size, "column_name", "value").withColumn("part", F.spark_partition_id()), "histogram"
    )
    parts = histogram.groupBy("column_name", "part").agg(
        F.sum("n_ref").alias("part_ref"), F.sum("n_cur").alias("part_cur"), F.min("value").alias("part_start")
    )
    in_order = Window.partitionBy("column_name").orderBy("part")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("column_name")
    offsets = parts.select(
        "column_name",
        "part",
        F.coalesce(F.sum("part_ref").over(earlier), F.lit(0)).alias("before_ref"),
        F.coalesce(F.sum("part_cur").over(earlier), F.lit(0)).alias("before_cur"),
        F.sum("part_ref").over(whole).alias("total_ref"),
        F.sum("part_cur").over(whole).alias("total_cur"),
        F.lead("part_start").over(in_order).alias("next_start"),
    )
    inside = Window.partitionBy("part", "column_name").orderBy("value")
    running = join_small(histogram, offsets, ["column_name", "part"]).select(
        "column_name",
        F.when(F.col("total_ref") > 0,
               (F.col("before_ref") + F.sum("n_ref").over(inside)) / F.col("total_ref")).alias("f_ref"),
        F.when(F.col("total_cur") > 0,
               (F.col("before_cur") + F.sum("n_cur").over(inside)) / F.col("total_cur")).alias("f_cur"),
        (F.coalesce(F.lead("value").over(inside), F.col("next_start")) - F.col("value")).alias("width"),
    )
    gap = F.abs(F.col("f_ref") - F.col("f_cur"))
    distances = running.groupBy("column_name").agg(
        F.max(gap).alias("ks"), F.coalesce(F.sum(gap * F.col("width")), F.lit(0.0)).alias("area")
    )
    spread = reference.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "deviation"
    )
    wasserstein = F.col("area") / F.when(F.col("deviation") > 0, F.col("deviation")).otherwise(1.0)
    return distances.join(spread, "column_name").select(
        "column_name", "ks", wasserstein.alias("wasserstein"), (wasserstein >= threshold).alias("drifted")
    )


def categorical_drift(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], threshold: float = COLUMN_THRESHOLD
) -> DataFrame:
    """Per column: Jensen-Shannon distance (base 2) between the category shares of the two sides."""
    counts = written(_value_counts(reference, current, columns, "string"), "category-counts")
    totals = counts.groupBy("column_name").agg(F.sum("n_ref").alias("all_ref"), F.sum("n_cur").alias("all_cur"))
    shares = join_small(counts, totals, ["column_name"]).select(
        "column_name",
        F.when(F.col("all_ref") > 0, F.col("n_ref") / F.col("all_ref")).alias("p"),
        F.when(F.col("all_cur") > 0, F.col("n_cur") / F.col("all_cur")).alias("q"),
    )
    middle = (F.col("p") + F.col("q")) / 2

    def part(share):
        return F.when(share > 0, share * F.log2(share / middle)).otherwise(0.0)

    divergence = F.sum((part(F.col("p")) + part(F.col("q"))) / 2)
    distance = F.sqrt(F.greatest(divergence, F.lit(0.0)))
    return shares.groupBy("column_name").agg(distance.alias("js")).withColumn("drifted", F.col("js") >= threshold)


def table_drift(*column_results: DataFrame, threshold: float = TABLE_THRESHOLD) -> DataFrame:
    """One row: columns looked at, columns drifted, and whether that makes the table drifted."""
    merged = None
    for result in column_results:
        part = result.select("column_name", "drifted")
        merged = part if merged is None else merged.unionByName(part)
    counted = merged.agg(F.count("*").alias("columns"), F.count_if("drifted").alias("drifted_columns"))
    share = F.try_divide(F.col("drifted_columns"), F.col("columns"))
    return counted.select("*", share.alias("share"), F.coalesce(share >= threshold, F.lit(False)).alias("drifted"))


def summarize(
    df: DataFrame,
    columns: Sequence[str],
    shares: Sequence[float] = (0.25, 0.5, 0.75),
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """One row per numeric column: rows, missing ones (null or not-a-number), distinct values, range, mean, population deviation, quantiles.

    The moments take one pass. Distinct values are counted after de-duplicating (column, value) pairs across the
    cluster, and quantiles are found by narrowing, so nothing grows with the table in one task.
    """
    stats = []
    for i, c in enumerate(columns):
        value = present(df, c).cast("double")
        stats += [
            F.count("*").alias(f"rows_{i}"),
            F.count_if(~is_present(df, c)).alias(f"nulls_{i}"),
            F.min(value).alias(f"low_{i}"),
            F.max(value).alias(f"high_{i}"),
            F.avg(value).alias(f"mean_{i}"),
            F.stddev_pop(value).alias(f"deviation_{i}"),
        ]
    wide = df.agg(*stats)
    quantiles = exact_quantiles(df, columns, shares, exact_rows)
    rows = []
    for i, c in enumerate(columns):
        cells = [F.lit(c).alias("column_name")]
        cells += [F.col(f"{s}_{i}").alias(s) for s in ("rows", "nulls", "low", "high", "mean", "deviation")]
        cells += [F.lit(q).cast("double").alias(f"p{round(p * 100)}") for p, q in zip(shares, quantiles[c])]
        rows.append(F.struct(*cells))
    long = wide.select(F.inline(F.array(*rows)))
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    distinct = values.dropna().distinct().groupBy("column_name").agg(F.count("*").alias("distinct_values"))
    return long.join(distinct, "column_name", "left").fillna(0, ["distinct_values"])
