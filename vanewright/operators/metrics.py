"""Classification quality, version choice and the deployment gate as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def binary_metrics(
    df: DataFrame, real: str, predicted: str, positive: object = "ok", groups: Sequence[str] = ()
) -> DataFrame:
    """Counts, precision, recall and F1 of one class, per group; 0 where nothing is to be divided by.

    Conditional counts combine per task, so only one row per task and group is shuffled.
    """
    is_real = F.col(real).eqNullSafe(F.lit(positive))
    is_predicted = F.col(predicted).eqNullSafe(F.lit(positive))
    counted = df.groupBy(*groups).agg(
        F.count_if(is_real & is_predicted).alias("tp"),
        F.count_if(~is_real & is_predicted).alias("fp"),
        F.count_if(is_real & ~is_predicted).alias("fn"),
        F.count_if(~is_real & ~is_predicted).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counted.withColumns({
        "precision": _share(tp, tp + fp),
        "recall": _share(tp, tp + fn),
        "f1": _share(2 * tp, 2 * tp + fp + fn),
    })


def confusion(df: DataFrame, real: str, predicted: str) -> DataFrame:
    """Rows per pair of real and predicted class."""
    return df.groupBy(real, predicted).agg(F.count("*").alias("n"))


def deploy_gate(prior_scores: DataFrame, current_score: DataFrame, score: str = "f1") -> DataFrame:
    """One row: the current score, the best prior one, and ``deploy`` = 1 if none is better (or none exists).

    Both inputs are aggregates with one row per model version.
    """
    both = prior_scores.select(F.col(score).alias("_score"), F.lit(False).alias("_new")).unionByName(
        current_score.select(F.col(score).alias("_score"), F.lit(True).alias("_new"))
    )
    best = both.agg(
        F.max(F.when(F.col("_new"), F.col("_score"))).alias("current"),
        F.max(F.when(~F.col("_new"), F.col("_score"))).alias("best_prior"),
    )
    passes = F.col("best_prior").isNull() | (F.col("current") >= F.col("best_prior"))
    return best.withColumn("deploy", F.when(passes, 1).otherwise(0))


def best_trial(trials: DataFrame, loss: str = "loss", ties: Sequence[str] = ()) -> DataFrame:
    """The trial with the smallest loss; equal losses are settled by the smallest ``ties``."""
    row = F.struct(*trials.columns)
    return trials.agg(F.min_by(row, F.struct(loss, *ties)).alias("best")).select("best.*")


def resolve_versions(
    registry: DataFrame, requests: DataFrame, name: str = "name", version: str = "version", wanted: str = "wanted"
) -> DataFrame:
    """For each requested model name the version asked for if it is registered, otherwise the highest one.

    A name without versions gives nulls. ``registry`` columns other than the name come back for the chosen version.
    """
    rest = [c for c in registry.columns if c != name]
    offered = requests.join(registry, name, "left")
    entry = F.struct(*rest)
    exact = F.max_by(entry, F.when(F.col(version) == F.col(wanted), F.col(version)))
    highest = F.max_by(entry, F.col(version))
    chosen = offered.groupBy(name, wanted).agg(F.coalesce(exact, highest).alias("_chosen"))
    return chosen.select(name, wanted, *[F.col(f"_chosen.{c}").alias(c) for c in rest])
