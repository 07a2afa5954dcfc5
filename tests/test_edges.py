"""Missing numbers, uneven times, awkward requests and files: rows that a plain reading would get wrong."""

import math

import pytest
from pyspark.sql import functions as F

from vanewright.functions.text import REQUEST_FIELDS, parse_requests
from vanewright.operators.drift import summarize
from vanewright.operators.fills import fill_along_time
from vanewright.operators.prepare import MedianFill, Scale
from vanewright.operators.quantiles import exact_medians, exact_quantiles
from vanewright.operators.retrieval import report_corpus, similar_reports
from vanewright.operators.split import stratified_split
from vanewright.sources.landing import infer_schema


@pytest.fixture(scope="module")
def gappy(spark):
    """10,001 numbers among 20,000 rows, the rest not-a-number or null."""
    kept = F.when(F.col("id") <= 10_000, F.col("id").cast("double"))
    return spark.range(20_000).select(F.coalesce(kept, F.when(F.col("id") % 2 == 0, F.lit(float("nan")))).alias("x"))


def test_narrowing_ends_with_missing_numbers(gappy):
    for exact_rows in (200, 1_000_000):
        assert exact_medians(gappy, ["x"], exact_rows) == {"x": 5000.0}
        assert exact_quantiles(gappy, ["x"], [0.25, 1.0], exact_rows) == {"x": [2500.0, 10_000.0]}


def test_fits_and_fills_take_nan_as_missing(gappy):
    filled = MedianFill(columns=["x"]).fit(gappy).transform(gappy)
    assert filled.where(F.isnan("x") | F.col("x").isNull()).count() == 0
    assert filled.where("x = 5000").count() == 10_000
    scaled = Scale(columns=["x"]).fit(gappy)
    assert math.isclose(scaled.getOrDefault(scaled.means)[0], 5000.0)
    row = summarize(gappy, ["x"], exact_rows=200).first()
    assert (row["rows"], row["nulls"], row["high"], row["p50"], row["distinct_values"]) == (20_000, 9999, 10_000.0, 5000.0, 10_001)


@pytest.mark.parametrize("rows", [9_000, 300_000])
def test_split_is_exact_at_any_size(spark, rows):
    df = spark.range(rows).withColumn("label", F.lit("ok"))
    split = stratified_split(df, "label", F.xxhash64("id"), exact_rows=5_000)
    assert split.where("is_train").count() == math.ceil(0.75 * rows)


def test_fills_with_stray_times_and_bursts(spark):
    times = F.when(F.col("id") == 0, F.lit(0)).when(F.col("id") < 60_000, F.col("id") % 500 + 5_000_000)
    df = spark.range(100_000).select(
        F.lit("u").alias("unit"), F.coalesce(times, F.lit(10_000_000) + F.col("id")).alias("t"), F.col("id").alias("n"),
        F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"),
    )
    one, many = (
        fill_along_time(df, ["unit"], "t", ["v"], ties=["n"], rows_per_part=size) for size in (1000, 1_000_000)
    )
    assert one.exceptAll(many).count() == 0


GOOD = ["'2024-01-01 00:00:00'", *map(str, range(1, 8)), "'x'", "'m'", "'s'"]


@pytest.mark.parametrize("text, status, location", [
    ("[" + ", ".join(GOOD) + "]", "ok", "x"),
    ("(" + ", ".join(GOOD) + ")", "ok", "x"),
    ("[" + ", ".join(GOOD) + ",]", "ok", "x"),
    ("[" + ", ".join([*GOOD[:8], "'x, None, y'", *GOOD[9:]]) + "]", "ok", "x, None, y"),
    ("[" + ", ".join([*GOOD[:8], "None", *GOOD[9:]]) + "]", "ok", None),
    ("[" + ", ".join([*GOOD[:8], "'a [b] (c)'", *GOOD[9:]]) + "]", "ok", "a [b] (c)"),
    ("[" + ", ".join(GOOD) + "] and more", "invalid", None),
    ("[" + ", ".join([GOOD[0], "'much'", *GOOD[2:]]) + "]", "invalid", None),
    ("[" + ", ".join(GOOD[:-1]) + "]", "invalid", None),
    ("[]", "invalid", None), ("", "invalid", None), ("no list", "invalid", None), (None, "invalid", None),
])
def test_requests(spark, text, status, location):
    row = parse_requests(spark.createDataFrame([(text,)], "request string"), "request").first()
    assert (row["status"], row["location"]) == (status, location)
    assert status == "ok" or all(row[name] is None for name, _ in REQUEST_FIELDS)


def test_reports_of_one_unit_and_hour_stay_apart(spark):
    training = spark.createDataFrame(
        [("a", "h", 1.5, 2.5, "x", "worn"), ("a", "h", 1.5, 2.5, "x", "worn"), ("a", "h", 1.5, 2.5, "x", "torn"),
         (None, "a/h", 9.5, 2.5, "x", "worn"), ("a/h", None, 9.5, 2.5, "x", "worn")],
        "turbine_id string, hour string, std_a double, std_b double, location string, report string",
    )
    corpus = report_corpus(training, "report", ["location"], ["turbine_id", "hour"])
    assert corpus.count() == corpus.select("report_id").distinct().count() == 4
    asked = spark.createDataFrame([("q", "1.5 2.5")], "query_id string, request string")
    found = similar_reports(corpus, asked, "request", k=2).collect()
    assert sorted((r["rank"], r["report"]) for r in found) in ([(1, "torn"), (2, "worn")], [(1, "worn"), (2, "torn")])


def test_schema_has_the_columns_of_all_files(spark, folder):
    spark.range(3).withColumn("sensor_A", F.lit(1.0)).write.parquet(f"{folder}/in")
    spark.range(3).withColumn("sensor_B", F.lit(2.0)).write.mode("append").parquet(f"{folder}/in")
    assert {"id", "sensor_A", "sensor_B"} == set(infer_schema(spark, f"{folder}/in", "parquet").names)
