import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vanewright.session import scratch_folder, written
from vanewright.sources.landing import (
    TABLE_SCHEMAS,
    LandingTable,
    append_stream,
    infer_schema,
    ingest,
    ingest_all,
    read_merged,
    stream_files,
)
from vanewright.sources.sinks import append_result, read_csv, write_csv
from vanewright.sources.versions import VersionedTable


def land(spark, folder):
    turbines = spark.createDataFrame([("t1", "ERROR"), (None, "1.5")], "turbine_id string, lat string")
    turbines.repartition(2).write.json(f"{folder}/landing/turbine")
    readings = spark.createDataFrame([(i, float(i)) for i in range(30)], "timestamp bigint, energy double")
    readings.repartition(3).write.parquet(f"{folder}/landing/incoming_data")
    return [LandingTable("turbine", "json"), LandingTable("incoming_data", "parquet")]


def test_restart_adds_only_new_files(spark, folder):
    tables = land(spark, folder)
    places = (f"{folder}/landing", f"{folder}/lake", f"{folder}/checkpoints")
    count = lambda: spark.read.parquet(f"{folder}/lake/bronze/bronze_incoming_data").count()
    ingest_all(spark, *places, tables)
    ingest_all(spark, *places, tables)
    assert count() == 30
    assert spark.read.parquet(f"{folder}/lake/bronze/bronze_turbine").count() == 2
    spark.createDataFrame([(99, 1.0)], "timestamp bigint, energy double").write.mode("append").parquet(
        f"{folder}/landing/incoming_data")
    ingest_all(spark, *places, tables)
    assert count() == 31


def test_landing_files_with_a_new_column(spark, folder):
    places = (f"{folder}/landing", f"{folder}/lake", f"{folder}/checkpoints")
    table = [LandingTable("turbine", "json")]
    spark.createDataFrame([("t1",)], "turbine_id string").write.json(f"{folder}/landing/turbine")
    ingest_all(spark, *places, table)
    spark.createDataFrame([("t2", "N")], "turbine_id string, state string").write.mode("append").json(
        f"{folder}/landing/turbine")
    ingest_all(spark, *places, table)
    rows = read_merged(spark, f"{folder}/lake/bronze/bronze_turbine").select("turbine_id", "state").collect()
    assert {tuple(r) for r in rows} == {("t1", None), ("t2", "N")}


def test_declared_schema_is_taken(spark, folder):
    spark.createDataFrame([("t1", 5)], "turbine_id string, more int").write.json(f"{folder}/landing/turbine")
    table = LandingTable("turbine", "json", schema=TABLE_SCHEMAS["turbine"])
    ingest(spark, table, f"{folder}/landing", f"{folder}/lake", f"{folder}/c").awaitTermination()
    row = spark.read.parquet(f"{folder}/lake/bronze/bronze_turbine").first().asDict()
    assert row["turbine_id"] == "t1" and row["lat"] is None and "more" not in row and len(row) == 7


def test_one_file_per_batch(spark, folder):
    land(spark, folder)
    stream = stream_files(spark, f"{folder}/landing/incoming_data", "parquet", max_files=1)
    query = append_stream(stream, f"{folder}/out", f"{folder}/checkpoint")
    query.awaitTermination()
    batches = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert len(batches) == 3 and sum(batches) == 30


def test_failures_are_raised(spark, folder):
    with pytest.raises(ValueError):
        infer_schema(spark, folder, "xml")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ingest(spark, LandingTable("nowhere", "json"), folder, folder, folder)


def test_infer_schema(spark, folder):
    land(spark, folder)
    assert infer_schema(spark, f"{folder}/landing/turbine", "json").simpleString() == "struct<lat:string,turbine_id:string>"
    assert infer_schema(spark, f"{folder}/landing/incoming_data", "parquet").simpleString() == (
        "struct<timestamp:bigint,energy:double>")


def test_new_column_reads_as_null_for_old_rows(spark, folder):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{folder}/t")
    spark.createDataFrame([(2, "x")], "a int, b string").write.mode("append").parquet(f"{folder}/t")
    assert {tuple(r) for r in read_merged(spark, f"{folder}/t").collect()} == {(1, None), (2, "x")}


def test_versions(spark, folder):
    table = VersionedTable(spark, f"{folder}/v")
    assert not table.exists() and table.history().count() == 0
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.write(spark.range(3).toDF("a"), "first") == 0
    assert table.previous_and_latest() == (0, 0)
    # A version may be made from the table itself, with other columns.
    assert table.write(table.read().withColumn("b", F.lit("x")).drop("a")) == 1
    assert table.previous_and_latest() == (0, 1) and table.latest_version() == 1
    assert table.read().columns == ["b"] and table.read(0).columns == ["a"]
    assert {(r.version, r.note) for r in table.history().collect()} == {(0, "first"), (1, "")}


def test_unfinished_version_is_not_seen(spark, folder):
    table = VersionedTable(spark, f"{folder}/v")
    table.write(spark.range(3))
    spark.range(99).write.parquet(f"{folder}/v/rows/version=1")  # a writer that died before the history row
    assert table.read().count() == 3
    assert table.write(spark.range(5)) == 1
    assert table.read().count() == 5


def test_csv_keeps_nulls_texts_and_times(spark, folder):
    rows = [(1, 'say "hi", now', datetime(2024, 1, 1, 1, 2, 3, 456789)), (2, "two\nlines", None), (3, None, None)]
    df = spark.createDataFrame(rows, "i int, s string, t timestamp").withColumn("n", F.col("t").cast("timestamp_ntz"))
    write_csv(df, f"{folder}/csv")
    back = read_csv(spark, f"{folder}/csv", df.schema, multi_line=True)
    assert back.orderBy("i").collect() == df.collect()


def test_results_are_added(spark, folder):
    for score in (0.5, 0.7):
        append_result(spark.createDataFrame([(score,)], "f1 double"), f"{folder}/scores")
    stored = spark.read.parquet(f"{folder}/scores")
    assert sorted(r.f1 for r in stored.collect()) == [0.5, 0.7] and "recorded_at" in stored.columns


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    place = scratch_folder(spark, "x")
    assert place != scratch_folder(spark, "x")
    if shared:
        assert os.path.commonpath([place, shared]) == shared.rstrip("/")
    df = written(spark.range(5), "numbers")
    assert df.count() == 5
