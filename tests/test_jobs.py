"""From landing files to answers, as a deployment would run it."""

import pytest
from pyspark.sql import functions as F

from vanewright.operators import models
from vanewright.operators.retrieval import similar_reports
from vanewright.plans import jobs
from vanewright.sources.landing import LANDING_TABLES, ingest_all

H = 1705424400


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    turbines = [(None, "ERROR"), ("t90", "ERROR")] + [(f"t{i}", "52.1") for i in range(12)]
    spark.createDataFrame(turbines, "turbine_id string, lat string").select(
        "turbine_id", "lat", F.col("lat").alias("long"),
        F.lit("US").alias("country"), F.lit("M-100").alias("model"), F.lit("America/New_York").alias("state"),
        F.concat(F.lit("town "), F.length("turbine_id")).alias("location"),
    ).write.json(f"{root}/landing/turbine")
    status = [(f"t{i}", "ok" if i % 3 else "sensor_B", None if i % 3 else f"replace {i}", H, H + 9) for i in range(12)]
    spark.createDataFrame(
        status, "turbine_id string, abnormal_sensor string, maintenance_report string, start_time bigint, end_time bigint"
    ).write.json(f"{root}/landing/historical_turbine_status")
    spark.createDataFrame([("1", ["sensor_A"])], "EAN string, sensors array<string>").write.json(f"{root}/landing/parts")
    land_readings(spark, root, range(5))
    return root


def land_readings(spark, root, hours):
    rows = []
    for t in range(12):
        for h in hours:
            for n in range(6):
                swing = float((n % 2) * (9 if t % 3 == 0 else 1 + t / 10))
                rows.append((H + h * 3600 + n, f"t{t}", 1.0 + n, *[swing + s for s in range(6)]))
    sensors = ", ".join(f"sensor_{s} double" for s in "ABCDEF")
    spark.createDataFrame(rows, f"timestamp bigint, turbine_id string, energy double, {sensors}").coalesce(2) \
        .write.mode("append").parquet(f"{root}/landing/incoming_data")


def test_everything(spark, lake):
    places = (f"{lake}/landing", f"{lake}/lake", f"{lake}/checkpoints")
    root = places[1]
    ingest_all(spark, *places, LANDING_TABLES)
    assert jobs.bronze(spark, root, "turbine").count() == 14
    assert jobs.bronze(spark, root, "parts").first().sensors == ["sensor_A"]

    # The batch job, then a stream over the same and later readings, agree.
    jobs.rebuild_hourly(spark, root)
    batch = jobs.silver_hourly(spark, root).read()
    assert batch.count() == 12 * 5
    land_readings(spark, lake, range(5, 7))
    ingest_all(spark, *places, LANDING_TABLES)
    jobs.stream_hourly(spark, root, places[2], drain=True).awaitTermination(120)
    silver = jobs.silver_hourly(spark, root).read()
    assert silver.count() == 12 * 7
    assert batch.exceptAll(silver).count() == 0

    assert jobs.rebuild_training_set(spark, root) == 0
    assert jobs.training_drift(spark, root) is None
    rows = jobs.training_table(spark, root).read()
    assert rows.count() == 12 * 7
    assert {tuple(r) for r in rows.select("abnormal_sensor", "sensor_status").distinct().collect()} == {
        ("ok", "ok"), ("sensor_B", "faulty")
    }
    assert jobs.rebuild_training_set(spark, root) == 1
    numeric, categorical = jobs.training_drift(spark, root)
    assert numeric.filter("drifted").count() == 0 and numeric.count() == 7
    assert categorical.filter("drifted").count() == 0 and categorical.count() == 4
    assert jobs.summary(spark, root).filter("column_name = 'std_sensor_A' and rows = 84").count() == 1

    registry = models.ModelRegistry(spark, f"{lake}/registry")
    forest = models.classifier()
    grid = [{forest.numTrees: 5, forest.maxDepth: d, forest.minInstancesPerNode: 1,
             forest.featureSubsetStrategy: "sqrt"} for d in (2, 4)]
    assert jobs.train(spark, root, registry, f"{lake}/results", grid, forest) == "turbine_hourly:1"
    assert jobs.train(spark, root, registry, f"{lake}/results", grid, forest) == "turbine_hourly:2"  # a tie passes
    gate = spark.read.parquet(f"{lake}/results/gate")
    assert sorted((r.best_prior is None, r.deploy) for r in gate.collect()) == [(False, 1), (True, 1)]
    trials = spark.read.parquet(f"{lake}/results/trials")
    assert trials.count() == 4 and trials.select("run_id").distinct().count() == 2
    assert {r[0] for r in trials.select("training_version").distinct().collect()} == {1}
    assert spark.read.parquet(f"{lake}/results/numeric_drift").groupBy("run_id").count().count() == 2
    assert {r.name for r in spark.read.parquet(f"{lake}/registry/predictions/turbine_hourly").schema} >= {"version", "predicted_label"}

    model = registry.load("turbine_hourly")
    faulty = rows.filter("sensor_status = 'faulty'").first()
    cells = [repr(str(faulty.hourly_timestamp)), faulty.avg_energy]
    cells += [faulty[f"std_sensor_{s}"] for s in "ABCDEF"] + [repr(faulty[c]) for c in models.CATEGORIES]
    asked = spark.createDataFrame([(1, f"[{', '.join(map(str, cells))}]"), (2, "[]")], "i int, request string")
    answers = {r.i: (r.status, r.predicted_label) for r in jobs.predict(model, asked, "request").collect()}
    assert answers == {1: ("ok", "faulty"), 2: ("invalid", None)}

    found = jobs.specifications(spark, root, ["t3", "t90"]).collect()
    assert [(r.turbine_id, str(r.hourly_timestamp)[11:13], r.maintenance_report) for r in found] == [
        ("t3", "23", "replace 3")]
    corpus = jobs.corpus(spark, root)
    assert corpus.count() == 4 * 7
    text = spark.createDataFrame([("q", f"readings {' '.join(str(faulty[f'std_sensor_{s}']) for s in 'ABCDEF')}")],
                                 "query_id string, text string")
    best = similar_reports(corpus, text, "text").orderBy("rank").collect()
    assert len(best) == 5 and best[0].distance == pytest.approx(0.0)
    for _ in range(2):  # a version that is in the index already adds nothing
        index = jobs.refresh_reports(spark, root)
        assert index.rows().count() == 4 * 7
    indexed = similar_reports(corpus, text, "text", search=jobs.report_index(spark, root).search)
    assert indexed.orderBy("rank").select("report_id", "distance").collect() == [(r.report_id, r.distance) for r in best]


def test_stream_runs_until_stopped(spark, lake):
    places = (f"{lake}/landing", f"{lake}/lake-2", f"{lake}/checkpoints-2")
    ingest_all(spark, *places, LANDING_TABLES)
    query = jobs.stream_hourly(spark, places[1], places[2], every="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive
        assert jobs.silver_hourly(spark, places[1]).read().count() >= 12 * 5
    finally:
        query.stop()
