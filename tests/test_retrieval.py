import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanewright.operators import cells, topk
from vanewright.operators.cells import VectorCells
from vanewright.operators.retrieval import nearest, parse_readings, report_corpus, similar_reports


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    spread = rng.normal(size=(200, 6))
    copies = np.tile(rng.normal(size=6), (100, 1))  # a third of all rows are the same
    return np.concatenate([spread, copies]), np.concatenate([rng.normal(size=(12, 6)), copies[:1]])


def brute(corpus, queries, k):
    out = {}
    for q, point in enumerate(queries):
        distance = ((corpus - point) ** 2).sum(axis=1)
        out[q] = [int(i) for i in np.lexsort((np.arange(len(corpus)), distance))[:k]]
    return out


def vectors(spark, array, name):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(array)]
    return spark.createDataFrame(rows, f"{name} bigint, vector array<double>").repartition(5)


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["report_id"])
    return out


@pytest.mark.parametrize("query_block, corpus_block", [(100, 50_000), (5, 40), (1, 1000)])
def test_nearest_equals_brute_force(spark, points, query_block, corpus_block):
    corpus, queries = vectors(spark, points[0], "report_id"), vectors(spark, points[1], "query_id")
    got = nearest(corpus, queries, 5, query_block=query_block, corpus_block=corpus_block)
    assert found(got) == brute(*points, 5)
    first = got.filter("query_id = 0 and rank = 1").first()
    assert first.distance == pytest.approx(((points[0][first.report_id] - points[1][0]) ** 2).sum())


@pytest.mark.parametrize("travelling", [cells.TRAVELLING_BYTES, 0])
def test_cells_find_the_same(spark, points, folder, monkeypatch, travelling):
    monkeypatch.setattr(cells, "TRAVELLING_BYTES", travelling)
    monkeypatch.setattr(cells, "ROWS_BLOCK", 30)
    monkeypatch.setattr(cells, "QUERIES_BLOCK", 3)
    corpus, queries = vectors(spark, points[0], "report_id"), vectors(spark, points[1], "query_id")
    index = VectorCells(spark, f"{folder}/index")
    index.build(corpus, cells=12)
    assert index.rows().count() == len(points[0])
    assert found(index.search(queries, 5)) == brute(*points, 5)
    assert found(index.search(queries, 400)) == brute(*points, 400)  # more than there are
    only_copy = queries.filter("query_id = 12")
    assert found(index.search(only_copy, 5))[12] == [200, 201, 202, 203, 204]


def clustered(rng, clusters=20, each=40):
    centres = 50 * rng.normal(size=(clusters, 8))
    return (centres[:, None] + rng.normal(size=(clusters, each, 8))).reshape(-1, 8), centres + 0.5


def test_searches_read_few_cells(spark, folder, monkeypatch):
    """Queries in all clusters, yet each is compared with a few cells alone, and cells without a query are not read."""
    corpus, queries = clustered(np.random.default_rng(5))
    index = VectorCells(spark, f"{folder}/index")
    index.build(vectors(spark, corpus, "report_id"), cells=20)
    met, read = [], []
    compared, rows = index._compared, index._rows
    monkeypatch.setattr(index, "_compared", lambda pairs, *rest: (met.append(pairs.count()), compared(pairs, *rest))[1])
    monkeypatch.setattr(index, "_rows", lambda cells: (read.append(len(cells)), rows(cells))[1])
    assert found(index.search(vectors(spark, queries[:4], "query_id"), 5)) == brute(corpus, queries[:4], 5)
    assert sum(met) < 4 * 20 / 2 and max(read[1:]) < 20 / 2


def test_an_index_grown_in_steps_finds_the_same(spark, points, folder):
    """Small cells are split on the way, replays and repeated rows count once, an empty batch is fine."""
    rows = vectors(spark, points[0], "report_id").withColumn("note", F.lit("kept"))
    index = VectorCells(spark, f"{folder}/index", cell_rows=25, cell_folders=2)
    queries = vectors(spark, points[1], "query_id")
    assert found(index.search(queries, 5)) == {}
    steps = [rows.where("report_id < 90"), rows.where("report_id >= 80 AND report_id < 210"), rows.limit(0), rows.where("report_id >= 210")]
    for turn in (0, 1, 1, 2, 3, 0):
        index.add(steps[turn], turn, cells=2, known_apart=False)
    stored = index.rows()
    assert stored.count() == stored.select("report_id").distinct().count() == len(points[0])
    assert {r[0] for r in stored.select("note").distinct().collect()} == {"kept"}
    listed = index._latest()[1]
    assert len(listed) > 8 and sum(c["n_rows"] for c in listed) == len(points[0])
    assert all(c["n_rows"] <= 25 or not c["splits"] or not c["radius"] for c in listed)
    assert all(len(c["folders"]) <= 2 for c in listed)
    assert found(index.search(queries, 5)) == brute(*points, 5)


def test_all_large_cells_are_sampled_at_once(spark, folder, monkeypatch):
    rows = spark.range(600).select(
        F.concat(F.lit("r"), "id").alias("report_id"), F.array(F.col("id") * 1.0, F.col("id") % 7 * 1.0).alias("vector"))
    single, at_once = [], []
    sample, within = VectorCells._sample, VectorCells._centres_within
    monkeypatch.setattr(VectorCells, "_sample", lambda self, rows: single.append(1) or sample(self, rows))
    monkeypatch.setattr(
        VectorCells, "_centres_within", lambda self, cells: at_once.append(len(cells)) or within(self, cells))
    index = VectorCells(spark, f"{folder}/index", cell_rows=30)
    index.build(rows, cells=6)
    assert len(single) == 1 and at_once[0] == 6
    stored = index._latest()[1]
    assert sum(c["n_rows"] for c in stored) == 600 and max(c["n_rows"] for c in stored) <= 30
    assert len(found(index.search(rows.limit(9).select(F.col("report_id").alias("query_id"), "vector"), 3).where("rank = 1"))) == 9


def test_an_index_follows_a_stream(spark, points, folder):
    schema = "report_id bigint, vector array<double>"
    rows = vectors(spark, points[0], "report_id")
    index = VectorCells(spark, f"{folder}/index", cell_rows=60)
    for low, high in ((0, 100), (100, 300)):
        rows.where(f"report_id >= {low} AND report_id < {high}").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        index.follow(stream, f"{folder}/checkpoint").awaitTermination(120)
    assert found(index.search(vectors(spark, points[1], "query_id"), 5)) == brute(*points, 5)


def test_matrix_product_and_exact_distances_agree():
    rng = np.random.default_rng(9)
    rows = np.concatenate([1e6 + 1e-3 * rng.normal(size=(400, 5)), np.tile(1e6, (60, 5))])
    asked = np.concatenate([rows[:5], 1e6 + 1e-3 * rng.normal(size=(5, 5))])
    best = topk.Nearest(range(10), asked, 7)
    for at in range(0, 460, 50):
        best.see(np.arange(at, min(at + 50, 460)).astype(object), rows[at:at + 50])
    for q, (distance, ids) in enumerate(best.kept):
        exact = ((rows - asked[q]) ** 2).sum(axis=1)
        assert ids.tolist() == np.lexsort([np.arange(460), exact])[:7].tolist()


def test_fewer_rows_than_asked_for_and_null_vectors(spark):
    corpus = spark.createDataFrame(
        [("a", [1.0]), ("b", None), ("c", [3.0]), ("d", [None]), ("e", [float("nan")])],
        "report_id string, vector array<double>",
    )
    queries = spark.createDataFrame([("q", [0.0]), ("none", None)], "query_id string, vector array<double>")
    rows = nearest(corpus, queries, 5).orderBy("rank").collect()
    assert [(r.query_id, r.report_id, r.distance) for r in rows] == [("q", "a", 1.0), ("q", "c", 9.0)]


def test_corpus_and_similar_reports(spark):
    training = spark.createDataFrame(
        [("t1", 1, 0.5, 1.5, "N", "report one"), ("t1", 2, 0.6, None, "N", "report two"), ("t2", 1, 9.0, 9.0, "S", None)],
        "turbine_id string, hour int, std_sensor_B double, std_sensor_A double, location string, maintenance_report string",
    )
    corpus = report_corpus(training, "maintenance_report", ["location"], ["turbine_id", "hour"])
    rows = {r.report_id.split("#")[0]: r for r in corpus.collect()}
    assert set(rows) == {"t1/1", "t1/2"}
    assert (rows["t1/1"].content, rows["t1/1"].vector) == ("1.5 0.5", [1.5, 0.5])
    assert rows["t1/2"].content == "None 0.6"
    whole = corpus.filter(F.col("report_id").startswith("t1/1#"))
    asked = spark.createDataFrame([(1, "near 1.4 0.6"), (2, "no numbers 7"), (3, "1.0 2.0 3.0")], "query_id int, request string")
    got = {r.query_id: r for r in similar_reports(whole, asked, "request").collect()}
    assert (got[1].status, got[1].report_id, got[1].maintenance_report) == ("ok", rows["t1/1"].report_id, "report one")
    assert {(got[i].status, got[i].report_id) for i in (2, 3)} == {("invalid", None)}
    assert parse_readings(asked, "request").filter("query_id = 1").first().vector == [1.4, 0.6]


def test_workers_do_not_need_the_package(tmp_path):
    """The driver alone knows where the package is, as on a cluster."""
    repo = Path(__file__).resolve().parents[1]
    script = f"""
import sys
sys.path.insert(0, {str(repo)!r})
import __spark_entry__ as registered
from vanewright.session import local_session
spark = local_session("elsewhere", "2")
for name in ("q_knn", "q_knn_cells"):
    print(name, registered.queries()[name](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "q_knn 50" in done.stdout and "q_knn_cells 50" in done.stdout
