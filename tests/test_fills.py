import pandas as pd
import pytest
from pyspark.sql import functions as F

from vanewright.operators import fills
from vanewright.operators.fills import fill_along_time


@pytest.fixture(scope="module")
def gappy(spark):
    rows = []
    for i in range(300):
        key = None if i % 10 == 9 else "hot" if i % 3 else "cold"
        rows.append((i, key, 1000 + i // 4 * 7, None if i % 5 else float(i), None if i % 37 else f"v{i}"))
    return spark.createDataFrame(rows, "i int, k string, t bigint, x double, s string")


@pytest.mark.parametrize("direction", ["forward", "backward"])
@pytest.mark.parametrize("rows_per_part", [3, 50, 1_000_000])
@pytest.mark.parametrize("as_time", [False, True])
def test_fill_equals_whole_history_fill(gappy, direction, rows_per_part, as_time):
    df = gappy.withColumn("t", F.timestamp_seconds("t")) if as_time else gappy
    got = fill_along_time(df, ["k"], "t", ["x", "s"], direction, ["i"], rows_per_part).toPandas().sort_values("i")
    pdf = gappy.toPandas().sort_values(["t", "i"])
    groups = pdf.groupby("k", dropna=False)[["x", "s"]]
    pdf[["x", "s"]] = groups.ffill() if direction == "forward" else groups.bfill()
    expected = pdf.sort_values("i")
    pd.testing.assert_series_equal(got["x"].reset_index(drop=True), expected["x"].reset_index(drop=True))
    left, right = got["s"].fillna("-").tolist(), expected["s"].fillna("-").tolist()
    assert left == right
    assert list(got.columns) == gappy.columns


@pytest.fixture
def small_batches(spark):
    """Arrow batches of a few rows, so that entities and gaps run over their borders."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("direction", ["forward", "backward"])
def test_parts_and_batches_do_not_show(gappy, small_batches, direction):
    whole = fill_along_time(gappy, ["k"], "t", ["x", "s"], direction, ["i"])
    cut = fill_along_time(gappy.repartition(3), ["k"], "t", ["x", "s"], direction, ["i"], 20)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, cut.collect()))


def test_a_gap_over_many_parts_and_other_types(spark):
    rows = spark.range(1000).select(
        F.lit(1).alias("a"), F.when(F.col("id") < 990, "u").alias("b"), F.col("id").alias("t"),
        F.when(F.col("id") == 3, F.array(F.col("id"))).alias("list"),
        F.when(F.col("id") == 4, F.col("id").cast("decimal(20,3)")).alias("amount"),
        F.when(F.col("id") == 995, F.struct(F.col("id").alias("n"))).alias("pair"),
    )
    filled = fill_along_time(rows, ["a", "b"], "t", ["list", "amount", "pair"], rows_per_part=40)
    assert filled.dtypes == rows.dtypes
    assert filled.where("b = 'u' AND list[0] = 3").count() == 987 and filled.where("b = 'u' AND amount = 4").count() == 986
    assert filled.where("b IS NULL AND list IS NULL").count() == 10 and filled.where("pair.n = 995").count() == 5
    assert fill_along_time(rows.limit(0), ["a"], "t", ["list"]).count() == 0


def test_one_entity_at_one_time_is_dealt_to_many_tasks(spark, monkeypatch):
    parts = []
    join = fills.join_small
    monkeypatch.setattr(fills, "join_small", lambda big, *rest: (parts.append(big), join(big, *rest))[1])
    rows = spark.range(20_000).selectExpr("if(id % 3 < 2, 'hot', cast(id AS string)) AS k", "if(id % 3 < 2, 5, id) AS t", "if(id % 9 = 0, id, null) AS v")
    assert fill_along_time(rows, ["k"], "t", ["v"], rows_per_part=1000).count() == 20_000
    sizes = [r["count"] for r in parts[0].groupBy("_part").count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 2000


def test_single_moment_and_direction_check(spark):
    df = spark.createDataFrame([(1, 5, 1.0), (2, 5, None)], "i int, t bigint, x double")
    rows = fill_along_time(df.withColumn("k", F.lit(1)), ["k"], "t", ["x"], ties=["i"]).orderBy("i").collect()
    assert [r.x for r in rows] == [1.0, 1.0]
    with pytest.raises(ValueError):
        fill_along_time(df, ["i"], "t", ["x"], "sideways")
