import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.plans import plan_of
from vanewright.operators.bounded import join_small, rows_if_small
from vanewright.operators.metrics import best_trial, binary_metrics, confusion, deploy_gate, resolve_versions
from vanewright.operators.split import label_codes, one_hot, stratified_rungs, stratified_split


def test_split_is_disjoint_stratified_and_repeatable(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, "faulty").otherwise("ok").alias("label"))
    split = stratified_split(df, "label", F.xxhash64("id"))
    shares = {r.label: r.share for r in split.groupBy("label").agg(F.avg(F.col("is_train").cast("int")).alias("share")).collect()}
    assert shares == {"faulty": 0.75, "ok": 0.75}
    again = stratified_split(df.repartition(7), "label", F.xxhash64("id"))
    assert split.exceptAll(again).count() == 0 and split.count() == 4000


def test_split_keeps_unlabelled_rows(spark):
    df = spark.createDataFrame([(1, "ok"), (2, None)], "id int, label string")
    rows = {r.id: r.is_train for r in stratified_split(df, "label", F.col("id")).collect()}
    assert rows == {1: True, 2: None}


def test_rungs_are_exact_shares_of_each_label(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, "faulty").otherwise("ok").alias("label"))
    odd = spark.createDataFrame([(2000, None), (None, "ok")], "id long, label string")
    place = F.when(F.col("id").isNotNull(), F.xxhash64("id"))
    rungs = stratified_rungs(df.union(odd), "label", place, [0.1, 0.2, 0.6])
    counts = {(r.label, r.rung): r["count"] for r in rungs.groupBy("label", "rung").count().collect()}
    assert counts == {("faulty", 0): 10, ("faulty", 1): 10, ("faulty", 2): 40, ("faulty", 3): 40, ("ok", 0): 90,
                      ("ok", 1): 90, ("ok", 2): 360, ("ok", 3): 360, ("ok", None): 1, (None, None): 1}
    by_label = rungs.where("rung IS NOT NULL").withColumn("place", place).groupBy("label", "rung").agg(
        F.min("place").alias("low"), F.max("place").alias("high")).orderBy("label", "rung").collect()
    assert all(a.high < b.low for a, b in zip(by_label, by_label[1:]) if a.label == b.label)
    assert stratified_rungs(df.limit(0), "label", F.xxhash64("id"), [0.5]).count() == 0


def test_small_side_is_broadcast_only_within_the_bound(spark):
    big = spark.range(100).withColumn("k", F.col("id") % 5)
    small = spark.range(5).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    assert rows_if_small(small, 4) is None and len(rows_if_small(small, 5)) == 5
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        within, beyond = join_small(big, small, ["k"], max_rows=5), join_small(big, small, ["k"], max_rows=4)
        assert "BroadcastHashJoin" in plan_of(within) and "BroadcastHashJoin" not in plan_of(beyond)
        assert within.exceptAll(beyond).count() == 0 and within.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_label_codes_go_there_and_back(spark):
    df = spark.createDataFrame([("ok",), ("faulty",), ("ok",)], "label string")
    rows = label_codes(df, "label", "code", "back").transform(df).collect()
    assert [(r.code, r.back) for r in rows] == [(1.0, "ok"), (0.0, "faulty"), (1.0, "ok")]


def test_unknown_category_is_all_zeros(spark):
    known = spark.createDataFrame([("b",), ("a",)], "c string")
    seen = spark.createDataFrame([("a",), ("b",), ("z",)], "c string")
    rows = one_hot(["c"]).fit(known).transform(seen).select(vector_to_array("c_vec")).collect()
    assert [r[0] for r in rows] == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]


def predictions(spark, pairs):
    return spark.createDataFrame(pairs, "real string, pred string")


def test_binary_metrics(spark):
    df = predictions(spark, [("ok", "ok"), ("ok", "ok"), ("faulty", "ok"), ("ok", "faulty"), ("faulty", "faulty")])
    row = binary_metrics(df, "real", "pred").first()
    assert (row.tp, row.fp, row.fn, row.tn) == (2, 1, 1, 1)
    assert (row.precision, row.recall, row.f1) == pytest.approx((2 / 3,) * 3)
    other = binary_metrics(df, "real", "pred", positive="faulty").first()
    assert (other.tp, other.f1) == (1, 0.5)


def test_metrics_without_positives_are_zero(spark):
    row = binary_metrics(predictions(spark, [("faulty", "faulty")]), "real", "pred").first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)


def test_missing_prediction_is_not_positive(spark):
    row = binary_metrics(predictions(spark, [("ok", None), ("ok", "ok")]), "real", "pred").first()
    assert (row.tp, row.fn) == (1, 1)


def test_confusion(spark):
    df = predictions(spark, [("ok", "ok"), ("ok", "ok"), ("faulty", "ok")])
    assert {tuple(r) for r in confusion(df, "real", "pred").collect()} == {("ok", "ok", 2), ("faulty", "ok", 1)}


@pytest.mark.parametrize("prior, current, deploy", [([], 0.1, 1), ([0.5, 0.9], 0.9, 1), ([0.5, 0.9], 0.89, 0)])
def test_gate_lets_ties_and_first_versions_pass(spark, prior, current, deploy):
    scores = spark.createDataFrame([(float(p),) for p in prior], "f1 double")
    assert deploy_gate(scores, spark.createDataFrame([(current,)], "f1 double")).first().deploy == deploy


def test_best_trial(spark):
    df = spark.createDataFrame([(3, -0.5), (2, -0.9), (1, -0.9)], "trial int, loss double")
    assert tuple(best_trial(df, ties=["trial"]).first()) == (1, -0.9)


def test_version_choice(spark):
    registry = spark.createDataFrame([("m", 1, "one"), ("m", 3, "three"), ("n", 2, "two")], "name string, version int, source string")
    requests = spark.createDataFrame([("m", 1), ("m", 2), ("m", None), ("none", 1)], "name string, wanted int")
    got = {(r.name, r.wanted): (r.version, r.source) for r in resolve_versions(registry, requests).collect()}
    assert got == {("m", 1): (1, "one"), ("m", 2): (3, "three"), ("m", None): (3, "three"), ("none", 1): (None, None)}
