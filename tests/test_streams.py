"""Streams over several small files, one per micro-batch, landed in order."""

import os

import pytest
from pyspark.sql import functions as F

from vanewright.operators.features import hourly_features
from vanewright.plans import queries
from vanewright.sources import files
from vanewright.sources.landing import append_stream, stream_files
from vanewright.streaming import upserts
from vanewright.streaming.hourly import COUNT_STATE, dedup_readings, stream_hourly_features, upsert_stream
from vanewright.streaming.progress import ProgressLog
from vanewright.streaming.upserts import UpsertTable

H = 1704067200
SCHEMA = "timestamp bigint, turbine_id string, energy double, sensor_A double"


def land(spark, path, batches):
    """One file per batch; the file source takes older files first."""
    os.makedirs(path, exist_ok=True)
    before = len(os.listdir(path))
    for i, rows in enumerate(batches, before):
        staged = f"{path}-staged-{i}"
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(staged)
        (part,) = [f for f in os.listdir(staged) if f.endswith(".parquet")]
        target = f"{path}/{i:03}.parquet"
        os.link(f"{staged}/{part}", target)
        os.utime(target, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))


def silver(spark, folder, stream):
    return UpsertTable(spark, f"{folder}/silver", ["hourly_timestamp", "turbine_id"], stream.schema)


def run(spark, folder, deduplicate=False):
    stream = stream_files(spark, f"{folder}/in", "parquet", SCHEMA, 1)
    if deduplicate:
        stream = dedup_readings(stream, ["timestamp", "turbine_id"])
    features = stream_hourly_features(stream)
    table = silver(spark, folder, features)
    query = upsert_stream(features, table, f"{folder}/checkpoint")
    query.awaitTermination(120)
    return table, query


def plain(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_later_batches_change_the_stored_row(spark, folder):
    land(spark, f"{folder}/in", [[(H + i, "a", e, e)] for i, e in enumerate((10.0, 20.0, 30.0))])
    table, _ = run(spark, folder)
    assert [r.avg_energy for r in table.read().collect()] == [20.0]


def test_stream_equals_batch(spark, folder):
    rows = [(H + 600 * i, f"t{i % 3}", float(i % 7), None if i % 4 == 0 else float(i % 5)) for i in range(60)]
    land(spark, f"{folder}/in", [rows[i: i + 12] for i in range(0, 60, 12)])
    table, _ = run(spark, folder)
    expected = hourly_features(spark.read.parquet(f"{folder}/in"))
    assert plain(table.read()) == plain(expected)
    table.compact()
    assert plain(table.read()) == plain(expected)


def test_restart_goes_on_with_the_state(spark, folder):
    land(spark, f"{folder}/in", [[(H, "a", 10.0, 1.0)]])
    run(spark, folder)
    table, query = run(spark, folder)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 0
    table.compact()
    land(spark, f"{folder}/in", [[(H + 1, "a", 20.0, 1.0), (H + 1, "b", 5.0, 1.0)]])
    table, _ = run(spark, folder)
    assert {r.turbine_id: r.avg_energy for r in table.read().collect()} == {"a": 15.0, "b": 5.0}


def test_late_reading_is_dropped_and_counted(spark, folder):
    land(spark, f"{folder}/in", [
        [(H, "a", 10.0, 1.0)],
        [(H + 36_000, "a", 1.0, 1.0)],  # ten hours on
        [(H + 36_001, "a", 1.0, 1.0)],
        [(H + 1, "a", 99.0, 1.0)],
    ])
    table, query = run(spark, folder)
    first = table.read().filter(F.col("hourly_timestamp") == F.timestamp_seconds(F.lit(H))).first()
    assert first.avg_energy == 10.0
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped == 1


def test_state_of_past_hours_is_freed(spark, folder):
    land(spark, f"{folder}/in", [[(H + 3600 * 10 * i, "a", 1.0, 1.0)] for i in range(4)])
    _, query = run(spark, folder)
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 2


def test_append_mode_emits_finished_hours_once(spark, folder):
    land(spark, f"{folder}/in", [[(H + 3600 * 5 * i, "a", float(i), 1.0)] for i in range(3)])
    features = stream_hourly_features(stream_files(spark, f"{folder}/in", "parquet", SCHEMA, 1))
    append_stream(features, f"{folder}/out", f"{folder}/checkpoint").awaitTermination(120)
    assert sorted(r.avg_energy for r in spark.read.parquet(f"{folder}/out").collect()) == [0.0, 1.0]


def test_readings_delivered_again_count_once(spark, folder):
    land(spark, f"{folder}/in", [
        [(H, "a", 10.0, 1.0), (H, "a", 10.0, 1.0)], [(H, "a", 10.0, 1.0), (H + 1, "a", 40.0, 1.0)],
    ])
    table, _ = run(spark, folder, deduplicate=True)
    assert table.read().first().avg_energy == 25.0


@pytest.fixture
def keyed(spark, folder):
    df = spark.createDataFrame([], "k string, v int")
    return UpsertTable(spark, f"{folder}/keyed", ["k"], df.schema)


def test_upserts_replays_and_compaction(spark, keyed):
    def batch(*rows):
        return spark.createDataFrame(rows, "k string, v int")

    def state():
        return {r.k: r.v for r in keyed.read().collect()}

    assert state() == {} and keyed.compact() is None
    keyed.apply(batch(("a", 1), ("b", 1)), 0)
    keyed.apply(batch(("a", 2), ("c", 2), ("c", 3)), 1, [F.col("v").desc()])
    expected = {"a": 2, "b": 1, "c": 3}
    assert state() == expected
    keyed.apply(batch(("a", 2), ("c", 2), ("c", 3)), 1, [F.col("v").desc()])  # replay
    assert state() == expected
    assert {r.k: r.v for r in keyed.read(through=0).collect()} == {"a": 1, "b": 1}
    assert keyed.compact() == 0 and keyed.compact() is None
    assert state() == expected
    keyed.apply(batch(("b", 9)), 2)
    assert state() == {"a": 2, "b": 9, "c": 3}
    assert keyed.compact() == 1 and state() == {"a": 2, "b": 9, "c": 3}


def test_a_new_checkpoint_loses_nothing(spark, keyed, folder):
    """Batches of a stream that starts anew count from 0 again, after compaction and after a rebuild."""
    def batch(*rows):
        return spark.createDataFrame(rows, "k string, v int")

    def state():
        return {r.k: r.v for r in keyed.read().collect()}

    first = keyed.stream_number(f"{folder}/one")
    keyed.apply(batch(("a", 1), ("b", 1)), 0, stream=first)
    keyed.apply(batch(("c", 1)), 1, stream=first)
    keyed.compact()
    second = keyed.stream_number(f"{folder}/two")
    assert (first, second) == (1, 2) and keyed.stream_number(f"{folder}/one") == 1
    for _ in range(2):  # a replay replaces itself
        keyed.apply(batch(("a", 2), ("z", 9)), 0, stream=second)
        assert state() == {"a": 2, "b": 1, "c": 1, "z": 9}
    keyed.compact()
    assert state() == {"a": 2, "b": 1, "c": 1, "z": 9}
    keyed.rebuild(batch(("r", 1)))
    third = keyed.stream_number(f"{folder}/three")
    keyed.apply(batch(("r", 2), ("s", 1)), 0, stream=third)
    assert third == 3 and state() == {"r": 2, "s": 1}


def rows(spark, **pairs):
    return spark.createDataFrame(list(pairs.items()), "k string, v int")


def values(table):
    return {r.k: r.v for r in table.read().collect()}


@pytest.mark.parametrize("order", [(1, 2), (2, 1)])
def test_checkpoints_from_before_the_first_batch_lose_nothing(spark, keyed, folder, order):
    """Two streams that start over an empty folder get numbers of their own, whoever writes first."""
    numbers = {1: keyed.stream_number(f"{folder}/one"), 2: keyed.stream_number(f"{folder}/two")}
    assert numbers == {1: 1, 2: 2}
    batches = {1: rows(spark, z=3), 2: rows(spark, x=1, y=2)}
    for turn in order + order:  # and each comes again
        keyed.apply(batches[turn], 0, stream=numbers[turn])
    assert values(keyed) == {"x": 1, "y": 2, "z": 3}
    keyed.compact()
    for turn in order:
        keyed.apply(batches[turn], 0, stream=numbers[turn])
    assert values(keyed) == {"x": 1, "y": 2, "z": 3} and keyed.compact() is None


def test_a_number_is_claimed_once(spark, folder):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(8) as pool:
        claimed = list(pool.map(lambda _: files.claim_next(spark, f"{folder}/n", "number=", 0), range(24)))
    assert sorted(claimed) == list(range(1, 25))
    assert not files.claim(spark, f"{folder}/n/number=3") and files.numbers(spark, f"{folder}/n", "number=") == sorted(claimed)
    files.write_text(spark, f"{folder}/n/note", "text é\n")
    assert files.read_text(spark, f"{folder}/n/note") == "text é\n" and files.read_text(spark, f"{folder}/none") is None


@pytest.mark.parametrize("compactions", [(), (0,), (1,), (0, 1, 2)])
def test_streams_that_write_in_turn_do_not_depend_on_compaction(spark, keyed, folder, compactions):
    """The larger stream number wins a key, folded in or not."""
    first, second = keyed.stream_number(f"{folder}/one"), keyed.stream_number(f"{folder}/two")
    steps = [(rows(spark, a=1, b=1), 0, first), (rows(spark, a=2), 0, second), (rows(spark, a=3, b=3, c=3), 1, first)]
    for at, (batch, number, stream) in enumerate(steps):
        keyed.apply(batch, number, stream=stream)
        if at in compactions:
            keyed.compact()
    assert values(keyed) == {"a": 2, "b": 3, "c": 3}
    keyed.compact()
    assert values(keyed) == {"a": 2, "b": 3, "c": 3}


def stored_files(folder):
    return {
        os.path.relpath(os.path.join(at, f), folder)
        for at, _, found in os.walk(f"{folder}/base") for f in found if f.endswith(".parquet")
    }


def test_a_days_changes_rewrite_that_day(spark, folder):
    schema = "day date, k int, v int"
    table = UpsertTable(spark, f"{folder}/t", ["day", "k"], spark.createDataFrame([], schema).schema, bucket=F.col("day"))
    days = spark.range(40).selectExpr("date_add(DATE'2024-01-01', cast(id % 8 AS int)) AS day", "cast(id AS int) AS k", "0 AS v")
    table.rebuild(days)
    before = stored_files(f"{folder}/t")
    assert len({f.split("/")[2] for f in before}) == 8
    table.apply(days.where("day = DATE'2024-01-03'").withColumn("v", F.lit(1)).limit(2), 0, stream=1)
    assert table.compact() == 1
    added = stored_files(f"{folder}/t") - before
    assert {f.split("/")[2] for f in added} == {"bucket=2024-01-03"} and before < stored_files(f"{folder}/t")
    assert table.read().count() == 40 and table.read().where("v = 1").count() == 2
    for batch in range(1, 4):  # what only older manifests need goes
        table.apply(days.where("k = 7").withColumn("v", F.lit(batch)), batch, stream=1)
        table.compact()
    assert files.numbers(spark, f"{folder}/t/manifests", "version=") == [3, 4]
    assert files.numbers(spark, f"{folder}/t/changes/_stream=1", "_batch=") == [3]
    assert {f.split("/")[2] for f in stored_files(f"{folder}/t") & before} == {f"bucket=2024-01-0{d}" for d in (1, 2, 4, 5, 6, 7)}
    assert {(r.k, r.v) for r in table.read().collect() if r.v} == {(2, 1), (10, 1), (7, 3)}


def test_an_unfinished_batch_does_not_count(spark, keyed, folder):
    keyed.apply(rows(spark, a=1), 0)
    keyed.apply(rows(spark, a=2), 1)
    os.remove(f"{folder}/keyed/changes/_stream=0/_batch=1/_SUCCESS")
    assert values(keyed) == {"a": 1} and keyed.compact() == 0
    keyed.apply(rows(spark, a=2), 1)  # it comes again
    assert values(keyed) == {"a": 2}


def test_a_version_without_manifest_is_not_read(spark, keyed, folder, monkeypatch):
    keyed.apply(rows(spark, a=1), 0)
    keyed.compact()
    keyed.apply(rows(spark, a=2), 1)
    with monkeypatch.context() as m:
        m.setattr(files, "write_text", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            keyed.compact()
    assert values(keyed) == {"a": 2} and keyed.compact() == 2 and values(keyed) == {"a": 2}


def test_columns_added_later_are_null_in_old_rows(spark, folder):
    old = UpsertTable(spark, f"{folder}/keyed", ["k"], spark.createDataFrame([], "k string, v int").schema)
    old.apply(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), 0)
    old.compact()
    old.apply(spark.createDataFrame([("c", 1)], "k string, v int"), 1)
    new = UpsertTable(spark, f"{folder}/keyed", ["k"], spark.createDataFrame([], "k string, w string, v int").schema)
    new.apply(spark.createDataFrame([("b", "x", 2)], "k string, w string, v int"), 2)
    assert {tuple(r) for r in new.read().collect()} == {("a", None, 1), ("b", "x", 2), ("c", None, 1)}


def test_progress_of_streams_is_a_table(spark, folder):
    land(spark, f"{folder}/in", [[(H, "a", 10.0, 1.0)], [(H + 36_000, "a", 1.0, 1.0)], [(H + 36_001, "a", 1.0, 1.0)], [(H + 1, "a", 9.0, 1.0)]])
    features = stream_hourly_features(stream_files(spark, f"{folder}/in", "parquet", SCHEMA, 1))
    table = silver(spark, folder, features)
    with ProgressLog(spark, f"{folder}/progress") as log:
        query = upsert_stream(features, table, f"{folder}/checkpoint")
        log.wait(query)
    told = log.table().where("input_rows > 0").orderBy("batch_id").collect()
    assert [(r.batch_id, r.input_rows, r.late_rows) for r in told] == [(0, 1, 0), (1, 1, 0), (2, 1, 0), (3, 1, 1)]
    assert {r.run_id for r in told} == {str(query.runId)} and all(r.duration_ms > 0 and r.started_at for r in told)
    before = log.table().count()
    upsert_stream(features, table, f"{folder}/checkpoint").awaitTermination()  # no longer told
    assert log.table().count() == before


def test_readings_of_many_files_land_in_order_of_time(spark, folder, monkeypatch):
    """Every file spans all times, and a part has several: still no reading comes too late, and a micro-batch is a part."""
    events = spark.range(400).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 600).alias("ts"),
        (F.col("id") % 3).alias("user_id"), F.lit("view").alias("event_type"), F.col("id").cast("double").alias("value"),
        F.lit('{"k": 1}').alias("props"),
    )
    for part in range(4):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == part).coalesce(1).write.mode("append").parquet(
            f"{folder}/events.parquet")
    monkeypatch.setattr(queries, "LANDED_ROWS", 40)
    landed = queries._landed_in_parts(spark, folder)
    sizes = []
    landed.writeStream.foreachBatch(lambda batch, _: sizes.append(batch.count())).option(
        "checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert len(sizes) == 4 and sum(sizes) == 400
    wanted = queries.hourly(spark, folder).orderBy("hourly_timestamp", "turbine_id").collect()
    assert queries.stream_upsert(spark, folder).orderBy("hourly_timestamp", "turbine_id").collect() == wanted


def test_compaction_shuffles_and_sorts_only_when_many_keys_come_again(spark, folder, monkeypatch):
    """Keys that are null or in several batches of two streams; the newest wins either way of finding it."""
    schema = spark.createDataFrame([], "k string, n int, v int").schema
    batches = {
        (1, 0): [("a", 1, 10), ("b", 1, 10), (None, 1, 10), ("c", None, 10)], (1, 1): [("a", 1, 11), ("d", 2, 11)],
        (1, 12): [(None, 1, 12), ("e", 2, 12)], (2, 0): [("b", 1, 20), ("f", 2, 20)], (2, 3): [("c", None, 23)],
    }
    newest, calls, plain_first = {}, [], upserts.first_per_key
    for rows_of_batch in batches.values():
        newest.update({row[:2]: row for row in rows_of_batch})
    monkeypatch.setattr(upserts, "first_per_key", lambda *given: (calls.append(given), plain_first(*given))[1])
    for many in (False, True):
        if many:
            monkeypatch.setattr(upserts, "rows_if_small", lambda df: None, raising=False)
        table = UpsertTable(spark, f"{folder}/{many}", ["k", "n"], schema, buckets=2)
        for (stream, batch), rows_of_batch in batches.items():
            table.apply(spark.createDataFrame(rows_of_batch, schema), batch, stream=stream)
        calls.clear()
        assert table.compact() == 0 and len(calls) == many
        assert sorted(map(tuple, table.read().collect()), key=str) == sorted(newest.values(), key=str)


def test_buckets_by_date_or_number_need_no_pattern(spark, folder):
    rows_in = spark.sql("SELECT * FROM VALUES (DATE'2024-01-02', 7, 'a b/c'), (DATE'+12024-01-02', -7, 'd'), (null, null, null) AS t(day, n, s)")
    for column, names, pattern in (
        ("day", {"2024-01-02", "-12024-01-02", "none"}, False), ("n", {"7", "-7", "none"}, False), ("s", {"a-b-c", "d", "none"}, True),
    ):
        table = UpsertTable(spark, f"{folder}/{column}", ["day", "n", "s"], rows_in.schema, bucket=F.col(column))
        named = rows_in.select(table.bucket.alias("bucket"))
        assert {r.bucket for r in named.collect()} == names
        assert ("regexp_replace" in named._jdf.queryExecution().toString()) == pattern


def test_a_grouped_stream_is_not_grouped_again_and_need_not_count_its_state(spark, folder, monkeypatch):
    rows_in = [(H + 600 * i, f"t{i % 3}", float(i % 7), float(i % 5)) for i in range(40)]
    land(spark, f"{folder}/in", [rows_in[:20], rows_in[20:]])
    features = stream_hourly_features(stream_files(spark, f"{folder}/in", "parquet", SCHEMA, 1))
    monkeypatch.setattr(type(features), "dropDuplicates", lambda *given: 1 / 0)
    table = silver(spark, folder, features)
    query = upsert_stream(features, table, f"{folder}/checkpoint", grouped=True, count_state=False)
    assert spark.conf.get(COUNT_STATE, None) is None
    query.awaitTermination(120)
    assert all(p["stateOperators"][0]["numRowsTotal"] <= 0 for p in query.recentProgress)
    assert plain(table.read()) == plain(hourly_features(spark.read.parquet(f"{folder}/in")))
