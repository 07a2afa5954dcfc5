import pytest
from pyspark.sql import functions as F

from vanewright.functions.columns import columns_named, numeric_columns
from vanewright.functions.labels import health_label
from vanewright.functions.text import decimals_in, explode_ids, ids_in, joined_values, parse_requests
from vanewright.functions.times import epoch_seconds, event_time, hour_of, parts_up_to, with_date_parts


def test_sensor_columns_are_numeric_only(spark):
    df = spark.createDataFrame([], "sensor_A double, abnormal_sensor string, sensors array<string>, energy double, sensor_n int")
    assert numeric_columns(df, "sensor") == ["sensor_A", "sensor_n"]


def test_columns_by_name_are_sorted(spark):
    df = spark.createDataFrame([], "std_b double, year_ts int, std_a double, avg_energy double, other int")
    assert columns_named(df, prefix="std_", suffix="_ts", names=["avg_energy"]) == [
        "avg_energy", "std_a", "std_b", "year_ts"
    ]
    assert columns_named(df, names=["missing"]) == []


def test_epoch_and_hour(spark):
    row = spark.createDataFrame([(1705425128,)], "t bigint").select(
        event_time(F.col("t")).cast("string").alias("at"),
        hour_of(F.col("t")).cast("string").alias("hour"),
        epoch_seconds(event_time(F.col("t"))).alias("back"),
    ).first()
    assert tuple(row) == ("2024-01-16 17:12:08", "2024-01-16 17:00:00", 1705425128)


def test_hour_follows_real_time_when_clocks_go_back(spark):
    # 05:30 and 06:30 UTC both read 01:30 on this day in New York.
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(1730611800,), (1730615400,)], "t bigint")
        assert df.select(hour_of(F.col("t"))).distinct().count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("granularity, parts", [
    ("month", ("year", "month")), ("year", ("year",)),
    ("dayofweek", ("year", "month", "day", "hour", "minute", "dayofweek")),
    ("second", ("year", "month", "day", "hour", "minute", "dayofweek")),
])
def test_parts_for_a_granularity(granularity, parts):
    assert parts_up_to(granularity) == parts


def test_date_parts_of_text(spark):
    df = spark.createDataFrame([("2024-01-15 13:45:10",), ("soon",), (None,)], "at string")
    rows = with_date_parts(df, "at", "all", keep_original=True).collect()
    assert tuple(rows[0])[1:] == (2024, 1, 15, 13, 45, 0)  # a Monday
    assert all(v is None for r in rows[1:] for v in tuple(r)[1:])
    months = with_date_parts(df, "at", "month")
    assert months.columns == ["year_ts", "month_ts"]
    assert months.schema["month_ts"].metadata == {"feature_name": "at_month_ts"}
    with pytest.raises(TypeError):
        with_date_parts(spark.range(1), "id")


def test_decimals_need_a_point(spark):
    df = spark.createDataFrame([("1.5 -2.25e-3 7",), ("none",), (None,)], "t string")
    assert [r[0] for r in df.select(decimals_in(F.col("t"))).collect()] == [["1.5", "-2.25e-3"], [], None]


def test_ids_split_on_any_space(spark):
    df = spark.createDataFrame([(1, "  a\tb c\n"), (2, " "), (3, None)], "r int, t string")
    assert [r[0] for r in df.select(ids_in(F.col("t"))).collect()] == [["a", "b", "c"], [], None]
    assert [tuple(r) for r in explode_ids(df, "t").collect()] == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c")]


def test_missing_values_are_written_out(spark):
    df = spark.createDataFrame([(1.5, None, "x")], "a double, b double, c string")
    assert df.select(joined_values([F.col(c) for c in "abc"])).first()[0] == "1.5 None x"


def test_requests(spark):
    good = "['2024-01-16 17:00:00', 1.5, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 'North', \"M-100\", None]"
    ten = "['2024-01-16 17:00:00', 1.5, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 'North', 'M-100']"
    df = spark.createDataFrame([(0, good), (1, ten), (2, "[]"), (3, ""), (4, "please"), (5, None)], "i int, t string")
    rows = parse_requests(df, "t").orderBy("i").collect()
    assert [r["status"] for r in rows] == ["ok"] + ["invalid"] * 5
    assert (rows[0]["avg_energy"], rows[0]["std_sensor_F"], rows[0]["model"], rows[0]["state"]) == (
        1.5, 0.6, "M-100", None
    )
    assert rows[1]["avg_energy"] is None


def test_labels(spark):
    df = spark.createDataFrame([("ok",), ("sensor_B",), (None,)], "s string")
    assert [r[0] for r in df.select(health_label(F.col("s"))).collect()] == ["ok", "faulty", "faulty"]
