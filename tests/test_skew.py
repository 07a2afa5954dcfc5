"""Registered queries on tables of several files where a third of all rows share a key, a value or a vector."""

import duckdb
import pytest

import __spark_entry__ as registered
from tests.oracle_check import TABLES, compare

SOURCE = "/root/testdata/sf0.001"
SKEWED = {
    "events": """SELECT event_id + i * 1000 AS event_id, ts + to_microseconds(i * 1000003) AS ts,
        CASE WHEN (event_id + i) % 3 = 0 THEN 7 ELSE user_id END AS user_id, event_type,
        CASE WHEN (event_id + i) % 3 = 1 THEN 42.5 ELSE value END AS value, props FROM '{0}', range(4) r(i)""",
    "orders": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey,
        o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM '{0}'""",
    "lineitem": """SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 1000.0 ELSE l_extendedprice END AS
        l_extendedprice) FROM '{0}'""",
    "customer": """SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 'MACHINERY' ELSE c_mktsegment END AS
        c_mktsegment) FROM '{0}'""",
    "embeddings": """SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN (SELECT embedding FROM '{0}' WHERE vec_id = 0)
        ELSE embedding END AS embedding, CASE WHEN vec_id % 3 = 0 THEN 0 ELSE label END AS label FROM '{0}'""",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    for t in TABLES:
        source = f"{SOURCE}/{t}.parquet"
        con.execute(f"COPY ({SKEWED.get(t, 'SELECT * FROM ' + repr('{0}')).format(source)}) TO '{folder}/{t}-one.parquet'")
        spark.read.parquet(f"{folder}/{t}-one.parquet").repartition(3).write.parquet(f"{folder}/{t}.parquet")
    duck = duckdb.connect()
    duck.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}-one.parquet'")
    return folder, duck


@pytest.mark.parametrize("name", [
    "q_hourly_features", "q_training_set", "q_latest_per_key", "q_upsert", "q_dedup", "q_impute_median", "q_impute_mode",
    "q_ffill", "q_bfill", "q_stratified_split", "q_data_summary", "q_drift_numeric", "q_drift_categorical", "q_knn",
    "q_knn_cells", "q_stream_hourly", "q_stream_dedup", "q_ingest_stream",
])
def test_skewed_tables(spark, skewed, name):
    folder, duck = skewed
    assert compare(registered.queries()[name](spark, folder), duck, registered.oracle_sql()[name]) is None
