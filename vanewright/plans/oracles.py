"""The same results as ``plans.queries`` in plain SQL, for checking on another engine."""

from __future__ import annotations

from vanewright.operators.features import PERCENTILES

_READINGS = """readings AS (
  SELECT event_id AS reading_id, user_id AS turbine_id, CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp", ts,
         value AS energy, value AS sensor_value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS sensor_k,
         event_type
  FROM events)"""


def _percentile_columns() -> str:
    return ", ".join(
        f"quantile_disc(sensor_{s}, {p}) AS p{round(p * 100)}_sensor_{s}"
        for s in ("value", "k") for p in PERCENTILES
    )


def _features(name: str, grain: str) -> str:
    return f"""{name} AS (
  SELECT date_trunc('{grain}', ts) AS hourly_timestamp, turbine_id, avg(energy) AS avg_energy,
         stddev_pop(sensor_value) AS std_sensor_value, stddev_pop(sensor_k) AS std_sensor_k, {_percentile_columns()}
  FROM readings GROUP BY 1, 2)"""


_HOURLY = f"WITH {_READINGS}, {_features('features', 'hour')}"
_TURBINES = """turbines AS (
  SELECT c_custkey AS turbine_id, n_name AS location, r_name AS state, c_mktsegment AS model
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
_STATUS = """status AS (
  SELECT turbine_id, CASE WHEN event_type = 'error' THEN 'sensor_value' ELSE 'ok' END AS abnormal_sensor
  FROM (SELECT *, row_number() OVER (PARTITION BY turbine_id ORDER BY "timestamp" DESC, reading_id DESC) AS n
        FROM readings) WHERE n = 1)"""
_TRAINING = f"""{_HOURLY}, {_TURBINES}, {_STATUS}, training AS (
  SELECT *, CASE WHEN abnormal_sensor = 'ok' THEN 'ok' ELSE 'faulty' END AS sensor_status
  FROM features JOIN turbines USING (turbine_id) JOIN status USING (turbine_id))"""
_ROUND6 = """round(avg_energy, 6) AS avg_energy, round(std_sensor_value, 6) AS std_sensor_value,
  round(std_sensor_k, 6) AS std_sensor_k"""
_HOURLY_RESULT = f"{_HOURLY} SELECT * REPLACE ({_ROUND6}) FROM features"
_JUDGED = """judged AS (
  SELECT doc_id, lang, n_chars, CASE WHEN quality = 1 THEN 'ok' ELSE 'faulty' END AS real_label
  FROM labels JOIN documents USING (doc_id))"""
_RULE = "CASE WHEN n_chars >= {0} THEN 'ok' ELSE 'faulty' END"


def _counts(predicted: str) -> str:
    def count(real: str, pred: str) -> str:
        return f"count(*) FILTER (WHERE real_label {real} 'ok' AND {predicted} {pred} 'ok')"

    return (f"{count('=', '=')} AS tp, {count('<>', '=')} AS fp, {count('=', '<>')} AS fn, "
            f"{count('<>', '<>')} AS tn")


_F1 = "CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0::DOUBLE * tp / (2 * tp + fp + fn) ELSE 0 END"
_PRECISION = "CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END"
_RECALL = "CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END"


def _median_fill(column: str) -> str:
    return f"round(coalesce({column}, (SELECT quantile_cont({column}, 0.5) FROM gappy)), 6) AS {column}"


def _mode_fill(column: str) -> str:
    return f"""coalesce({column}, (SELECT {column} FROM gappy WHERE {column} IS NOT NULL GROUP BY {column}
      ORDER BY count(*) DESC, {column} LIMIT 1)) AS {column}"""


_GAPPY_LINEITEM = """gappy AS (
  SELECT l_orderkey, l_linenumber, nullif(l_quantity, 25) AS l_quantity,
    CASE WHEN NOT (l_linestatus = 'F' AND l_returnflag = 'A') THEN l_extendedprice END AS l_extendedprice,
    nullif(l_discount, 0.05::DOUBLE) AS l_discount, CASE WHEN l_linestatus <> 'F' THEN l_returnflag END AS l_returnflag,
    CASE WHEN l_linenumber <> 1 THEN l_linestatus END AS l_linestatus
  FROM lineitem)"""
_GAPPY_EVENTS = """gappy AS (
  SELECT event_id, user_id, ts, CASE WHEN event_type NOT IN ('view', 'error') THEN value END AS value,
    CASE WHEN event_type = 'click' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k
  FROM events)"""


def _fill(direction: str) -> str:
    order = "ts, event_id" if direction == "forward" else "ts DESC, event_id DESC"
    frame = f"OVER (PARTITION BY user_id ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""WITH {_GAPPY_EVENTS} SELECT event_id, user_id, ts,
      last_value(value IGNORE NULLS) {frame} AS value, last_value(k IGNORE NULLS) {frame} AS k FROM gappy"""


def _scaled(column: str) -> str:
    return f"""round(({column} - (SELECT avg({column}) FROM lineitem))
      / (SELECT coalesce(nullif(stddev_pop({column}), 0), 1) FROM lineitem), 6) AS {column}"""


_VERSION_1 = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CAST(o_orderpriority[1] AS INTEGER) AS urgency FROM orders"""

_DRIFT = f"""{_READINGS}, long AS (
  SELECT 'energy' AS column_name, energy AS value, ts >= TIMESTAMP '2024-01-16' AS now FROM readings
  UNION ALL SELECT 'sensor_k', sensor_k, ts >= TIMESTAMP '2024-01-16' FROM readings),
numeric_counts AS (
  SELECT column_name, value, count(*) FILTER (WHERE NOT now) AS r, count(*) FILTER (WHERE now) AS c
  FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
running AS (
  SELECT column_name,
    abs(sum(r) OVER w / sum(r) OVER (PARTITION BY column_name)
        - sum(c) OVER w / sum(c) OVER (PARTITION BY column_name)) AS gap,
    lead(value) OVER (PARTITION BY column_name ORDER BY value) - value AS width
  FROM numeric_counts WINDOW w AS (PARTITION BY column_name ORDER BY value)),
numeric_drift AS (
  SELECT column_name, max(gap) AS ks, sum(gap * width) / (
    SELECT stddev_pop(value) FROM long WHERE long.column_name = running.column_name AND NOT now) AS wasserstein
  FROM running GROUP BY column_name),
texts AS (
  SELECT 'event_type' AS column_name, event_type AS value, ts >= TIMESTAMP '2024-01-16' AS now FROM readings
  UNION ALL SELECT 'k_text', CAST(CAST(sensor_k AS INTEGER) AS VARCHAR), ts >= TIMESTAMP '2024-01-16' FROM readings),
text_shares AS (
  SELECT column_name, value,
    count(*) FILTER (WHERE NOT now) / sum(count(*) FILTER (WHERE NOT now)) OVER (PARTITION BY column_name) AS p,
    count(*) FILTER (WHERE now) / sum(count(*) FILTER (WHERE now)) OVER (PARTITION BY column_name) AS q
  FROM texts WHERE value IS NOT NULL GROUP BY 1, 2),
categorical_drift AS (
  SELECT column_name, sqrt(greatest(sum((CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2), 0)) AS js
  FROM text_shares GROUP BY column_name)"""

_PARTS = ", ".join(
    f"coalesce(length({part}) || ':' || {part}, '-')"
    for part in ("CAST(turbine_id AS VARCHAR)", "hour", "location", "model", "state", "text", "content")
)
_CORPUS = f"""WITH {_READINGS}, {_features('monthly', 'month')}, {_TURBINES}, reported AS (
  SELECT turbine_id, strftime(hourly_timestamp, '%Y-%m-%d %H:%M:%S') AS hour,
    coalesce(CAST(CAST(round(std_sensor_k, 4) AS DECIMAL(18, 4)) AS VARCHAR), 'None') || ' ' ||
    coalesce(CAST(CAST(round(std_sensor_value, 4) AS DECIMAL(18, 4)) AS VARCHAR), 'None') AS content,
    std_sensor_k, std_sensor_value, location, model, state, text
  FROM monthly JOIN turbines USING (turbine_id) JOIN documents ON doc_id IN (turbine_id, turbine_id + 1)
  WHERE text IS NOT NULL),
  corpus AS (SELECT DISTINCT turbine_id || '/' || hour || '#' || left(md5(concat_ws(';', {_PARTS})), 16) AS report_id,
    content, std_sensor_k, std_sensor_value, location, model, state, text AS maintenance_report FROM reported)"""

_INFERRED = {
    "json": (("energy", "double"), ("event_type", "string"), ("reading_id", "bigint"), ("sensor_k", "double"),
             ("sensor_value", "double"), ("timestamp", "bigint"), ("turbine_id", "bigint")),
}
_INFERRED["parquet"] = _INFERRED["json"]
_READING_COLUMNS = 'reading_id, turbine_id, "timestamp", energy, sensor_value, sensor_k, event_type'

# Distances are summed within a list, in order: the order of a grouped sum, and so its last bit, would vary from copy
# to copy of a vector.
_KNN = """WITH parts AS (
        SELECT label, unnest(range(1, len(embedding) + 1)) AS i, CAST(unnest(embedding) AS DOUBLE) AS x
        FROM embeddings),
      means AS (SELECT label, i, round(avg(x), 6) AS m FROM parts GROUP BY 1, 2),
      centres AS (SELECT label AS query_id, list(m ORDER BY i) AS centre FROM means GROUP BY label),
      distances AS (SELECT query_id, vec_id, list_sum(list_transform(list_zip(embedding::DOUBLE[], centre),
          lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance FROM embeddings, centres),
      ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER)
        AS rank FROM distances)
      SELECT query_id, vec_id, round(distance, 6) AS distance, rank FROM ranked WHERE rank <= 5"""

_DECIDED = f"""{_HOURLY}, {_TURBINES}, rows AS (
        SELECT CASE WHEN state = 'ASIA' THEN 'faulty' ELSE 'ok' END AS label, ((turbine_id % 2147483648) * 2654435761
          + CAST(floor(epoch(hourly_timestamp) / 3600) AS BIGINT) * 40503) % 4294967296 AS place
        FROM features JOIN turbines USING (turbine_id) WHERE avg_energy IS NOT NULL AND std_sensor_k IS NOT NULL
          AND std_sensor_value IS NOT NULL AND location IS NOT NULL AND model IS NOT NULL AND state IS NOT NULL)"""

ORACLES: dict[str, str] = {
    "q_epoch_to_hour": f"""WITH {_READINGS}
      SELECT reading_id, "timestamp", date_trunc('hour', ts) AS hourly_timestamp FROM readings""",
    "q_hourly_features": _HOURLY_RESULT,
    "q_percentiles": f"""WITH {_READINGS} SELECT date_trunc('day', ts) AS day, event_type, {_percentile_columns()}
      FROM readings GROUP BY 1, 2""",
    "q_coarser_percentiles": f"""WITH {_READINGS}, grains AS (
        SELECT 'day' AS grain, date_trunc('day', ts) AS start, * FROM readings
        UNION ALL SELECT 'month', date_trunc('month', ts), * FROM readings)
      SELECT grain, CAST(start AS TIMESTAMP) AS start, event_type, count(sensor_value) AS n, true AS within, 5 AS shares
      FROM grains GROUP BY 1, 2, 3""",
    "q_training_set": f"{_TRAINING} SELECT * REPLACE ({_ROUND6}) FROM training",
    "q_status_label": """SELECT event_id, abnormal_sensor,
        CASE WHEN abnormal_sensor = 'ok' THEN 'ok' ELSE 'faulty' END AS sensor_status
      FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'sensor_value' WHEN 'view' THEN NULL ELSE 'ok' END
        AS abnormal_sensor FROM events)""",
    "q_latest_per_key": """SELECT user_id, event_id, ts, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
      WHERE n = 1""",
    "q_specifications": f"""{_TRAINING} SELECT turbine_id, hourly_timestamp, {_ROUND6}, location, model, state,
        sensor_status
      FROM (SELECT *, row_number() OVER (PARTITION BY turbine_id ORDER BY hourly_timestamp DESC) AS n FROM training
        WHERE model = 'MACHINERY') WHERE n = 1""",
    "q_feature_select": f"""WITH {_READINGS}
      SELECT date_trunc('day', ts) AS day_ts, turbine_id, round(avg(energy), 8) AS avg_energy,
        round(stddev_pop(sensor_value), 8) AS std_sensor_value, round(stddev_pop(sensor_k), 8) AS std_sensor_k
      FROM readings GROUP BY 1, 2""",
    "q_dropna": f"""WITH {_READINGS} SELECT reading_id, event_type, sensor_k, sensor_value FROM readings
      WHERE event_type <> 'error' AND sensor_k <> 13 AND sensor_value IS NOT NULL""",
    "q_upsert": """WITH fresh AS (
        SELECT * REPLACE (round(o_totalprice + 2, 2) AS o_totalprice) FROM orders
        WHERE o_orderdate >= TIMESTAMP '1998-01-01')
      SELECT * FROM orders o WHERE o_orderdate < TIMESTAMP '1999-01-01' AND NOT EXISTS (
        SELECT 1 FROM fresh f WHERE f.o_orderkey = o.o_orderkey AND f.o_orderdate = o.o_orderdate)
      UNION ALL SELECT * FROM fresh""",
    "q_dedup": """SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (
        PARTITION BY o_custkey, o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n = 1""",
    "q_snapshot_overwrite": _VERSION_1,
    "q_latest_version": "SELECT 0 AS previous, 1 AS latest, count(*) AS n_rows FROM orders",
    "q_time_travel": """SELECT 0::BIGINT AS version, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total
      FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY ALL
      UNION ALL SELECT 1, o_orderstatus, count(*), round(sum(o_totalprice), 2) FROM orders GROUP BY ALL""",
    "q_impute_median": f"""WITH {_GAPPY_LINEITEM} SELECT l_orderkey, l_linenumber, {_median_fill('l_quantity')},
        {_median_fill('l_extendedprice')}, {_median_fill('l_discount')} FROM gappy""",
    "q_impute_mode": f"""WITH {_GAPPY_LINEITEM} SELECT l_orderkey, l_linenumber, {_mode_fill('l_returnflag')},
        {_mode_fill('l_linestatus')} FROM gappy""",
    "q_impute_datetime": """WITH seen AS (
        SELECT event_id, CASE WHEN event_type <> 'view' THEN ts END AS ts FROM events),
      ranked AS (SELECT epoch_us(ts) AS us, row_number() OVER (ORDER BY ts) AS i, count(*) OVER () AS n
        FROM seen WHERE ts IS NOT NULL),
      days AS (SELECT date_trunc('day', ts) AS day FROM seen WHERE ts IS NOT NULL GROUP BY 1
        ORDER BY count(*) DESC, 1 LIMIT 1),
      fills AS (SELECT
        (SELECT make_timestamp(CAST(sum(epoch_us(ts)) // count(ts) AS BIGINT)) FROM seen) AS mean,
        (SELECT make_timestamp(CAST(sum(us) // count(*) AS BIGINT)) FROM ranked
          WHERE i IN ((n + 1) // 2, n // 2 + 1)) AS median)
      SELECT event_id, coalesce(ts, mean) AS by_mean, coalesce(ts, median) AS by_median,
        coalesce(CAST(date_trunc('day', ts) AS TIMESTAMP), CAST(day AS TIMESTAMP)) AS by_mode, ts AS by_none
      FROM seen, fills, days""",
    "q_ffill": _fill("forward"),
    "q_bfill": _fill("backward"),
    "q_standardize": f"""SELECT l_orderkey, l_linenumber, {_scaled('l_quantity')}, {_scaled('l_extendedprice')},
        {_scaled('l_discount')}, {_scaled('l_tax')} FROM lineitem""",
    "q_date_parts": """WITH dated AS (
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS day_of FROM orders)
      SELECT o_orderkey, CAST(year(day_of) AS INTEGER) AS year_ts, CAST(month(day_of) AS INTEGER) AS month_ts,
        CAST(day(day_of) AS INTEGER) AS day_ts, CAST(hour(day_of) AS INTEGER) AS hour_ts,
        CAST(minute(day_of) AS INTEGER) AS minute_ts, CAST(isodow(day_of) - 1 AS INTEGER) AS dayofweek_ts FROM dated""",
    "q_stratified_split": """WITH placed AS (
        SELECT c_custkey, c_mktsegment, ((c_custkey % 2147483648) * 2654435761) % 4294967296 AS place FROM customer)
      SELECT c_custkey, c_mktsegment, CAST(place <= threshold AS INTEGER) AS is_train
      FROM placed JOIN (SELECT c_mktsegment, quantile_disc(place, 0.75) AS threshold FROM placed GROUP BY 1)
        USING (c_mktsegment)""",
    "q_label_encode": """SELECT c_custkey, c_mktsegment,
        CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS code, c_mktsegment AS decoded
      FROM customer""",
    "q_one_hot": """SELECT c_custkey, CAST(c_mktsegment = 'AUTOMOBILE' AS INTEGER) AS is_0,
        CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS is_1, CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS is_2,
        CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS is_3 FROM customer""",
    "q_binary_metrics": f"""WITH {_JUDGED}, counted AS (
        SELECT lang, {_counts(_RULE.format(1000))} FROM judged GROUP BY lang)
      SELECT lang, tp, fp, fn, tn, round({_PRECISION}, 8) AS "precision", round({_RECALL}, 8) AS recall,
        round({_F1}, 8) AS f1 FROM counted""",
    "q_confusion": f"""WITH {_JUDGED} SELECT real_label, {_RULE.format(1000)} AS predicted_label, count(*) AS n
      FROM judged GROUP BY ALL""",
    "q_deploy_gate": f"""WITH {_JUDGED}, counted AS (
        SELECT version, {_counts(_RULE.format('version'))}
        FROM judged, (VALUES (200), (1000), (5000), (500)) v(version) GROUP BY version),
      scored AS (SELECT version, round({_F1}, 8) AS f1 FROM counted),
      best AS (SELECT max(f1) FILTER (WHERE version = 500) AS current, max(f1) FILTER (WHERE version <> 500)
        AS best_prior FROM scored)
      SELECT current, best_prior, CASE WHEN best_prior IS NULL OR current >= best_prior THEN 1 ELSE 0 END AS deploy
      FROM best""",
    "q_metric_sink": f"""WITH {_JUDGED}, counted AS (
        SELECT version, {_counts(_RULE.format('version'))} FROM judged, (VALUES (500), (1000)) v(version)
        GROUP BY version)
      SELECT version, tp, fp, fn, tn, round({_PRECISION}, 8) AS "precision", round({_RECALL}, 8) AS recall,
        round({_F1}, 8) AS f1, 'rule ' || version AS run_id, CAST(version AS INTEGER) AS least_chars, true AS recorded FROM counted""",
    "q_register": f"""WITH {_JUDGED}, counted AS (
        SELECT turn, {_counts(_RULE.format('rule'))}
        FROM judged, (VALUES (1, 5000), (2, 1000), (3, 2000), (4, 500), (5, 100)) v(turn, rule) GROUP BY turn),
      scored AS (SELECT turn, {_F1} AS f1 FROM counted),
      gated AS (SELECT *, max(f1) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
        FROM scored)
      SELECT 'rule' AS name, row_number() OVER (ORDER BY turn) AS version, round(f1, 8) AS f1
      FROM gated WHERE best IS NULL OR f1 >= best""",
    "q_resolve_version": """WITH registry AS (
        SELECT o_orderpriority AS name, CAST(year(o_orderdate) - 1990 AS INTEGER) AS version,
          'model/' || min(o_orderkey) AS source FROM orders GROUP BY 1, 2),
      requests AS (SELECT name, CASE name WHEN '1-URGENT' THEN 7 WHEN '2-HIGH' THEN 99 END AS wanted FROM (
        SELECT o_orderpriority AS name FROM orders UNION SELECT c_mktsegment FROM customer)),
      chosen AS (SELECT q.name, q.wanted, coalesce(
          (SELECT max(version) FROM registry r WHERE r.name = q.name AND r.version = q.wanted),
          (SELECT max(version) FROM registry r WHERE r.name = q.name)) AS version FROM requests q)
      SELECT c.name, c.wanted, c.version, r.source FROM chosen c
      LEFT JOIN registry r ON r.name = c.name AND r.version = c.version""",
    "q_best_trial": f"""WITH {_JUDGED}, counted AS (
        SELECT threshold, {_counts(_RULE.format('threshold'))}
        FROM judged, (SELECT CAST(unnest(range(100, 5001, 100)) AS INTEGER) AS threshold) GROUP BY threshold),
      trials AS (SELECT threshold, -round({_F1}, 8) AS loss FROM counted)
      SELECT threshold, loss FROM trials ORDER BY loss, threshold LIMIT 1""",
    "q_data_summary": f"""WITH {_READINGS}, long AS (
        SELECT 'energy' AS column_name, energy AS v FROM readings
        UNION ALL SELECT 'sensor_k', nullif(sensor_k, 13) FROM readings)
      SELECT column_name, count(*) AS "rows", count(*) - count(v) AS nulls, min(v) AS low, max(v) AS high,
        round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS deviation, quantile_disc(v, 0.25) AS p25,
        quantile_disc(v, 0.5) AS p50, quantile_disc(v, 0.75) AS p75, count(DISTINCT v) AS distinct_values
      FROM long GROUP BY column_name""",
    "q_drift_numeric": f"""WITH {_DRIFT} SELECT column_name, round(ks, 6) AS ks, round(wasserstein, 6) AS wasserstein,
        CAST(wasserstein >= 0.1 AS INTEGER) AS drifted FROM numeric_drift""",
    "q_drift_categorical": f"""WITH {_DRIFT} SELECT column_name, round(js, 6) AS js,
        CAST(js >= 0.1 AS INTEGER) AS drifted FROM categorical_drift""",
    "q_drift_table": f"""WITH {_DRIFT}, flags AS (
        SELECT wasserstein >= 0.1 AS d FROM numeric_drift UNION ALL SELECT js >= 0.1 FROM categorical_drift)
      SELECT count(*) AS columns, count(*) FILTER (WHERE d) AS drifted_columns,
        count(*) FILTER (WHERE d) / count(*) AS share,
        CAST(count(*) FILTER (WHERE d) / count(*) >= 0.5 AS INTEGER) AS drifted FROM flags""",
    "q_knn": _KNN,
    "q_knn_cells": _KNN,
    "q_report_corpus": f"""{_CORPUS} SELECT report_id, content, location, model, state, maintenance_report
      FROM corpus""",
    "q_similar_reports": f"""{_CORPUS}, asked AS (
        SELECT state AS query_id, CAST(round(avg(std_sensor_k), 4) AS DECIMAL(18, 4))::DOUBLE AS k,
          CAST(round(avg(std_sensor_value), 4) AS DECIMAL(18, 4))::DOUBLE AS v
        FROM monthly JOIN turbines USING (turbine_id) GROUP BY state),
      distances AS (SELECT query_id, c.*, (std_sensor_k - k) ** 2 + (std_sensor_value - v) ** 2 AS distance
        FROM asked, corpus c WHERE query_id <> 'ASIA'),
      ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, report_id) AS INTEGER)
        AS rank FROM distances)
      SELECT query_id, CASE WHEN query_id = 'ASIA' THEN 'invalid' ELSE 'ok' END AS status, report_id,
        round(distance, 6) AS distance, rank, content, location, model, state, maintenance_report
      FROM (SELECT query_id FROM asked) LEFT JOIN (SELECT * FROM ranked WHERE rank <= 5) USING (query_id)""",
    "q_extract_numbers": r"""SELECT doc_id, CAST(len(found) AS INTEGER) AS n_numbers,
        array_to_string(found, ' ') AS numbers
      FROM (SELECT doc_id, regexp_extract_all(text, '-?\d+\.\d+(?:[eE][-+]?\d+)?') AS found FROM documents)""",
    "q_split_ids": r"""SELECT conv_id, turn, CAST(position AS INTEGER) AS "position", word FROM (
        SELECT conv_id, turn, unnest(words) AS word, unnest(range(len(words))) AS position
        FROM (SELECT conv_id, turn, list_filter(regexp_split_to_array(text, '[\t-\r\x{1c}-\x{1f}\x{85}\p{Z}]+'),
          lambda w: w <> '') AS words FROM conversations))""",
    "q_parse_requests": """WITH fine AS (SELECT *, l_linenumber NOT IN (5, 6, 7) AS ok FROM lineitem)
      SELECT l_orderkey, l_linenumber, CASE WHEN ok THEN 'ok' ELSE 'invalid' END AS status,
        CASE WHEN ok THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS hourly_timestamp,
        CASE WHEN ok THEN l_extendedprice END AS avg_energy, CASE WHEN ok THEN l_quantity END AS std_sensor_A,
        CASE WHEN ok THEN l_discount END AS std_sensor_B, CASE WHEN ok THEN l_tax END AS std_sensor_C,
        CASE WHEN ok THEN CAST(l_linenumber AS DOUBLE) END AS std_sensor_D,
        CASE WHEN ok THEN CAST(l_suppkey AS DOUBLE) END AS std_sensor_E,
        CASE WHEN ok THEN CAST(l_partkey AS DOUBLE) END AS std_sensor_F,
        CASE WHEN ok THEN l_returnflag END AS location, CASE WHEN ok THEN l_linestatus END AS model,
        CASE WHEN ok AND l_linenumber <> 4 THEN 'North' END AS state FROM fine""",
    "q_rows_of_list": "SELECT * FROM orders WHERE o_custkey IN (1, 7, 11, 13, 14)",
    "q_ingest_list": """SELECT 'parts' AS name, p_partkey AS key, p_brand || ', ' || p_type AS value FROM part
      UNION ALL SELECT 'suppliers', s_suppkey, s_name FROM supplier""",
    "q_narrowed_medians": """WITH kept AS (
        SELECT l_quantity, l_extendedprice, l_discount FROM lineitem WHERE l_orderkey % 7 > 0 AND l_orderkey % 11 > 0),
      long AS (SELECT 'l_quantity' AS column_name, CAST(l_quantity AS DOUBLE) AS v FROM kept UNION ALL
        SELECT 'l_extendedprice', l_extendedprice FROM kept UNION ALL SELECT 'l_discount', l_discount FROM kept),
      medians AS (SELECT column_name, median(v) AS median FROM long GROUP BY 1)
      SELECT column_name, median, count(*) FILTER (WHERE v < median) AS n_below
      FROM long JOIN medians USING (column_name) GROUP BY ALL""",
    "q_ingest_stream": "SELECT * FROM events",
    "q_ingest_json": f"WITH {_READINGS} SELECT {_READING_COLUMNS} FROM readings",
    "q_merge_schema": """SELECT * REPLACE (CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN props END AS props)
      FROM events""",
    "q_schema_infer": f"WITH {_READINGS} " + " UNION ALL ".join(
        f"""SELECT '{fmt}' AS fmt, '{name}' AS column_name, '{kind}' AS data_type, count("{name}") AS n_values
      FROM readings""" for fmt, fields in _INFERRED.items() for name, kind in fields),
    "q_csv_roundtrip": "SELECT * FROM orders",
    "q_stream_hourly": _HOURLY_RESULT,
    "q_stream_append": f"""{_HOURLY} SELECT * REPLACE ({_ROUND6}) FROM features
      WHERE hourly_timestamp + INTERVAL 1 HOUR <= (SELECT make_timestamp(max("timestamp") * 1000000) FROM readings)
        - INTERVAL 3 HOURS""",
    "q_stream_dedup": f"WITH {_READINGS} SELECT {_READING_COLUMNS} FROM readings",
    "q_stream_upsert": _HOURLY_RESULT,
    "q_model_exact": f"""{_DECIDED},
      held AS (SELECT label FROM rows JOIN (SELECT label, quantile_disc(place, 0.75) AS threshold FROM rows GROUP BY 1)
        USING (label) WHERE place > threshold)
      SELECT count(*) FILTER (WHERE label = 'ok') AS tp, 0 AS fp, 0 AS fn, count(*) FILTER (WHERE label = 'faulty') AS tn,
        1.0::DOUBLE AS "precision", 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1 FROM held""",
    "q_search_trials": f"""{_DECIDED},
      thresholds AS (SELECT label, quantile_disc(place, 0.375) AS half, quantile_disc(place, 0.75) AS whole
        FROM rows GROUP BY 1),
      sizes AS (SELECT count(*) FILTER (WHERE place <= half) AS half, count(*) FILTER (WHERE place <= whole) AS whole
        FROM rows JOIN thresholds USING (label))
      SELECT r.round, r.n_trials, CASE r.round WHEN 0 THEN half ELSE whole END AS n_rows, r.n_kept, true AS best_kept
      FROM sizes, (VALUES (0, 4::BIGINT, 2::BIGINT), (1, 2::BIGINT, 1::BIGINT)) r(round, n_trials, n_kept)""",
    "q_stream_late": f"""WITH {_READINGS}, span AS (SELECT min("timestamp") AS low, max("timestamp") AS high FROM readings),
      told AS (SELECT r.*, "timestamp" < low + 86400 AND reading_id % 10 = 0 AS late, "timestamp" = high AS again
        FROM readings r, span),
      hours AS (SELECT date_trunc('hour', ts) AS h, turbine_id, avg(energy) AS e FROM told WHERE NOT late GROUP BY 1, 2)
      SELECT 4 AS n_batches, count(*) + count(*) FILTER (WHERE again) AS n_rows, count(*) FILTER (WHERE late) AS n_late,
        true AS timed, (SELECT count(*) FROM hours) AS n_hours, (SELECT round(sum(e), 4) FROM hours) AS energy FROM told""",
}
ORACLES["q_similar_reports_grown"] = ORACLES["q_similar_reports"]
