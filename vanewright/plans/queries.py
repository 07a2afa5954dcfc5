"""The registered queries, over the given tables in the roles of ``plans.tables``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewright.functions.columns import columns_named
from vanewright.functions.labels import health_label
from vanewright.functions.text import REQUEST_FIELDS, decimals_in, explode_ids, parse_requests
from vanewright.functions.times import epoch_seconds, hour_of, with_date_parts
from vanewright.operators import drift, metrics, models, retrieval
from vanewright.operators.cells import VectorCells
from vanewright.operators.features import (
    PERCENTILES,
    SKETCH_SIZE,
    hourly_features,
    merged_percentiles,
    sensor_sketches,
    split_percentiles,
)
from vanewright.operators.fills import fill_along_time
from vanewright.operators.keyed import (
    first_per_key,
    latest_per_key,
    latest_specifications,
    merge_rows,
    rows_of,
)
from vanewright.operators.prepare import MedianFill, ModeFill, Scale, TimeFill, complete_rows
from vanewright.operators.quantiles import exact_medians
from vanewright.operators.split import label_codes, one_hot, stratified_split
from vanewright.plans.tables import (
    hourly_training_set,
    judged_documents,
    label_by_length,
    monthly_reports,
    readings,
    streamed_readings,
    table,
    turbines,
)
from vanewright.session import scratch_folder, written
from vanewright.sources import files
from vanewright.sources.landing import (
    LandingTable,
    append_stream,
    infer_schema,
    ingest_all,
    read_merged,
    stream_files,
    table_path,
)
from vanewright.sources.sinks import append_result, read_csv, write_csv
from vanewright.sources.versions import VersionedTable
from vanewright.streaming.hourly import dedup_readings, stream_hourly_features, upsert_stream
from vanewright.streaming.progress import ProgressLog
from vanewright.streaming.upserts import UpsertTable

Query = Callable[[SparkSession, str], DataFrame]

STREAM_FILES = 1_000  # files per micro-batch when a whole table is streamed
LANDED_ROWS = 250_000  # rows of a file, when readings land in parts
FILLED = ("value", "k")
RULES = (5000, 1000, 2000, 500, 100)  # lengths tried as models


def _plain_time(column: str) -> Column:
    return F.col(column).cast("timestamp_ntz").alias(column)


def _plain_times(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[_plain_time(c) if c in columns else F.col(c) for c in df.columns])


def _rounded(df: DataFrame, digits: int, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _hourly_result(features: DataFrame, digits: int = 6) -> DataFrame:
    flat = _plain_times(split_percentiles(features), "hourly_timestamp")
    return _rounded(flat, digits, columns_named(flat, prefix="std_", names=["avg_energy"]))


# Scalars, projections, filters


def epoch_to_hour(spark, folder):
    rows = readings(spark, folder)
    return _plain_times(
        rows.select("reading_id", "timestamp", hour_of(F.col("timestamp")).alias("hourly_timestamp")),
        "hourly_timestamp",
    )


def status_label(spark, folder):
    sensor = F.when(F.col("event_type") == "error", "sensor_value").when(F.col("event_type") != "view", "ok")
    rows = table(spark, folder, "events").select("event_id", sensor.alias("abnormal_sensor"))
    return rows.withColumn("sensor_status", health_label(F.col("abnormal_sensor")))


def feature_select(spark, folder):
    daily = hourly_features(readings(spark, folder), grain="day", time_column="day_ts")
    chosen = columns_named(daily, prefix="std_", suffix="_ts", names=["avg_energy", "turbine_id"])
    return _rounded(
        _plain_times(daily.select(*chosen), "day_ts"), 8, columns_named(daily, prefix="std_", names=["avg_energy"])
    )


def dropna(spark, folder):
    rows = readings(spark, folder).select(
        "reading_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.nullif(F.col("sensor_k"), F.lit(13.0)).alias("sensor_k"),
        "sensor_value",
    )
    return complete_rows(rows)


def date_parts(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "not a date").otherwise(F.col("o_orderdate").cast("string")).alias("at"),
    )
    return with_date_parts(rows, "at", "all")


def extract_numbers(spark, folder):
    found = decimals_in(F.col("text"))
    return table(spark, folder, "documents").select(
        "doc_id", F.size(found).alias("n_numbers"), F.array_join(found, " ").alias("numbers")
    )


def split_ids(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return explode_ids(rows, "text", "word")


def _request_texts(spark, folder):
    """Request texts made of line items: whole ones, some with an item missing, some empty, some plain text."""
    items = [F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")] + [
        F.col(c).cast("decimal(18,2)").cast("string")
        for c in ("l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_linenumber", "l_suppkey", "l_partkey")
    ]
    head = F.concat(F.lit("['"), items[0], F.lit("', "), F.concat_ws(", ", *items[1:]))
    tail = F.concat(F.lit(", '"), F.col("l_returnflag"), F.lit("', '"), F.col("l_linestatus"), F.lit("'"))
    number = F.col("l_linenumber")
    text = (
        F.when(number == 7, F.concat(head, tail, F.lit("]")))
        .when(number == 6, F.lit("[]"))
        .when(number == 5, F.concat(F.lit("please predict "), items[0]))
        .when(number == 4, F.concat(head, tail, F.lit(", None]")))
        .otherwise(F.concat(head, tail, F.lit(", 'North']")))
    )
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", text.alias("request"))


def requests_parsed(spark, folder):
    parsed = parse_requests(_request_texts(spark, folder), "request")
    return parsed.select("l_orderkey", "l_linenumber", "status", *[name for name, _ in REQUEST_FIELDS])


# Features, joins, keys


def hourly(spark, folder):
    return _hourly_result(hourly_features(readings(spark, folder)))


def percentiles(spark, folder):
    daily = hourly_features(readings(spark, folder), keys=["event_type"], grain="day", time_column="day")
    flat = split_percentiles(daily)
    return _plain_times(flat.select("day", "event_type", *[c for c in flat.columns if c.startswith("p")]), "day")


def coarser_percentiles(spark, folder):
    """Percentiles of days and months from stored hourly sketches alone, and whether the share of readings below each
    is as near to what was asked for as twice the error that the sketch has 99 of 100 times."""
    rows = readings(spark, folder)
    stored = written(sensor_sketches(rows, ["event_type"]), "sketches")
    found = None
    for grain in ("day", "month"):
        one = merged_percentiles(stored, grain, ["event_type"]).select(
            F.lit(grain).alias("grain"), F.col("hourly_timestamp").alias("start"), "event_type",
            F.col("count_sensor_value").alias("n"), F.col("percentiles_sensor_value").alias("found"),
        )
        found = one if found is None else found.unionByName(one)
    asked = F.array(*[F.lit(float(p)) for p in PERCENTILES])
    placed = found.select("*", F.explode(F.arrays_zip(asked.alias("share"), F.col("found").alias("value"))).alias("p"))
    of = rows.select(F.col("event_type").alias("type"), hour_of(F.col("timestamp")).alias("hour"), "sensor_value")
    own = (F.col("event_type") == F.col("type")) & (F.col("start") == F.expr("date_trunc(grain, hour)"))
    value, error = F.col("p.value"), 4.6 / SKETCH_SIZE ** 0.9
    ranks = placed.join(of, own).groupBy("grain", "start", "event_type", "n", "p").agg(
        F.avg((F.col("sensor_value") < value).cast("int")).alias("below"),
        F.avg((F.col("sensor_value") <= value).cast("int")).alias("up_to"),
    )
    near = (F.col("below") - error <= F.col("p.share")) & (F.col("p.share") <= F.col("up_to") + error)
    result = ranks.groupBy("grain", "start", "event_type", "n").agg(F.min(near).alias("within"), F.count("*").alias("shares"))
    return _plain_times(result, "start")


def training(spark, folder):
    return _hourly_result(hourly_training_set(spark, folder))


def latest(spark, folder):
    rows = latest_per_key(table(spark, folder, "events"), ["user_id"], "ts", ["event_id"])
    return rows.select("user_id", "event_id", "ts", "event_type", "value")


def specifications(spark, folder):
    wanted = turbines(spark, folder).filter(F.col("model") == "MACHINERY")
    columns = [
        "turbine_id", "hourly_timestamp", "avg_energy", "std_sensor_k", "std_sensor_value", "location", "model",
        "state", "sensor_status",
    ]
    return _hourly_result(latest_specifications(hourly_training_set(spark, folder, wanted), wanted, columns))


def rows_of_list(spark, folder):
    """A short list of customers: the filter reaches the scan."""
    return rows_of(table(spark, folder, "orders"), "o_custkey", [1, 7, 11, 13, 14])


def _order_batches(spark, folder):
    """Orders up to 1998, and changed orders from 1998 on, each delivered twice."""
    orders = table(spark, folder, "orders")
    target = orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    fresh = orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    twice = fresh.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    return target, twice.withColumn("o_totalprice", F.round(F.col("o_totalprice") + F.col("delivery"), 2))


def upsert(spark, folder):
    target, source = _order_batches(spark, folder)
    keys = ["o_orderkey", "o_orderdate"]
    return merge_rows(target, first_per_key(source, keys, [F.col("delivery").desc()]).drop("delivery"), keys)


def dedup(spark, folder):
    """One order per customer and state: the dearest, then the lowest number."""
    return first_per_key(
        table(spark, folder, "orders"), ["o_custkey", "o_orderstatus"],
        [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()],
    )


# Versions and files


def _versioned_orders(spark, folder) -> VersionedTable:
    """Two versions: orders before 1998, then all orders with a column more and the priority replaced."""
    orders = table(spark, folder, "orders")
    versions = VersionedTable(spark, scratch_folder(spark, "versions"))
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    versions.write(orders.filter(F.col("o_orderdate") < cut))
    both = versions.read().unionByName(orders.filter(F.col("o_orderdate") >= cut))
    versions.write(
        both.withColumn("urgency", F.substring("o_orderpriority", 1, 1).cast("int")).drop("o_orderpriority")
    )
    return versions


def snapshot_overwrite(spark, folder):
    return _versioned_orders(spark, folder).read()


def latest_version(spark, folder):
    versions = _versioned_orders(spark, folder)
    previous, newest = versions.previous_and_latest()
    rows = versions.read(newest).agg(F.count("*").alias("n_rows"))
    return rows.select(F.lit(previous).alias("previous"), F.lit(newest).alias("latest"), "n_rows")


def time_travel(spark, folder):
    versions = _versioned_orders(spark, folder)
    previous, newest = versions.previous_and_latest()

    def counted(version):
        return versions.read(version).groupBy("o_orderstatus").agg(
            F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"),
        ).withColumn("version", F.lit(version).cast("bigint"))

    return counted(previous).unionByName(counted(newest))


def csv_roundtrip(spark, folder):
    orders = table(spark, folder, "orders")
    path = scratch_folder(spark, "csv")
    write_csv(orders, path)
    return read_csv(spark, path, orders.schema)


def ingest_stream(spark, folder):
    schema = table(spark, folder, "events").schema
    stream = stream_files(spark, f"{folder}/event[s].parquet", "parquet", schema, STREAM_FILES)
    lake = scratch_folder(spark, "bronze")
    append_stream(stream, f"{lake}/events", f"{lake}/checkpoint").awaitTermination()
    return spark.read.schema(schema).parquet(f"{lake}/events")


def _landed_json(spark, folder) -> tuple[str, DataFrame]:
    rows = readings(spark, folder)
    path = scratch_folder(spark, "landing")
    rows.write.json(path)
    return path, rows


def ingest_json(spark, folder):
    path, rows = _landed_json(spark, folder)
    lake = scratch_folder(spark, "bronze")
    stream = stream_files(spark, path, "json", rows.schema, STREAM_FILES)
    append_stream(stream, f"{lake}/readings", f"{lake}/checkpoint").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{lake}/readings")


def ingest_list(spark, folder):
    """Two tables ingested side by side, parts as JSON with an array column. One more file of parts follows; the second
    run takes in that one and nothing twice."""
    landing, lake, checkpoints = (scratch_folder(spark, name) for name in ("landing", "bronze", "checkpoints"))
    parts = table(spark, folder, "part").select("p_partkey", "p_size", F.array("p_brand", "p_type").alias("sensors"))
    old = F.col("p_partkey") % 3 > 0
    parts.filter(old).write.json(f"{landing}/parts")
    table(spark, folder, "supplier").write.parquet(f"{landing}/suppliers")
    tables = [LandingTable("parts", "json", schema=parts.schema, max_files=1), LandingTable("suppliers", "parquet")]
    ingest_all(spark, landing, lake, checkpoints, tables)
    parts.filter(~old).write.mode("append").json(f"{landing}/parts")
    ingest_all(spark, landing, lake, checkpoints, tables)
    suppliers = spark.read.parquet(table_path(lake, "suppliers"))
    return spark.read.parquet(table_path(lake, "parts")).select(
        F.lit("parts").alias("name"), F.col("p_partkey").alias("key"), F.array_join("sensors", ", ").alias("value")
    ).union(suppliers.select(F.lit("suppliers"), "s_suppkey", "s_name"))


def merge_schema(spark, folder):
    """Bronze files of two ages: the older ones lack the properties."""
    events = table(spark, folder, "events")
    path = scratch_folder(spark, "bronze")
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    events.filter(F.col("ts") < half).drop("props").write.parquet(path)
    events.filter(F.col("ts") >= half).write.mode("append").parquet(path)
    return read_merged(spark, path)


def schema_infer(spark, folder):
    """Inferred columns of the readings landed as JSON and as parquet, with how many values each file set holds."""
    json_path, rows = _landed_json(spark, folder)
    parquet_path = scratch_folder(spark, "landing")
    rows.write.parquet(parquet_path)
    results = []
    for fmt, path in (("json", json_path), ("parquet", parquet_path)):
        schema = infer_schema(spark, path, fmt)
        landed = spark.read.format(fmt).schema(schema).load(path)
        counts = landed.agg(*[F.count(c).alias(c) for c in landed.columns])
        described = F.array(*[
            F.struct(
                F.lit(fmt).alias("fmt"), F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f.name).alias("n_values"),
            )
            for f in schema.fields
        ])
        results.append(counts.select(F.inline(described)))
    return results[0].unionByName(results[1])


# Preparation


def _gappy_lineitem(spark, folder):
    gap = F.col("l_linestatus") == "F"
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_quantity", F.lit(25.0)).alias("l_quantity"),
        F.when(~(gap & (F.col("l_returnflag") == "A")), F.col("l_extendedprice")).alias("l_extendedprice"),
        F.nullif("l_discount", F.lit(0.05)).alias("l_discount"),
        F.when(~gap, F.col("l_returnflag")).alias("l_returnflag"),
        F.when(F.col("l_linenumber") != 1, F.col("l_linestatus")).alias("l_linestatus"),
    )


def impute_median(spark, folder):
    numbers = ["l_quantity", "l_extendedprice", "l_discount"]
    rows = _gappy_lineitem(spark, folder).select("l_orderkey", "l_linenumber", *numbers)
    return _rounded(MedianFill(columns=numbers).fit(rows).transform(rows), 6, numbers)


def narrowed_medians(spark, folder):
    """Medians of columns with missing and not-a-number values, found by narrowing at any size."""
    numbers = ["l_quantity", "l_extendedprice", "l_discount"]
    rows = table(spark, folder, "lineitem").select(*[
        F.when(F.col("l_orderkey") % 7 == 0, F.lit(float("nan"))).when(F.col("l_orderkey") % 11 > 0, F.col(c)).alias(c)
        for c in numbers
    ])
    medians = exact_medians(rows, numbers, exact_rows=1000)
    return rows.agg(*[F.count_if(F.col(c) < medians[c]).alias(c) for c in numbers]).unpivot(
        [], numbers, "column_name", "n_below"
    ).withColumn("median", F.element_at(F.create_map(*[F.lit(x) for c in numbers for x in (c, medians[c])]), F.col("column_name")))


def impute_mode(spark, folder):
    texts = ["l_returnflag", "l_linestatus"]
    rows = _gappy_lineitem(spark, folder).select("l_orderkey", "l_linenumber", *texts)
    return ModeFill(columns=texts).fit(rows).transform(rows)


def impute_datetime(spark, folder):
    seen = F.when(F.col("event_type") != "view", F.col("ts"))
    rows = table(spark, folder, "events").select(
        "event_id", seen.alias("by_mean"), seen.alias("by_median"),
        F.when(F.col("event_type") != "view", F.date_trunc("day", "ts").cast("timestamp_ntz")).alias("by_mode"),
        seen.alias("by_none"),
    )
    for strategy in ("mean", "median", "mode", "none"):
        rows = TimeFill(columns=[f"by_{strategy}"], strategy=strategy).fit(rows).transform(rows)
    return rows


def _gappy_events(spark, folder):
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").select(
        "event_id", "user_id", "ts",
        F.when(~F.col("event_type").isin("view", "error"), F.col("value")).alias("value"),
        F.when(F.col("event_type") == "click", k).alias("k"),
    )


def ffill(spark, folder):
    return fill_along_time(_gappy_events(spark, folder), ["user_id"], "ts", FILLED, "forward", ["event_id"])


def bfill(spark, folder):
    return fill_along_time(_gappy_events(spark, folder), ["user_id"], "ts", FILLED, "backward", ["event_id"])


def standardize(spark, folder):
    numbers = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *numbers)
    return _rounded(Scale(columns=numbers).fit(rows).transform(rows), 6, numbers)


def split(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    # Multiplicative hashing within 63 bits.
    place = (F.col("c_custkey") % 2147483648 * F.lit(2654435761)) % F.lit(4294967296)
    rows = stratified_split(customers, "c_mktsegment", place)
    return rows.withColumn("is_train", F.col("is_train").cast("int"))


def label_encode(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    coded = label_codes(customers, "c_mktsegment", "code", "decoded").transform(customers)
    return coded.withColumn("code", F.col("code").cast("int"))


def one_hot_encode(spark, folder):
    """Categories learnt from all segments but one, which is then unknown."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    fitted = one_hot(["c_mktsegment"]).fit(customers.filter(F.col("c_mktsegment") != "MACHINERY"))
    coded = fitted.transform(customers).withColumn("bits", vector_to_array("c_mktsegment_vec"))
    width = len(fitted.stages[0].labelsArray[0])
    return coded.select("c_custkey", *[F.get("bits", F.lit(i)).cast("int").alias(f"is_{i}") for i in range(width)])


# Quality, versions of models, drift


def binary_quality(spark, folder):
    judged = judged_documents(spark, folder).withColumn("predicted_label", label_by_length(1000))
    result = metrics.binary_metrics(judged, "real_label", "predicted_label", groups=["lang"])
    return _rounded(result, 8, ["precision", "recall", "f1"])


def confusion(spark, folder):
    judged = judged_documents(spark, folder).withColumn("predicted_label", label_by_length(1000))
    return metrics.confusion(judged, "real_label", "predicted_label")


def _rule_scores(judged: DataFrame, name: str, thresholds: list[int]) -> DataFrame:
    """Quality of one length rule per threshold, all in one pass."""
    rules = judged.withColumn(name, F.explode(F.array(*[F.lit(t) for t in thresholds])))
    predicted = rules.withColumn("predicted_label", label_by_length(F.col(name)))
    return metrics.binary_metrics(predicted, "real_label", "predicted_label", groups=[name])


def deploy(spark, folder):
    """A new rule against three whose predictions are stored."""
    judged = judged_documents(spark, folder)
    store = models.PredictionStore(spark, scratch_folder(spark, "predictions"), ["doc_id"])
    for version in (200, 1000, 5000):
        store.add("rule", version, judged.withColumn("predicted_label", label_by_length(version)))
    gate = metrics.deploy_gate(store.scores("rule", judged, "real_label"), _rule_scores(judged, "version", [500]))
    return _rounded(gate, 8, ["current", "best_prior"])


def metric_sink(spark, folder):
    """Scores of two rules added to one result table: each row with its run, its rule and when it was recorded."""
    judged, path = judged_documents(spark, folder), scratch_folder(spark, "scores")
    begun = spark.range(1).select(F.current_timestamp()).first()[0]
    for threshold in (500, 1000):
        known = {"run_id": F.lit(f"rule {threshold}"), "least_chars": F.lit(threshold)}
        append_result(_rule_scores(judged, "version", [threshold]).withColumns(known), path)
    recorded = F.col("recorded_at").between(F.lit(begun), F.current_timestamp())
    kept = spark.read.parquet(path).withColumn("recorded", recorded).drop("recorded_at")
    return _rounded(kept, 8, ["precision", "recall", "f1"])


def register(spark, folder):
    """Five rules offered one after the other; each is registered unless a registered one is better."""
    judged = judged_documents(spark, folder)
    model = label_codes(judged, "real_label", "code")
    registry = models.ModelRegistry(spark, scratch_folder(spark, "registry"))
    offered = {r["version"]: r["f1"] for r in _rule_scores(judged, "version", list(RULES)).collect()}
    for threshold in RULES:
        current = spark.createDataFrame([(offered[threshold],)], "f1 double")
        decision = metrics.deploy_gate(registry.versions(), current).first()
        registry.register("rule", model, decision["current"], decision["deploy"])
    return _rounded(registry.versions().select("name", "version", "f1"), 8, ["f1"])


def best_trial(spark, folder):
    scores = _rule_scores(judged_documents(spark, folder), "threshold", list(range(100, 5001, 100)))
    trials = scores.select("threshold", (-F.round("f1", 8)).alias("loss"))
    return metrics.best_trial(trials, ties=["threshold"])


def version_choice(spark, folder):
    """Versions per order priority (one per year). Segments are asked for too, but have no versions."""
    orders = table(spark, folder, "orders")
    registry = orders.groupBy(
        F.col("o_orderpriority").alias("name"), (F.year("o_orderdate") - 1990).alias("version")
    ).agg(F.concat(F.lit("model/"), F.min("o_orderkey").cast("string")).alias("source"))
    wanted = F.when(F.col("name") == "1-URGENT", 7).when(F.col("name") == "2-HIGH", 99)
    names = orders.select(F.col("o_orderpriority").alias("name")).unionByName(
        table(spark, folder, "customer").select(F.col("c_mktsegment").alias("name"))
    ).distinct()
    return metrics.resolve_versions(registry, names.withColumn("wanted", wanted))


def summary(spark, folder):
    rows = readings(spark, folder).select(
        F.col("energy"), F.nullif("sensor_k", F.lit(13.0)).alias("sensor_k")
    )
    return _rounded(drift.summarize(rows, ["energy", "sensor_k"]), 6, ["mean", "deviation"])


def _halves(spark, folder):
    rows = readings(spark, folder)
    half = epoch_seconds(F.lit("2024-01-16").cast("timestamp_ntz"))
    return rows.filter(F.col("timestamp") < half), rows.filter(F.col("timestamp") >= half)


def drift_numeric(spark, folder):
    result = drift.numeric_drift(*_halves(spark, folder), ["energy", "sensor_k"])
    return _rounded(result, 6, ["ks", "wasserstein"]).withColumn("drifted", F.col("drifted").cast("int"))


def _texts(df: DataFrame) -> DataFrame:
    return df.withColumn("k_text", F.col("sensor_k").cast("int").cast("string"))


def drift_categorical(spark, folder):
    before, after = map(_texts, _halves(spark, folder))
    result = drift.categorical_drift(before, after, ["event_type", "k_text"])
    return _rounded(result, 6, ["js"]).withColumn("drifted", F.col("drifted").cast("int"))


def drift_table(spark, folder):
    before, after = map(_texts, _halves(spark, folder))
    result = drift.table_drift(
        drift.numeric_drift(before, after, ["energy", "sensor_k"]),
        drift.categorical_drift(before, after, ["event_type", "k_text"]),
    )
    return result.withColumn("drifted", F.col("drifted").cast("int"))


# Retrieval


def _corpus(spark, folder):
    return retrieval.report_corpus(
        monthly_reports(spark, folder), "maintenance_report", ["location", "model", "state"],
        ["turbine_id", "hourly_timestamp"], lambda c: F.round(c, 4).cast("decimal(18,4)").cast("string"),
    )


def report_corpus(spark, folder):
    return _corpus(spark, folder).drop("vector")


def _requests(spark, folder) -> DataFrame:
    """One request per state with its mean readings; one state sends none."""
    units = hourly_features(readings(spark, folder), grain="month").join(turbines(spark, folder), "turbine_id")
    means = [F.round(F.avg(c), 4).cast("decimal(18,4)").cast("string") for c in ("std_sensor_k", "std_sensor_value")]
    text = F.concat(F.lit("readings "), means[0], F.lit(" and "), means[1])
    return units.groupBy(F.col("state").alias("query_id")).agg(text.alias("request")).withColumn(
        "request", F.when(F.col("query_id") == "ASIA", "no readings, sorry").otherwise(F.col("request"))
    )


def similar_reports(spark, folder):
    stored = written(_corpus(spark, folder), "corpus")
    found = retrieval.similar_reports(stored, _requests(spark, folder), "request")
    return _rounded(found, 6, ["distance"])


def similar_reports_grown(spark, folder):
    """The same from an index that a stream fed in three steps, the last of which brings old reports again."""
    landed = scratch_folder(spark, "reports")
    stored = written(_corpus(spark, folder), "corpus")
    part = F.pmod(F.xxhash64("report_id"), F.lit(3))
    a_step = max(1, -(-stored.count() // LANDED_ROWS))
    for step in (part == 0, part == 1, part != 0):
        _land(stored.where(step), landed, a_step)
    index = VectorCells(spark, scratch_folder(spark, "report-cells"), cell_rows=500)
    reports = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", a_step).parquet(landed)
    index.follow(reports, scratch_folder(spark, "report-checkpoint")).awaitTermination()
    corpus = index.rows().drop("cell", "centre_distance")
    found = retrieval.similar_reports(corpus, _requests(spark, folder), "request", search=index.search)
    return _rounded(found, 6, ["distance"])


def _vectors_and_centres(spark, folder):
    """All vectors, and the centre of each label to search for."""
    vectors = table(spark, folder, "embeddings")
    centres = vectors.groupBy(F.col("label").alias("query_id")).agg(
        vector_to_array(Summarizer.mean(array_to_vector("embedding"))).alias("mean")
    ).select("query_id", F.transform("mean", lambda x: F.round(x, 6)).alias("vector"))
    return vectors.select("vec_id", F.col("embedding").alias("vector")), centres


def knn(spark, folder):
    found = retrieval.nearest(*_vectors_and_centres(spark, folder), 5, "vec_id", "query_id")
    return _rounded(found, 6, ["distance"])


def knn_cells(spark, folder):
    vectors, centres = _vectors_and_centres(spark, folder)
    index = VectorCells(spark, scratch_folder(spark, "cells"), "vec_id")
    index.build(vectors, cells=16)
    return _rounded(index.search(centres, 5, "query_id"), 6, ["distance"])


# Streams


def _hourly_table(spark, stream: DataFrame) -> UpsertTable:
    root = scratch_folder(spark, "silver")
    features = stream_hourly_features(stream)
    silver = UpsertTable(spark, root, ["hourly_timestamp", "turbine_id"], features.schema)
    upsert_stream(features, silver, f"{root}/checkpoint").awaitTermination()
    return silver


def stream_hourly(spark, folder):
    return _hourly_result(_hourly_table(spark, streamed_readings(spark, folder)).read())


def stream_append(spark, folder):
    """Hours that are over by the watermark, written once each."""
    lake = scratch_folder(spark, "finished")
    features = stream_hourly_features(streamed_readings(spark, folder))
    append_stream(features, f"{lake}/hours", f"{lake}/checkpoint").awaitTermination()
    return _hourly_result(spark.read.schema(features.schema).parquet(f"{lake}/hours"))


def _delivered_twice(stream: DataFrame) -> DataFrame:
    return stream.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2)))).drop("delivery")


def stream_dedup(spark, folder):
    lake = scratch_folder(spark, "bronze")
    stream = dedup_readings(_delivered_twice(streamed_readings(spark, folder)), ["reading_id"]).drop("event_time")
    append_stream(stream, f"{lake}/readings", f"{lake}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{lake}/readings")


def _land(rows: DataFrame, path: str, n_files: int) -> None:
    """Write rows as so many files more, empty ones among them: a task without rows writes none."""
    def landed() -> int:
        return sum(name.endswith(".parquet") for name in files.names(rows.sparkSession, path))

    wanted = landed() + n_files
    rows.repartition(n_files).write.mode("append").parquet(path)
    while landed() < wanted:
        rows.limit(0).coalesce(1).write.mode("append").parquet(path)


def _landed_in_parts(spark, folder, parts: int = 4) -> DataFrame:
    """The readings as a stream of parts that follow each other in time, one part a micro-batch. The hours at the
    borders are in two of them. Every part has the same number of files, and a micro-batch takes so many: files of one
    part span the same time, so of two micro-batches that shared them the second would come too late."""
    path, rows = scratch_folder(spark, "landing"), readings(spark, folder)
    counted = rows.agg(F.count("*"), F.percentile_approx("timestamp", [i / parts for i in range(1, parts)])).first()
    place = sum((F.col("timestamp") > b).cast("int") for b in counted[1] or [0])
    a_part = max(1, -(-counted[0] // (parts * LANDED_ROWS)))
    for part in range(parts):
        _land(rows.filter(place == part), path, a_part)
    return stream_files(spark, path, "parquet", rows.schema, a_part)


def stream_upsert(spark, folder):
    """De-duplicated, aggregated, upserted file by file, compacted on the way and by the next stream, which has a new
    checkpoint and meets all files again: still the batch result."""
    root = scratch_folder(spark, "silver")
    features = stream_hourly_features(dedup_readings(_delivered_twice(_landed_in_parts(spark, folder)), ["reading_id"]))
    day = F.to_date("hourly_timestamp")
    silver = UpsertTable(spark, root, ["hourly_timestamp", "turbine_id"], features.schema, bucket=day)
    for checkpoint in ("first", "second"):
        upsert_stream(
            features, silver, f"{root}/{checkpoint}", compact_every=3, grouped=True, count_state=False
        ).awaitTermination()
    return _hourly_result(silver.read())


def stream_late(spark, folder):
    """Readings up to the middle of all time, then the others, then the very last ones again; of the first day every
    tenth reading comes last of all, and is dropped and counted by the progress table."""
    landed, rows = scratch_folder(spark, "landed"), written(readings(spark, folder), "readings")
    first, last = rows.agg(F.min("timestamp"), F.max("timestamp")).first()
    late = (F.col("timestamp") < first + 86_400) & (F.col("reading_id") % 10 == 0)
    middle = F.col("timestamp") <= (first + last) // 2
    for part in (~late & middle, ~late & ~middle, F.col("timestamp") == last, late):
        rows.where(part).coalesce(1).write.mode("append").parquet(landed)
    stream = stream_files(spark, landed, "parquet", rows.schema, 1)
    root = scratch_folder(spark, "late")
    features = stream_hourly_features(dedup_readings(stream, ["reading_id"]))
    silver = UpsertTable(spark, f"{root}/silver", ["hourly_timestamp", "turbine_id"], features.schema)
    with ProgressLog(spark, f"{root}/progress") as log:
        log.wait(upsert_stream(features, silver, f"{root}/checkpoint"))
    hours, energy = silver.read().agg(F.count("*"), F.round(F.sum("avg_energy"), 4)).first()
    return log.table().where("input_rows > 0").agg(
        F.count("*").alias("n_batches"), F.sum("input_rows").alias("n_rows"), F.sum("late_rows").alias("n_late"),
        F.min(F.col("duration_ms") > 0).alias("timed"), F.lit(hours).alias("n_hours"), F.lit(energy).alias("energy"),
    )


# Models


def _stored_training_set(spark, folder) -> DataFrame:
    versions = VersionedTable(spark, scratch_folder(spark, "training"))
    rows = hourly_training_set(spark, folder).select(
        "turbine_id", "hourly_timestamp", "avg_energy", "std_sensor_k", "std_sensor_value", "location", "model",
        "state", "sensor_status",
    )
    versions.write(complete_rows(rows))
    return versions.read()


def _train_and_test(spark, folder):
    place = F.xxhash64("turbine_id", "hourly_timestamp")
    placed = stratified_split(_stored_training_set(spark, folder), "sensor_status", place)
    return [placed.filter(side).drop("is_train") for side in (F.col("is_train"), ~F.col("is_train"))]


def model_fit(spark, folder):
    train, test = _train_and_test(spark, folder)
    model = models.fit_model(train, forest=models.classifier(trees=20, depth=8))
    return metrics.binary_metrics(models.score(model, test), "sensor_status", "predicted_label")


def _decided_labels(spark, folder):
    """Training rows whose label a unit's state decides, and an arithmetic hash of unit and hour."""
    rows = _stored_training_set(spark, folder).withColumn(
        "sensor_status", F.when(F.col("state") == "ASIA", "faulty").otherwise("ok")
    )
    hours = F.floor(F.unix_seconds("hourly_timestamp") / 3600)
    return rows, ((F.col("turbine_id") % 2147483648) * 2654435761 + hours * 40503) % 4294967296


def model_exact(spark, folder):
    """A forest of the default size on labels that a unit's state decides, measured on a quarter held out per label by an
    arithmetic hash of unit and hour: whatever breaks in preparation, fit or decoding shows as a wrong row."""
    rows, place = _decided_labels(spark, folder)
    placed = written(stratified_split(rows, "sensor_status", place), "split")
    model = models.fit_model(placed.where("is_train").drop("is_train"))
    scored = models.score(model, placed.where("NOT is_train"))
    return metrics.binary_metrics(scored, "sensor_status", "predicted_label")


def batch_score(spark, folder):
    train, test = _train_and_test(spark, folder)
    model = models.fit_model(train, forest=models.classifier(trees=20, depth=8))
    scored = models.score(model, test).withColumnRenamed("sensor_status", "real_label")
    path = scratch_folder(spark, "predictions")
    write_csv(scored, path)
    return _plain_times(read_csv(spark, path, scored.schema), "hourly_timestamp")


def search_trials(spark, folder):
    """The rounds of a search over those four points of the operator's own grid that have the fewest trees, on labels
    that a unit's state decides: how many trials and rows each round had, and whether it kept the best."""
    rows, place = _decided_labels(spark, folder)
    forest = models.classifier()
    grid = sorted(models.search_grid(forest), key=lambda point: point[forest.numTrees])[:4]
    _, trials = models.search(rows, grid=grid, forest=forest, place=place)
    return trials.groupBy("round").agg(
        F.count("*").alias("n_trials"), F.max("rows").alias("n_rows"), F.count_if("kept").alias("n_kept"),
        (F.max(F.when(F.col("kept"), F.col("loss"))) <= F.min(F.when(~F.col("kept"), F.col("loss")))).alias("best_kept"),
    )


QUERIES: dict[str, Query] = {
    "q_epoch_to_hour": epoch_to_hour,
    "q_hourly_features": hourly,
    "q_percentiles": percentiles,
    "q_coarser_percentiles": coarser_percentiles,
    "q_training_set": training,
    "q_status_label": status_label,
    "q_latest_per_key": latest,
    "q_specifications": specifications,
    "q_feature_select": feature_select,
    "q_dropna": dropna,
    "q_upsert": upsert,
    "q_dedup": dedup,
    "q_snapshot_overwrite": snapshot_overwrite,
    "q_latest_version": latest_version,
    "q_time_travel": time_travel,
    "q_impute_median": impute_median,
    "q_impute_mode": impute_mode,
    "q_impute_datetime": impute_datetime,
    "q_ffill": ffill,
    "q_bfill": bfill,
    "q_standardize": standardize,
    "q_narrowed_medians": narrowed_medians,
    "q_rows_of_list": rows_of_list,
    "q_ingest_list": ingest_list,
    "q_date_parts": date_parts,
    "q_stratified_split": split,
    "q_label_encode": label_encode,
    "q_one_hot": one_hot_encode,
    "q_binary_metrics": binary_quality,
    "q_confusion": confusion,
    "q_deploy_gate": deploy,
    "q_metric_sink": metric_sink,
    "q_register": register,
    "q_resolve_version": version_choice,
    "q_best_trial": best_trial,
    "q_data_summary": summary,
    "q_drift_numeric": drift_numeric,
    "q_drift_categorical": drift_categorical,
    "q_drift_table": drift_table,
    "q_knn": knn,
    "q_knn_cells": knn_cells,
    "q_report_corpus": report_corpus,
    "q_similar_reports": similar_reports,
    "q_similar_reports_grown": similar_reports_grown,
    "q_extract_numbers": extract_numbers,
    "q_split_ids": split_ids,
    "q_parse_requests": requests_parsed,
    "q_ingest_stream": ingest_stream,
    "q_ingest_json": ingest_json,
    "q_merge_schema": merge_schema,
    "q_schema_infer": schema_infer,
    "q_csv_roundtrip": csv_roundtrip,
    "q_stream_hourly": stream_hourly,
    "q_stream_append": stream_append,
    "q_stream_dedup": stream_dedup,
    "q_stream_upsert": stream_upsert,
    "q_stream_late": stream_late,
    "q_model_fit": model_fit,
    "q_model_exact": model_exact,
    "q_batch_score": batch_score,
    "q_search_trials": search_trials,
}
