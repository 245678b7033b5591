"""Derive the engine's domain tables from the driver's test tables.

The driver ships TPC-H-like tables plus ``events``.  These adapters map them
onto the telemetry data model (see FIXTURES.md §3) with plain projections and
joins, so every derived table grows with its source.  Defects needed by the
reject paths are injected by data-driven rules, never by sampling rows away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_engine.functions.timeutil import format_hour, format_micros


TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def gpu_uuid_of(id_col: Column | str) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.format_string("GPU-%08x-0000-0000-0000-%012x", c, c)


def hour_batch_id(ts: Column | str) -> Column:
    return format_hour(ts)


def _labels(props: Column) -> Column:
    return F.concat(F.lit('k="'), F.get_json_object(props, "$.k"), F.lit('"'))


def telemetry_from_events(events: DataFrame) -> DataFrame:
    """events -> telemetry(gpu_uuid, metric_name, value, timestamp, batch_id, labels_raw, seq)."""
    return events.select(
        gpu_uuid_of("user_id").alias("gpu_uuid"),
        F.col("event_type").alias("metric_name"),
        F.col("value").cast("string").alias("value"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        hour_batch_id("ts").alias("batch_id"),
        _labels(F.col("props")).alias("labels_raw"),
        F.col("event_id").alias("seq"),
    )


def devices_from_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """customer (+ nation name as namespace) -> device registry rows."""
    nat = nation.select(F.col("n_nationkey"), F.col("n_name"))
    slot = F.col("c_custkey") % 8
    return customer.join(nat, customer.c_nationkey == nat.n_nationkey, "left").select(
        gpu_uuid_of("c_custkey").alias("uuid"),
        F.concat(F.lit("nvidia"), slot.cast("string")).alias("device_id"),
        slot.cast("string").alias("gpu_index"),
        F.col("c_mktsegment").alias("model_name"),
        F.col("c_name").alias("hostname"),
        F.lit("").alias("container"),
        F.lit("").alias("pod"),
        F.coalesce(F.col("n_name"), F.lit("")).alias("namespace"),
    )


def csv_records_from_events(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """events joined to their customer -> the 12 text columns of a metrics CSV, plus seq."""
    nat = nation.select("n_nationkey", "n_name")
    cust = customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey").join(
        nat, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    slot = F.col("user_id") % 8
    return events.join(cust, events.user_id == cust.c_custkey, "left").select(
        format_micros("ts").alias("timestamp"),
        F.col("event_type").alias("metric_name"),
        slot.cast("string").alias("gpu_id"),
        F.concat(F.lit("nvidia"), slot.cast("string")).alias("device"),
        gpu_uuid_of("user_id").alias("uuid"),
        F.coalesce("c_mktsegment", F.lit("")).alias("modelName"),
        F.coalesce("c_name", F.lit("")).alias("Hostname"),
        F.lit("").alias("container"),
        F.lit("").alias("pod"),
        F.coalesce("n_name", F.lit("")).alias("namespace"),
        F.col("value").cast("string").alias("value"),
        _labels(F.col("props")).alias("labels_raw"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
    )


def messages_from_events(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Telemetry messages as a producer would have published them, with defects.

    Defect rules (data driven): error events with value >= 300 carry a
    truncated payload (undecodable); click events with value < 1 lost their
    uuid; signup events with value >= 300 carry the zero time; click events with
    value >= 300 carry further, nested fields; purchase events with value >= 300
    repeat a key (the last counts); signup events with value < 100 write a key in
    capitals and a longer fraction of the time; view events with value >= 200 repeat
    a key in another case.  In the metadata, view events with value < 10
    give gpu_index as a number, purchase events with value < 10 a numeric device
    beside a nested text one.  One batch per hour of ``ts``; the message is
    stamped with its event time.
    """
    from telemetry_engine.operators.messages import encode_messages

    recs = csv_records_from_events(events, customer, nation)
    recs = recs.withColumn(
        "uuid", F.when((F.col("metric_name") == "click") & (F.col("value").cast("double") < 1), F.lit("")).otherwise(F.col("uuid"))
    )
    msgs = encode_messages(
        recs,
        batch_ts=F.col("ts"),
        batch_id=hour_batch_id("ts"),
        instance_id=F.lit("streamer-0"),
        message_id=F.col("seq").cast("string"),
        keep=["seq", F.col("metric_name").alias("_mt"), F.col("value").cast("double").alias("_val")],
    )
    v, mt = F.col("_val"), F.col("_mt")
    zero_time = F.regexp_replace(
        "payload", r'"timestamp":"[^"]*"', '"timestamp":"0001-01-01T00:00:00Z"'
    )
    payload = (
        F.when((mt == "error") & (v >= 300), F.substring("payload", 1, 40))
        .when((mt == "signup") & (v >= 300), zero_time)
        .when((mt == "click") & (v >= 300), F.regexp_replace("payload", r"\}$", ',"extra":{"value":1,"gpu_uuid":2}}'))
        .when((mt == "purchase") & (v >= 300), F.regexp_replace("payload", r"^\{", '{"value":"0",'))
        .when((mt == "signup") & (v < 100), F.replace(
            F.regexp_replace("payload", r'(\.[0-9]+)Z"', '$10000000000123Z"'), F.lit('"gpu_uuid"'), F.lit('"GPU_UUID"')))
        .when((mt == "view") & (v >= 200), F.regexp_replace("payload", r"^\{", '{"Gpu_Uuid":"x","VALUE":null,'))
        .otherwise(F.col("payload"))
    )
    numeric_index = F.regexp_replace("metadata", r'"gpu_index":"([0-9]+)"', '"gpu_index":$1')
    nested_device = F.regexp_replace("metadata", r'"device":"nvidia([0-9]+)"', '"device":$1,"x":{"device":"a"}')
    metadata = (F.when((mt == "view") & (v < 10), numeric_index)
                .when((mt == "purchase") & (v < 10), nested_device).otherwise(F.col("metadata")))
    return msgs.withColumns({"payload": payload, "metadata": metadata}).drop("_mt", "_val")


DELIVERY_OPS = {"signup": "publish", "click": "fetch", "view": "fetch", "purchase": "ack", "error": "nack"}
DELIVERY_TOPICS = ["telemetry", "alerts", "audit"]


def delivery_log_from_events(events: DataFrame) -> DataFrame:
    """Every event as a delivery event: the topic by user, ``audit`` with a second group that never fetches."""
    op = F.lit(None).cast("string")
    for k, v in DELIVERY_OPS.items():
        op = F.when(F.col("event_type") == k, F.lit(v)).otherwise(op)
    topic = F.element_at(F.array(*map(F.lit, DELIVERY_TOPICS)), (F.col("user_id") % 3 + 1).cast("int"))
    idle = (F.col("user_id") % 3 == 2) & F.col("event_type").isin("signup", "error")
    return events.select(
        topic.alias("topic"),
        F.when(idle, F.lit("archivers")).otherwise(F.lit("collectors")).alias("consumer_group"),
        F.concat(F.lit("consumer-"), (F.col("event_id") % 4).cast("string")).alias("consumer_id"),
        # one message per user and day
        F.concat(F.col("user_id").cast("string"), F.lit(":"), F.col("ts").cast("date").cast("string")).alias("message_id"),
        op.alias("op"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_id").alias("seq"),
    )


def routing_messages_from_events(events: DataFrame) -> DataFrame:
    """One message per event; the topic is the event type."""
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("topic"),
        F.col("value"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
    )


# Fixed subscription table: 'error' has no subscriber.
SUBSCRIPTIONS = [
    ("click", "sub-a"), ("click", "sub-b"),
    ("view", "sub-a"),
    ("purchase", "sub-a"), ("purchase", "sub-b"), ("purchase", "sub-c"),
    ("signup", "sub-b"),
]


def subscriptions(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{t}', '{s}')" for t, s in SUBSCRIPTIONS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS subscriptions(topic, subscriber_id)")  # of known size


def history_requests_from_customers(customer: DataFrame) -> DataFrame:
    """One history request per customer, covering every validation outcome.

    uuid: nation 24 -> missing, 23 -> malformed, 22 -> well formed but unknown,
           12 -> a line feed at the end.
    start: AUTOMOBILE -> none, nation 21 -> garbage, 15 -> bare date, 11 -> a line feed at the end,
           14 -> +02:00 offset, else 2024-01-(1 + nation % 10) at hour custkey % 24.
    end:   FURNITURE -> none, nation 20 -> month 13, 19 -> before any start,
           else start day + 1 + custkey % 7 at 12:00.
    limit: HOUSEHOLD -> none, nation 18 -> 'abc', 17 -> 0, 16 -> 10001,
           13 -> 10000, 10 -> a line feed at the end, else 1 + custkey % 7.
    """
    k, n, seg = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment")
    day_s = F.lit(1) + n % 10
    uuid = (
        F.when(n == 24, F.lit(""))
        .when(n == 23, F.concat(F.lit("gpu-"), F.col("c_name")))
        .when(n == 22, gpu_uuid_of(k + F.lit(1000000000)))
        .when(n == 12, F.concat(gpu_uuid_of(k), F.lit("\n")))
        .otherwise(gpu_uuid_of(k))
    )
    start = (
        F.when(seg == "AUTOMOBILE", F.lit(""))
        .when(n == 21, F.lit("invalid"))
        .when(n == 15, F.lit("2024-01-05"))
        .when(n == 11, F.lit("2024-01-05T00:00:00Z\n"))
        .when(n == 14, F.format_string("2024-01-%02dT%02d:00:00+02:00", day_s, k % 24))
        .otherwise(F.format_string("2024-01-%02dT%02d:00:00Z", day_s, k % 24))
    )
    end = (
        F.when(seg == "FURNITURE", F.lit(""))
        .when(n == 20, F.lit("2024-13-01T00:00:00Z"))
        .when(n == 19, F.lit("2023-12-01T00:00:00Z"))
        .otherwise(F.format_string("2024-01-%02dT12:00:00Z", day_s + 1 + k % 7))
    )
    limit = (
        F.when(seg == "HOUSEHOLD", F.lit(""))
        .when(n == 18, F.lit("abc"))
        .when(n == 17, F.lit("0"))
        .when(n == 16, F.lit("10001"))
        .when(n == 13, F.lit("10000"))
        .when(n == 10, F.lit("5\n"))
        .otherwise((F.lit(1) + k % 7).cast("string"))
    )
    return customer.select(
        k.alias("request_id"), uuid.alias("uuid"), start.alias("start_time"),
        end.alias("end_time"), limit.alias("limit"),
    )

