"""Telemetry messages: encode, decode, validate, extract devices, count.

A message is a row (id, topic, payload JSON text, headers map, timestamp,
metadata JSON text).  The fields of interest are parsed as VARIANT, so their
*types* can be checked like a strict decoder does: a number where text is
expected makes the payload undecodable, and a non-text metadata value is
treated as absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_engine.functions.scalars import empty_to_null
from telemetry_engine.functions.timeutil import format_rfc3339_nano, parse_rfc3339
from telemetry_engine.schemas import DEFAULT_TOPIC, METADATA_KEYS

PAYLOAD_FIELDS = ["gpu_uuid", "metric_name", "value", "timestamp", "batch_id", "labels_raw"]
ZERO_TIME = "0001-01-01 00:00:00"


def encode_messages(
    records: DataFrame,
    batch_ts: Column,
    batch_id: Column,
    instance_id: Column | None = None,
    message_id: Column | None = None,
    topic: str = DEFAULT_TOPIC,
    keep: list[str] | None = None,
) -> DataFrame:
    """CSV records -> messages carrying the point as payload plus device metadata.

    Empty batch_id / labels_raw are omitted from the payload; metadata keys
    are written in sorted order with every value kept, even when empty.
    """
    ts = batch_ts.cast("timestamp_ntz")
    payload = F.to_json(
        F.struct(
            F.col("uuid").alias("gpu_uuid"),
            F.col("metric_name"),
            F.col("value"),
            format_rfc3339_nano(ts).alias("timestamp"),
            empty_to_null(batch_id).alias("batch_id"),
            empty_to_null(F.col("labels_raw")).alias("labels_raw"),
        )
    )
    meta_src = {
        "hostname": "Hostname", "device": "device", "gpu_index": "gpu_id",
        "model_name": "modelName", "container": "container", "pod": "pod",
        "namespace": "namespace",
    }
    metadata = F.to_json(F.struct(*[F.col(meta_src[k]).alias(k) for k in sorted(METADATA_KEYS)]))
    headers = F.create_map(
        F.lit("instance_id"), instance_id if instance_id is not None else F.lit(""),
        F.lit("gpu_uuid"), F.col("uuid"),
        F.lit("metric_name"), F.col("metric_name"),
        F.lit("batch_id"), batch_id,
    )
    return records.select(
        (message_id if message_id is not None else F.expr("uuid()")).alias("id"),
        F.lit(topic).alias("topic"),
        payload.alias("payload"),
        headers.alias("headers"),
        ts.alias("timestamp"),
        metadata.alias("metadata"),
        *(keep or []),
    )


def _parse_once(df: DataFrame, column: str, names: list[str], prefix: str) -> DataFrame:
    """Parse JSON text once per row into ``<prefix>_bad`` and ``<prefix>_val``.

    ``_val``: the named fields of the JSON object itself, as text where they
    are JSON text, else null.  ``_bad``: the text is no JSON object, or some of
    the fields are neither text, null nor absent.  Each field is asked for its
    own type, so what lies deeper or beside it has no say; of a repeated key
    the last counts.  The values are produced by a generator (``inline`` of a
    one-element array): filters on them cannot be pushed below it, so Catalyst
    never re-inlines the parse into each predicate.
    """
    schema = "struct<" + ", ".join(f"{n}: variant" for n in names) + ", _broken: string>"
    text = F.col(column)
    parsed = df.select("*", F.inline(F.array(F.struct(
        F.from_json(text, schema, {"columnNameOfCorruptRecord": "_broken"}).alias(f"{prefix}_raw")))))
    raw = lambda n: F.col(f"{prefix}_raw.{n}")
    kind = {n: F.schema_of_variant(raw(n)) for n in names}
    wrong = [~F.coalesce(kind[n].isin("STRING", "VOID"), F.lit(True)) for n in names]
    # one object and nothing after it
    whole = (text.rlike(r"\A\s*\{") & raw("_broken").isNull()
             & (F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1))
    values = F.struct(
        (~F.coalesce(whole, F.lit(False)) | F.array_contains(F.array(*wrong), True)).alias(f"{prefix}_bad"),
        F.struct(*[F.when(kind[n] == "STRING", F.try_variant_get(raw(n), "$", "string")).alias(n) for n in names])
        .alias(f"{prefix}_val"),
    )
    return parsed.select("*", F.inline(F.array(values))).drop(f"{prefix}_raw")


def _parse_folded(df: DataFrame, column: str, names: list[str], prefix: str) -> DataFrame:
    """``_parse_once`` with keys matched without regard to case, as a struct decoder matches them.

    All of the object's keys are read in order.  Of those that name one field, in
    whatever case, the last text counts, a null changes nothing, and one of
    another type makes the payload undecodable.
    """
    text = F.col(column)
    entries = F.map_entries(F.from_json(text, "map<string, variant>"))
    kind = lambda e: F.schema_of_variant(e["value"])
    named = F.filter(entries, lambda e: F.lower(F.upper(e["key"])).isin(*names))
    read = F.transform(named, lambda e: F.struct(
        F.lower(F.upper(e["key"])).alias("name"), kind(e).alias("kind"),
        F.when(kind(e) == "STRING", F.try_variant_get(e["value"], "$", "string")).alias("text")))
    parsed = df.select("*", F.inline(F.array(F.struct(read.alias(f"{prefix}_read")))))
    fields = F.col(f"{prefix}_read")
    # one object and nothing after it
    whole = (text.rlike(r"\A\s*\{") & fields.isNotNull()
             & (F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1))
    wrong = F.exists(fields, lambda e: ~e["kind"].isin("STRING", "VOID"))
    last = lambda n: F.try_element_at(
        F.filter(fields, lambda e: (e["name"] == n) & e["text"].isNotNull()), F.lit(-1))["text"]
    values = F.struct(
        (~F.coalesce(whole, F.lit(False)) | F.coalesce(wrong, F.lit(True))).alias(f"{prefix}_bad"),
        F.struct(*[last(n).alias(n) for n in names]).alias(f"{prefix}_val"))
    return parsed.select("*", F.inline(F.array(values))).drop(f"{prefix}_read")


def decode_messages(messages: DataFrame) -> DataFrame:
    """Decode payloads and validate the points.

    Adds the six payload fields ('' when absent), ``timestamp`` parsed to
    timestamp_ntz (null when absent or the zero time), and ``reject_reason``:
    bad_json, missing_uuid, missing_metric, missing_timestamp, or null.
    """
    df = _parse_folded(messages, "payload", PAYLOAD_FIELDS, "_pl")
    ts_text = F.col("_pl_val.timestamp")
    df = df.withColumn("_ts", parse_rfc3339(ts_text))
    bad = F.col("_pl_bad") | (ts_text.isNotNull() & F.col("_ts").isNull())
    df = df.withColumn("_bad", bad)
    out = {
        f: F.when(~F.col("_bad"), F.coalesce(F.col(f"_pl_val.{f}"), F.lit("")))
        for f in PAYLOAD_FIELDS if f != "timestamp"
    }
    # the zero time means "not set": surfaced as null
    ts = F.when(~F.col("_bad") & (F.col("_ts") != F.lit(ZERO_TIME).cast("timestamp_ntz")), F.col("_ts"))
    df = df.select(
        *[c for c in messages.columns if c != "timestamp"],
        F.col("timestamp").alias("message_timestamp"),
        *[e.alias(f) for f, e in out.items()],
        ts.alias("timestamp"),
        "_bad",
    )
    return with_validation(df).drop("_bad")


def with_validation(points: DataFrame) -> DataFrame:
    """First failing rule wins: uuid, then metric name, then timestamp."""
    reason = (
        F.when(F.col("_bad"), F.lit("bad_json"))
        .when(F.col("gpu_uuid") == "", F.lit("missing_uuid"))
        .when(F.col("metric_name") == "", F.lit("missing_metric"))
        .when(
            F.col("timestamp").isNull() | (F.col("timestamp") == F.lit(ZERO_TIME).cast("timestamp_ntz")),
            F.lit("missing_timestamp"),
        )
    )
    return points.withColumn("reject_reason", reason)


def message_devices(decoded: DataFrame) -> DataFrame:
    """Device rows from valid messages: uuid from the payload, the seven
    metadata fields only when they are JSON text ('' otherwise or when the
    metadata is missing)."""
    keys = ["device", "gpu_index", "model_name", "hostname", "container", "pod", "namespace"]
    out_name = {"device": "device_id"}
    m = _parse_once(decoded.where(F.col("reject_reason").isNull()), "metadata", keys, "_md")
    cols = [
        F.coalesce(F.col(f"_md_val.{k}"), F.lit("")).alias(out_name.get(k, k))
        for k in keys
    ]
    return m.select(
        F.col("gpu_uuid").alias("uuid"), *cols, *[c for c in ["seq"] if c in decoded.columns]
    )


def collector_stats(decoded: DataFrame) -> DataFrame:
    """processed / errors / gpus_stored / telemetry_stored over decoded messages."""
    ok = F.col("reject_reason").isNull()
    return decoded.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(~ok).alias("errors"),
        F.count_if(ok).alias("gpus_stored"),
        F.count_if(ok).alias("telemetry_stored"),
    )


def telemetry_of(decoded: DataFrame) -> DataFrame:
    """Valid decoded messages -> telemetry rows."""
    keep = [c for c in ["seq"] if c in decoded.columns]
    return decoded.where(F.col("reject_reason").isNull()).select(*PAYLOAD_FIELDS, *keep)
