"""CSV record projections and batch stamping."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_engine.functions.pytime import format_rfc3339_nano_py
from telemetry_engine.functions.timeutil import format_rfc3339_nano


def batch_stamp(batch_ts: datetime | None = None) -> tuple[Column, Column]:
    """One (timestamp, batch_id) pair for a whole pass, fixed on the driver.

    Never per-row ``current_timestamp``: every row of a pass must share it.
    """
    ts = batch_ts or datetime.now(timezone.utc).replace(tzinfo=None)
    return F.lit(ts).cast("timestamp_ntz"), F.lit(format_rfc3339_nano_py(ts))


def stamp_batch(df: DataFrame, batch_ts: datetime | Column | None = None, batch_id: Column | None = None) -> DataFrame:
    """Add ``timestamp`` and ``batch_id`` columns shared by the pass."""
    if isinstance(batch_ts, Column):
        ts = batch_ts.cast("timestamp_ntz")
        bid = batch_id if batch_id is not None else format_rfc3339_nano(ts)
    else:
        ts, bid = batch_stamp(batch_ts)
        if batch_id is not None:
            bid = batch_id
    return df.withColumn("timestamp", ts).withColumn("batch_id", bid)


def to_telemetry(records: DataFrame, batch_ts=None, batch_id=None, keep: list[str] | None = None) -> DataFrame:
    """CSV records -> telemetry points; the CSV timestamp is ignored."""
    stamped = stamp_batch(records, batch_ts, batch_id)
    return stamped.select(
        F.col("uuid").alias("gpu_uuid"),
        "metric_name",
        "value",
        "timestamp",
        "batch_id",
        "labels_raw",
        *(keep or []),
    )


def to_devices(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """CSV records -> device rows."""
    return records.select(
        "uuid",
        F.col("device").alias("device_id"),
        F.col("gpu_id").alias("gpu_index"),
        F.col("modelName").alias("model_name"),
        F.col("Hostname").alias("hostname"),
        "container",
        "pod",
        "namespace",
        *(keep or []),
    )


def ingest_stats(scanned: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Per pass: rows read, rows sent (accepted), rows rejected."""
    return scanned.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(F.col("reject_reason").isNull()).alias("rows_sent"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rows_rejected"),
    )
