"""Unique-key de-duplication of telemetry (batch form)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_engine.functions.scalars import point_key
from telemetry_engine.operators.registry import latest_per_key


def with_point_key(telemetry: DataFrame) -> DataFrame:
    return telemetry.withColumn(
        "point_key", point_key("gpu_uuid", "metric_name", "batch_id", "timestamp")
    )


def dedup_telemetry(telemetry: DataFrame) -> DataFrame:
    """Keep the first stored row per point key (earliest timestamp, then seq).

    A unique index would have refused the later inserts, so the earliest
    survives.  ``dropDuplicates`` would keep an arbitrary row instead.
    """
    keyed = with_point_key(telemetry)
    return latest_per_key(keyed, "point_key", [F.col("timestamp").asc(), F.col("seq").asc()])
