"""Telemetry table (append-only) and device registry (versioned snapshots).

Telemetry layout: parquet partitioned by ``event_date``; every file is
sorted by (gpu_uuid, timestamp), so parquet row-group min/max statistics let
a point lookup skip almost every row group.  Writes are rebalanced by AQE,
which splits a hot date over several tasks instead of one.

Registry: every upsert writes a complete new snapshot directory
``v=<n>``; readers always open the newest complete one, so a reader never
sees a half-written version and nothing is overwritten while being read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_engine.schemas import DEVICE_COLUMNS
from telemetry_engine.sources import fs

# bound each output file (~tens of MB of telemetry rows)
MAX_RECORDS_PER_FILE = 2_000_000


def with_event_date(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.to_date(F.col("timestamp")))


def append_telemetry(df: DataFrame, path: str, num_partitions: int | None = None, mode: str = "append") -> None:
    """Append telemetry rows (empty input is a no-op commit).

    ``rebalance`` by event_date lets AQE size the write tasks: small dates
    are coalesced, a hot date is split into several size-bounded tasks, and
    no sampling pass over the input is needed.  Each task sorts its rows by
    (event_date, gpu_uuid, timestamp), which is also the order the
    partitioned writer needs, so parquet row groups cover narrow uuid ranges.
    ``num_partitions`` forces a fixed count instead (mainly for tests).
    """
    staged = with_event_date(df)
    if num_partitions:
        staged = staged.repartition(num_partitions, "event_date")
    else:
        staged = staged.hint("rebalance", "event_date")
    out = staged.sortWithinPartitions("event_date", "gpu_uuid", "timestamp")
    (
        out.write.mode(mode)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy("event_date")
        .parquet(path)
    )


def read_telemetry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _versions(spark: SparkSession, base: str) -> list[int]:
    out = []
    for name in fs.list_subdirs(spark, base):
        if name.startswith("v=") and fs.exists(spark, f"{base}/{name}/_SUCCESS"):
            out.append(int(name[2:]))
    return sorted(out)


def read_registry(spark: SparkSession, base: str) -> DataFrame | None:
    """Newest complete registry snapshot, or None if none exists."""
    vs = _versions(spark, base)
    if not vs:
        return None
    return spark.read.parquet(f"{base}/v={vs[-1]:08d}").select(*DEVICE_COLUMNS)


def write_registry(devices: DataFrame, base: str) -> int:
    """Write ``devices`` as the next snapshot; returns its version number.

    One writer at a time per registry (the caller serialises upserts).
    """
    spark = devices.sparkSession
    vs = _versions(spark, base)
    v = (vs[-1] + 1) if vs else 1
    devices.select(*DEVICE_COLUMNS).write.mode("overwrite").parquet(f"{base}/v={v:08d}")
    return v


def upsert_registry(spark: SparkSession, updates: DataFrame, base: str, order_col: str | None = "seq") -> int:
    """Apply ``updates`` (last write wins) on top of the newest snapshot."""
    from telemetry_engine.operators.registry import upsert_devices

    current = read_registry(spark, base)
    if current is None:
        current = spark.createDataFrame([], ", ".join(f"{c} string" for c in DEVICE_COLUMNS))
    return write_registry(upsert_devices(current, updates, order_col), base)
