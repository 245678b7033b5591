"""Device registry: last-write-wins upsert, listing, lookup, existence sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetry_engine.schemas import DEVICE_COLUMNS


def latest_per_key(df: DataFrame, key: str, order: list) -> DataFrame:
    """Keep the first row per ``key`` under ``order`` (a total order).

    ``row_number() = 1`` plans a partial WindowGroupLimit before the shuffle,
    so every map task forwards at most one row per key: a key that owns a
    third of the input costs no more shuffle than any other key.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def upsert_devices(current: DataFrame, updates: DataFrame, order_col: str | None = "seq") -> DataFrame:
    """New registry version: ``updates`` replace whole rows of ``current``.

    Every field is set from the winning update (a blank value overwrites).
    Among updates of one uuid the greatest ``order_col`` wins; remaining
    ties fall back to the row contents so the result is deterministic.
    ``current`` is a registry (one row per uuid).

    The updates are cut to the latest per uuid; the registry is anti-joined
    against their uuids, broadcast by Spark where they are small.
    """
    from telemetry_engine.session import materialize

    ordv = F.col(order_col).cast("long") if order_col else F.lit(None).cast("long")
    upd = updates.select(*DEVICE_COLUMNS, ordv.alias("_ord"))
    order = [F.col("_ord").desc_nulls_last()] + [F.col(c).desc() for c in DEVICE_COLUMNS[1:]]
    # used by the anti join and the union: compute once
    latest = materialize(latest_per_key(upd, "uuid", order).select(*DEVICE_COLUMNS))
    changed = latest.select(F.col("uuid").alias("_changed"))
    keep = current.select(*DEVICE_COLUMNS)
    keep = keep.join(changed, keep.uuid == changed._changed, "left_anti")
    return keep.unionByName(latest)


def list_devices(devices: DataFrame, telemetry: DataFrame | None = None) -> DataFrame:
    """Whole registry; with ``telemetry`` only devices that have telemetry."""
    out = devices.select(*DEVICE_COLUMNS)
    if telemetry is not None:
        out = devices_with_telemetry(out, telemetry)
    return out


def devices_with_telemetry(devices: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Left-semi join: the registry side is never multiplied.

    Telemetry uuids are de-duplicated first; the partial (map-side)
    aggregate forwards at most one row per uuid per task, so a device that
    owns a large share of telemetry does not skew the join.
    """
    t = telemetry.select(F.col("gpu_uuid")).distinct()
    return devices.join(t, devices.uuid == t.gpu_uuid, "left_semi").select(*DEVICE_COLUMNS)


def get_device(devices: DataFrame, uuid: str) -> DataFrame:
    """Point lookup (0 or 1 row on a registry)."""
    return devices.where(F.col("uuid") == uuid).select(*DEVICE_COLUMNS)


def unknown_devices(uuids: DataFrame, devices: DataFrame, column: str = "uuid") -> DataFrame:
    """Distinct non-empty ``column`` values of ``uuids`` absent from the registry.

    De-duplicates before the anti join so the join sees one row per uuid.
    """
    u = uuids.select(F.col(column).alias("uuid")).where(F.col("uuid") != "").distinct()
    d = devices.select(F.col("uuid").alias("_known"))
    return u.join(d, u.uuid == d._known, "left_anti")


def counts(telemetry: DataFrame, devices: DataFrame) -> DataFrame:
    """Row counts of both stores, one row per store (no join)."""
    t = telemetry.agg(F.count(F.lit(1)).alias("n")).select(F.lit("telemetry").alias("store"), "n")
    d = devices.agg(F.count(F.lit(1)).alias("n")).select(F.lit("devices").alias("store"), "n")
    return t.unionByName(d)


def device_keys(devices: DataFrame) -> DataFrame:
    from telemetry_engine.functions.scalars import device_key

    return devices.select("uuid", device_key("hostname", "device_id").alias("device_key"))
