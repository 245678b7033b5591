"""Redelivery-safe de-duplication of a telemetry stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from telemetry_engine.operators.dedup import with_point_key


def dedup_stream(telemetry: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The first arrival of every point; a redelivery is dropped however late it comes.

    No watermark: no row is too late, and the result holds the same keys as the
    batch twin in any order of arrival.  The state is the set of keys; start the
    query within ``epochs.state_on_disk`` so that it lives in RocksDB, spread
    over the shuffle partitions, and not on the heap.
    """
    return with_point_key(telemetry).dropDuplicates(keys or ["point_key"])
