"""Session construction and the shared scratch folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(a DFS/object-store path every executor can reach).  We only invent one when
the setting is absent *and* Spark runs in local mode (tests, laptops).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # reliable checkpoints (bulk history's validated requests) are removed
    # once their datasets are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # state of streams on local disks with changelog checkpoints, not on the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # parquet written by this engine is sorted by (gpu_uuid, timestamp) inside
    # each event_date partition, so row-group min/max stats prune point lookups
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(
    app: str = "telemetry_engine",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``shuffle_partitions`` should be sized to the data: roughly
    total_shuffle_bytes / 128 MiB on a cluster; AQE coalesces the rest.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(shuffle_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized to the largest expected shuffle.

    Shuffle partitions start at shuffle_bytes / 256 MiB (AQE then coalesces
    small ones and splits skewed ones at run time); scan splits stay at
    256 MiB so a task's input fits comfortably in executor memory.  Most plans here shuffle far less than they scan (partial
    aggregates, broadcast request sides), so size from the shuffle, not the
    input.
    """
    parts = max(200, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
    }


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by driver and executors, taken from ``spark.checkpoint.dir``.

    Sets a private one only when unset and the master is local.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster needs a shared folder "
            "(DFS or object store) for checkpoints and engine tables"
        )
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir().rstrip("/")


def pickle_by_value(module: str) -> None:
    """Send a module's functions and classes to the tasks by value.

    Python processes that Spark starts (executors, and the driver-side runner of
    stateful processors) may not have this package on their path.
    """
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[module])


def materialize(df):
    """Compute ``df`` once into a reliable checkpoint in the shared folder.

    For results used several times (a size check, a broadcast side, a union
    branch): the lineage is cut and later uses read the checkpoint files.  The
    temporary persist lets the checkpoint's write job reuse the first
    computation instead of running the plan twice.
    """
    shared_dir(df.sparkSession)
    pending = df.persist()
    out = pending.checkpoint(eager=True)
    pending.unpersist()
    return out
