"""Output of ``foreachBatch`` streams: one directory per table and epoch, valid once its epoch is committed.

Layout: ``<out>/<table>/epoch=<n>`` and ``<out>/_committed/<n>``.  The marker is
written last, after every table of the epoch, so a reader never sees an epoch
that is being written or written again; a replayed epoch overwrites its own
directories.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from telemetry_engine.sources import fs

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def epoch_dir(base: str, epoch_id: int) -> str:
    return f"{base}/epoch={epoch_id:010d}"


def commit(spark: SparkSession, out_dir: str, epoch_id: int) -> None:
    fs.write_text(spark, f"{out_dir}/_committed/{epoch_id:010d}", "")


def is_committed(spark: SparkSession, out_dir: str, epoch_id: int) -> bool:
    return fs.exists(spark, f"{out_dir}/_committed/{epoch_id:010d}")


def committed(spark: SparkSession, out_dir: str) -> list[int]:
    return sorted(int(n) for n in fs.list_names(spark, f"{out_dir}/_committed") if n.isdigit())


def epoch_paths(spark: SparkSession, base: str) -> list[str]:
    """The directories of a table that belong to committed epochs."""
    out_dir = base.rsplit("/", 1)[0]
    there = set(fs.list_subdirs(spark, base))
    return [p for p in (epoch_dir(base, e) for e in committed(spark, out_dir)) if p.rsplit("/", 1)[-1] in there]


def read_epochs(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    """All committed epochs of the table at ``base`` (the ``epoch`` column is the partition)."""
    paths = epoch_paths(spark, base)
    if not paths:
        raise ValueError(f"no committed epoch under {base}")
    return spark.read.format(fmt).option("basePath", base).load(paths)


@contextmanager
def state_on_disk(spark: SparkSession):
    """Streams started inside keep their state in RocksDB; the session's own setting comes back after."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
