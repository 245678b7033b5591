"""Batch fetch: a consumer group takes a topic's messages, at most ``prefetch`` at a time.

A group is a stream of its own over the message files.  Its checkpoint is the
group's committed position: every message is fetched once per group, also after
a restart, and groups do not see each other.  Messages are numbered where they
are read, so a micro-batch is cut into batches without a shuffle or a sort; a
task's last batch may be short.  ``max_files`` of the source bounds what one
micro-batch admits.

``out_dir/batches`` holds the messages with their ``batch_id`` and ``consumer_id``;
``out_dir/log`` the fetch rows of a delivery log (``operators.delivery``), to which
the consumers' acks and nacks are added.  Both are valid once the epoch is
committed; a replayed epoch overwrites its own.  Messages without an id are
fetched like others; an epoch without messages of the topic writes empty tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telemetry_engine.operators.ingest import batch_stamp
from telemetry_engine.schemas import PREFETCH_MAX, PREFETCH_MIN
from telemetry_engine.streaming.epochs import commit, epoch_dir, read_epochs

PREFETCH = 500
TASK_BITS = 33  # monotonically_increasing_id: the task's number above, the row's number in it below


def batches_of(messages: DataFrame, prefetch: int, epoch_id: int, consumers: Sequence[str]) -> DataFrame:
    """``messages`` with ``batch_id`` and ``consumer_id``; at most ``prefetch`` (clamped) share a batch."""
    size = max(PREFETCH_MIN, min(PREFETCH_MAX, prefetch))
    task = F.shiftright("_n", TASK_BITS)
    no = F.floor(F.col("_n").bitwiseAND((1 << TASK_BITS) - 1) / size)
    turn = F.pmod(task + no, F.lit(len(consumers))).cast("int")
    return messages.withColumn("_n", F.monotonically_increasing_id()).select(
        *messages.columns, F.format_string("%010d-%06d-%08d", F.lit(epoch_id), task, no).alias("batch_id"),
        F.element_at(F.array(*[F.lit(c) for c in consumers]), turn + 1).alias("consumer_id"))


def fetch_stream(
    messages: DataFrame,
    topic: str,
    consumer_group: str,
    out_dir: str,
    prefetch: int = PREFETCH,
    consumers: Sequence[str] = ("consumer-0",),
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Fetch ``topic`` for ``consumer_group``, the batches dealt to ``consumers`` in turn."""
    if not consumers:
        raise ValueError("a group needs a consumer")

    def process(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        got = batches_of(batch.where(F.col("topic") == topic), prefetch, epoch_id, consumers)
        at = epoch_dir(f"{out_dir}/batches", epoch_id)
        got.write.mode("overwrite").parquet(at)
        stamp, _ = batch_stamp()
        session.read.schema(got.schema).parquet(at).select(
            "topic", F.lit(consumer_group).alias("consumer_group"), "consumer_id", F.col("id").alias("message_id"),
            F.lit("fetch").alias("op"), F.lit(epoch_id).cast("long").alias("seq"), stamp.cast("timestamp_ntz").alias("ts"),
        ).write.mode("overwrite").parquet(epoch_dir(f"{out_dir}/log", epoch_id))
        commit(session, out_dir, epoch_id)

    w = messages.writeStream.foreachBatch(process).option("checkpointLocation", f"{out_dir}/_checkpoints/fetch")
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def fetched(spark: SparkSession, out_dir: str) -> DataFrame:
    """The messages of all committed batches."""
    return read_epochs(spark, f"{out_dir}/batches").drop("epoch")


def fetch_log(spark: SparkSession, out_dir: str) -> DataFrame:
    """The fetch rows of all committed batches."""
    return read_epochs(spark, f"{out_dir}/log").drop("epoch")
