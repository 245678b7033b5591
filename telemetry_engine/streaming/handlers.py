"""Message handlers as an extension point of the stream.

A handler is a function of a pandas DataFrame of messages.  It runs inside the
tasks, on up to ``batch_rows`` messages at a time, and either raises (some
message of the batch failed), or returns nothing (all are done), or returns one
error text per message, None where there is none.  A batch that raises is
halved until the messages that fail stand alone, so one of them costs a few
more calls and no other message its outcome; a message may be handled more than
once, as with any redelivery.

Each epoch's messages, and those that the epoch before left failed, become rows
of a delivery log (``operators.delivery``): a fetch, then an ack or a nack.
Failed messages are redelivered with every epoch until they succeed; with
``max_deliveries`` they become dead letters after as many.  The handlers run once
per epoch: their outcomes are written first, and all that follows is derived
from the written ones.  An epoch is valid once committed; a replayed one
overwrites its own directories, so nothing is acknowledged twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from telemetry_engine.operators.ingest import batch_stamp
from telemetry_engine.session import pickle_by_value
from telemetry_engine.sources import fs
from telemetry_engine.streaming.epochs import commit, committed, epoch_dir, epoch_paths, read_epochs

Handler = Callable[[pd.DataFrame], "Sequence[str | None] | None"]
BATCH_ROWS = 1000


def outcomes_of(handler: Handler, messages: pd.DataFrame) -> list[str | None]:
    """One error text or None per message; a batch that raises is halved."""
    if not len(messages):
        return []
    try:
        errors = handler(messages)
        if errors is None:
            return [None] * len(messages)
        errors = [None if e is None else str(e) for e in errors]
        if len(errors) != len(messages):
            raise ValueError(f"handler gave {len(errors)} outcomes for {len(messages)} messages")
        return errors
    except Exception as e:  # noqa: BLE001 - any failure is an outcome
        if len(messages) == 1:
            return [f"{type(e).__name__}: {e}"]
        half = len(messages) // 2
        return outcomes_of(handler, messages.iloc[:half]) + outcomes_of(handler, messages.iloc[half:])


def handled(messages: DataFrame, handler: Handler, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """``messages`` with ``error``: what the handler made of each, null where it succeeded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, batch_rows):
                part = b.slice(a, batch_rows)
                errors = outcomes_of(handler, part.to_pandas())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(errors, pa.string())], [*part.schema.names, "error"])

    pickle_by_value(__name__)
    schema = T.StructType([*messages.drop("error").schema.fields, T.StructField("error", T.StringType())])
    return messages.drop("error").mapInArrow(run, schema)


def process_stream(
    messages: DataFrame,
    handler: Handler,
    out_dir: str,
    consumer_group: str = "default",
    consumer_id: str = "consumer-0",
    max_deliveries: int | None = None,
    batch_rows: int = BATCH_ROWS,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Run ``handler`` over a stream of messages (id, topic and any other columns).

    ``out_dir/log``: fetch, ack and nack rows; ``out_dir/failed``: the messages that the next epoch redelivers;
    ``out_dir/dead_letters``; ``out_dir/stats``: delivered, errors.  The handler also sees ``deliveries``,
    the number of times that a message has been delivered, this one included.
    """

    def process(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        work = batch.withColumn("deliveries", F.lit(1).cast("long"))
        back = _failed_before(session, out_dir, epoch_id)
        if back is not None:
            work = work.unionByName(back.withColumn("deliveries", F.col("deliveries") + 1), allowMissingColumns=True)
        ok = F.col("error").isNull()
        # a message that succeeded leaves its key only
        keep = [c for c in work.columns if c not in ("id", "topic", "deliveries")]
        done = handled(work, handler, batch_rows).select(
            "id", "topic", "deliveries", "error", *[F.when(~ok, F.col(c)).alias(c) for c in keep])
        at = epoch_dir(f"{out_dir}/outcomes", epoch_id)
        done.write.mode("overwrite").parquet(at)
        done = session.read.schema(done.schema).parquet(at)

        stamp, _ = batch_stamp()
        log_rows(done, epoch_id, stamp, consumer_group, consumer_id).write.mode("overwrite").parquet(
            epoch_dir(f"{out_dir}/log", epoch_id))
        spent = F.lit(False) if max_deliveries is None else F.col("deliveries") >= max_deliveries
        done.where(~ok & ~spent).write.mode("overwrite").parquet(epoch_dir(f"{out_dir}/failed", epoch_id))
        done.where(~ok & spent).write.mode("overwrite").parquet(epoch_dir(f"{out_dir}/dead_letters", epoch_id))
        (done.agg(F.count_if(ok).alias("delivered"), F.count_if(~ok).alias("errors")).coalesce(1)
         .write.mode("overwrite").parquet(epoch_dir(f"{out_dir}/stats", epoch_id)))
        commit(session, out_dir, epoch_id)

    w = messages.writeStream.foreachBatch(process).option("checkpointLocation", f"{out_dir}/_checkpoints/handler")
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def _failed_before(spark: SparkSession, out_dir: str, epoch_id: int) -> DataFrame | None:
    """The failed messages of the newest committed epoch before this one."""
    before = [e for e in committed(spark, out_dir) if e < epoch_id]
    if not before or not fs.exists(spark, epoch_dir(f"{out_dir}/failed", before[-1])):
        return None
    return spark.read.parquet(epoch_dir(f"{out_dir}/failed", before[-1])).drop("error")


def log_rows(done: DataFrame, epoch_id: int, stamp: Column, consumer_group: str, consumer_id: str) -> DataFrame:
    """Delivery-log rows of an epoch: one fetch per message, then its ack or nack, with its error."""
    ops = F.array(
        F.struct(F.lit("fetch").alias("op"), F.lit(2 * epoch_id).cast("long").alias("seq"), F.lit(None).cast("string").alias("error")),
        F.struct(F.when(F.col("error").isNull(), "ack").otherwise("nack").alias("op"),
                 F.lit(2 * epoch_id + 1).cast("long").alias("seq"), F.col("error").alias("error")))
    return done.select("topic", F.lit(consumer_group).alias("consumer_group"), F.lit(consumer_id).alias("consumer_id"),
                       F.col("id").alias("message_id"), F.inline(ops), stamp.cast("timestamp_ntz").alias("ts"))


def handler_log(spark: SparkSession, out_dir: str) -> DataFrame:
    """The delivery log that the committed epochs wrote: input of ``operators.delivery``."""
    return read_epochs(spark, f"{out_dir}/log").drop("epoch")


def dead_letters(spark: SparkSession, out_dir: str) -> DataFrame:
    """Messages that failed ``max_deliveries`` times, with their last error."""
    return spark.read.parquet(*epoch_paths(spark, f"{out_dir}/dead_letters"))
