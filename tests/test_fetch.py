"""Batch fetch per consumer group: bounded batches, every message once a group, position kept."""

import os

import pytest
from pyspark.sql import functions as F

from telemetry_engine.operators.delivery import delivery_state
from telemetry_engine.sources.messages_io import stream_messages, write_messages
from telemetry_engine.streaming.fetch import batches_of, fetch_log, fetch_stream, fetched


def _write(spark, path, ids, topic="t", files=2):
    rows = spark.createDataFrame([(str(i),) for i in ids], "id string").repartition(files)
    write_messages(rows.select(
        "id", F.lit(topic).alias("topic"), F.lit("{}").alias("payload"), F.create_map(F.lit("h"), F.col("id")).alias("headers"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("timestamp"), F.lit("{}").alias("metadata")), path)


def _run(spark, src, out, group, prefetch, consumers=("a", "b")):
    fetch_stream(stream_messages(spark, f"{src}/*", max_files=1), "t", group, out, prefetch, consumers).awaitTermination()
    return fetched(spark, out)


@pytest.mark.parametrize("prefetch,size", [(7, 7), (0, 1), (-5, 1), (9_999, 2500)])
def test_a_batch_holds_at_most_the_clamped_size(spark, prefetch, size):
    rows = spark.range(0, 6000, 1, 2).select(F.col("id").cast("string").alias("id"), F.lit("t").alias("topic"))
    got = batches_of(rows, prefetch, 3, ["a", "b", "c"])
    assert got.columns == ["id", "topic", "batch_id", "consumer_id"]
    per = got.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("consumer_id").alias("c")).collect()
    assert max(r.n for r in per) == size and {r.c for r in per} == {1}
    assert len(per) == 2 * -(-3000 // size)                   # one short batch a task
    assert all(r.batch_id.startswith("0000000003-") for r in per)
    assert got.select("consumer_id").distinct().count() == 3
    assert got.select("id").distinct().count() == 6000


def test_every_message_once_a_group_also_after_a_restart(spark, tmp):
    src = f"{tmp}/queue"
    _write(spark, f"{src}/a", range(25))
    _write(spark, f"{src}/other", range(100, 105), topic="u", files=1)
    one = _run(spark, src, f"{tmp}/g1", "g1", 4)
    assert sorted(int(r.id) for r in one.collect()) == list(range(25))
    _write(spark, f"{src}/b", range(25, 40))
    one = _run(spark, src, f"{tmp}/g1", "g1", 4)               # a restart goes on where the group was
    two = _run(spark, src, f"{tmp}/g2", "g2", 1000)            # another group begins at the start
    for got, size in ((one, 4), (two, 1000)):
        assert sorted(int(r.id) for r in got.collect()) == list(range(40))
        assert got.groupBy("batch_id").count().agg(F.max("count")).first()[0] <= size
    assert _run(spark, src, f"{tmp}/g1", "g1", 4).count() == 40  # nothing new


def test_fetches_are_rows_of_a_delivery_log(spark, tmp):
    src, out = f"{tmp}/queue", f"{tmp}/g"
    _write(spark, f"{src}/a", range(6), files=1)
    _run(spark, src, out, "g", 2)
    log = fetch_log(spark, out)
    acks = log.where("message_id < '2'").withColumns({"op": F.lit("ack"), "seq": F.col("seq") + 1})
    state = delivery_state(log.unionByName(acks))
    assert {(r.message_id, r.consumer_group, r.state) for r in state.collect()} == {
        (str(i), "g", "acked" if i < 2 else "in_flight") for i in range(6)}


def test_an_epoch_without_its_marker_is_not_read_and_no_consumer_is_refused(spark, tmp):
    src, out = f"{tmp}/queue", f"{tmp}/g"
    _write(spark, f"{src}/a", range(3), files=1)
    _write(spark, f"{src}/b", range(3, 5), files=1)
    assert _run(spark, src, out, "g", 2).count() == 5
    os.remove(f"{out}/_committed/{1:010d}")
    assert fetched(spark, out).count() in (2, 3)
    with pytest.raises(ValueError):
        fetch_stream(stream_messages(spark, f"{src}/*"), "t", "g", out, consumers=())
