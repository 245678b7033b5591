"""Physical-plan shape: the properties the scale design relies on."""

from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from telemetry_engine.operators import dedup, history, registry, routing
from telemetry_engine.sources.store import append_telemetry, read_telemetry

TEL = "gpu_uuid string, metric_name string, value string, timestamp timestamp_ntz, batch_id string, labels_raw string, seq long"
DEV = "uuid string, device_id string, gpu_index string, model_name string, hostname string, container string, pod string, namespace string"
U = "GPU-00000007-0000-0000-0000-000000000007"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    t0 = datetime(2024, 1, 1)
    rows = [(f"GPU-{i % 5:08x}-0000-0000-0000-{i % 5:012x}", "m", str(i), t0 + timedelta(hours=i), "b", "", i)
            for i in range(200)]
    path = str(tmp_path_factory.mktemp("store"))
    append_telemetry(spark.createDataFrame(rows, TEL), path, num_partitions=4, mode="overwrite")
    return read_telemetry(spark, path)


def test_point_history_is_pruned_pushed_and_top_k(store):
    p = plan(history.device_history(store, U, "2024-01-02T00:00:00Z", "2024-01-03T00:00:00Z", 5))
    assert "TakeOrderedAndProject" in p
    assert "PushedFilters: [IsNotNull(gpu_uuid), IsNotNull(timestamp), EqualTo(gpu_uuid," in p
    assert "PartitionFilters: [isnotnull(event_date" in p and "event_date" in p


def test_latest_per_key_limits_before_shuffle(store):
    p = plan(dedup.dedup_telemetry(store))
    assert p.count("WindowGroupLimit") == 2  # partial (map side) + final


def test_bulk_history_prunes_partitions_from_request_bounds(spark, store):
    devs = spark.createDataFrame([(U,) + ("",) * 7], DEV)
    reqs = spark.createDataFrame([(1, U, "2024-01-02T00:00:00Z", "2024-01-03T00:00:00Z", "5")],
                                 "request_id long, uuid string, start_time string, end_time string, limit string")
    df = history.bulk_history(history.request_status(reqs, devs), store)
    p = plan(df)
    # one scan counts the days of the devices; one reads the points, of the days that are needed
    assert p.count("FileScan") == p.count("PartitionFilters: [isnotnull(event_date") >= 2
    assert "dynamicpruning" in p
    # rows are cut before a shuffle and after; these few points are broadcast, and stage 1 needs no shuffle
    assert p.count("WindowGroupLimit") in (2, 4)


def test_bulk_history_answers_each_kind_of_request_with_its_own_bounds(spark, store):
    devs = spark.createDataFrame([(U,) + ("",) * 7], DEV)
    reqs = spark.createDataFrame([
        (1, U, "2024-01-02T00:00:00Z", "2024-01-03T00:00:00Z", "5"), (2, U, "", "", "5"),
        (3, U, "2024-01-04T00:00:00Z", "2024-01-05T00:00:00Z", "")],
        "request_id long, uuid string, start_time string, end_time string, limit string")
    statuses = history.request_status(reqs, devs)
    p = plan(history.bulk_history(statuses, store))
    bounded, unbounded = p.count("PartitionFilters: [isnotnull(event_date"), p.count("PartitionFilters: []")
    assert bounded >= 4 and 1 <= unbounded <= 3
    totals = plan(history.history_totals(statuses, store))
    assert totals.count("FileScan") == totals.count("ReadSchema: struct<gpu_uuid:string,timestamp:timestamp_ntz>") > 0


REQ = "request_id long, uuid string, start_time string, end_time string, limit string"


def _hot(spark, tmp, requests):
    """One device with 48 points a day for 60 days, and what ``requests`` need of it."""
    t0 = datetime(2024, 1, 1)
    rows = [(U, "m", str(i), t0 + timedelta(minutes=30 * i), "b", "", i) for i in range(48 * 60)]
    append_telemetry(spark.createDataFrame(rows, TEL), tmp, num_partitions=4, mode="overwrite")
    t = read_telemetry(spark, tmp)
    statuses = history.request_status(spark.createDataFrame(requests, REQ), spark.createDataFrame([(U,) + ("",) * 7], DEV))
    return t, statuses


def test_many_requests_on_one_device_join_near_the_answer(spark, tmp):
    requests = [(i, U, f"2024-01-{i % 28 + 1:02d}T06:10:00Z", f"2024-01-{i % 28 + 2:02d}T05:00:00Z", "") for i in range(200)]
    t, statuses = _hot(spark, tmp, requests)
    (branch,) = history._branches(statuses)
    joined = history.request_days(branch, history._within(branch, t, ["gpu_uuid"])).agg({"_n": "sum"}).first()[0]
    answer = history.bulk_history(statuses, t).count()
    assert answer == 200 * 46 and joined <= 200 * 2 * 48  # the two days that a request touches, of 60


def test_a_limited_request_needs_the_days_that_fill_it(spark, tmp):
    t, statuses = _hot(spark, tmp, [(1, U, "", "", "50"), (2, U, "", "2024-01-20T00:10:00Z", "10"), (3, U, "2024-01-05T00:00:00Z", "", "10000")])
    days = {r: 0 for r in (1, 2, 3)}
    for b in history._branches(statuses):
        for r in history.request_days(b, history._within(b, t, ["gpu_uuid"])).collect():
            days[r.request_id] += 1
    assert days == {1: 2, 2: 2, 3: 56}
    got = {r.request_id: r.n for r in history.bulk_history(statuses, t).groupBy("request_id").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 50, 2: 10, 3: 56 * 48}
    totals = {r.request_id: r.total for r in history.history_totals(statuses, t).collect()}
    assert totals == got


def test_totals_join_no_request_to_a_point(spark, tmp):
    requests = [(i, U, "2024-01-01T00:00:00Z" if i % 3 else "", "2024-02-20T00:00:00Z" if i % 2 else "", "") for i in range(300)]
    t, statuses = _hot(spark, tmp, requests)
    from collections import Counter

    got = history.history_totals(statuses, t)
    want = Counter(r.request_id for r in history.bulk_history(statuses, t).select("request_id").collect())
    assert {r.request_id: r.total for r in got.collect()} == {i: want[i] for i in range(300)}
    branch = history._branches(statuses, by_limit=False)
    assert len(branch) == 2
    p = plan(history._counts(branch[0], t))
    # points meet the distinct devices and hours of the bounds; the requests come in by the union
    assert p.count("Union") == 2 and "LeftSemi" in p


def test_routing_broadcasts_checked_subscriptions(spark):
    msgs = spark.range(100).selectExpr("cast(id as string) id", "if(id % 2 = 0, 't', 'u') topic")
    subs = spark.sql("SELECT * FROM VALUES ('t', 'a') AS s(topic, subscriber_id)")
    p = plan(routing.route_messages(msgs, subs))
    assert "BroadcastHashJoin" in p and "BroadcastExchange" in p


def test_semi_join_pre_aggregates_telemetry(spark, store):
    devs = spark.createDataFrame([(U,) + ("",) * 7], DEV)
    p = plan(registry.devices_with_telemetry(devs, store))
    assert "HashAggregate" in p


def test_unrouted_anti_join_does_not_shuffle_messages(spark):
    msgs = spark.range(100).selectExpr("cast(id as string) id", "if(id % 2 = 0, 't', 'u') topic")
    subs = spark.sql("SELECT * FROM VALUES ('t', 'a') AS s(topic, subscriber_id)")
    p = plan(routing.unrouted_messages(msgs, subs))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
