"""Topic routing counters and delivery semantics (leases, retries, dead letters)."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from telemetry_engine.operators import delivery as D
from telemetry_engine.operators import routing as R

LOG = "topic string, consumer_group string, consumer_id string, message_id string, op string, ts timestamp_ntz, seq long"
T0 = datetime(2025, 1, 18, 12, 0, 0)


def test_fan_out_50_by_5(spark):
    msgs = spark.createDataFrame([(str(i), "t") for i in range(50)], "id string, topic string")
    subs = spark.createDataFrame([("t", f"s{i}") for i in range(5)], "topic string, subscriber_id string")
    s = R.routing_stats(msgs, subs).first()
    assert (s.published, s.delivered, s.errors, s.active_subscribers) == (50, 250, 0, 1)


def test_handler_errors_and_topics(spark):
    msgs = spark.createDataFrame([(str(i), "a" if i < 10 else "b", i) for i in range(25)], "id string, topic string, n int")
    subs = spark.createDataFrame([("a", "s1"), ("b", "s2")], "topic string, subscriber_id string")
    fails = F.col("n") >= 20
    assert R.route_messages(msgs, subs, fails).where("handler_error").count() == 5
    s = R.routing_stats(msgs, subs, fails).first()
    assert (s.published, s.delivered, s.errors, s.active_subscribers, s.unrouted) == (25, 20, 5, 2, 0)
    none = spark.createDataFrame([("c", "s3")], "topic string, subscriber_id string")
    assert R.unrouted_messages(msgs, none).count() == 25


def _log(spark, events):
    rows = [("q", "g", "c1", m, op, T0 + timedelta(seconds=s), i) for i, (m, op, s) in enumerate(events)]
    return spark.createDataFrame(rows, LOG)


def test_delivery_states(spark):
    log = _log(spark, [
        ("ready", "publish", 0),
        ("acked", "fetch", 0), ("acked", "ack", 10),
        ("nacked", "fetch", 0), ("nacked", "nack", 10),
        ("late_ack", "fetch", 0), ("late_ack", "ack", 400),
        ("flight", "fetch", 900),
        ("dead", "fetch", 0), ("dead", "fetch", 301), ("dead", "fetch", 602),
        ("edge", "fetch", 700),          # expires exactly at 1000 s (as of time)
        ("clock", "publish", 1000),
    ])
    st = {r.message_id: (r.state, r.deliveries) for r in D.delivery_state(log).collect()}
    assert st["ready"] == ("ready", 0)
    assert st["acked"] == ("acked", 1)
    assert st["nacked"] == ("ready", 1)
    assert st["late_ack"] == ("redeliver", 1)
    assert st["flight"] == ("in_flight", 1)
    assert st["dead"] == ("dead_letter", 3)
    assert st["edge"] == ("redeliver", 1)
    q = D.queue_stats(D.delivery_state(log), log).first()
    assert (q.pending, q.acked, q.dead_letters, q.consumers) == (1, 1, 1, 1)


def test_ack_matching(spark):
    log = _log(spark, [
        ("m", "ack", 0),                    # ack without fetch
        ("m", "fetch", 1), ("m", "nack", 2), ("m", "ack", 3),   # nack closes; ack unmatched
        ("m", "fetch", 4), ("m", "ack", 5), ("m", "ack", 6),    # second ack unmatched
    ])
    got = [(r.op, r.matched) for r in D.match_acks(log).orderBy("seq").collect()]
    assert got == [("ack", False), ("nack", True), ("ack", False), ("ack", True), ("ack", False)]


def test_ack_matching_carries_leases_across_time_buckets(spark):
    base = datetime(2025, 1, 18, 10, 59, 50)
    rows = [
        ("q", "g", "c1", "m", "fetch", base, 1),                              # 10:59:50
        ("q", "g", "c1", "m", "ack", base + timedelta(seconds=15), 2),        # 11:00:05, next hour: matched
        ("q", "g", "c1", "m", "fetch", base + timedelta(hours=2), 3),         # 12:59:50
        ("q", "g", "c1", "m", "nack", base + timedelta(hours=3), 4),          # 13:59:50, lease expired: unmatched
        ("q", "g", "c1", "n", "ack", base + timedelta(hours=5), 5),           # other key, no lease
    ]
    log = spark.createDataFrame(rows, LOG)
    got = [(r.seq, r.lease_seq, r.matched) for r in D.match_acks(log).orderBy("seq").collect()]
    assert got == [(2, 1, True), (4, 3, False), (5, None, False)]
    # the same answer when every key counts as hot and is split by time
    split = [(r.seq, r.lease_seq, r.matched) for r in D.match_acks(log, hot_rows=0).orderBy("seq").collect()]
    assert split == got


def test_hot_keys_give_the_same_leases_and_states(spark):
    import random

    rng = random.Random(9)
    rows = [("q", f"g{rng.randint(0, 1)}", "c", f"m{rng.randint(0, 3)}", rng.choice(["fetch", "fetch", "ack", "nack", "publish"]),
             T0 + timedelta(seconds=rng.randint(0, 40_000)), k) for k in range(900)]
    log = spark.createDataFrame(rows, LOG)
    for f in (D.leases, D.match_acks):
        assert sorted(map(str, f(log).collect())) == sorted(map(str, f(log, hot_rows=100).collect()))
    assert sorted(map(str, D.delivery_state(log).collect())) == sorted(map(str, D.delivery_state(log, hot_rows=100).collect()))
    assert sorted(map(str, D.lease_outcomes(log, None).collect())) == sorted(map(str, D.lease_outcomes(log, None, hot_rows=100).collect()))


def test_a_key_with_most_rows_in_one_hour_is_split_finely_and_gives_the_same(spark):
    import random

    rng = random.Random(4)
    ops = ["fetch", "fetch", "ack", "nack"]
    hour = [("q", "g", "c", "hot", rng.choice(ops), T0 + timedelta(microseconds=rng.choice([0, 1, 500_000, 520_000, 999_999])
             + rng.randint(0, 3_000_000) * rng.randint(0, 1_000)), k) for k in range(700)]
    same = [("q", "g", "c", "hot", rng.choice(ops), T0 + timedelta(seconds=90), 700 + k) for k in range(60)]  # one time
    rest = [("q", "g", "c", f"m{k % 3}", rng.choice(ops), T0 + timedelta(hours=k), 800 + k) for k in range(40)]
    odd = [("q", "g", "c", "hot", "fetch", None, 900), ("q", "g", "c", None, "fetch", T0, 901), ("q", "g", "c", None, "ack", T0, 902)]
    log = spark.createDataFrame([*hour, *same, *rest, *odd], LOG)
    per = D.with_segments(log.where("message_id = 'hot'"), 50).groupBy("_b").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("ts").alias("times"), F.min("ts").alias("a"), F.max("ts").alias("z"))
    per = sorted(per.collect(), key=lambda r: r["_b"])
    assert sum(r.n for r in per) == 761
    assert all(r.n <= 50 or r.times == 1 for r in per) and len(per) >= 15  # none is large but that of one time
    assert all(x.z < y.a for x, y in zip(per[1:], per[2:])) and per[0]["_b"] == "" and per[0].n == 1  # in the order of time
    for f in (D.leases, D.match_acks):
        assert sorted(map(str, f(log).collect())) == sorted(map(str, f(log, hot_rows=50).collect()))
    assert sorted(map(str, D.delivery_state(log).collect())) == sorted(map(str, D.delivery_state(log, hot_rows=50).collect()))


def test_matching_and_states_take_one_shuffle(spark, tmp):
    rows = [("q", "g", "c", f"m{k % 7}", "fetch" if k % 2 else "ack", T0 + timedelta(seconds=k), k) for k in range(60)]
    spark.createDataFrame(rows, LOG).write.parquet(f"{tmp}/log")
    log = spark.read.parquet(f"{tmp}/log")
    for df in (D.match_acks(log), D.delivery_state(log)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1


def test_topic_depth_and_groups_without_fetches(spark):
    log = _log(spark, [("a", "publish", 0), ("b", "fetch", 1), ("b", "fetch", 1000), ("b", "fetch", 2000), ("c", "publish", 9000)])
    log = log.unionByName(log.where("op = 'publish'").withColumn("topic", F.lit("other")).withColumn("consumer_group", F.lit("idle")))
    s = D.delivery_state(log)
    depth = {r.topic: (r.groups, r.queue_depth, r.dead_letters) for r in D.topic_depth(s).collect()}
    assert depth == {"q": (1, 2, 1), "other": (1, 2, 0), "*": (2, 4, 1)}
    assert {r.consumer_group: r.consumers for r in D.queue_stats(s, log).collect()} == {"g": 1, "idle": 0}
