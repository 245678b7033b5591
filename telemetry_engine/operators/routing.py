"""Topic routing: fan a message out to every subscriber of its exact topic.

Joins leave the choice of strategy to Spark: a subscription table of known size
below ``spark.sql.autoBroadcastJoinThreshold`` is broadcast, a larger one is
joined by shuffle, and adaptive execution corrects a wrong estimate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route_messages(
    messages: DataFrame,
    subscriptions: DataFrame,
    handler_fails: Column | None = None,
) -> DataFrame:
    """One row per (message, subscriber) on an equal topic.

    ``handler_fails`` is a predicate over the joined row marking deliveries
    whose handler failed.
    """
    subs = subscriptions.select(F.col("topic").alias("_sub_topic"), "subscriber_id")
    routed = messages.join(subs, messages.topic == subs._sub_topic, "inner").drop("_sub_topic")
    return routed.withColumn("handler_error", _fails(handler_fails))


def _fails(handler_fails: Column | None) -> Column:
    return F.coalesce(handler_fails, F.lit(False)) if handler_fails is not None else F.lit(False)


def unrouted_messages(messages: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Messages whose topic has no subscriber (dropped by the router)."""
    subs = subscriptions.select(F.col("topic").alias("_sub_topic")).distinct()
    return messages.join(subs, messages.topic == subs._sub_topic, "left_anti")


def routing_stats(messages: DataFrame, subscriptions: DataFrame, handler_fails: Column | None = None) -> DataFrame:
    """published, delivered, errors, unrouted, active_subscribers (= subscribed topics).

    One left join to the list of subscribers per topic and one aggregate: the
    messages are read once.
    """
    lists = subscriptions.groupBy(F.col("topic").alias("_topic")).agg(F.collect_list("subscriber_id").alias("_subs"))
    each = messages.join(lists, messages.topic == lists._topic, "left").select(
        *messages.columns, F.posexplode_outer("_subs").alias("_pos", "subscriber_id"))
    each = each.withColumn("_error", _fails(handler_fails))
    sent = F.col("_pos").isNotNull()
    topics = subscriptions.agg(F.count_distinct("topic")).scalar()
    return each.agg(
        F.count_if(~sent | (F.col("_pos") == 0)).alias("published"),
        F.count_if(sent & ~F.col("_error")).alias("delivered"),
        F.count_if(sent & F.col("_error")).alias("errors"),
        F.count_if(~sent).alias("unrouted"),
    ).withColumn("active_subscribers", topics)
