"""Event validity and event-to-account lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.joins import one_per_key


def _on_time() -> Column:
    return F.coalesce(F.col("event_timestamp") >= F.col("user_created_at"), F.lit(False))


def known_users(users: DataFrame) -> DataFrame:
    """(user_id, user_created_at, customer_id), one row per user."""
    return one_per_key(users, "user_id", F.min("created_at").alias("user_created_at"), F.min("account_id").alias("customer_id"))


def flag_valid_events(events: DataFrame, users: DataFrame) -> DataFrame:
    """Add ``is_valid_event``: not before its user was created.

    Events of unknown users, and of users without a creation time, are invalid.
    Every event is kept exactly once, so users are first reduced to one row
    each.  Busy users' events are split over tasks by Spark.
    """
    created = known_users(users).select("user_id", "user_created_at")
    return events.join(created, "user_id", "left").withColumn("is_valid_event", _on_time()).select(*events.columns, "is_valid_event")


def flag_and_enrich(events: DataFrame, users: DataFrame) -> DataFrame:
    """Add ``customer_id`` and ``is_valid_event`` from one look at each event's user."""
    plain = events.drop("customer_id", "is_valid_event")
    return (
        plain.join(known_users(users), "user_id", "left")
        .withColumn("is_valid_event", _on_time())
        .select(*plain.columns, "customer_id", "is_valid_event")
    )


def account_of_users(users: DataFrame) -> DataFrame:
    """(user_id, customer_id), one row per user."""
    return one_per_key(users, "user_id", F.min("account_id").alias("customer_id"))


def enrich_events_with_account(events: DataFrame, users: DataFrame) -> DataFrame:
    """Attach ``customer_id`` by user; works on a static or a streaming frame.

    Unknown users keep their events with a NULL customer.  A micro-batch is
    bounded by its trigger; a table's busy users are split over tasks by Spark.
    """
    events = events.drop("customer_id")
    owners = account_of_users(users).withColumn("user_id", F.col("user_id").cast(events.schema["user_id"].dataType))
    return events.join(owners, "user_id", "left").select(*events.columns, "customer_id")
