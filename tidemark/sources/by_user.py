"""Events and their users stored side by side, so that joins need no shuffle.

Both tables are bucketed by user and slot.  An ordinary user has slot 0; a user
with so many events that they would outgrow a bucket has several, its events are
dealt to them and its own row stands in each.  Every bucket then holds about its
share of the events, and a join reads pairs of buckets where they lie, with the
filters and columns of the query pushed into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.joins import hot_keys, salt_rows

KEY = ["user_id", "slot"]


def _store(rows: DataFrame, table: str, path: str, buckets: int) -> None:
    """One file per bucket: rows are shuffled as the buckets will hold them."""
    rows = rows.repartition(buckets, *KEY)
    rows.write.mode("overwrite").bucketBy(buckets, *KEY).sortBy(*KEY).option("path", path).saveAsTable(table)


def store_by_user(events: DataFrame, users: DataFrame, name: str, folder: str, buckets: int | None = None) -> None:
    """Store both as tables ``<name>_events`` and ``<name>_users`` below ``folder``.

    Users are reduced to one row each: earliest creation, smallest account.
    Buckets are as many as the shuffle has partitions, unless given.
    """
    buckets = buckets or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(events, "user_id")
    dealt = salt_rows(events, hot, "user_id", tuple(name for name in ("event_id", "event_timestamp") if name in events.columns))
    known = users.groupBy("user_id").agg(F.min("created_at").alias("user_created_at"), F.min("account_id").alias("customer_id"))
    places = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    copies = known.join(F.broadcast(hot), "user_id", "left").withColumn("slot", F.explode(places)).drop("_salts")
    _store(dealt.withColumnRenamed("_salt", "slot"), f"{name}_events", f"{folder}/{name}_events", buckets)
    _store(copies, f"{name}_users", f"{folder}/{name}_users", buckets)


def stored_flags(spark: SparkSession, name: str) -> DataFrame:
    """The stored events with ``customer_id`` and ``is_valid_event``."""
    events, users = spark.table(f"{name}_events"), spark.table(f"{name}_users")
    on_time = F.coalesce(F.col("event_timestamp") >= F.col("user_created_at"), F.lit(False))
    names = [column for column in events.columns if column != "slot"]
    return events.join(users, KEY, "left").select(*names, "customer_id", on_time.alias("is_valid_event"))
