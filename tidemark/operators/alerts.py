"""Alert rules, suppression, feeds, acknowledgement and follow-up actions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import json_text, lookup
from tidemark.functions.fixed_values import (
    ACKNOWLEDGED,
    AT_RISK,
    DEFAULT_FOLLOW_UP,
    DEFAULT_OWNER,
    EXPANSION_ALERT,
    EXPANSION_FEATURE,
    FOLLOW_UPS,
    HEALTH_ALERT,
    NOT_ACKNOWLEDGED,
    PAYMENT_ALERT,
)
from tidemark.session import cut_lineage


def _alert_rows(df: DataFrame, customer: str, texts: dict, severity: Column, metadata: Column) -> DataFrame:
    return df.select(
        F.col(customer).alias("customer_id"),
        F.lit(texts["alert_type"]).alias("alert_type"),
        severity.alias("severity"),
        F.lit(texts["owner"]).alias("owner"),
        F.lit("Open").alias("status"),
        F.lit(texts["reason"]).alias("reason"),
        F.lit(texts["recommended_action"]).alias("recommended_action"),
        F.lit(texts["source"]).alias("source"),
        metadata.alias("metadata"),
    )


def suppress_open_alerts(candidates: DataFrame, alerts: DataFrame) -> DataFrame:
    """Drop candidates whose customer already has an open alert of that type.

    Acknowledged alerts do not suppress, and a NULL customer never matches.
    """
    raised = alerts.filter(F.col("status") == "Open").select("customer_id", "alert_type").distinct()
    raised = raised.withColumn("customer_id", F.col("customer_id").cast(candidates.schema["customer_id"].dataType))
    return candidates.join(raised, ["customer_id", "alert_type"], "left_anti")


def health_risk_alerts(health: DataFrame, alerts: DataFrame) -> DataFrame:
    """An alert for each At Risk customer without an open one."""
    at_risk = health.filter(F.col("health_status") == AT_RISK)
    scores = json_text(
        F.col("health_score").cast("decimal(5,2)").alias("health_score"),
        F.col("usage_score"),
        F.col("support_score"),
        F.col("billing_score"),
    )
    return suppress_open_alerts(_alert_rows(at_risk, "customer_id", HEALTH_ALERT, F.lit("High"), scores), alerts)


def payment_failure_alerts(invoices: DataFrame, alerts: DataFrame) -> DataFrame:
    """An alert for each account with failed invoices; two make it High."""
    failing = (
        invoices.groupBy("account_id")
        .agg(
            F.count_if(F.col("status") == "Failed").alias("failed_invoice_count"),
            F.count(F.lit(1)).alias("invoice_count"),
        )
        .filter(F.col("failed_invoice_count") > 0)
    )
    severity = F.when(F.col("failed_invoice_count") >= 2, "High").otherwise("Medium")
    counts = json_text(F.col("failed_invoice_count"), F.col("invoice_count"))
    return suppress_open_alerts(_alert_rows(failing, "account_id", PAYMENT_ALERT, severity, counts), alerts)


def expansion_alerts(new_events: DataFrame, alerts: DataFrame, trigger: str = EXPANSION_FEATURE) -> DataFrame:
    """An alert per customer whose newly stored events use the trigger feature.

    The earliest trigger event of a customer speaks for all its events, found
    by an aggregate that combines before the shuffle.  Events without a
    customer match no open alert, so each of them raises its own; they also
    bypass the join, where their NULL keys would pile up in one task.
    """
    triggers = new_events.filter(F.col("feature") == trigger)
    detail = F.struct(
        "event_timestamp",
        "event_id",
        "feature",
        "user_id",
        F.get_json_object("raw_event", "$.timestamp").alias("sent_at"),
    )
    first = triggers.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.min(detail).alias("event"))
    anonymous = triggers.filter(F.col("customer_id").isNull()).select("customer_id", detail.alias("event"))

    def rows(df: DataFrame) -> DataFrame:
        metadata = json_text(
            F.col("event.event_id").alias("event_id"),
            F.col("event.feature").alias("feature"),
            F.col("event.user_id").alias("user_id"),
            F.col("event.sent_at").alias("event_timestamp"),
        )
        return _alert_rows(df, "customer_id", EXPANSION_ALERT, F.lit("Medium"), metadata)

    return suppress_open_alerts(rows(first), alerts).unionByName(rows(anonymous))


def number_rows(new: DataFrame, existing: DataFrame, id_column: str, created_at: Column) -> DataFrame:
    """Give rows about to be appended the next ids, without gaps, and a creation time.

    The rows are materialised, counted by partition and numbered on from the
    partitions before; no task sees more than its own.  Write the result once.
    """
    last = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint")).scalar()
    placed = cut_lineage(new).withColumn("_place", F.monotonically_increasing_id())
    part = F.shiftright("_place", 33).alias("_part")  # the number of the partition is in the upper bits
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))  # a row per partition
    )
    within = F.col("_place") - F.shiftleft("_part", 33)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select((last + 1 + F.col("_start") + within).alias(id_column), *new.columns, created_at.alias("created_at"))
    )


def number_alerts(new: DataFrame, existing: DataFrame, created_at: Column) -> DataFrame:
    """New alerts as they are stored: numbered, dated, not acknowledged."""
    return number_rows(new, existing, "alert_id", created_at).withColumn(
        "acknowledged_at", F.lit(None).cast("timestamp_ntz")
    )


def new_alert_counts(inserted: dict[str, DataFrame]) -> DataFrame:
    """New alerts per rule, zeros included, and in total."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("new_alerts")).select(F.lit(rule).alias("alert_type"), "new_alerts")
        for rule, df in inserted.items()
    ]
    return (
        reduce(DataFrame.unionByName, counted)
        .rollup("alert_type")
        .agg(F.sum("new_alerts").alias("new_alerts"))
        .select(F.coalesce("alert_type", F.lit("Total")).alias("alert_type"), "new_alerts")
    )


def open_alert_summary(alerts: DataFrame) -> DataFrame:
    """Open alerts per type and severity, most frequent first, with the total."""
    counts = (
        alerts.filter(F.col("status") == "Open")
        .groupBy("alert_type", "severity")
        .agg(F.count(F.lit(1)).alias("alert_count"))
    )
    return counts.withColumn("total_open_alerts", counts.agg(F.sum("alert_count")).scalar()).orderBy(
        F.col("alert_count").desc(), "alert_type", "severity"
    )


def alert_feed(alerts: DataFrame, n: int = 20) -> DataFrame:
    """The latest alerts; equal times go by descending id."""
    return (
        alerts.select(
            "alert_id",
            "customer_id",
            "alert_type",
            "severity",
            "owner",
            "status",
            "reason",
            "recommended_action",
            "source",
            "created_at",
            "acknowledged_at",
        )
        .orderBy(F.col("created_at").desc(), F.col("alert_id").desc())
        .limit(n)
    )


def alert_feed_counts(feed: DataFrame) -> DataFrame:
    return feed.agg(
        F.count(F.lit(1)).alias("recent_alerts"),
        F.count_if(F.lower("status") == "open").alias("open_in_feed"),
        F.count_if(F.lower("severity") == "high").alias("high_severity"),
        F.count_if(F.col("alert_type") == EXPANSION_ALERT["alert_type"]).alias("expansion_signals"),
    )


def acknowledge_alerts(alerts: DataFrame, ids: DataFrame, at: Column) -> tuple[DataFrame, DataFrame]:
    """(all alerts after acknowledging ``ids``, one report row per id asked for).

    Only open alerts change.  Both are lazy; write the first to a new place,
    never over the table being read.
    """
    asked = ids.select("alert_id").distinct()
    marked = alerts.join(asked.withColumn("asked", F.lit(True)), "alert_id", "left")
    changes = F.col("asked").isNotNull() & (F.col("status") == "Open")
    updated = marked.select(
        *[
            F.when(changes, "Acknowledged").otherwise(F.col("status")).alias("status")
            if name == "status"
            else F.when(changes, at).otherwise(F.col("acknowledged_at")).alias("acknowledged_at")
            if name == "acknowledged_at"
            else F.col(name)
            for name in alerts.columns
        ]
    )
    # The same alerts seen from the ids: what each request came to.
    opened = alerts.filter(F.col("status") == "Open").select(
        "alert_id", "customer_id", "alert_type", "severity", "owner", F.lit("Acknowledged").alias("status"),
        at.alias("acknowledged_at"),
    )
    report = asked.join(opened, "alert_id", "left").withColumn(
        "message", F.when(F.col("status").isNull(), NOT_ACKNOWLEDGED).otherwise(ACKNOWLEDGED)
    )
    return updated, report


def customer_actions(alerts: DataFrame) -> DataFrame:
    """The follow-up action each alert asks for, ready to be appended."""
    return alerts.select(
        "customer_id",
        F.coalesce(lookup(F.col("alert_type"), FOLLOW_UPS), F.lit(DEFAULT_FOLLOW_UP)).alias("action_type"),
        F.coalesce(F.nullif(F.col("owner"), F.lit("")), F.lit(DEFAULT_OWNER)).alias("owner"),
        F.coalesce("reason", F.lit("")).alias("notes"),
        F.lit("Created").alias("status"),
    )
