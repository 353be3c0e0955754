"""Star schema: dimensions and row-grain facts keyed by calendar day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import hundredth_hours
from tidemark.operators.events import enrich_events_with_account, flag_and_enrich
from tidemark.sources.stored import observed_write


def dim_customer(accounts: DataFrame) -> DataFrame:
    return accounts.select(F.col("account_id").alias("customer_id"), "industry", "size", "region", "owner").distinct()


def dim_user(users: DataFrame) -> DataFrame:
    return users.select("user_id", F.col("account_id").alias("customer_id"), "role", "created_at").distinct()


def dim_plan(plans: DataFrame) -> DataFrame:
    return plans.select("plan_id", "plan_name", "monthly_price").distinct()


def dim_date(*facts: DataFrame) -> DataFrame:
    """One row for each day from the earliest to the latest ``date_key``.

    Each fact shrinks to its own two bounds before the bounds are merged.
    """
    bounds = reduce(
        DataFrame.unionByName,
        [fact.agg(F.min("date_key").alias("first_day"), F.max("date_key").alias("last_day")) for fact in facts],
    ).agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
    day = F.col("date_key")
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date_key")).select(
        day,
        F.year(day).cast("int").alias("year"),
        F.quarter(day).cast("int").alias("quarter"),
        F.month(day).cast("int").alias("month"),
        F.dayofmonth(day).cast("int").alias("day"),
        F.trunc(day, "month").alias("month_start"),
    )


def fact_usage(events: DataFrame, users: DataFrame) -> DataFrame:
    """Events with the owning customer (NULL for unknown users).  Events that carry
    no validity get it from the same look at their users."""
    flagged = "is_valid_event" in events.columns
    enriched = enrich_events_with_account(events, users) if flagged else flag_and_enrich(events, users)
    return enriched.select(
        "event_id",
        "user_id",
        "customer_id",
        "feature",
        "event_timestamp",
        "is_valid_event",
        F.to_date("event_timestamp").alias("date_key"),
    )


def fact_billing(invoices: DataFrame) -> DataFrame:
    return invoices.select(
        "invoice_id",
        F.col("account_id").alias("customer_id"),
        "amount",
        "status",
        F.to_date("due_date").alias("date_key"),
    )


def fact_subscription(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Subscriptions with their plan's id (NULL for unknown plan names).

    Plan names are unique in the price list.  It is joined as it stands: small
    it is broadcast, and large the few hot names leave Spark free to split.
    """
    ids = plans.select("plan_id", "plan_name")
    return subscriptions.join(ids, F.col("plan") == F.col("plan_name"), "left").select(
        "subscription_id",
        F.col("account_id").alias("customer_id"),
        "plan_id",
        "plan",
        "status",
        F.to_date("start_date").alias("date_key"),
    )


def fact_support(support: DataFrame) -> DataFrame:
    hours = hundredth_hours(F.col("created_at"), F.col("resolved_at")) / 100
    return support.select(
        "ticket_id",
        F.col("account_id").alias("customer_id"),
        "severity",
        "created_at",
        "resolved_at",
        hours.alias("resolution_hours"),
        F.to_date("created_at").alias("date_key"),
    )


def write_fact(fact: DataFrame, path: str) -> dict[str, int]:
    """Overwrite a fact, one folder per month, for date-pruned reads; returns
    its row count, observed on the way.

    Rows are grouped by day, not by month, before the write: a month then
    arrives in up to 31 tasks, and AQE splits a day that is still too big.
    """
    keyed = fact.withColumn("month_key", F.trunc("date_key", "month"))
    dealt = keyed.hint("rebalance", "month_key", "date_key")
    return observed_write(dealt, lambda rows: rows.write.mode("overwrite").partitionBy("month_key").parquet(path))
