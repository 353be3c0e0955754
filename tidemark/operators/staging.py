"""Staging projections: typed tables under their analytical names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import hundredth_hours


def stage_customers(accounts: DataFrame) -> DataFrame:
    return accounts.withColumnRenamed("account_id", "customer_id").select(
        "customer_id", "industry", "size", "region", "owner"
    )


def stage_users(users: DataFrame) -> DataFrame:
    return users.withColumnRenamed("account_id", "customer_id").select("user_id", "customer_id", "role", "created_at")


def stage_product_events(events: DataFrame) -> DataFrame:
    return events.select("event_id", "user_id", "feature", "event_timestamp", "is_valid_event")


def stage_subscriptions(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.withColumnRenamed("account_id", "customer_id").select(
        "subscription_id", "customer_id", "plan", "start_date", "status"
    )


def stage_invoices(invoices: DataFrame) -> DataFrame:
    return invoices.withColumnRenamed("account_id", "customer_id").select(
        "invoice_id", "customer_id", "amount", "due_date", "status"
    )


def stage_support(support: DataFrame) -> DataFrame:
    """Adds ``resolution_hours``, two decimals; NULL while unresolved."""
    hours = hundredth_hours(F.col("created_at"), F.col("resolved_at")) / 100
    return support.withColumnRenamed("account_id", "customer_id").select(
        "ticket_id", "customer_id", "severity", "created_at", "resolved_at", hours.alias("resolution_hours")
    )
