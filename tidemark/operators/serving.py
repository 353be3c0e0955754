"""Read queries behind the dashboard: KPIs, listings and feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fixed_values import AT_RISK, CUSTOMER_NOT_FOUND, HEALTHY, WATCH

HEALTH_COLUMNS = ("customer_id", "usage_score", "support_score", "billing_score", "health_score", "health_status")


def dashboard_kpis(revenue: DataFrame, health: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row of headline figures.

    ``active_customers`` adds up the plans and so counts a customer on two
    plans twice; ``active_customers_distinct`` does not.  The three one-row
    aggregates are merged column-wise by a last aggregate over three rows.
    """
    parts = [
        revenue.agg(
            F.coalesce(F.sum("active_mrr"), F.lit(0)).alias("active_mrr"),
            F.coalesce(F.sum("active_arr"), F.lit(0)).alias("active_arr"),
            F.coalesce(F.sum("active_customers"), F.lit(0)).alias("active_customers"),
            F.coalesce(F.sum("active_subscriptions"), F.lit(0)).alias("active_subscriptions"),
        ),
        alerts.agg(F.count_if(F.col("status") == "Open").alias("open_alerts")),
        health.agg(
            F.count_if(F.col("health_status") == HEALTHY).alias("healthy_customers"),
            F.count_if(F.col("health_status") == WATCH).alias("watch_customers"),
            F.count_if(F.col("health_status") == AT_RISK).alias("at_risk_customers"),
            F.count_if(F.col("active_subscriptions") > 0).alias("active_customers_distinct"),
        ),
    ]
    merged = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    return merged.agg(*[F.max(name).alias(name) for name in merged.columns])


def revenue_listing(revenue: DataFrame) -> DataFrame:
    return revenue


def plan_mix(revenue: DataFrame) -> DataFrame:
    """Active revenue per plan and its share of the total (0 without revenue)."""
    mrr = F.coalesce("active_mrr", F.lit(0))
    shown = revenue.select(F.coalesce(F.nullif(F.col("plan"), F.lit("")), F.lit("Plan")).alias("plan"), mrr.alias("active_mrr"))
    total = shown.agg(F.sum("active_mrr")).scalar()
    return shown.withColumn("share", F.when(total > 0, F.col("active_mrr") / total).otherwise(0.0))


def customer_health_lookup(health: DataFrame, ids: DataFrame) -> DataFrame:
    """Scores for the asked customers; missing ones say so."""
    asked = ids.select("customer_id").distinct()
    found = health.select(*HEALTH_COLUMNS)
    return asked.join(found, "customer_id", "left").withColumn(
        "message", F.when(F.col("health_status").isNull(), CUSTOMER_NOT_FOUND)
    )


def health_watchlist(health: DataFrame, n: int = 10) -> DataFrame:
    return health.select(*HEALTH_COLUMNS).orderBy("health_score", "customer_id").limit(n)


def product_usage_feed(usage: DataFrame, n: int = 100) -> DataFrame:
    """The latest usage rows; features of one date go by name."""
    return usage.orderBy(F.col("usage_date").desc(), "feature").limit(n)


def usage_by_feature(feed: DataFrame, n: int = 6) -> DataFrame:
    feature = F.coalesce(F.nullif(F.col("feature"), F.lit("")), F.lit("Unknown"))
    return (
        feed.groupBy(feature.alias("feature"))
        .agg(F.coalesce(F.sum("total_events"), F.lit(0)).alias("total_events"))
        .orderBy(F.col("total_events").desc(), "feature")
        .limit(n)
    )


def usage_trend(feed: DataFrame, n: int = 8) -> DataFrame:
    """Events per date for the latest ``n`` dates, newest first."""
    per_date = feed.groupBy("usage_date").agg(F.coalesce(F.sum("total_events"), F.lit(0)).alias("total_events"))
    return per_date.orderBy(F.col("usage_date").desc()).limit(n)


def usage_feed_totals(feed: DataFrame) -> DataFrame:
    feature = F.coalesce(F.nullif(F.col("feature"), F.lit("")), F.lit("Unknown"))
    return feed.agg(
        F.count_distinct(feature).alias("features_observed"),
        F.coalesce(F.sum("total_events"), F.lit(0)).alias("recent_events"),
    )


def live_event_feed(live: DataFrame, n: int = 20) -> DataFrame:
    return (
        live.select(
            "event_id", "event_type", "customer_id", "user_id", "feature", "event_timestamp", "received_at"
        )
        .orderBy(F.col("received_at").desc(), F.col("event_id").desc())
        .limit(n)
    )


def forecast_listing(forecast: DataFrame) -> DataFrame:
    return forecast.orderBy("forecast_month")
