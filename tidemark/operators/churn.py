"""Churn features, pattern analysis and risk tiers.

Each child table is reduced to one row per account before it is joined, so no
join multiplies rows and none sees a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import micros_between, whole_days
from tidemark.functions.fixed_values import (
    CATEGORICAL_FEATURES,
    CHURN_REFERENCE_DATE,
    HIGH_RISK_FROM,
    MEDIUM_RISK_FROM,
    PATTERN_MEANS,
)
from tidemark.operators.marts import user_feature_counts

MICROS_PER_HOUR = 3_600_000_000


def churn_subscription_features(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Subscriptions, latest start, plan prices and the churn label per account.

    Unknown plans have no price; averages skip them.
    """
    prices = plans.select("plan_name", "monthly_price")
    return (
        subscriptions.join(prices, F.col("plan") == F.col("plan_name"), "left")
        .groupBy("account_id")
        .agg(
            F.count(F.lit(1)).alias("subscription_count"),
            F.max("start_date").alias("latest_subscription_start"),
            F.avg("monthly_price").alias("avg_plan_price"),
            F.max("monthly_price").cast("bigint").alias("max_plan_price"),
            F.max(F.when(F.col("status") == "Cancelled", 1).otherwise(0)).alias("churned"),
        )
    )


def churn_usage_features(users: DataFrame, events: DataFrame) -> DataFrame:
    """Valid events and distinct features per account that has users."""
    return (
        users.select("user_id", "account_id")
        .join(user_feature_counts(events), "user_id", "left")
        .groupBy("account_id")
        .agg(
            F.coalesce(F.sum("feature_events"), F.lit(0)).alias("usage_events"),
            F.count_distinct("feature").alias("features_used"),
        )
    )


def churn_support_features(support: DataFrame) -> DataFrame:
    """Resolved tickets and their unrounded mean hours per account.

    Durations are summed as wide decimals: exact, and safe from overflow.
    """
    took = micros_between(F.col("created_at"), F.col("resolved_at")).cast("decimal(20,0)")
    return (
        support.filter(F.col("resolved_at").isNotNull())
        .groupBy("account_id")
        .agg(
            F.count(F.lit(1)).alias("support_ticket_count"),
            (F.sum(took).cast("double") / F.count(took) / MICROS_PER_HOUR).alias("avg_resolution_hours"),
        )
    )


def churn_billing_features(invoices: DataFrame, any_case: bool = False) -> DataFrame:
    """Invoices and failed invoices per account."""
    failed = F.lower("status") == "failed" if any_case else F.col("status") == "Failed"
    return invoices.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("invoice_count"),
        F.count_if(failed).alias("failed_invoice_count"),
    )


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def churn_features(
    accounts: DataFrame,
    subscription: DataFrame,
    usage: DataFrame,
    support: DataFrame,
    billing: DataFrame,
    with_label: bool = True,
) -> DataFrame:
    """Model input, one row per account that ever subscribed."""
    joined = accounts.select("account_id", "industry", "size", "region").join(subscription, "account_id")
    for part in (usage, support, billing):
        joined = joined.join(part, "account_id", "left")
    invoices, failed = F.col("invoice_count"), F.col("failed_invoice_count")
    rate = F.when(invoices > 0, failed / invoices).otherwise(0.0)
    return joined.select(
        "account_id",
        "industry",
        "size",
        "region",
        "subscription_count",
        "latest_subscription_start",
        "avg_plan_price",
        "max_plan_price",
        _zero("usage_events"),
        _zero("features_used"),
        _zero("support_ticket_count"),
        _zero("avg_resolution_hours"),
        _zero("invoice_count"),
        _zero("failed_invoice_count"),
        rate.alias("failed_invoice_rate"),
        *(["churned"] if with_label else []),
    )


def subscription_age_days(features: DataFrame, reference_date: str = CHURN_REFERENCE_DATE) -> DataFrame:
    """Replace the latest start by its age in full days at the reference date."""
    reference = F.lit(reference_date).cast("timestamp_ntz")
    age = whole_days(F.col("latest_subscription_start"), reference)
    return features.withColumn("subscription_age_days", age).drop("latest_subscription_start")


def churn_pattern_features(
    accounts: DataFrame,
    subscriptions: DataFrame,
    users: DataFrame,
    events: DataFrame,
    support: DataFrame,
    invoices: DataFrame,
    ordered: bool = True,
) -> DataFrame:
    """Analysis input for all accounts; the label is NULL without subscriptions.

    Statuses compare without regard to case here.
    """
    label = subscriptions.groupBy("account_id").agg(
        F.max(F.when(F.lower("status") == "cancelled", 1).otherwise(0)).alias("churned")
    )
    joined = accounts.select("account_id", "industry", "size", "region", "owner")
    for part in (
        label,
        churn_usage_features(users, events),
        churn_support_features(support),
        churn_billing_features(invoices, any_case=True),
    ):
        joined = joined.join(part, "account_id", "left")
    rows = joined.select(
        "account_id",
        "industry",
        "size",
        "region",
        "owner",
        "churned",
        _zero("usage_events"),
        _zero("features_used"),
        _zero("support_ticket_count"),
        _zero("avg_resolution_hours"),
        _zero("failed_invoice_count"),
        _zero("invoice_count"),
    )
    return rows.orderBy("account_id") if ordered else rows


def churn_distribution(df: DataFrame) -> DataFrame:
    """Rows per label, most frequent first; unlabelled rows are left out."""
    return (
        df.filter(F.col("churned").isNotNull())
        .groupBy("churned")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), "churned")
    )


def churn_rate_by_segment(df: DataFrame, segments=CATEGORICAL_FEATURES) -> DataFrame:
    """Labelled rows, churned rows and churn rate for each value of each
    segment column, all columns in a single pass over the data.

    Rows become (column, value) pairs that partial aggregation collapses at
    once, before anything is shuffled.
    """
    pairs = F.array(*[F.struct(F.lit(name).alias("segment"), F.col(name).alias("value")) for name in segments])
    return (
        df.select("churned", F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("segment", "value")
        .agg(
            F.count("churned").alias("count"),
            F.coalesce(F.sum("churned"), F.lit(0)).alias("sum"),
            F.avg("churned").alias("mean"),
        )
        .orderBy("segment", F.col("mean").desc_nulls_last(), "value")
    )


def feature_means_by_churn(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("churned").isNotNull())
        .groupBy("churned")
        .agg(*[F.bround(F.avg(name), 2).alias(name) for name in PATTERN_MEANS])
    )


def failed_rate_by_churn(df: DataFrame) -> DataFrame:
    """Mean failed share by label; accounts without invoices count as zero."""
    invoices = F.when(F.col("invoice_count") == 0, 1).otherwise(F.col("invoice_count"))
    share = F.col("failed_invoice_count") / invoices
    return (
        df.filter(F.col("churned").isNotNull())
        .groupBy("churned")
        .agg(F.bround(F.avg(share), 4).alias("failed_invoice_rate"))
    )


def risk_tier(scored: DataFrame) -> DataFrame:
    """Tier from the unrounded probability, which is then shown in four decimals."""
    p = F.col("churn_probability")
    tier = F.when(p >= HIGH_RISK_FROM, "High").when(p >= MEDIUM_RISK_FROM, "Medium").otherwise("Low")
    return scored.select(
        F.col("account_id").alias("customer_id"),
        F.bround(p, 4).alias("churn_probability"),
        tier.alias("risk_level"),
    )


def churn_risk(scored: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` riskiest of all customers."""
    return risk_tier(scored).orderBy(F.col("churn_probability").desc(), "customer_id").limit(n)


def risk_summary(scored: DataFrame) -> DataFrame:
    """Customers per tier, over all of them."""
    level = F.col("risk_level")
    return risk_tier(scored).agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(level == "High").alias("high_risk_customers"),
        F.count_if(level == "Medium").alias("medium_risk_customers"),
        F.count_if(level == "Low").alias("low_risk_customers"),
    )
