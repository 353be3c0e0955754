"""Customer, revenue, usage and service-level marts over the staged tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    as_hundredths,
    banded,
    integer_quotient,
    month_of,
    percent,
    plan_price,
    sla_hours,
)
from tidemark.functions.fixed_values import (
    AT_RISK,
    BILLING_CLEAN,
    BILLING_FLOOR,
    BILLING_RARE,
    BILLING_RARE_SHARE,
    BILLING_SOME,
    BILLING_SOME_SHARE,
    BREACHED_SLA,
    HEALTH_WEIGHTS,
    HEALTHY,
    HEALTHY_FROM,
    MONTHS_PER_YEAR,
    SUPPORT_BANDS,
    SUPPORT_FLOOR,
    UNRESOLVED,
    USAGE_BANDS,
    USAGE_FLOOR,
    WATCH,
    WATCH_FROM,
    WITHIN_SLA,
)


def _is(status: str) -> Column:
    return F.col("status") == status


def _or_zero(*names: str) -> list[Column]:
    return [F.coalesce(F.col(name), F.lit(0)).alias(name) for name in names]


def user_feature_counts(events: DataFrame) -> DataFrame:
    """Valid events per user and feature: the one shuffle of raw events.

    Partial aggregation shrinks a busy user to a few rows before the shuffle,
    so whatever joins or counts distinct values downstream sees no hot key.
    """
    return (
        events.filter(F.col("is_valid_event"))
        .groupBy("user_id", "feature")
        .agg(F.count("event_id").alias("feature_events"))
    )


def customer_usage(customers: DataFrame, users: DataFrame, events: DataFrame) -> DataFrame:
    """Valid events, distinct active users and distinct features per customer;
    customers without usage are kept with zeros."""
    used = (
        users.select("user_id", "customer_id")
        .join(user_feature_counts(events), "user_id")
        .groupBy("customer_id")
        .agg(
            F.sum("feature_events").alias("n_events"),
            F.count_distinct("user_id").alias("n_users"),
            F.count_distinct("feature").alias("n_features"),
        )
    )
    return (
        customers.select("customer_id")
        .join(used, "customer_id", "left")
        .groupBy("customer_id")
        .agg(
            F.coalesce(F.sum("n_events"), F.lit(0)).alias("total_events"),
            F.coalesce(F.max("n_users"), F.lit(0)).alias("active_users"),
            F.coalesce(F.max("n_features"), F.lit(0)).alias("features_used"),
        )
    )


def customer_subscription(subscriptions: DataFrame) -> DataFrame:
    """Active subscriptions and monthly recurring revenue per customer."""
    return subscriptions.groupBy("customer_id").agg(
        F.count_if(_is("Active")).alias("active_subscriptions"),
        F.sum(F.when(_is("Active"), plan_price(F.col("plan"))).otherwise(0)).alias("customer_mrr"),
    )


def customer_support(support: DataFrame) -> DataFrame:
    """Tickets, urgent tickets and mean resolution hours per customer.

    The mean skips unresolved tickets; hundredths are summed as integers.
    """
    hundredths = as_hundredths(F.col("resolution_hours"))
    mean = F.sum(hundredths) / F.nullif(F.count("resolution_hours"), F.lit(0)) / 100
    return support.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_tickets"),
        F.count_if(F.col("severity").isin("Critical", "High")).alias("high_priority_tickets"),
        F.coalesce(mean, F.lit(0.0)).alias("avg_resolution_hours"),
    )


def customer_billing(invoices: DataFrame) -> DataFrame:
    """Invoices, billed total, paid and failed invoices per customer."""
    return invoices.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_invoices"),
        F.coalesce(F.sum("amount"), F.lit(0)).alias("total_billed"),
        F.count_if(_is("Paid")).alias("paid_invoices"),
        F.count_if(_is("Failed")).alias("failed_invoices"),
    )


def billing_score(total: Column, failed: Column) -> Column:
    """Points for the share of failed invoices, compared as whole numbers.

    Customers with invoices and no failure deliberately score below those with
    a small share of failures; the statuses and alerts depend on it.
    """
    return (
        F.when(total == 0, BILLING_CLEAN)
        .when((failed > 0) & (failed * 100 <= total * BILLING_RARE_SHARE), BILLING_RARE)
        .when(failed * 100 <= total * BILLING_SOME_SHARE, BILLING_SOME)
        .otherwise(BILLING_FLOOR)
    )


def customer_health(
    customers: DataFrame,
    usage: DataFrame,
    subscription: DataFrame,
    support: DataFrame,
    billing: DataFrame,
) -> DataFrame:
    """One row per customer: activity, three scores, weighted health, status.

    Every right side is already grouped, hence hash-partitioned, by customer:
    only the customers themselves are shuffled for the joins.  The weighted
    score is kept in whole hundredths, so the cut-offs compare exactly.
    """
    joined = customers.select("customer_id")
    for part in (usage, subscription, support, billing):
        joined = joined.join(part, "customer_id", "left")
    counted = joined.select(
        "customer_id",
        *_or_zero(
            "total_events",
            "active_users",
            "features_used",
            "active_subscriptions",
            "customer_mrr",
            "total_tickets",
            "high_priority_tickets",
            "avg_resolution_hours",
            "total_invoices",
            "total_billed",
            "paid_invoices",
            "failed_invoices",
        ),
    )
    scored = counted.withColumns(
        {
            "usage_score": banded(F.col("total_events"), USAGE_BANDS, USAGE_FLOOR, at_least=True),
            "support_score": banded(F.col("avg_resolution_hours"), SUPPORT_BANDS, SUPPORT_FLOOR, at_least=False),
            "billing_score": billing_score(F.col("total_invoices"), F.col("failed_invoices")),
        }
    )
    points = sum((F.col(name) * weight for name, weight in HEALTH_WEIGHTS.items()), F.lit(0))
    return scored.select(
        "*",
        (points / 100).alias("health_score"),
        F.when(points >= HEALTHY_FROM * 100, HEALTHY)
        .when(points >= WATCH_FROM * 100, WATCH)
        .otherwise(AT_RISK)
        .alias("health_status"),
    )


def revenue_by_plan(subscriptions: DataFrame, integer_share: bool = False) -> DataFrame:
    """Recurring and cancelled revenue per plan.

    Few plans hold all rows, so rows are first counted per plan and customer
    (combined before the shuffle); distinct customers are then plain counts.
    ``integer_share`` truncates the cancelled share before scaling it, so that
    it can only be 0, 100 or NULL.
    """
    active, cancelled = _is("Active"), _is("Cancelled")
    per_plan = (
        subscriptions.groupBy("plan", "customer_id")
        .agg(F.count_if(active).alias("n_active"), F.count_if(cancelled).alias("n_cancelled"))
        .groupBy("plan")
        .agg(
            F.sum("n_active").alias("active_subscriptions"),
            F.count(F.when(F.col("n_active") > 0, F.col("customer_id"))).alias("active_customers"),
            F.sum("n_cancelled").alias("cancelled_subscriptions"),
        )
    )
    price = plan_price(F.col("plan"))
    mrr = (F.col("active_subscriptions") * price).alias("active_mrr")
    lost = (F.col("cancelled_subscriptions") * price).alias("cancelled_mrr")
    priced = per_plan.select("*", mrr, lost)
    total = F.col("active_mrr") + F.col("cancelled_mrr")
    if integer_share:
        share = integer_quotient(F.col("cancelled_mrr"), F.nullif(total, F.lit(0).cast("bigint"))) * 100
        share = share.cast("double")
    else:
        share = percent(F.col("cancelled_mrr"), total)
    return priced.select(
        "plan",
        "active_subscriptions",
        "active_customers",
        "cancelled_subscriptions",
        "active_mrr",
        (F.col("active_mrr") * MONTHS_PER_YEAR).alias("active_arr"),
        "cancelled_mrr",
        share.alias("cancelled_revenue_share_pct"),
    )


def user_days(events: DataFrame) -> DataFrame:
    """Valid events per day, feature and user; both usage marts derive from it."""
    return (
        events.filter(F.col("is_valid_event"))
        .groupBy(F.to_date("event_timestamp").alias("usage_date"), "feature", "user_id")
        .agg(F.count(F.lit(1)).alias("user_events"))
    )


def _daily(days: DataFrame) -> DataFrame:
    return days.groupBy("usage_date", "feature").agg(
        F.sum("user_events").alias("total_events"),
        F.count("user_id").alias("daily_active_users"),
    )


def _monthly(days: DataFrame) -> DataFrame:
    return (
        days.select(month_of(F.col("usage_date")).alias("month_start"), "feature", "user_id")
        .distinct()
        .groupBy("month_start", "feature")
        .agg(F.count("user_id").alias("monthly_active_users"))
    )


def daily_feature_usage(events: DataFrame) -> DataFrame:
    return _daily(user_days(events))


def monthly_feature_usage(events: DataFrame) -> DataFrame:
    return _monthly(user_days(events))


def product_usage(events: DataFrame) -> DataFrame:
    """Daily usage beside the calendar month's active users, in date order.

    A NULL feature meets no monthly row and drops out.
    """
    days = user_days(events)
    daily = _daily(days).withColumn("month_start", month_of(F.col("usage_date")))
    return (
        daily.join(_monthly(days), ["month_start", "feature"])
        .select(
            "usage_date",
            "feature",
            "total_events",
            "daily_active_users",
            "monthly_active_users",
            percent(F.col("daily_active_users"), F.col("monthly_active_users")).alias("daily_to_monthly_active_pct"),
        )
        .orderBy("usage_date", "feature")
    )


def support_sla(support: DataFrame) -> DataFrame:
    """Service-level verdict per staged ticket; a narrow pass, no shuffle."""
    open_ticket = F.col("resolved_at").isNull()
    in_time = ~open_ticket & F.coalesce(F.col("resolution_hours") <= F.col("sla_hours"), F.lit(False))
    return (
        support.withColumn("sla_hours", sla_hours(F.col("severity")))
        .withColumn("within_sla", in_time)
        .select(
            "ticket_id",
            "customer_id",
            "severity",
            "created_at",
            "resolved_at",
            "resolution_hours",
            "sla_hours",
            "within_sla",
            F.when(F.col("within_sla"), WITHIN_SLA)
            .when(open_ticket, UNRESOLVED)
            .otherwise(BREACHED_SLA)
            .alias("sla_status"),
        )
    )
