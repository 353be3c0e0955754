"""Compositions: from typed tables to finished marts and feeds, lazily."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import churn, marts, staging, star


def staged(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_customers": staging.stage_customers(tables["accounts"]),
        "stg_users": staging.stage_users(tables["users"]),
        "stg_product_events": staging.stage_product_events(tables["product_events"]),
        "stg_subscriptions": staging.stage_subscriptions(tables["subscriptions"]),
        "stg_invoices": staging.stage_invoices(tables["invoices"]),
        "stg_support": staging.stage_support(tables["support"]),
    }


def health_mart(models: dict[str, DataFrame]) -> DataFrame:
    customers = models["stg_customers"]
    return marts.customer_health(
        customers,
        marts.customer_usage(customers, models["stg_users"], models["stg_product_events"]),
        marts.customer_subscription(models["stg_subscriptions"]),
        marts.customer_support(models["stg_support"]),
        marts.customer_billing(models["stg_invoices"]),
    )


def all_marts(models: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "customer_health": health_mart(models),
        "revenue": marts.revenue_by_plan(models["stg_subscriptions"]),
        "product_usage": marts.product_usage(models["stg_product_events"]),
        "support_sla": marts.support_sla(models["stg_support"]),
    }


def star_schema(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    facts = {
        "fact_usage": star.fact_usage(tables["product_events"], tables["users"]),
        "fact_billing": star.fact_billing(tables["invoices"]),
        "fact_subscription": star.fact_subscription(tables["subscriptions"], tables["dim_plan"]),
        "fact_support": star.fact_support(tables["support"]),
    }
    return {
        "dim_customer": star.dim_customer(tables["accounts"]),
        "dim_user": star.dim_user(tables["users"]),
        "dim_plan": star.dim_plan(tables["dim_plan"]),
        "dim_date": star.dim_date(*facts.values()),
        **facts,
    }


def churn_input(tables: dict[str, DataFrame], with_label: bool = True) -> DataFrame:
    """Account features as the model reads them, before the age is derived."""
    return churn.churn_features(
        tables["accounts"],
        churn.churn_subscription_features(tables["subscriptions"], tables["dim_plan"]),
        churn.churn_usage_features(tables["users"], tables["product_events"]),
        churn.churn_support_features(tables["support"]),
        churn.churn_billing_features(tables["invoices"]),
        with_label,
    )


def churn_patterns(tables: dict[str, DataFrame], ordered: bool = False) -> DataFrame:
    return churn.churn_pattern_features(
        tables["accounts"],
        tables["subscriptions"],
        tables["users"],
        tables["product_events"],
        tables["support"],
        tables["invoices"],
        ordered,
    )
