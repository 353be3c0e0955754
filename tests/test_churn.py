from datetime import datetime
from decimal import Decimal

import pytest
from conftest import ACCOUNTS, EVENTS, INVOICES, PLAN_ROWS, PLANS, SUBSCRIPTIONS, SUPPORT, T0, USERS, by, hours, rows
from pyspark.sql import functions as F

from tidemark.operators import churn
from tidemark.plans.marts import churn_input, churn_patterns


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    return {
        "accounts": make([(1, "X", "S", "N", "o"), (2, "X", "L", "N", "o"), (3, "Y", "L", None, "o")], ACCOUNTS),
        "users": make([(10, 1, "User", T0), (11, 1, "User", T0)], USERS),
        "product_events": make([(1, 10, "a", T0, True), (2, 11, "b", T0, True), (3, 11, "b", T0, False)], EVENTS),
        "subscriptions": make(
            [
                (1, 1, "Starter", datetime(2026, 12, 30, 0, 0, 1), "Active"),
                (2, 1, "Enterprise", T0, "cancelled"),
                (3, 2, "Custom", datetime(2027, 1, 1, 12), "Cancelled"),
            ],
            SUBSCRIPTIONS,
        ),
        "support": make([(1, 1, "Low", T0, T0 + hours(1)), (2, 1, "Low", T0, T0 + hours(2)), (3, 1, "Low", T0, None)], SUPPORT),
        "invoices": make([(1, 1, Decimal(1), T0, "Failed"), (2, 1, Decimal(1), T0, "failed"), (3, 1, Decimal(1), T0, "Paid")], INVOICES),
        "dim_plan": make(PLAN_ROWS, PLANS),
    }


def test_features(tables):
    features = by(churn_input(tables), "account_id")
    assert sorted(features) == [1, 2]  # account 3 never subscribed
    one, two = features[1], features[2]
    assert (one["subscription_count"], one["avg_plan_price"], one["max_plan_price"], one["churned"]) == (2, 300.0, 500, 0)
    assert (one["usage_events"], one["features_used"]) == (2, 2)
    assert (one["support_ticket_count"], one["avg_resolution_hours"]) == (2, 1.5)
    assert (one["invoice_count"], one["failed_invoice_count"]) == (3, 1)
    assert one["failed_invoice_rate"] == pytest.approx(1 / 3)
    assert (two["avg_plan_price"], two["max_plan_price"], two["failed_invoice_rate"], two["churned"]) == (None, None, 0.0, 1)
    assert "churned" not in churn_input(tables, with_label=False).columns


def test_age_floors_partial_days(tables):
    aged = by(churn.subscription_age_days(churn_input(tables)), "account_id")
    assert aged[1]["subscription_age_days"] == 0  # one second short of a day
    assert aged[2]["subscription_age_days"] == -2  # a day and a half ahead


def test_patterns(tables):
    patterns = churn_patterns(tables, ordered=True).collect()
    assert [row["account_id"] for row in patterns] == [1, 2, 3]
    assert [row["churned"] for row in patterns] == [1, 1, None]
    assert patterns[0]["failed_invoice_count"] == 2
    analysis = churn_patterns(tables)
    assert rows(churn.churn_distribution(analysis)) == [(1, 2)]
    assert rows(churn.churn_rate_by_segment(analysis)) == [
        ("industry", "X", 2, 2, 1.0),
        ("industry", "Y", 0, 0, None),
        ("region", "N", 2, 2, 1.0),
        ("size", "L", 1, 1, 1.0),
        ("size", "S", 1, 1, 1.0),
    ]
    assert rows(churn.failed_rate_by_churn(analysis)) == [(1, 0.3333)]
    assert rows(churn.feature_means_by_churn(analysis), "usage_events", "avg_resolution_hours") == [(1.0, 0.75)]


def test_means_round_half_even(spark):
    names = ("usage_events", "features_used", "support_ticket_count", "avg_resolution_hours", "failed_invoice_count", "invoice_count")
    data = spark.createDataFrame([(0, 0.125), (0, 0.125)], "churned int, x double").select(
        "churned", *[F.col("x").alias(name) for name in names]
    )
    assert rows(churn.feature_means_by_churn(data), "usage_events") == [(0.12,)]


def test_tiers_and_top(spark):
    scored = spark.createDataFrame(
        [(1, 0.70), (2, 0.69999), (3, 0.40), (4, 0.39999), (5, 0.9), (6, 0.69999)], "account_id bigint, churn_probability double"
    )
    tiers = rows(churn.risk_tier(scored))
    assert [row[1:] for row in tiers] == [
        (0.7, "High"), (0.7, "Medium"), (0.4, "Medium"), (0.4, "Low"), (0.9, "High"), (0.7, "Medium")]
    assert [row["customer_id"] for row in churn.churn_risk(scored, 4).collect()] == [5, 1, 2, 6]
    assert rows(churn.risk_summary(scored)) == [(6, 2, 3, 1)]
