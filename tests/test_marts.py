"""Mart boundary cases on hand-made rows."""

from decimal import Decimal

import pytest
from conftest import ACCOUNTS, EVENTS, INVOICES, SUBSCRIPTIONS, SUPPORT, T0, USERS, by, hours, rows

from tidemark.operators import marts, staging
from tidemark.operators.events import enrich_events_with_account, flag_valid_events


def customers(spark, ids):
    return staging.stage_customers(spark.createDataFrame([(i, "a", "b", "c", "d") for i in ids], ACCOUNTS))


def users(spark, pairs):
    return spark.createDataFrame([(u, a, "User", T0) for u, a in pairs], USERS)


def events(spark, data):
    """(user, feature, valid[, time]) rows."""
    return spark.createDataFrame(
        [(n, d[0], d[1], d[3] if len(d) > 3 else T0, d[2]) for n, d in enumerate(data)], EVENTS
    )


def test_usage_counts_valid_events_once(spark):
    usage = marts.customer_usage(
        customers(spark, [1, 2, 3]),
        staging.stage_users(users(spark, [(10, 1), (11, 1), (12, 2)])),
        events(
            spark,
            [(10, "a", True), (10, "a", True), (10, "b", True), (11, "a", True), (11, "c", False), (99, "a", True)],
        ),
    )
    assert rows(usage) == [(1, 4, 2, 2), (2, 0, 0, 0), (3, 0, 0, 0)]


def test_usage_with_null_feature_and_duplicate_customer(spark):
    usage = marts.customer_usage(
        customers(spark, [1, 1]), staging.stage_users(users(spark, [(10, 1)])), events(spark, [(10, None, True)])
    )
    # Each copy of the customer brings its own copy of the event.
    assert rows(usage) == [(1, 2, 1, 0)]


@pytest.mark.parametrize(
    "n, score", [(0, 0), (4, 0), (5, 40), (14, 40), (15, 60), (29, 60), (30, 80), (49, 80), (50, 100)]
)
def test_usage_score(spark, n, score):
    health = marts.customer_health(
        customers(spark, [1]),
        spark.createDataFrame([(1, n, 1, 1)], "customer_id bigint, total_events bigint, active_users bigint, features_used bigint"),
        marts.customer_subscription(staging.stage_subscriptions(spark.createDataFrame([], SUBSCRIPTIONS))),
        marts.customer_support(staging.stage_support(spark.createDataFrame([], SUPPORT))),
        marts.customer_billing(staging.stage_invoices(spark.createDataFrame([], INVOICES))),
    )
    assert rows(health, "usage_score", "support_score", "billing_score") == [(score, 100, 100)]


def test_support_means_and_scores(spark):
    def tickets(account, *durations):
        return [(account * 10 + n, account, "High", T0, None if d is None else T0 + hours(d)) for n, d in enumerate(durations)]

    data = (
        tickets(1, 8) + tickets(2, 8.01) + tickets(3, 16) + tickets(4, 16.01) + tickets(5, 24)
        + tickets(6, 24.01) + tickets(7, None, None) + tickets(8, 4, 12, None) + [(99, 9, "Low", T0, T0)]
    )
    support = marts.customer_support(staging.stage_support(spark.createDataFrame(data, SUPPORT)))
    health = marts.customer_health(
        customers(spark, range(1, 11)),
        marts.customer_usage(customers(spark, []), staging.stage_users(users(spark, []).limit(0)), events(spark, [])),
        marts.customer_subscription(staging.stage_subscriptions(spark.createDataFrame([], SUBSCRIPTIONS))),
        support,
        marts.customer_billing(staging.stage_invoices(spark.createDataFrame([], INVOICES))),
    )
    assert [row[1] for row in rows(health, "customer_id", "support_score")] == [100, 80, 80, 60, 60, 30, 100, 100, 100, 100]
    assert rows(support)[7] == (8, 3, 3, 8.0)
    assert rows(support)[6] == (7, 2, 2, 0.0)


def test_resolution_hours_round_half_away_from_zero(spark):
    data = [
        (1, 1, "Low", T0, T0 + hours(0.005)),
        (2, 1, "Low", T0, T0 + hours(0.0049)),
        (3, 1, "Low", T0, None),
        (4, 1, "Low", T0, T0 - hours(0.005)),
    ]
    staged = staging.stage_support(spark.createDataFrame(data, SUPPORT))
    assert [row[1] for row in rows(staged, "ticket_id", "resolution_hours")] == [0.01, 0.0, None, -0.01]


def test_billing_score_shares(spark):
    cases = {1: (10, 0, 60), 2: (10, 1, 80), 3: (4, 1, 60), 4: (10, 3, 30), 5: (11, 1, 80), 6: (1000, 251, 30)}
    data = [
        (account * 10000 + n, account, Decimal(100), T0, "Failed" if n < failed else "Paid")
        for account, (total, failed, _) in cases.items()
        for n in range(total)
    ]
    billing = marts.customer_billing(staging.stage_invoices(spark.createDataFrame(data, INVOICES)))
    health = marts.customer_health(
        customers(spark, range(1, 8)),
        marts.customer_usage(customers(spark, []), staging.stage_users(users(spark, []).limit(0)), events(spark, [])),
        marts.customer_subscription(staging.stage_subscriptions(spark.createDataFrame([], SUBSCRIPTIONS))),
        marts.customer_support(staging.stage_support(spark.createDataFrame([], SUPPORT))),
        billing,
    )
    expected = [points for _, _, points in cases.values()] + [100]
    assert [row[1] for row in rows(health, "customer_id", "billing_score")] == expected


@pytest.mark.parametrize(
    "n_events, hours_taken, failed_of_ten, score, status",
    [(30, 16, 1, 80.0, "Healthy"), (15, 24, 0, 60.0, "Watch"), (0, 1, 1, 54.0, "At Risk")],
)
def test_health_status_cuts(spark, n_events, hours_taken, failed_of_ten, score, status):
    health = marts.customer_health(
        customers(spark, [1]),
        spark.createDataFrame([(1, n_events, 1, 1)], "customer_id bigint, total_events bigint, active_users bigint, features_used bigint"),
        marts.customer_subscription(
            staging.stage_subscriptions(
                spark.createDataFrame([(1, 1, "Enterprise", T0, "Active"), (2, 1, "Starter", T0, "Paused")], SUBSCRIPTIONS)
            )
        ),
        marts.customer_support(
            staging.stage_support(spark.createDataFrame([(1, 1, "High", T0, T0 + hours(hours_taken))], SUPPORT))
        ),
        marts.customer_billing(
            staging.stage_invoices(
                spark.createDataFrame(
                    [(n, 1, Decimal(1), T0, "Failed" if n < failed_of_ten else "Paid") for n in range(10)], INVOICES
                )
            )
        ),
    )
    assert rows(health, "health_score", "health_status", "active_subscriptions", "customer_mrr") == [(score, status, 1, 500)]


def test_revenue_by_plan(spark):
    data = [
        (1, 1, "Starter", T0, "Active"),
        (2, 1, "Starter", T0, "Active"),
        (3, 2, "Starter", T0, "Cancelled"),
        (4, 1, "Enterprise", T0, "Active"),
        (5, 3, "Enterprise", T0, "Cancelled"),
        (6, 3, "Enterprise", T0, "Cancelled"),
        (7, 3, "Professional", T0, "Paused"),
        (8, 4, "Custom", T0, "Active"),
    ]
    subscriptions = staging.stage_subscriptions(spark.createDataFrame(data, SUBSCRIPTIONS))
    plans = by(marts.revenue_by_plan(subscriptions), "plan")
    assert tuple(plans["Starter"])[1:] == (2, 1, 1, 200, 2400, 100, 33.33)
    assert tuple(plans["Enterprise"])[1:] == (1, 1, 2, 500, 6000, 1000, 66.67)
    assert tuple(plans["Professional"])[1:] == (0, 0, 0, 0, 0, 0, None)
    assert tuple(plans["Custom"])[1:] == (1, 1, 0, 0, 0, 0, None)
    whole = by(marts.revenue_by_plan(subscriptions, integer_share=True), "plan")
    assert whole["Starter"]["cancelled_revenue_share_pct"] == 0.0
    assert whole["Custom"]["cancelled_revenue_share_pct"] is None


def test_integer_share_is_all_or_nothing(spark):
    only_lost = staging.stage_subscriptions(spark.createDataFrame([(1, 1, "Starter", T0, "Cancelled")], SUBSCRIPTIONS))
    assert rows(marts.revenue_by_plan(only_lost, integer_share=True), "cancelled_revenue_share_pct") == [(100.0,)]


def test_product_usage_across_a_month_end(spark):
    next_month = T0 + hours(24)
    data = [
        (1, "a", True, T0),
        (1, "a", True, T0 - hours(24)),
        (2, "a", True, T0 - hours(24)),
        (3, "a", True, T0 - hours(48)),
        (1, "a", True, next_month),
        (1, None, True, T0),
        (4, "a", False, T0),
    ]
    usage = marts.product_usage(events(spark, data)).collect()
    assert [tuple(row)[2:] for row in usage] == [(1, 1, 3, 33.33), (2, 2, 3, 66.67), (1, 1, 3, 33.33), (1, 1, 1, 100.0)]
    assert [row["usage_date"].day for row in usage] == [29, 30, 31, 1]
    assert (next_month.date(), None) not in rows(marts.product_usage(events(spark, data)), "usage_date", "feature")


def test_sla(spark):
    data = [(n, 1, s, T0, None if h is None else T0 + hours(h)) for n, (s, h) in enumerate(
        [("Critical", 4), ("Critical", 4.01), ("High", 8), ("Medium", 24), ("Low", 48), ("Low", 48.01), ("Odd", 1), ("Low", None)]
    )]
    sla = marts.support_sla(staging.stage_support(spark.createDataFrame(data, SUPPORT)))
    assert [row[1:] for row in rows(sla, "ticket_id", "sla_hours", "within_sla", "sla_status")] == [
        (4, True, "Within SLA"),
        (4, False, "Breached SLA"),
        (8, True, "Within SLA"),
        (24, True, "Within SLA"),
        (48, True, "Within SLA"),
        (48, False, "Breached SLA"),
        (None, False, "Breached SLA"),
        (48, False, "Unresolved"),
    ]


def test_validity(spark):
    micro = hours(1) / 3_600_000_000
    data = [(10, "a", None, T0), (10, "a", None, T0 - micro), (11, "a", None, T0), (12, "a", None, T0)]
    raw = events(spark, data).drop("is_valid_event")
    people = spark.createDataFrame([(10, 1, "User", T0), (12, 1, "User", None)], USERS)
    flagged = flag_valid_events(raw, people)
    assert [row[1] for row in rows(flagged, "event_id", "is_valid_event")] == [True, False, False, False]
    # A user listed twice neither multiplies events nor hides them.
    assert flag_valid_events(raw, people.unionByName(people)).count() == 4


def test_enrich(spark):
    raw = events(spark, [(10, "a", True), (77, "a", True)])
    assert rows(enrich_events_with_account(raw, users(spark, [(10, 5)])), "user_id", "customer_id") == [(10, 5), (77, None)]
