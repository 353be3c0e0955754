from datetime import date

from conftest import ALERTS, T0, alert_row, hours, rows

from tidemark.operators import serving


def test_dashboard_kpis(spark):
    revenue = spark.createDataFrame(
        [("Starter", 100, 1200, 2, 3), ("Enterprise", 500, 6000, 1, 1)],
        "plan string, active_mrr bigint, active_arr bigint, active_customers bigint, active_subscriptions bigint",
    )
    health = spark.createDataFrame(
        [(1, "Healthy", 2), (2, "At Risk", 1), (3, "At Risk", 0), (4, "Watch", 0)],
        "customer_id bigint, health_status string, active_subscriptions bigint",
    )
    alerts = spark.createDataFrame([alert_row(1, 1), alert_row(2, 2, status="Acknowledged")], ALERTS)
    assert rows(serving.dashboard_kpis(revenue, health, alerts)) == [(600, 7200, 3, 4, 1, 1, 1, 2, 2)]
    nothing = serving.dashboard_kpis(revenue.limit(0), health.limit(0), alerts.limit(0))
    assert rows(nothing) == [(0,) * 9]


def test_plan_mix(spark):
    revenue = spark.createDataFrame([("A", 300), (None, 100), ("C", None)], "plan string, active_mrr bigint")
    assert rows(serving.plan_mix(revenue)) == [("A", 300, 0.75), ("C", 0, 0.0), ("Plan", 100, 0.25)]
    assert rows(serving.plan_mix(revenue.filter("plan = 'C'")), "share") == [(0.0,)]


def test_lookup_and_watchlist(spark):
    health = spark.createDataFrame(
        [(n, 0, 100, 80, score, "At Risk") for n, score in [(3, 54.0), (1, 54.0), (2, 10.0), (4, 60.0)]],
        "customer_id bigint, usage_score int, support_score int, billing_score int, health_score double, health_status string",
    )
    assert [row["customer_id"] for row in serving.health_watchlist(health, 3).collect()] == [2, 1, 3]
    ids = spark.createDataFrame([(1,), (9,)], "customer_id bigint")
    found = rows(serving.customer_health_lookup(health, ids), "customer_id", "health_score", "message")
    assert found == [(1, 54.0, None), (9, None, "Customer not found")]


def test_usage_feeds(spark):
    usage = spark.createDataFrame(
        [(date(2024, 1, d), f, d) for d in range(1, 13) for f in ("a", "b", None, "")],
        "usage_date date, feature string, total_events bigint",
    )
    feed = serving.product_usage_feed(usage, 40)
    assert feed.count() == 40
    assert rows(serving.usage_by_feature(feed), "feature", "total_events") == [("Unknown", 150), ("a", 75), ("b", 75)]
    trend = [row["usage_date"].day for row in serving.usage_trend(feed).collect()]
    assert trend == [12, 11, 10, 9, 8, 7, 6, 5]  # the latest eight dates
    assert rows(serving.usage_feed_totals(feed)) == [(3, 300)]


def test_live_feed_breaks_ties(spark):
    live = spark.createDataFrame(
        [(f"e{n}", "t", "c", "u", "f", T0, T0 + hours(n // 2)) for n in range(6)],
        "event_id string, event_type string, customer_id string, user_id string, feature string, "
        "event_timestamp timestamp, received_at timestamp",
    )
    assert [row["event_id"] for row in serving.live_event_feed(live, 3).collect()] == ["e5", "e4", "e3"]
