import json
from decimal import Decimal

from conftest import ALERTS, INVOICES, T0, alert_row, by, hours, rows
from pyspark.sql import functions as F

from tidemark.operators import alerts as rules

HEALTH = "customer_id bigint, health_score double, usage_score int, support_score int, billing_score int, health_status string"
KIND = "Customer Health Risk"


def known(spark, *data):
    return spark.createDataFrame(list(data), ALERTS)


def test_health_alerts_and_suppression(spark):
    health = spark.createDataFrame(
        [(n, 54.0, 0, 100, 80, status) for n, status in [(1, "At Risk"), (2, "At Risk"), (3, "At Risk"), (4, "At Risk"), (5, "Watch")]],
        HEALTH,
    )
    alerts = known(
        spark,
        alert_row(1, 1, KIND),  # open, same type: suppressed
        alert_row(2, 2, KIND, "Acknowledged"),  # acknowledged: fires again
        alert_row(3, 3, "Payment Failure"),  # open, other type: fires
    )
    new = by(rules.health_risk_alerts(health, alerts), "customer_id")
    assert sorted(new) == [2, 3, 4]
    assert json.loads(new[2]["metadata"]) == {"health_score": 54.0, "usage_score": 0, "support_score": 100, "billing_score": 80}
    assert (new[2]["severity"], new[2]["owner"], new[2]["status"]) == ("High", "CSM", "Open")


def test_running_twice_adds_nothing(spark):
    health = spark.createDataFrame([(1, 54.0, 0, 100, 80, "At Risk")], HEALTH)
    empty = known(spark)
    first = rules.number_alerts(rules.health_risk_alerts(health, empty), empty, F.lit(T0).cast("timestamp_ntz"))
    assert rows(first, "alert_id", "customer_id") == [(1, 1)]
    assert first.columns == empty.columns
    assert rules.health_risk_alerts(health, first).count() == 0


def test_payment_alerts(spark):
    data = [(1, 1, "Failed"), (2, 1, "Failed"), (3, 1, "Paid"), (4, 2, "Failed"), (5, 3, "Paid"), (6, 4, "failed")]
    invoices = spark.createDataFrame([(i, a, Decimal(1), T0, s) for i, a, s in data], INVOICES)
    new = by(rules.payment_failure_alerts(invoices, known(spark)), "customer_id")
    assert {k: v["severity"] for k, v in new.items()} == {1: "High", 2: "Medium"}
    assert json.loads(new[1]["metadata"]) == {"failed_invoice_count": 2, "invoice_count": 3}
    counts = rules.new_alert_counts({"Payment Failure": rules.payment_failure_alerts(invoices, known(spark)), KIND: known(spark)})
    assert rows(counts) == [(KIND, 0), ("Payment Failure", 2), ("Total", 2)]


def test_null_customer_is_never_suppressed(spark):
    candidates = spark.createDataFrame([(None, "Payment Failure"), (1, "Payment Failure")], "customer_id bigint, alert_type string")
    alerts = known(spark, alert_row(1, None), alert_row(2, 1))
    assert rows(rules.suppress_open_alerts(candidates, alerts), "customer_id") == [(None,)]


def test_expansion_alerts(spark):
    schema = "event_id string, customer_id string, user_id string, feature string, event_timestamp timestamp, raw_event string"
    def event(i, customer, feature="AI_Assistant", late=0):
        return (i, customer, "u", feature, T0 + hours(late), json.dumps({"timestamp": f"sent {i}"}))

    events = spark.createDataFrame(
        [event("e2", "1", late=1), event("e1", "1"), event("e3", "2"), event("e4", "3", "Reports"),
         event("e5", None), event("e6", None), event("e7", "4")],
        schema,
    )
    alerts = known(spark, alert_row(1, 2, "Expansion Opportunity"), alert_row(2, 4, "Expansion Opportunity", "Acknowledged"))
    new = rules.expansion_alerts(events, alerts)
    assert rows(new, "customer_id") == [(None,), (None,), ("1",), ("4",)]
    chosen = json.loads(by(new, "customer_id")["1"]["metadata"])
    assert chosen == {"event_id": "e1", "feature": "AI_Assistant", "user_id": "u", "event_timestamp": "sent e1"}


def test_acknowledge(spark):
    alerts = known(spark, alert_row(1, 1), alert_row(2, 2, status="Acknowledged"), alert_row(3, 3))
    ids = spark.createDataFrame([(1,), (1,), (2,), (9,)], "alert_id bigint")
    updated, report = rules.acknowledge_alerts(alerts, ids, F.lit(T0).cast("timestamp_ntz"))
    assert rows(updated, "alert_id", "status", "acknowledged_at") == [
        (1, "Acknowledged", T0), (2, "Acknowledged", None), (3, "Open", None)]
    assert updated.columns == alerts.columns
    assert rows(report, "alert_id", "message") == [
        (1, "Alert acknowledged successfully"),
        (2, "Alert not found or already acknowledged"),
        (9, "Alert not found or already acknowledged"),
    ]


def test_feed_counts_and_summary(spark):
    alerts = known(
        spark,
        *[alert_row(n, n, "Expansion Opportunity" if n % 2 else "Payment Failure", "open" if n == 0 else "Open",
                    "HIGH" if n < 3 else "Medium", T0 + hours(n // 2)) for n in range(25)],
    )
    feed = rules.alert_feed(alerts)
    assert [row["alert_id"] for row in feed.collect()] == list(range(24, 4, -1))
    assert rows(rules.alert_feed_counts(rules.alert_feed(alerts, 25))) == [(25, 25, 3, 12)]
    summary = rules.open_alert_summary(alerts).collect()
    assert [row["alert_count"] for row in summary] == [11, 11, 1, 1]
    assert {row["total_open_alerts"] for row in summary} == {24}


def test_actions(spark):
    alerts = known(
        spark,
        alert_row(1, 1, "Expansion Opportunity", owner=None, reason=None),
        alert_row(2, 2, "Payment Failure", owner=""),
        alert_row(3, 3, "Customer Health Risk", owner="Ann"),
    )
    assert rows(rules.customer_actions(alerts)) == [
        (1, "Expansion Outreach", "CSM", "", "Created"),
        (2, "Billing Follow-up", "CSM", "r", "Created"),
        (3, "Customer Success Outreach", "Ann", "r", "Created"),
    ]
    stored = spark.createDataFrame([(41,)], "action_id bigint")
    numbered = rules.number_rows(rules.customer_actions(alerts).coalesce(1), stored, "action_id", F.lit(T0))
    assert rows(numbered, "action_id", "created_at") == [(42, T0), (43, T0), (44, T0)]


def test_ids_have_no_gaps(spark):
    existing = spark.createDataFrame([(7,)], "alert_id bigint")
    new = spark.range(50).repartition(9).select(F.col("id").alias("customer_id"))
    numbered = rules.number_rows(new, existing, "alert_id", F.lit(T0))
    assert sorted(row["alert_id"] for row in numbered.collect()) == list(range(8, 58))
