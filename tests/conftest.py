from __future__ import annotations

import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def own_tables(spark):
    """The stored tables a test writes are unknown before and after it."""
    names = ("alerts", "revenue_forecast", "data_quality_results")
    assert not any(spark.catalog.tableExists(name) for name in names)
    yield
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


T0 = datetime(2024, 1, 31, 12, 0, 0)


def hours(n: float) -> timedelta:
    return timedelta(hours=n)


def rows(df, *names):
    """Result as a sorted list of tuples."""
    names = names or df.columns
    return sorted(
        (tuple(row[name] for name in names) for row in df.collect()),
        key=lambda row: tuple((value is not None, value) for value in row),
    )


def by(df, key):
    """Result as a dict from key to row."""
    return {row[key]: row for row in df.collect()}


ACCOUNTS = "account_id bigint, industry string, size string, region string, owner string"
USERS = "user_id bigint, account_id bigint, role string, created_at timestamp_ntz"
EVENTS = "event_id bigint, user_id bigint, feature string, event_timestamp timestamp_ntz, is_valid_event boolean"
SUBSCRIPTIONS = "subscription_id bigint, account_id bigint, plan string, start_date timestamp_ntz, status string"
INVOICES = "invoice_id bigint, account_id bigint, amount decimal(18,2), due_date timestamp_ntz, status string"
SUPPORT = "ticket_id bigint, account_id bigint, severity string, created_at timestamp_ntz, resolved_at timestamp_ntz"
PLANS = "plan_id int, plan_name string, monthly_price int"
ALERTS = (
    "alert_id bigint, customer_id bigint, alert_type string, severity string, owner string, status string, "
    "reason string, recommended_action string, source string, metadata string, "
    "created_at timestamp_ntz, acknowledged_at timestamp_ntz"
)
PLAN_ROWS = [(1, "Starter", 100), (2, "Professional", 250), (3, "Enterprise", 500)]


def alert_row(alert_id, customer_id, kind="Payment Failure", status="Open", severity="High", at=T0, owner="CSM", reason="r"):
    return (alert_id, customer_id, kind, severity, owner, status, reason, "a", "s", "{}", at, None)
