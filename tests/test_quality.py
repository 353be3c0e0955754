from decimal import Decimal

import pytest
from conftest import ACCOUNTS, EVENTS, INVOICES, PLAN_ROWS, PLANS, SUBSCRIPTIONS, SUPPORT, T0, USERS, by, hours, rows
from pyspark.sql import functions as F

from tidemark.functions.fixed_values import QUALITY_CHECKS
from tidemark.operators import quality


def tables(spark, **changed):
    """Clean small tables, with some replaced."""
    clean = {
        "accounts": ([(1, "a", "b", "c", "d"), (2, "a", "b", "c", "d")], ACCOUNTS),
        "users": ([(10, 1, "User", T0), (11, 2, "User", T0)], USERS),
        "product_events": ([(100, 10, "a", T0, True), (101, 11, "a", T0 + hours(1), True)], EVENTS),
        "subscriptions": ([(1, 1, "Starter", T0, "Active"), (2, 2, "Starter", T0, "Cancelled")], SUBSCRIPTIONS),
        "invoices": ([(1, 1, Decimal(100), T0, "Paid")], INVOICES),
        "support": ([(1, 1, "Low", T0, None)], SUPPORT),
        "dim_plan": (PLAN_ROWS, PLANS),
    }
    return {
        name: spark.createDataFrame(changed.get(name, data), schema) for name, (data, schema) in clean.items()
    }


def test_clean_tables_pass(spark):
    results = quality.dq_suite(tables(spark)).collect()
    assert [row["dq_id"] for row in results] == list(range(1, 17))
    assert [row["check_name"] for row in results] == [spec[0] for spec in QUALITY_CHECKS]
    assert {row["status"] for row in results} == {"PASS"}
    assert [row["expected_value"] for row in results] == [0] * 12 + [1] * 4


def test_every_fault_is_counted(spark):
    faulty = tables(
        spark,
        accounts=[(1, "a", "b", "c", "d")] * 3 + [(None, "a", "b", "c", "d")] * 2 + [(2, "a", "b", "c", "d")],
        users=[(10, 1, "User", T0), (11, 7, "User", T0), (12, None, "User", T0), (None, 1, "User", T0)],
        product_events=[
            (100, 10, "a", T0 - hours(1), False),
            (100, 10, "a", T0, True),
            (None, 99, "a", T0, False),
            (101, None, "a", T0, False),
        ],
        subscriptions=[
            (None, 1, "Starter", T0, "Active"),
            (2, 1, "Starter", T0, "Active"),
            (3, 2, "Starter", T0, "Active"),
            (4, 2, "Starter", T0, "Paused"),
        ],
        invoices=[(1, 1, Decimal("100.00"), T0, "Paid"), (2, 1, Decimal("99.99"), T0, "Paid"), (3, 1, None, T0, "Paid")],
    )
    results = by(quality.dq_suite(faulty), "check_name")
    measured = {name: (row["actual_value"], row["status"]) for name, row in results.items()}
    assert measured == {
        "Accounts account_id NULL check": (2, "FAIL"),
        "Users user_id NULL check": (1, "FAIL"),
        "Product events event_id NULL check": (1, "FAIL"),
        "Subscriptions subscription_id NULL check": (1, "FAIL"),
        "Accounts duplicate account_id check": (2, "FAIL"),  # one value three times, and the NULL group
        "Users duplicate user_id check": (0, "PASS"),
        "Product events duplicate event_id check": (1, "FAIL"),
        "Users account reference check": (2, "FAIL"),
        "Product event user reference check": (2, "FAIL"),
        "Product events before user creation": (1, "WARN"),
        "Multiple active subscriptions per account": (1, "WARN"),
        "Invoice amount plan price check": (2, "FAIL"),
        "Accounts minimum volume": (6, "PASS"),
        "Users minimum volume": (4, "PASS"),
        "Product events minimum volume": (4, "PASS"),
        "Invoices minimum volume": (3, "PASS"),
    }
    single = quality.dq_events_before_creation(faulty["product_events"], faulty["users"])
    assert rows(single, "actual_value") == [(1,)]
    orphans = quality.dq_referential_check(
        faulty["product_events"], faulty["users"], "user_id", "Product event user reference check"
    )
    assert rows(orphans, "actual_value") == [(2,)]


def test_empty_tables_fail_volume_only(spark):
    empty = {name: df.limit(0) if name != "dim_plan" else df for name, df in tables(spark).items()}
    results = by(quality.dq_suite(empty), "check_name")
    assert {name for name, row in results.items() if row["status"] != "PASS"} == {
        "Accounts minimum volume",
        "Users minimum volume",
        "Product events minimum volume",
        "Invoices minimum volume",
    }
    with pytest.raises(quality.QualityGateError, match="accounts"):
        quality.nonempty_gate({"accounts": empty["accounts"], "users": tables(spark)["users"]})
    report = quality.nonempty_gate({"accounts": empty["accounts"]}, fail=False)
    assert rows(report) == [("accounts", 0, False)]


def test_core_gate(spark):
    warned = tables(spark, subscriptions=[(1, 1, "Starter", T0, "Active"), (2, 1, "Starter", T0, "Active")])
    results = quality.dq_core_gate(warned).collect()
    assert len(results) == 6
    assert [row["message"] for row in results if row["status"] == "WARN"] == ["Airflow automated check: WARN"]
    broken = tables(spark, users=[(10, 5, "User", T0)])
    with pytest.raises(quality.QualityGateError, match="Users account reference check"):
        quality.dq_core_gate(broken)


def test_reports(spark):
    results = spark.createDataFrame(
        [(1, "b", "PASS"), (2, "a", "WARN"), (3, "z", "FAIL"), (4, "a", "pass")],
        "dq_id int, check_name string, status string",
    )
    assert [row["dq_id"] for row in quality.dq_report(results).collect()] == [3, 2, 4, 1]
    assert [row["dq_id"] for row in quality.dq_report(results, order="inserted").collect()] == [1, 2, 3, 4]
    assert rows(quality.dq_pass_rate(results)) == [(4, 2, 1, 50)]
    assert rows(quality.dq_pass_rate(results.limit(0))) == [(0, 0, 0, 0)]
    eighths = spark.range(8).select(F.when(F.col("id") < 1, "PASS").otherwise("FAIL").alias("status"))
    assert rows(quality.dq_pass_rate(eighths), "pass_rate_pct") == [(13,)]  # 12.5 rounds up
    assert rows(quality.dq_summary(results)) == [("FAIL", 1), ("PASS", 1), ("WARN", 1), ("pass", 1)]


def test_contracts_ignore_null_duplicates(spark):
    df = spark.createDataFrame([(None, 1), (None, None), (3, 1), (3, 2), (3, 3), (4, 1)], "k int, other int")
    found = quality.schema_contracts({"m": df, "n": df}, {"m": ("k", ("k", "other")), "n": (None, ("other",))})
    assert rows(found) == [("m", "k", "not_null", 2), ("m", "k", "unique", 1), ("m", "other", "not_null", 1), ("n", "other", "not_null", 1)]
