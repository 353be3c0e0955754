"""Raw and typed layers, star schema, catalog tables and the daily run."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import EVENTS, INVOICES, PLAN_ROWS, PLANS, SUBSCRIPTIONS, T0, USERS, by, hours, rows
from pyspark.sql import functions as F

from tidemark.operators import star
from tidemark.operators.quality import QualityGateError, counted_gate, observed_checks
from tidemark.plans import daily
from tidemark.plans.tables import append, publish
from tidemark.sources.csv_layers import TYPED_TABLES, bronze_ingest, bronze_table, malformed_lines, silver_typed
from tidemark.sources.shared_files import names_in
from tidemark.sources.stored import current_counts, current_table, observed_write, replace_table


def test_bronze_keeps_text_and_replaces(spark, tmp_path):
    csv, table = tmp_path / "a.csv", str(tmp_path / "bronze")
    csv.write_text('id,name,amount\n007,NA,1.50\n8,,\n9,"a, ""b""",nan\n')
    loaded = bronze_ingest(spark, str(csv), table)
    assert [field.dataType.simpleString() for field in loaded.schema] == ["string"] * 3
    assert rows(loaded) == [("007", "NA", "1.50"), ("8", None, None), ("9", 'a, "b"', "nan")]
    csv.write_text("id,name,amount\n1,x,2\n")
    assert rows(bronze_ingest(spark, str(csv), table)) == [("1", "x", "2")]
    assert rows(bronze_ingest(spark, str(csv), table, columns=["id", "name", "amount"])) == [("1", "x", "2")]
    csv.write_text('id,name,amount\n1,"two\nlines",2\n')
    assert rows(bronze_ingest(spark, str(csv), table, multiline=True)) == [("1", "two\nlines", "2")]


def test_typed_casts_and_quarantine(spark):
    raw = spark.createDataFrame(
        [
            ("1", "5", "dash", "2026-01-02 03:04:05.000006"),
            ("2.0", "", None, None),
            ("3", "six", "x", "2026-01-02"),
            ("4", "7.5", "y", "not a time"),
            ("5", "8", "z", "  "),
        ],
        "event_id string, user_id string, feature string, `timestamp` string",
    )
    good, bad = silver_typed(raw, TYPED_TABLES["product_events"])
    assert good.columns == ["event_id", "user_id", "feature", "event_timestamp"]
    assert rows(good) == [
        (1, 5, "dash", datetime(2026, 1, 2, 3, 4, 5, 6)),
        (2, None, None, None),
        (5, 8, "z", None),
    ]
    assert {row["event_id"]: row["failed_columns"] for row in bad.collect()} == {
        "3": ["user_id"],
        "4": ["user_id", "event_timestamp"],
    }


def test_star(spark, tmp_path):
    users = spark.createDataFrame([(10, 1, "User", T0)], USERS)
    usage = star.fact_usage(
        spark.createDataFrame([(1, 10, "a", T0, True), (2, 99, "a", T0 + hours(48), False)], EVENTS), users
    )
    assert rows(usage, "event_id", "customer_id", "date_key") == [(1, 1, date(2024, 1, 31)), (2, None, date(2024, 2, 2))]
    plans = spark.createDataFrame(PLAN_ROWS, PLANS)
    subscriptions = spark.createDataFrame([(1, 1, "Starter", T0, "Active"), (2, 1, "Odd", T0, "Active")], SUBSCRIPTIONS)
    assert rows(star.fact_subscription(subscriptions, plans), "subscription_id", "plan_id") == [(1, 1), (2, None)]
    billing = star.fact_billing(spark.createDataFrame([(1, 1, Decimal(1), T0 + hours(72), "Paid"), (2, 1, Decimal(1), None, "Paid")], INVOICES))
    days = star.dim_date(usage, billing)
    assert rows(days, "date_key", "month") == [
        (date(2024, 1, 31), 1), (date(2024, 2, 1), 2), (date(2024, 2, 2), 2), (date(2024, 2, 3), 2)]
    star.write_fact(usage, str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    pruned = stored.filter(F.col("month_key") == date(2024, 2, 1))
    assert rows(pruned, "event_id") == [(2,)]
    assert "PartitionFilters: [isnotnull(month_key" in pruned._jdf.queryExecution().executedPlan().toString()


def test_publish_may_read_what_it_replaces(spark, tmp_path):
    first = publish(spark.range(3).withColumn("p", F.lit("x")), "numbers", str(tmp_path))
    assert first.count() == 3
    again = publish(first.withColumn("id", F.col("id") + 10), "numbers", str(tmp_path))
    assert rows(again, "id") == [(10,), (11,), (12,)]
    assert append(spark.range(1).withColumn("p", F.lit("y")), "numbers", str(tmp_path)).count() == 4
    parted = publish(spark.range(4).withColumn("p", F.col("id") % 2), "parted", str(tmp_path), ("p",))
    assert rows(parted.filter("p = 1"), "id") == [(1,), (3,)]
    assert publish(parted.filter("id > 1"), "parted", str(tmp_path), ("p",)).count() == 2


CSV = {
    "accounts": "account_id,industry,size,region,owner\n1,Retail,Small,West,CSM_01\n2,Finance,Large,East,CSM_02\n",
    "users": "user_id,account_id,role,created_at\n10,1,User,2026-01-01 00:00:00\n11,2,Admin,2026-01-05 00:00:00\n",
    "product_events": "event_id,user_id,feature,timestamp\n1,10,Reports,2026-01-02 00:00:00\n2,11,Export,2026-01-04 00:00:00\n",
    "subscriptions": "subscription_id,account_id,plan,start_date,status\n1,1,Starter,2026-01-01,Active\n2,2,Enterprise,2026-01-01,Cancelled\n",
    "invoices": "invoice_id,account_id,amount,due_date,status\n"
    + "".join(f"{m},1,100,2026-{m:02d}-05,Paid\n" for m in range(1, 8))
    + "8,1,100,2026-07-06,Failed\n9,2,x,2026-07-06,Paid\n",
    "support": "ticket_id,account_id,severity,created_at,resolved_at\n1,1,High,2026-01-03 00:00:00,2026-01-03 09:00:00\n2,2,Low,2026-01-03 00:00:00,\n",
    "dim_plan": "plan_id,plan_name,monthly_price\n1,Starter,100\n2,Professional,250\n3,Enterprise,500\n",
}


def test_daily_run_twice(spark, tmp_path, own_tables):
    folder, work = tmp_path / "csv", str(tmp_path / "work")
    folder.mkdir()
    for name, text in CSV.items():
        (folder / f"{name}.csv").write_text(text)
    at = datetime(2026, 8, 1)
    out = daily.run_daily(spark, str(folder), work, at)
    assert spark.read.parquet(f"{work}/quarantine/invoices").count() == 1
    health = by(out["customer_health"], "customer_id")
    # One valid event, 9 hours to resolve, one of eight invoices failed.
    assert tuple(health[1][name] for name in ("total_events", "support_score", "billing_score", "health_score")) == (1, 80, 60, 42.0)
    assert tuple(health[2][name] for name in ("total_events", "support_score", "billing_score")) == (0, 100, 100)
    assert health[2]["health_status"] == "Watch"
    assert rows(out["alerts"], "customer_id", "alert_type") == [(1, "Customer Health Risk"), (1, "Payment Failure")]
    results = out["data_quality_results"]
    assert results.count() == 22  # sixteen checks, then the gate's six appended
    assert rows(results.filter("status = 'WARN'"), "check_name") == [("Product events before user creation",)] * 2
    assert rows(out["revenue_forecast"], "forecast_month", "validation_mae") == [
        (date(2026, m, 1), pytest.approx(0.0)) for m in (8, 9, 10)]
    ids = rows(out["alerts"], "alert_id")
    assert len(set(ids)) == 2

    out = daily.run_daily(spark, str(folder), work, at)
    assert rows(out["alerts"], "alert_id") == ids
    assert out["revenue_forecast"].count() == 3
    assert out["data_quality_results"].count() == 22
    assert rows(out["open_alerts"], "alert_type", "alert_count") == [("Customer Health Risk", 1), ("Payment Failure", 1)]


def test_malformed_lines_and_rounded_amounts_are_kept_apart(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c\n1,x,2\n1,x,2,EXTRA,EXTRA2\n2,y\n3,,100.239\n4,z,100.2\n")
    raw = bronze_ingest(spark, str(tmp_path / "t.csv"), str(tmp_path / "raw"))
    assert rows(raw, "a", "b", "c") == [("1", "x", "2"), ("3", None, "100.239"), ("4", "z", "100.2")]
    bad = malformed_lines(spark, str(tmp_path / "raw"))
    assert current_counts(spark, str(tmp_path / "raw")) == {"row_count": 5, "good_rows": 3, "malformed_rows": 2}
    assert rows(bad, "malformed_line") == [("1,x,2,EXTRA,EXTRA2",), ("2,y",)]
    typed, quarantined = silver_typed(raw, {"a": ("a", "bigint"), "c": ("c", "decimal(18,2)")})
    assert [row[0] for row in rows(typed, "a")] == [1, 4]
    assert rows(quarantined, "a") == [("3",)]


def test_a_failing_load_leaves_the_old_rows(spark, tmp_path):
    csv, table = tmp_path / "a.csv", str(tmp_path / "bronze")
    csv.write_text("id,name\n1,x\nbroken\n")
    bronze_ingest(spark, str(csv), table)
    broken = current_table(spark, table).withColumn("name", F.raise_error(F.lit("midway")).cast("string"))
    with pytest.raises(Exception, match="midway"):
        replace_table(broken, table)
    assert rows(bronze_table(spark, table)) == [("1", "x")] and malformed_lines(spark, table).count() == 1
    csv.write_text("name,id\nx,1\n")
    with pytest.raises(Exception, match="header"):  # other columns than those it is told
        bronze_ingest(spark, str(csv), table, columns=["id", "name"])
    assert rows(bronze_table(spark, table)) == [("1", "x")]
    for value in "234":
        csv.write_text(f"id,name\n{value},y\n")
        bronze_ingest(spark, str(csv), table)
    assert rows(bronze_table(spark, table)) == [("4", "y")]
    assert sum(name.startswith("version-") for name in names_in(spark, table)) <= 3


def test_an_empty_csv_is_an_empty_table(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n")
    loaded = bronze_ingest(spark, str(tmp_path / "a.csv"), str(tmp_path / "raw"))
    assert loaded.columns == ["id", "name"] and loaded.count() == 0
    assert current_counts(spark, str(tmp_path / "raw"))["good_rows"] == 0
    with pytest.raises(FileNotFoundError):
        current_table(spark, str(tmp_path / "none"))


def test_counts_come_with_the_write(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7).withColumn("key", F.when(F.col("id") % 10 != 0, F.col("id")))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "")
    counts = observed_write(df, lambda rows: rows.write.parquet(str(tmp_path / "t")), null_keys=F.count_if(F.col("key").isNull()))
    counted_gate(spark, {"users": counts["row_count"]})
    assert len(jobs.getJobIdsForGroup("counted")) == 1  # the write itself
    spark.sparkContext._jsc.clearJobGroup()
    assert counts == {"row_count": 1000, "null_keys": 100}
    assert observed_write(df.limit(0), lambda rows: rows.write.parquet(str(tmp_path / "e")), null_keys=F.count_if(F.col("key").isNull())) == {"row_count": 0, "null_keys": 0}
    checks = by(observed_checks(spark, {"users": counts}), "check_name")
    assert {name: (row.status, row.actual_value) for name, row in checks.items()} == {
        "Users user_id NULL check": ("FAIL", 100), "Users minimum volume": ("PASS", 1000)}
    with pytest.raises(QualityGateError, match="support"):
        counted_gate(spark, {"users": 1, "support": 0})
