"""The daily refresh: raw files to alerts, in dependency order."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fixed_values import SOURCE_TABLES, STAR_TABLES
from tidemark.operators import alerts as alert_rules
from tidemark.operators import churn, churn_model
from tidemark.operators import forecast as forecasting
from tidemark.operators.events import flag_valid_events
from tidemark.operators.quality import counted_gate, dq_suite, raise_on_failures, run_core_checks, schema_contracts
from tidemark.operators.star import write_fact
from tidemark.plans.marts import all_marts, churn_input, staged, star_schema
from tidemark.plans.tables import append, publish
from tidemark.session import cut_lineage, prepare
from tidemark.sources.csv_layers import TYPED_TABLES, bronze_ingest, silver_typed
from tidemark.sources.stored import current_counts, observed_write
from tidemark.streaming.live_events import not_yet_stored, stored_alerts

EMPTY_ALERTS = (
    "alert_id bigint, customer_id bigint, alert_type string, severity string, owner string, status string, "
    "reason string, recommended_action string, source string, metadata string, "
    "created_at timestamp_ntz, acknowledged_at timestamp_ntz"
)


def _overwrite(path: str):
    return lambda rows: rows.write.mode("overwrite").parquet(path)


def load_raw(spark: SparkSession, csv_folder: str, work: str) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The raw tables, and how many rows each got."""
    raw = {name: bronze_ingest(spark, f"{csv_folder}/{name}.csv", f"{work}/bronze/{name}") for name in TYPED_TABLES}
    return raw, {name: current_counts(spark, f"{work}/bronze/{name}")["good_rows"] for name in TYPED_TABLES}


def load_typed(raw: dict[str, DataFrame], work: str) -> tuple[dict[str, DataFrame], dict[str, dict[str, int]]]:
    """Write each typed table once, with its quarantine; marts read the files.
    Returns the tables, and the rows and missing keys counted by the writes."""
    spark = next(iter(raw.values())).sparkSession
    typed, counts = {}, {}
    for name, spec in TYPED_TABLES.items():
        good, bad = silver_typed(raw[name], spec)
        bad.write.mode("overwrite").parquet(f"{work}/quarantine/{name}")
        if name == "product_events":
            good = flag_valid_events(good, typed["users"])
        key = F.col(next(iter(spec)))
        counts[name] = observed_write(good, _overwrite(f"{work}/silver/{name}"), null_keys=F.count_if(key.isNull()))
        typed[name] = spark.read.parquet(f"{work}/silver/{name}")
    return typed, counts


def write_star(tables: dict[str, DataFrame], work: str) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The stored star schema, and how many rows each table got."""
    spark = tables["accounts"].sparkSession
    stored, counts = {}, {}
    for name, df in star_schema(tables).items():
        path = f"{work}/analytics/{name}"
        counts[name] = (write_fact(df, path) if name.startswith("fact_") else observed_write(df, _overwrite(path)))["row_count"]
        stored[name] = spark.read.parquet(path)
    return stored, counts


def alert_table(spark: SparkSession) -> DataFrame:
    """The ``alerts`` table, empty before the first run."""
    if spark.catalog.tableExists("alerts"):
        return spark.table("alerts")
    return spark.createDataFrame([], EMPTY_ALERTS)


def take_in_live_alerts(spark: SparkSession, live_folder: str, folder: str, at: datetime) -> DataFrame:
    """Append the streaming job's new alerts to the ``alerts`` table; alerts of
    customers whose id is no number go to the quarantine folder."""
    known = alert_table(spark)
    new = not_yet_stored(stored_alerts(spark, live_folder), known)
    number = F.col("customer_id").try_cast("bigint")
    unnamed = new.filter(F.col("customer_id").isNotNull() & number.isNull())
    unnamed.write.mode("overwrite").parquet(f"{folder}/quarantine/live_alerts/{at:%Y%m%dT%H%M%S}")
    new = new.filter(F.col("customer_id").isNull() | number.isNotNull()).withColumn("customer_id", number)
    return append(alert_rules.number_alerts(new, known, F.lit(at).cast("timestamp_ntz")), "alerts", folder)


def raise_alerts(tables, health: DataFrame, folder: str, at: datetime) -> DataFrame:
    """Append the new health and payment alerts to the ``alerts`` table."""
    spark = health.sparkSession
    known = alert_table(spark)
    new = alert_rules.health_risk_alerts(health, known).unionByName(
        alert_rules.payment_failure_alerts(tables["invoices"], known)
    )
    return append(alert_rules.number_alerts(new, known, F.lit(at).cast("timestamp_ntz")), "alerts", folder)


def store_actions(alerts: DataFrame, folder: str, at: datetime) -> DataFrame:
    """Append the follow-up each alert asks for to ``customer_actions``, with
    ``action_id`` and ``created_at``; returns the whole table."""
    spark = alerts.sparkSession
    stored = spark.catalog.tableExists("customer_actions")
    known = spark.table("customer_actions") if stored else spark.createDataFrame([], "action_id bigint")
    new = alert_rules.customer_actions(alerts)
    return append(alert_rules.number_rows(new, known, "action_id", F.lit(at).cast("timestamp_ntz")), "customer_actions", folder)


def store_acknowledgements(spark: SparkSession, ids: DataFrame, folder: str, at: datetime) -> DataFrame:
    """Acknowledge the open ones of ``ids`` in the ``alerts`` table; returns what
    each request came to."""
    updated, report = alert_rules.acknowledge_alerts(spark.table("alerts"), ids, F.lit(at).cast("timestamp_ntz"))
    report = cut_lineage(report)  # it reads the alerts as they were
    publish(updated, "alerts", folder)
    return report


def record_quality(results: DataFrame, folder: str, at: datetime, mode: str = "append") -> DataFrame:
    """Add check results to ``data_quality_results`` under the next ids, or with
    ``mode="replace"`` begin the table anew."""
    spark = results.sparkSession
    table = "data_quality_results"
    rows = results.withColumn("checked_at", F.lit(at))
    if mode == "replace" or not spark.catalog.tableExists(table):
        return publish(rows, table, folder)
    last = spark.table(table).agg(F.coalesce(F.max("dq_id"), F.lit(0))).first()[0]
    numbered = (F.col("dq_id") + last).cast(rows.schema["dq_id"].dataType)
    return append(rows.withColumn("dq_id", numbered), table, folder)


def train_churn(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Fit the churn model on the training part, save it at ``path`` and return
    its metrics on the test part."""
    rows = churn_model.stratified_split(cut_lineage(churn.subscription_age_days(churn_input(tables))))
    rows = cut_lineage(rows)
    model = churn_model.churn_fit(rows.filter("is_train").drop("is_train"))
    model.write().overwrite().save(path)
    return churn_model.churn_metrics(churn_model.churn_score(model, rows.filter("NOT is_train")))


def score_churn(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Risk of all customers by the model saved at ``path``."""
    features = churn.subscription_age_days(churn_input(tables))
    return churn.risk_tier(churn_model.churn_score(PipelineModel.load(path), features))


def store_forecast(fact_billing: DataFrame, folder: str, at: datetime) -> DataFrame:
    """Upsert the next months into the ``revenue_forecast`` table."""
    spark = fact_billing.sparkSession
    monthly = forecasting.monthly_paid_revenue(fact_billing)
    new = forecasting.revenue_forecast(monthly, F.lit(at).cast("timestamp_ntz")).drop("segment")
    if spark.catalog.tableExists("revenue_forecast"):
        new = forecasting.upsert(spark.table("revenue_forecast"), new, "forecast_month")
    return publish(new, "revenue_forecast", folder)


def run_daily(
    spark: SparkSession, csv_folder: str, work: str, at: datetime, quality_mode: str = "replace", live_folder: str | None = None
) -> dict[str, DataFrame]:
    """Everything from CSV to alerts and forecast below the shared folder ``work``.

    Each layer is written before the next reads it, and the gates between them
    raise on empty tables or failed core checks.  ``quality_mode="append"`` keeps
    the check results of earlier days.  Alerts that the live job raised below
    ``live_folder`` are taken in.
    """
    prepare(spark)
    raw, counts = load_raw(spark, csv_folder, work)
    counted_gate(spark, {name: counts[name] for name in SOURCE_TABLES})
    tables, typed_counts = load_typed(raw, work)
    counted_gate(spark, {name: typed_counts[name]["row_count"] for name in SOURCE_TABLES})

    out = {}
    for name, df in all_marts(staged(tables)).items():
        df.write.mode("overwrite").parquet(f"{work}/marts/{name}")
        out[name] = spark.read.parquet(f"{work}/marts/{name}")
    stars, counts = write_star(tables, work)
    counted_gate(spark, {name: counts[name] for name in STAR_TABLES})
    out.update(stars)

    contracts = schema_contracts({**staged(tables), **{name: out[name] for name in all_marts(staged(tables))}})
    contracts.write.mode("overwrite").parquet(f"{work}/marts/schema_contracts")
    out["schema_contracts"] = spark.read.parquet(f"{work}/marts/schema_contracts")

    record_quality(dq_suite(tables), work, at, quality_mode)
    core = run_core_checks(tables)
    record_quality(core, work, at)
    raise_on_failures(core)
    out["data_quality_results"] = spark.table("data_quality_results")
    out["alerts"] = raise_alerts(tables, out["customer_health"], work, at)
    if live_folder:
        out["alerts"] = take_in_live_alerts(spark, live_folder, work, at)
    out["revenue_forecast"] = store_forecast(stars["fact_billing"], work, at)
    undated = forecasting.undated_paid_revenue(stars["fact_billing"])
    by_region = forecasting.segmented_paid_revenue(stars["fact_billing"], stars["dim_customer"], "region")
    for name, df in (("undated_paid_revenue", undated), ("short_series", forecasting.short_series(by_region))):
        df.write.mode("overwrite").parquet(f"{work}/marts/{name}")
        out[name] = spark.read.parquet(f"{work}/marts/{name}")
    out["open_alerts"] = alert_rules.open_alert_summary(out["alerts"])
    return out
