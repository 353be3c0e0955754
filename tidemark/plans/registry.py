"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.fixed_values import CATEGORICAL_FEATURES, NUMERIC_FEATURES, SOURCE_TABLES, STAR_TABLES
from tidemark.operators import alerts, churn, churn_model, forecast, marts, quality, serving, staging, star
from tidemark.operators.events import enrich_events_with_account, flag_valid_events
from tidemark.plans.daily import load_raw, write_star
from tidemark.plans.marts import all_marts, churn_input, churn_patterns, health_mart, staged
from tidemark.session import cut_lineage, fresh_folder, prepare
from tidemark.sources import by_user
from tidemark.sources.csv_layers import TYPED_TABLES, bronze_ingest, silver_typed
from tidemark.sources.driver_tables import LIVE_TRIGGER, DriverTables
from tidemark.sources.stored import observed_write
from tidemark.streaming import live_events

AT = "2026-12-31 00:00:00"  # the fixed "now" of the queries


def _at():
    return F.lit(AT).cast("timestamp_ntz")


class Inputs(DriverTables):
    """The mapped tables plus the models and marts derived from them."""

    def silver(self) -> dict[str, DataFrame]:
        names = (*SOURCE_TABLES, "dim_plan")
        return {name: getattr(self, name)() for name in names}

    def models(self) -> dict[str, DataFrame]:
        return staged(self.silver())

    def health(self) -> DataFrame:
        return health_mart(self.models())

    def revenue(self) -> DataFrame:
        return marts.revenue_by_plan(staging.stage_subscriptions(self.subscriptions()))

    def usage(self) -> DataFrame:
        return marts.product_usage(staging.stage_product_events(self.product_events()))

    def billing(self) -> DataFrame:
        return star.fact_billing(self.invoices())

    def dates(self) -> DataFrame:
        return star.dim_date(
            star.fact_usage(self.product_events(), self.users()),
            self.billing(),
            star.fact_subscription(self.subscriptions(), self.dim_plan()),
            star.fact_support(self.support()),
        )

    def features(self) -> DataFrame:
        return churn_input(self.silver())

    def model_rows(self) -> DataFrame:
        """Model input with the age, materialised because fitting rereads it."""
        return cut_lineage(churn.subscription_age_days(self.features()))

    def split(self) -> DataFrame:
        return churn_model.stratified_split(self.model_rows())

    def stored_split(self) -> DataFrame:
        return cut_lineage(self.split())

    def ratio_scores(self) -> DataFrame:
        """A repeatable score: trouble / (trouble + 4), no fitting involved."""
        trouble = (F.col("failed_invoice_count") * 3 + F.col("support_ticket_count") + 1).cast("double")
        return self.features().select("account_id", "churned", (trouble / (trouble + 4)).alias("churn_probability"))

    def monthly(self) -> DataFrame:
        return forecast.monthly_paid_revenue(self.billing())

    def regional_monthly(self) -> DataFrame:
        return forecast.segmented_paid_revenue(self.billing(), star.dim_customer(self.accounts()), "region")

    def live(self) -> DataFrame:
        return live_events.first_deliveries(live_events.usable(live_events.parse_messages(self.live_messages())))

    def health_alerts(self) -> DataFrame:
        return alerts.health_risk_alerts(self.health(), self.alerts())

    def payment_alerts(self) -> DataFrame:
        return alerts.payment_failure_alerts(self.invoices(), self.alerts())


# ---- queries that need more than one expression ------------------------------


def _bronze_accounts(t: Inputs) -> DataFrame:
    csv = fresh_folder(t.spark, "accounts-csv")
    t.accounts().write.options(header=True, escape='"').csv(csv)
    return bronze_ingest(t.spark, csv, fresh_folder(t.spark, "bronze-accounts"))


def _raw_invoices(t: Inputs) -> DataFrame:
    """Invoices as text, with number formats and faults a CSV export shows."""
    amount = F.col("amount").cast("string")
    return t.invoices().select(
        F.concat(F.col("invoice_id").cast("string"), F.lit(".0")).alias("invoice_id"),
        F.col("account_id").cast("string").alias("account_id"),
        F.when(F.col("amount") > 90000, "n/a").when(F.col("amount") > 80000, " ").otherwise(amount).alias("amount"),
        F.date_format("due_date", "yyyy-MM-dd HH:mm:ss").alias("due_date"),
        "status",
    )


def _texts(t: Inputs, name: str) -> DataFrame:
    """A table as a CSV export shows it: all text, and in every fiftieth row its
    last column that is no text has a word before its value."""
    spec = TYPED_TABLES[name]
    table = t.unflagged_events() if name == "product_events" else getattr(t, name)()
    key = F.col(next(iter(spec)))
    spoilt = [column for column, (_, kind) in spec.items() if kind != "string"][-1]
    cells = []
    for column, (raw, kind) in spec.items():
        text = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS") if kind.startswith("timestamp") else F.col(column).cast("string")
        if column == spoilt:
            text = F.when(key % 50 == 7, F.concat(F.lit("no "), text)).otherwise(text)
        cells.append(text.alias(raw))
    return table.select(*cells)


def _ingested(t: Inputs) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """All seven raw tables, loaded from CSV, and their counted rows."""
    work = fresh_folder(t.spark, "raw-layer")
    for name in TYPED_TABLES:
        _texts(t, name).write.options(header=True, escape='"').csv(f"{work}/csv/{name}.csv")
    return load_raw(t.spark, f"{work}/csv", work)


def _cells(name: str, rows: DataFrame, *others: str) -> DataFrame:
    """Rows of any table in one shape: its name, and its raw cells side by side."""
    raw = [F.coalesce(column, F.lit("")) for column, _ in TYPED_TABLES[name].values()]
    return rows.select(F.lit(name).alias("table_name"), F.concat_ws("|", *raw).alias("cells"), *others)


def _bronze_layer(t: Inputs) -> DataFrame:
    return reduce(DataFrame.unionByName, [_cells(name, rows) for name, rows in _ingested(t)[0].items()])


def _quarantine_layer(t: Inputs) -> DataFrame:
    bad = {name: silver_typed(_texts(t, name), spec)[1] for name, spec in TYPED_TABLES.items()}
    named = {name: rows.withColumn("failed_columns", F.array_join("failed_columns", ",")) for name, rows in bad.items()}
    return reduce(DataFrame.unionByName, [_cells(name, rows, "failed_columns") for name, rows in named.items()])


def _bronze_gate(t: Inputs) -> DataFrame:
    counts = _ingested(t)[1]
    return quality.counted_gate(t.spark, {name: counts[name] for name in SOURCE_TABLES})


def _star_gate(t: Inputs) -> DataFrame:
    counts = write_star(t.silver(), fresh_folder(t.spark, "star"))[1]
    return quality.counted_gate(t.spark, {name: counts[name] for name in STAR_TABLES})


def _observed_checks(t: Inputs) -> DataFrame:
    """NULL and volume checks from what writing the typed tables counted."""
    folder, counts = fresh_folder(t.spark, "typed"), {}
    for name in ("accounts", "users", "product_events", "subscriptions", "invoices"):
        table = _unflagged_tables(t)[name]
        key = F.col(next(iter(TYPED_TABLES[name])))
        counts[name] = observed_write(table, lambda rows, at=f"{folder}/{name}": rows.write.parquet(at), null_keys=F.count_if(key.isNull()))
    return quality.observed_checks(t.spark, counts)


def _placed(rows: DataFrame) -> DataFrame:
    """A short ordered listing with each row's position, so that order shows."""
    return rows.withColumn("_row", F.monotonically_increasing_id()).select(
        F.row_number().over(Window.orderBy("_row")).alias("position"), *rows.columns
    )


def _short_accounts(t: Inputs) -> DataFrame:
    """Accounts whose paid months are too few for a forecast of their own."""
    billing = t.billing().withColumn("account", F.col("customer_id").cast("string"))
    return forecast.short_series(forecast.monthly_paid_revenue(billing, "account"))


def _undated(t: Inputs) -> DataFrame:
    """Every tenth invoice has lost its date."""
    lost = t.billing().withColumn("date_key", F.when(F.col("invoice_id") % 10 != 0, F.col("date_key")))
    return forecast.undated_paid_revenue(lost)


def _quarantined(t: Inputs) -> DataFrame:
    bad = silver_typed(_raw_invoices(t), TYPED_TABLES["invoices"])[1]
    return bad.withColumn("failed_columns", F.array_join("failed_columns", ","))


def _live_stream(t: Inputs) -> str:
    """Run the streaming job over the event files, the whole backlog as one
    batch; returns its output folder."""
    folder = fresh_folder(t.spark, "live")
    live_events.start_live_events(
        t.live_stream(),
        folder,
        trigger_feature=LIVE_TRIGGER,
        alerts=lambda session: t.alerts(),
        dedupe="sink",
        availableNow=True,
    ).awaitTermination()
    return folder


SLICES = 4


def _live_slices(t: Inputs) -> str:
    """Run the job in its default mode, started anew for each of four deliveries
    in order of time; every delivery but the first repeats a tenth of the one
    before.  Returns its output folder."""
    folder, topic = fresh_folder(t.spark, "live"), fresh_folder(t.spark, "topic")
    events = t.raw("events").withColumn("day", F.datediff("ts", F.lit("1970-01-01")))
    first, last = events.agg(F.min("day"), F.max("day")).first()
    place = F.floor((F.col("day") - first) * SLICES / (last - first + 1)) if first is not None else F.lit(0)
    sliced = events.withColumn("place", place)
    for number in range(SLICES):
        again = (F.col("place") == number - 1) & (F.col("event_id") % 10 == 0)
        due = sliced.filter((F.col("place") == number) | again)
        t.live_messages(due).select("value").write.mode("append").text(topic)
        arriving = t.spark.readStream.option("maxFilesPerTrigger", 1000).text(topic)
        arrived = F.get_json_object("value", "$.timestamp").cast("timestamp").alias("received_at")
        live_events.start_live_events(
            arriving.select("value", arrived), folder, trigger_feature=LIVE_TRIGGER, alerts=lambda session: t.alerts(), availableNow=True
        ).awaitTermination()
    return folder


def _stored_flags(t: Inputs) -> DataFrame:
    """Events and users stored by user, joined where they lie."""
    folder = fresh_folder(t.spark, "by-user")
    name = "by_user_" + folder[-32:]
    by_user.store_by_user(t.unflagged_events(), t.users(), name, folder)
    return by_user.stored_flags(t.spark, name).drop("customer_id")


def _live_batch(t: Inputs) -> DataFrame:
    """Clicks are already stored; the batch delivers every event again."""
    stored = t.raw("events").filter(F.col("event_type") == "click").select(F.col("event_id").cast("string"))
    return live_events.ingest_batch(t.live_messages(), stored)


def _null_checks(t: Inputs) -> DataFrame:
    return (
        quality.dq_null_check(t.accounts(), "account_id", "Accounts account_id NULL check")
        .unionByName(quality.dq_null_check(t.users(), "user_id", "Users user_id NULL check"))
        .unionByName(quality.dq_null_check(t.unflagged_events(), "event_id", "Product events event_id NULL check"))
        .unionByName(
            quality.dq_null_check(t.subscriptions(), "subscription_id", "Subscriptions subscription_id NULL check")
        )
    )


def _duplicate_checks(t: Inputs) -> DataFrame:
    return (
        quality.dq_duplicate_check(t.accounts(), "account_id", "Accounts duplicate account_id check")
        .unionByName(quality.dq_duplicate_check(t.users(), "user_id", "Users duplicate user_id check"))
        .unionByName(
            quality.dq_duplicate_check(t.unflagged_events(), "event_id", "Product events duplicate event_id check")
        )
    )


def _referential_checks(t: Inputs) -> DataFrame:
    users = t.users()
    return quality.dq_referential_check(
        users, t.accounts(), "account_id", "Users account reference check"
    ).unionByName(
        quality.dq_referential_check(t.unflagged_events(), users, "user_id", "Product event user reference check")
    )


def _volume_checks(t: Inputs) -> DataFrame:
    return (
        quality.dq_min_volume(t.accounts(), "Accounts minimum volume")
        .unionByName(quality.dq_min_volume(t.users(), "Users minimum volume"))
        .unionByName(quality.dq_min_volume(t.unflagged_events(), "Product events minimum volume"))
        .unionByName(quality.dq_min_volume(t.invoices(), "Invoices minimum volume"))
    )


def _unflagged_tables(t: Inputs) -> dict[str, DataFrame]:
    """The checks never read the validity flag, so it is not derived for them."""
    names = [name for name in (*SOURCE_TABLES, "dim_plan") if name != "product_events"]
    return {**{name: getattr(t, name)() for name in names}, "product_events": t.unflagged_events()}


def _suite(t: Inputs) -> DataFrame:
    return quality.dq_suite(_unflagged_tables(t))


def _contracts(t: Inputs) -> DataFrame:
    models = t.models()
    return quality.schema_contracts({**models, **all_marts(models)})


def _acknowledged(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """Ask for every part number: some are open alerts, some are not."""
    asked = t.raw("part").select(F.col("p_partkey").alias("alert_id"))
    return alerts.acknowledge_alerts(t.alerts(), asked, _at())


def _lookup(t: Inputs) -> DataFrame:
    asked = t.raw("part").select(F.col("p_partkey").alias("customer_id"))
    return serving.customer_health_lookup(t.health(), asked)


def _impute(t: Inputs) -> DataFrame:
    rows = t.stored_split()
    medians, modes = churn_model.fit_impute(rows.filter("is_train"))
    return churn_model.impute(rows, medians, modes).select(
        "account_id", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES, "is_train"
    )


def _standardize(t: Inputs) -> DataFrame:
    rows = t.stored_split()
    train = rows.filter("is_train")
    medians, modes = churn_model.fit_impute(train)
    means, deviations = churn_model.fit_standardize(churn_model.impute(train, medians, modes))
    scaled = churn_model.standardize(churn_model.impute(rows, medians, modes), means, deviations)
    return scaled.select("account_id", *[F.round(name, 6).alias(name) for name in NUMERIC_FEATURES])


def _one_hot(t: Inputs) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    rows = t.stored_split()
    encoded = churn_model.fit_one_hot(rows.filter("is_train")).transform(rows)
    digits = [
        F.array_join(F.transform(vector_to_array(f"onehot_{name}"), lambda x: x.cast("int").cast("string")), "").alias(
            f"{name}_code"
        )
        for name in CATEGORICAL_FEATURES
    ]
    return encoded.select("account_id", *digits)


def _fitted(t: Inputs):
    rows = t.stored_split()
    return churn_model.churn_fit(rows.filter("is_train").drop("is_train")), rows


def _fit(t: Inputs) -> DataFrame:
    """Test-part metrics of the fitted model."""
    model, rows = _fitted(t)
    return churn_model.churn_metrics(churn_model.churn_score(model, rows.filter(~F.col("is_train"))))


def _score(t: Inputs) -> DataFrame:
    model, rows = _fitted(t)
    return churn.risk_tier(churn_model.churn_score(model, rows))


def _fit_gradients(t: Inputs) -> DataFrame:
    model, rows = _fitted(t)
    return churn_model.loss_gradients(model, rows.filter("is_train").drop("is_train"))


def _score_gaps(t: Inputs) -> DataFrame:
    model, rows = _fitted(t)
    return churn_model.score_gaps(model, rows)


def _cents(df: DataFrame, *names: str) -> DataFrame:
    """Least-squares sums depend on row order in their last digits; shown in
    hundredths of a cent they do not."""
    return df.withColumns({name: F.round(name, 4) for name in names})


def _forecast(t: Inputs, monthly: DataFrame | None = None) -> DataFrame:
    ahead = forecast.revenue_forecast(t.monthly() if monthly is None else monthly, _at())
    return _cents(ahead, "forecast_revenue", "validation_mae")


def _holdout(t: Inputs) -> DataFrame:
    return _cents(forecast.revenue_holdout(t.monthly()), "predicted", "mae")


def _forecast_upsert(t: Inputs) -> DataFrame:
    """A stored forecast, one month and 100 off, is brought up to date."""
    new = _forecast(t)
    stale = new.withColumn("forecast_month", F.add_months("forecast_month", -1)).withColumn(
        "forecast_revenue", F.col("forecast_revenue") - 100
    )
    return _cents(forecast.upsert(stale, new, ["segment", "forecast_month"]), "forecast_revenue")


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    # layers
    "bronze_ingest": _bronze_accounts,
    "silver_typed": lambda t: silver_typed(_raw_invoices(t), TYPED_TABLES["invoices"])[0],
    "silver_quarantine": _quarantined,
    "bronze_layer": _bronze_layer,
    "quarantine_layer": _quarantine_layer,
    **{
        f"silver_typed_{name}": lambda t, name=name: silver_typed(_texts(t, name), TYPED_TABLES[name])[0]
        for name in TYPED_TABLES
        if name not in ("invoices", "dim_plan")
    },
    "flag_valid_events": lambda t: flag_valid_events(t.unflagged_events(), t.users()),
    "flag_valid_events_stored": _stored_flags,
    "stage_customers": lambda t: staging.stage_customers(t.accounts()),
    "stage_users": lambda t: staging.stage_users(t.users()),
    "stage_product_events": lambda t: staging.stage_product_events(t.product_events()),
    "stage_subscriptions": lambda t: staging.stage_subscriptions(t.subscriptions()),
    "stage_invoices": lambda t: staging.stage_invoices(t.invoices()),
    "stage_support": lambda t: staging.stage_support(t.support()),
    "star_dim_customer": lambda t: star.dim_customer(t.accounts()),
    "star_dim_user": lambda t: star.dim_user(t.users()),
    "star_dim_plan": lambda t: star.dim_plan(t.sold_plans()),
    "star_dim_date": lambda t: t.dates(),
    "star_fact_usage": lambda t: star.fact_usage(t.unflagged_events(), t.users()),
    "star_fact_billing": lambda t: t.billing(),
    "star_fact_subscription": lambda t: star.fact_subscription(t.subscriptions(), t.dim_plan()),
    "star_fact_support": lambda t: star.fact_support(t.support()),
    "nonempty_gate": lambda t: quality.nonempty_gate(
        {name: df for name, df in _unflagged_tables(t).items() if name in SOURCE_TABLES}
    ),
    "nonempty_gate_bronze": _bronze_gate,
    "nonempty_gate_star": _star_gate,
    # marts
    "customer_usage": lambda t: marts.customer_usage(
        staging.stage_customers(t.accounts()), staging.stage_users(t.users()), t.product_events()
    ),
    "customer_subscription": lambda t: marts.customer_subscription(staging.stage_subscriptions(t.subscriptions())),
    "customer_support": lambda t: marts.customer_support(staging.stage_support(t.support())),
    "customer_billing": lambda t: marts.customer_billing(staging.stage_invoices(t.invoices())),
    "customer_health": lambda t: t.health(),
    "revenue_by_plan": lambda t: t.revenue(),
    "revenue_by_plan_integer_share": lambda t: marts.revenue_by_plan(
        staging.stage_subscriptions(t.subscriptions()), integer_share=True
    ),
    "daily_feature_usage": lambda t: marts.daily_feature_usage(t.product_events()),
    "monthly_feature_usage": lambda t: marts.monthly_feature_usage(t.product_events()),
    "product_usage": lambda t: t.usage(),
    "support_sla": lambda t: marts.support_sla(staging.stage_support(t.support())),
    # data quality
    "dq_null_check": _null_checks,
    "dq_duplicate_check": _duplicate_checks,
    "dq_referential_check": _referential_checks,
    "dq_events_before_creation": lambda t: quality.dq_events_before_creation(t.unflagged_events(), t.users()),
    "dq_multiple_active": lambda t: quality.dq_multiple_active(t.subscriptions()),
    "dq_invoice_price": lambda t: quality.dq_invoice_price(t.invoices(), t.dim_plan()),
    "dq_min_volume": _volume_checks,
    "dq_suite": _suite,
    "dq_core_gate": lambda t: quality.dq_core_gate(_unflagged_tables(t)),
    "dq_observed_checks": _observed_checks,
    "dq_report_positions": lambda t: _placed(quality.dq_report(_suite(t))),
    "dq_report_inserted": lambda t: _placed(quality.dq_report(_suite(t), order="inserted")),
    "dq_summary": lambda t: quality.dq_summary(_suite(t)),
    "dq_report": lambda t: quality.dq_report(_suite(t)),
    "dq_pass_rate": lambda t: quality.dq_pass_rate(_suite(t)),
    "schema_contracts": _contracts,
    # alerts and actions
    "health_risk_alerts": lambda t: t.health_alerts(),
    "payment_failure_alerts": lambda t: t.payment_alerts(),
    "suppress_open_alerts": lambda t: alerts.suppress_open_alerts(
        t.accounts().select(F.col("account_id").alias("customer_id"), F.lit("Payment Failure").alias("alert_type")),
        t.alerts(),
    ),
    "new_alert_counts": lambda t: alerts.new_alert_counts(
        {"Customer Health Risk": t.health_alerts(), "Payment Failure": t.payment_alerts()}
    ),
    "open_alert_summary": lambda t: alerts.open_alert_summary(t.alerts()),
    "alert_feed": lambda t: alerts.alert_feed(t.alerts()),
    "alert_feed_counts": lambda t: alerts.alert_feed_counts(t.alerts()),
    "acknowledge_alerts": lambda t: _acknowledged(t)[0],
    "acknowledge_report": lambda t: _acknowledged(t)[1],
    "customer_actions": lambda t: alerts.customer_actions(t.alerts()),
    # KPIs and feeds
    "dashboard_kpis": lambda t: serving.dashboard_kpis(t.revenue(), t.health(), t.alerts()),
    "revenue_listing": lambda t: serving.revenue_listing(t.revenue()),
    "plan_mix": lambda t: serving.plan_mix(t.revenue()),
    "customer_health_lookup": _lookup,
    "health_watchlist": lambda t: serving.health_watchlist(t.health()),
    "product_usage_feed": lambda t: serving.product_usage_feed(t.usage()),
    "usage_by_feature": lambda t: serving.usage_by_feature(t.usage()),
    "usage_trend": lambda t: serving.usage_trend(t.usage()),
    "usage_feed_totals": lambda t: serving.usage_feed_totals(t.usage()),
    "live_event_feed": lambda t: serving.live_event_feed(t.live()),
    "forecast_listing": lambda t: serving.forecast_listing(_forecast(t)),
    # churn
    "churn_subscription_features": lambda t: churn.churn_subscription_features(t.subscriptions(), t.dim_plan()),
    "churn_usage_features": lambda t: churn.churn_usage_features(t.users(), t.product_events()),
    "churn_support_features": lambda t: churn.churn_support_features(t.support()),
    "churn_billing_features": lambda t: churn.churn_billing_features(t.invoices()),
    "churn_features": lambda t: t.features(),
    "subscription_age_days": lambda t: churn.subscription_age_days(t.features()).select(
        "account_id", "subscription_age_days"
    ),
    "churn_pattern_features": lambda t: churn_patterns(t.silver(), ordered=True),
    "churn_distribution": lambda t: churn.churn_distribution(churn_patterns(t.silver())),
    "churn_rate_by_segment": lambda t: churn.churn_rate_by_segment(churn_patterns(t.silver())),
    "feature_means_by_churn": lambda t: churn.feature_means_by_churn(churn_patterns(t.silver())),
    "failed_rate_by_churn": lambda t: churn.failed_rate_by_churn(churn_patterns(t.silver())),
    "stratified_split": lambda t: t.split().select("account_id", "churned", "is_train"),
    "impute": _impute,
    "standardize": _standardize,
    "one_hot": _one_hot,
    "churn_fit": _fit,
    "churn_score": _score,
    "churn_fit_gradients": _fit_gradients,
    "churn_score_gaps": _score_gaps,
    "churn_metrics": lambda t: churn_model.churn_metrics(cut_lineage(t.ratio_scores())),
    "classification_report": lambda t: churn_model.classification_report(t.ratio_scores()),
    "risk_tier": lambda t: churn.risk_tier(t.ratio_scores()),
    "churn_risk": lambda t: churn.churn_risk(t.ratio_scores()),
    "risk_summary": lambda t: churn.risk_summary(t.ratio_scores()),
    # forecast
    "monthly_paid_revenue": lambda t: t.monthly(),
    "revenue_holdout": _holdout,
    "revenue_forecast": _forecast,
    "revenue_forecast_by_region": lambda t: _forecast(t, t.regional_monthly()),
    "revenue_forecast_upsert": _forecast_upsert,
    "forecast_listing_positions": lambda t: _placed(serving.forecast_listing(_forecast(t))),
    "short_series": _short_accounts,
    "undated_paid_revenue": _undated,
    # live events
    "live_events_ingest": lambda t: live_events.stored_events(t.spark, _live_stream(t)),
    "live_events_batch": _live_batch,
    "expansion_alerts": lambda t: alerts.expansion_alerts(t.live(), t.alerts(), LIVE_TRIGGER),
    "expansion_alerts_live": lambda t: live_events.stored_alerts(t.spark, _live_stream(t)),
    "live_events_stream": lambda t: live_events.stored_events(t.spark, _live_slices(t)),
    "expansion_alerts_stream": lambda t: live_events.stored_alerts(t.spark, _live_slices(t)),
    "enrich_events_with_account": lambda t: enrich_events_with_account(t.unflagged_events(), t.users()),
}


def _plain(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles and instants as wall-clock UTC times, the
    types both engines share."""
    shared = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        shared.append(column.alias(field.name))
    return df.select(*shared)


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return _plain(QUERIES[name](Inputs(prepare(spark), folder)))
