"""The given tables read as a subscription business.

Maps the star-schema Parquet files onto accounts, users, product events,
subscriptions, invoices, support tickets, live events and seed alerts.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import json_text
from tidemark.functions.fixed_values import PLAN_PRICES
from tidemark.operators.events import flag_valid_events

# Columns as the files hold them; stating them saves a schema job per table.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

PRODUCT_EVENT_TYPES = ("view", "click", "purchase")
ALERT_EPOCH = "2026-01-01 00:00:00"
LIVE_TRIGGER = "purchase"  # stands for the feature that signals expansion


def account_of(user_id: Column) -> Column:
    """Two of every four consecutive users share an account."""
    return F.when(user_id % 4 < 2, user_id - user_id % 4).otherwise(user_id)


def once(method):
    """Build a table's plan once per instance; the frames stay lazy."""

    @wraps(method)
    def built(self, *key):
        name = (method.__name__, *key)
        if name not in self._built:
            self._built[name] = method(self, *key)
        return self._built[name]

    return built


def _ahead(group: list[str], *order: str):
    """Window over the rows of a group that come later in ``order``."""
    return (
        Window.partitionBy(*group)
        .orderBy(*[F.col(name).desc() for name in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )


class DriverTables:
    """Lazy views over one scale-factor folder; every table is a method."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._built: dict[tuple, DataFrame] = {}

    @once
    def raw(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in SCHEMAS:
            reader = reader.schema(SCHEMAS[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    @once
    def dim_plan(self) -> DataFrame:
        """The fixed price list, as literal rows whose size the planner knows."""
        rows = [f"({number}, '{name}', {price})" for number, (name, price) in enumerate(PLAN_PRICES.items(), start=1)]
        return self.spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS plans(plan_id, plan_name, monthly_price)")

    @once
    def sold_plans(self) -> DataFrame:
        """The plans of the price list that some order has."""
        sold = self.subscriptions().select(F.col("plan").alias("plan_name")).distinct()
        return self.dim_plan().join(sold, "plan_name", "left_semi").select("plan_id", "plan_name", "monthly_price")

    @once
    def accounts(self) -> DataFrame:
        balance = F.col("c_acctbal")
        size = (
            F.when(balance < 1000, "Small")
            .when(balance < 4000, "Medium")
            .when(balance < 7000, "Large")
            .otherwise("Enterprise")
        )
        nations = self.raw("nation").join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return (
            self.raw("customer")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("account_id"),
                F.col("c_mktsegment").alias("industry"),
                size.alias("size"),
                F.col("r_name").alias("region"),
                F.col("n_name").alias("owner"),
            )
        )

    @once
    def users(self) -> DataFrame:
        signed_up = F.when(F.col("event_type") == "signup", F.col("ts"))
        role = F.element_at(
            F.array(*[F.lit(name) for name in ("User", "Analyst", "Manager", "Admin")]),
            (F.col("user_id") % 4 + 1).cast("int"),
        )
        return (
            self.raw("events")
            .groupBy("user_id")
            .agg(F.min(signed_up).alias("created_at"))
            .select("user_id", account_of(F.col("user_id")).alias("account_id"), role.alias("role"), "created_at")
        )

    @once
    def unflagged_events(self) -> DataFrame:
        return (
            self.raw("events")
            .filter(F.col("event_type").isin(*PRODUCT_EVENT_TYPES))
            .select("event_id", "user_id", F.col("event_type").alias("feature"), F.col("ts").alias("event_timestamp"))
        )

    @once
    def product_events(self) -> DataFrame:
        return flag_valid_events(self.unflagged_events(), self.users())

    @once
    def subscriptions(self) -> DataFrame:
        priority = F.col("o_orderpriority")
        plan = (
            F.when(priority == "1-URGENT", "Enterprise")
            .when(priority.isin("2-HIGH", "3-MEDIUM"), "Professional")
            .otherwise("Starter")
        )
        ended = F.col("o_totalprice") < 100000
        status = (
            F.when((F.col("o_orderstatus") == "F") & ended, "Cancelled")
            .when((F.col("o_orderstatus") == "P") & ended, "Paused")
            .otherwise("Active")
        )
        return self.raw("orders").select(
            F.col("o_orderkey").alias("subscription_id"),
            F.col("o_custkey").alias("account_id"),
            plan.alias("plan"),
            F.col("o_orderdate").alias("start_date"),
            status.alias("status"),
        )

    @once
    def invoices(self) -> DataFrame:
        quantity = F.col("l_quantity")
        amount = (
            F.when(F.col("l_linenumber") > 5, F.col("l_extendedprice"))
            .when(quantity < 23, 100)
            .when(quantity < 43, 250)
            .otherwise(500)
        )
        returned, open_line = F.col("l_returnflag"), F.col("l_linestatus")
        status = (
            F.when((returned == "R") & (open_line == "F") & (quantity <= 20), "Failed")
            .when(returned == "R", "Overdue")
            .when((returned == "N") & (open_line == "O"), "Pending")
            .otherwise("Paid")
        )
        owners = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("account_id"))
        lines = self.raw("lineitem").select(
            "l_orderkey",
            (F.col("l_orderkey") * 1000000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("invoice_id"),
            amount.cast("decimal(18,2)").alias("amount"),
            F.col("l_shipdate").alias("due_date"),
            status.alias("status"),
        )
        return lines.join(owners, "l_orderkey").select("invoice_id", "account_id", "amount", "due_date", "status")

    @once
    def support(self) -> DataFrame:
        """Error events as tickets, resolved by the same user's next other event.

        "Next" looks ahead over a user's whole history.  One user may own a
        third of all rows, so history is cut into minutes and days: a row looks
        ahead inside its own minute, a minute inside its own day, and a day
        over the days that follow.  No window holds more rows than a minute
        has events, a day has minutes, or a history has days.
        """
        events = self.raw("events").select("user_id", "event_id", "event_type", "ts", "value")
        events = events.withColumn("minute", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
        other = F.when(F.col("event_type") != "error", F.col("ts"))

        errors = events.withColumn("in_minute", F.min(other).over(_ahead(["user_id", "minute"], "ts", "event_id")))
        minutes = (
            events.groupBy("user_id", F.to_date("minute").alias("day"), "minute")
            .agg(F.min(other).alias("first_other"))
            .withColumn("in_day", F.min("first_other").over(_ahead(["user_id", "day"], "minute")))
        )
        days = (
            minutes.groupBy("user_id", "day")
            .agg(F.min("first_other").alias("first_other"))
            .withColumn("in_history", F.min("first_other").over(_ahead(["user_id"], "day")))
            .select("user_id", "day", "in_history")
        )
        later = minutes.join(days, ["user_id", "day"]).select(
            "user_id", "minute", F.coalesce("in_day", "in_history").alias("after_minute")
        )
        value = F.col("value")
        severity = F.when(value < 5, "Low").when(value < 30, "Medium").when(value < 70, "High").otherwise("Critical")
        return (
            errors.filter(F.col("event_type") == "error")
            .join(later, ["user_id", "minute"])
            .select(
                F.col("event_id").alias("ticket_id"),
                account_of(F.col("user_id")).alias("account_id"),
                severity.alias("severity"),
                F.col("ts").alias("created_at"),
                F.coalesce("in_minute", "after_minute").alias("resolved_at"),
            )
        )

    def live_messages(self, events: DataFrame | None = None) -> DataFrame:
        """Events as the JSON messages a topic would carry (``value``)."""
        events = self.raw("events") if events is None else events
        iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
        message = json_text(
            F.col("event_id").cast("string").alias("event_id"),
            F.lit("product_usage").alias("event_type"),
            account_of(F.col("user_id")).cast("string").alias("customer_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.col("event_type").alias("feature"),
            iso.alias("timestamp"),
        )
        return events.select(message.alias("value"), F.col("ts").cast("timestamp").alias("received_at"))

    def live_stream(self) -> DataFrame:
        """The same messages as a file stream."""
        return self.live_messages(self.spark.readStream.schema(SCHEMAS["events"]).parquet(f"{self.folder}/events*.parquet"))

    @once
    def alerts(self) -> DataFrame:
        """A seed alert per customer: type by market, open while the balance is low."""
        market, balance = F.col("c_mktsegment"), F.col("c_acctbal")
        kind = (
            F.when(market == "BUILDING", "Payment Failure")
            .when(market == "MACHINERY", "Expansion Opportunity")
            .otherwise("Customer Health Risk")
        )
        at = F.timestamp_seconds(F.unix_timestamp(F.lit(ALERT_EPOCH).cast("timestamp")) + F.col("c_custkey"))
        is_open = balance < 4000
        return self.raw("customer").select(
            F.col("c_custkey").alias("alert_id"),
            F.col("c_custkey").alias("customer_id"),
            kind.alias("alert_type"),
            F.when(balance < 1000, "High").otherwise("Medium").alias("severity"),
            F.when(market == "BUILDING", "Billing").otherwise("CSM").alias("owner"),
            F.when(is_open, "Open").otherwise("Acknowledged").alias("status"),
            F.lit("Seed alert").alias("reason"),
            F.lit("Review").alias("recommended_action"),
            F.lit("Seed").alias("source"),
            F.lit("{}").alias("metadata"),
            at.cast("timestamp_ntz").alias("created_at"),
            F.when(~is_open, at).cast("timestamp_ntz").alias("acknowledged_at"),
        )
