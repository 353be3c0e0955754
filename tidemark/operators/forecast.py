"""Monthly revenue, its holdout check and the least-squares forecast.

Facts shrink to one row per month (and segment) in a combined aggregate; all
later steps work on that calendar-bounded result.  A ``segment`` column fits
many series at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import month_of
from tidemark.functions.fixed_values import (
    FORECAST_HORIZON,
    FORECAST_MODEL,
    HOLDOUT_MONTHS,
    MINIMUM_MONTHS,
)

UNSEGMENTED = "all"


def monthly_paid_revenue(fact_billing: DataFrame, segment: str | None = None) -> DataFrame:
    """Paid revenue per month with a running ``time_index``.

    Months without paid invoices are not filled in; the index skips them.  Paid
    invoices without a date are in no month: see ``undated_paid_revenue``.
    """
    name = F.lit(UNSEGMENTED) if segment is None else F.col(segment)
    by_month = Window.partitionBy("segment").orderBy("revenue_month")
    return (
        fact_billing.filter((F.col("status") == "Paid") & F.col("date_key").isNotNull())
        .groupBy(name.alias("segment"), month_of(F.col("date_key")).alias("revenue_month"))
        .agg(F.sum("amount").alias("monthly_revenue"))
        .withColumn("time_index", (F.row_number().over(by_month) - 1).cast("bigint"))
    )


def segmented_paid_revenue(fact_billing: DataFrame, customers: DataFrame, segment: str) -> DataFrame:
    """Monthly paid revenue per customer segment.

    The facts shrink to one row per customer and month before they meet the
    customers, so a customer owning a third of the invoices joins as few rows.
    """
    per_customer = (
        fact_billing.filter((F.col("status") == "Paid") & F.col("date_key").isNotNull())
        .groupBy("customer_id", month_of(F.col("date_key")).alias("date_key"))
        .agg(F.sum("amount").alias("amount"))
        .withColumn("status", F.lit("Paid"))
    )
    return monthly_paid_revenue(per_customer.join(customers.select("customer_id", segment), "customer_id"), segment)


def _held_out(monthly: DataFrame) -> DataFrame:
    """Months with the holdout model's prediction beside them.

    Segments shorter than the minimum are left out (``short_series`` names them);
    an unsegmented series that short raises when run.
    """
    series = Window.partitionBy("segment")
    months = F.count(F.lit(1)).over(series)
    short = F.raise_error(F.lit(f"At least {MINIMUM_MONTHS} months of revenue history are required."))
    x = F.col("time_index").cast("double")
    y = F.col("monthly_revenue").cast("double")
    train_y = F.when(F.col("time_index") < F.col("months") - HOLDOUT_MONTHS, y)
    too_short = F.col("months") < MINIMUM_MONTHS
    return (
        monthly.withColumn("months", months)
        .filter(~too_short | (F.col("segment") == UNSEGMENTED))
        .withColumn("months", F.when(too_short, short.cast("bigint")).otherwise(F.col("months")))
        .withColumn("slope", F.regr_slope(train_y, x).over(series))
        .withColumn("intercept", F.regr_intercept(train_y, x).over(series))
        .withColumn("held_out", F.col("time_index") >= F.col("months") - HOLDOUT_MONTHS)
        .withColumn("actual", y)
        .withColumn("predicted", F.col("intercept") + F.col("slope") * x)
    )


def short_series(monthly: DataFrame) -> DataFrame:
    """(segment, months, monthly_revenue) of segments too short for a forecast."""
    return (
        monthly.groupBy("segment")
        .agg(F.count(F.lit(1)).alias("months"), F.sum("monthly_revenue").alias("monthly_revenue"))
        .filter(F.col("months") < MINIMUM_MONTHS)
    )


def undated_paid_revenue(fact_billing: DataFrame) -> DataFrame:
    """One row: paid invoices that no month can count, and their amount."""
    undated = fact_billing.filter((F.col("status") == "Paid") & F.col("date_key").isNull())
    return undated.agg(F.count(F.lit(1)).alias("invoices"), F.sum("amount").alias("amount"))


def _error() -> Column:
    return F.abs(F.col("actual") - F.col("predicted"))


def revenue_holdout(monthly: DataFrame) -> DataFrame:
    """Prediction of the last two months by a line through the earlier ones."""
    return (
        _held_out(monthly)
        .filter("held_out")
        .withColumn("mae", F.avg(_error()).over(Window.partitionBy("segment")))
        .select("segment", "revenue_month", "actual", "predicted", "mae")
    )


def revenue_forecast(monthly: DataFrame, generated_at: Column, horizon: int = FORECAST_HORIZON) -> DataFrame:
    """Next months' revenue from a line through all months, with the holdout MAE."""
    x, y = F.col("time_index").cast("double"), F.col("actual")
    fitted = (
        _held_out(monthly)
        .groupBy("segment")
        .agg(
            F.regr_slope(y, x).alias("slope"),
            F.regr_intercept(y, x).alias("intercept"),
            F.max("time_index").alias("last_index"),
            F.max("revenue_month").alias("last_month"),
            F.avg(F.when(F.col("held_out"), _error())).alias("validation_mae"),
        )
    )
    ahead = F.col("ahead")
    return fitted.withColumn("ahead", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).select(
        "segment",
        F.add_months("last_month", ahead).alias("forecast_month"),
        (F.col("intercept") + F.col("slope") * (F.col("last_index") + ahead)).alias("forecast_revenue"),
        F.lit(FORECAST_MODEL).alias("model_name"),
        "validation_mae",
        generated_at.alias("generated_at"),
    )


def upsert(existing: DataFrame, new: DataFrame, key: str | list[str]) -> DataFrame:
    """``existing`` with rows of equal key replaced by ``new``; never write the
    result over the table ``existing`` reads."""
    return existing.join(new, key, "left_anti").unionByName(new.select(*existing.columns))
