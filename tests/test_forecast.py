from datetime import date, datetime
from decimal import Decimal

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import forecast

SCHEMA = "date_key date, amount decimal(18,2), status string, region string"


def at():
    return F.lit(datetime(2026, 1, 1)).cast("timestamp_ntz")


def billing(spark, months, region="N"):
    """One paid and one unpaid invoice per (month, amount)."""
    return spark.createDataFrame(
        [row for day, amount in months for row in ((day, Decimal(amount), "Paid", region), (day, Decimal(7), "Failed", region))],
        SCHEMA,
    )


# June is missing and the year ends in between.
MONTHS = [
    (date(2025, 7, 3), "100"), (date(2025, 8, 9), "130"), (date(2025, 9, 1), "125.50"), (date(2025, 10, 30), "160"),
    (date(2025, 12, 31), "190"), (date(2026, 1, 1), "185"),
]


def test_months_are_not_filled(spark):
    monthly = forecast.monthly_paid_revenue(billing(spark, MONTHS))
    assert rows(monthly, "revenue_month", "time_index")[4] == (date(2025, 12, 1), 4)
    assert rows(monthly, "monthly_revenue")[0] == (Decimal("100.00"),)


def test_holdout_and_forecast_match_numpy(spark):
    monthly = forecast.monthly_paid_revenue(billing(spark, MONTHS))
    y = np.array([float(amount) for _, amount in MONTHS])
    slope, intercept = np.polyfit(np.arange(4), y[:4], 1)
    held = rows(forecast.revenue_holdout(monthly))
    predicted = intercept + slope * np.array([4, 5])
    assert [row[3] for row in held] == pytest.approx(list(predicted))
    mae = float(np.abs(y[4:] - predicted).mean())
    assert held[0][4] == pytest.approx(mae)

    slope, intercept = np.polyfit(np.arange(6), y, 1)
    ahead = rows(forecast.revenue_forecast(monthly, at()), "forecast_month", "forecast_revenue", "model_name", "validation_mae")
    assert [row[0] for row in ahead] == [date(2026, 2, 1), date(2026, 3, 1), date(2026, 4, 1)]
    assert [row[1] for row in ahead] == pytest.approx(list(intercept + slope * np.array([6, 7, 8])))
    assert {row[2] for row in ahead} == {"Linear Regression"} and ahead[0][3] == pytest.approx(mae)


def test_short_history_raises(spark):
    monthly = forecast.monthly_paid_revenue(billing(spark, MONTHS[:5]))
    for query in (forecast.revenue_holdout(monthly), forecast.revenue_forecast(monthly, at())):
        with pytest.raises(Exception, match="At least 6 months"):
            query.collect()


def test_segments_are_independent(spark):
    both = billing(spark, MONTHS).unionByName(billing(spark, [(d, str(float(a) * 2)) for d, a in MONTHS], "S"))
    split = forecast.revenue_forecast(forecast.monthly_paid_revenue(both, "region"), at())
    alone = rows(forecast.revenue_forecast(forecast.monthly_paid_revenue(billing(spark, MONTHS)), at()), "forecast_revenue")
    values = {key: [r[2] for r in rows(split) if r[0] == key] for key in "NS"}
    assert values["N"] == pytest.approx([v for (v,) in alone])
    assert values["S"] == pytest.approx([2 * v for (v,) in alone])


def test_upsert_twice_is_once(spark):
    monthly = forecast.monthly_paid_revenue(billing(spark, MONTHS))
    new = forecast.revenue_forecast(monthly, at()).drop("segment")
    old = new.withColumn("forecast_revenue", F.lit(1.0)).withColumn("forecast_month", F.add_months("forecast_month", -1))
    once = forecast.upsert(old, new, "forecast_month")
    assert rows(once) == rows(forecast.upsert(once, new, "forecast_month"))
    assert [row[0] for row in rows(once, "forecast_month")] == [date(2026, m, 1) for m in (1, 2, 3, 4)]
    assert rows(once, "forecast_month", "forecast_revenue")[0][1] == 1.0


def test_short_segments_are_named_and_left_out(spark):
    both = billing(spark, MONTHS, "N").unionByName(billing(spark, MONTHS[:1], "S"))
    monthly = forecast.monthly_paid_revenue(both, "region")
    assert {row["segment"] for row in forecast.revenue_forecast(monthly, at()).collect()} == {"N"}
    assert rows(forecast.short_series(monthly), "segment", "months") == [("S", 1)]


def test_undated_paid_invoices_are_counted(spark):
    undated = billing(spark, MONTHS).unionByName(billing(spark, [(None, "12.50"), (None, "1")]))
    assert rows(forecast.undated_paid_revenue(undated)) == [(2, Decimal("13.50"))]
