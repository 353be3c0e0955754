"""Wall-clock differences do not depend on the session's zone."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import hundredth_hours, whole_days


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_differences_over_a_clock_change(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        day = spark.createDataFrame([(datetime(2026, 3, 8, 0, 0), datetime(2026, 3, 8, 6, 0))], "a timestamp_ntz, b timestamp_ntz")
        row = day.select(hundredth_hours(F.col("a"), F.col("b")), whole_days(F.col("b"), F.col("a"))).first()
        assert tuple(row) == (600, -1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
