"""One key holds a third of all rows: the work still spreads, results stay whole."""

import pytest
from conftest import T0, hours, rows
from pyspark.sql import functions as F

from tidemark.functions.joins import hot_keys, salt_rows, salted_join
from tidemark.operators import marts, quality
from tidemark.operators.events import flag_and_enrich, flag_valid_events
from tidemark.sources import by_user
from tidemark.sources.driver_tables import DriverTables

ROWS = 300_000


@pytest.fixture
def tiny_thresholds(spark):
    """Make a few megabytes count as a big cluster's partitions would."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hot_events(spark):
    """User 0 owns a third of the events; a third of those are copies of one."""
    user = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997 + 1)
    copies = F.when(F.col("id") % 9 == 0, 0).otherwise(F.col("id"))
    return spark.range(0, ROWS, 1, 16).select(
        copies.alias("event_id"),
        user.cast("bigint").alias("user_id"),
        F.concat(F.lit("f"), (F.col("id") % 5).cast("string")).alias("feature"),
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))).cast("timestamp_ntz").alias("event_timestamp"),
    )


def people(spark):
    created = F.timestamp_seconds(F.lit(1_700_000_000 + ROWS // 2)).cast("timestamp_ntz")
    return spark.range(998).select(
        F.col("id").alias("user_id"), (F.col("id") % 100).alias("account_id"), F.lit("User").alias("role"), created.alias("created_at")
    )


def test_flagging_keeps_every_event(spark, tiny_thresholds):
    flagged = flag_valid_events(hot_events(spark), people(spark)).groupBy("user_id").agg(
        F.count_if("is_valid_event").alias("valid"), F.count(F.lit(1)).alias("n")
    )
    result = {row["user_id"]: (row["valid"], row["n"]) for row in flagged.collect()}
    assert result[0] == (ROWS // 6, ROWS // 3)
    assert sum(n for _, n in result.values()) == ROWS


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_event_joins_split_hot_users_and_push_filters(spark, tiny_thresholds, tmp_path):
    hot_events(spark).write.parquet(f"{tmp_path}/events")
    events = spark.read.parquet(f"{tmp_path}/events")
    grouped = people(spark).groupBy("user_id").agg(F.min("created_at").alias("created_at"), F.min("account_id").alias("account_id"))
    late = F.col("event_timestamp") > F.lit("2023-11-15").cast("timestamp_ntz")
    for flagged in (flag_valid_events(events, grouped), flag_and_enrich(events, grouped)):
        plan = executed(flagged.filter(late & F.col("is_valid_event")).agg(F.count(F.lit(1)), F.max("feature")))
        assert "SortMergeJoin(skew=true)" in plan
        assert "GreaterThan(event_timestamp" in plan  # in the scan's pushed filters
    early = quality.dq_events_before_creation(events, grouped)
    assert "SortMergeJoin(skew=true)" in executed(early) and rows(early, "actual_value") == [(ROWS // 2,)]


def test_stored_by_user_joins_without_a_shuffle(spark, tiny_thresholds, tmp_path):
    events = hot_events(spark).withColumn("user_id", F.when(F.col("user_id") % 5 != 1, F.col("user_id")))
    by_user.store_by_user(events, people(spark), "skewed", str(tmp_path), buckets=16)
    stored = by_user.stored_flags(spark, "skewed")
    late = F.col("event_timestamp") > F.lit("2023-11-15").cast("timestamp_ntz")
    plan = executed(stored.filter(late).select("event_id", "is_valid_event"))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert "GreaterThan(event_timestamp" in plan
    plain = flag_and_enrich(events, people(spark)).select(stored.columns)
    assert stored.exceptAll(plain).count() == 0 and plain.exceptAll(stored).count() == 0
    # No bucket holds much more than its share, though one user and NULL hold half of all.
    sizes = spark.table("skewed_events").groupBy(F.pmod(F.hash("user_id", "slot"), F.lit(16)).alias("bucket")).count()
    assert sizes.agg(F.max("count")).first()[0] < 4 * ROWS // 16
    for name in ("skewed_events", "skewed_users"):
        spark.sql(f"DROP TABLE {name}")


def test_quality_join_counts_every_event(spark, tiny_thresholds):
    early = quality.dq_events_before_creation(hot_events(spark), people(spark))
    assert rows(early, "actual_value") == [(ROWS // 2,)]


def test_hot_user_and_null_user_spread(spark):
    """No (key, salt) group keeps more than about one piece of the rows, not
    even copies of a single row."""
    events = hot_events(spark).withColumn("user_id", F.when(F.col("user_id") % 5 != 1, F.col("user_id")))
    one_row = (F.col("event_id") == 0) & (F.col("user_id") == 0)
    events = events.withColumn("event_timestamp", F.when(one_row, F.lit(T0)).otherwise(F.col("event_timestamp")))
    events = events.withColumn("feature", F.when(one_row, "f0").otherwise(F.col("feature")))
    assert events.groupBy(*events.columns).count().agg(F.max("count")).first()[0] > ROWS // 10
    hot = hot_keys(events, "user_id")
    listed = {row["user_id"]: row["_salts"] for row in hot.collect()}
    assert set(listed) == {0}  # a third of all rows; nobody else is close to 1/32
    salted = salt_rows(events, hot, "user_id")
    assert salted.count() == ROWS
    largest = salted.groupBy("user_id", "_salt").count().agg(F.max("count")).first()[0]
    assert largest < ROWS // 10
    same = salted.exceptAll(salt_rows(events, hot_keys(events, "user_id"), "user_id"))
    assert same.count() == 0  # a second run assigns the same salts


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, tiny_thresholds, how):
    large = hot_events(spark).filter("event_id < 20000").withColumn(
        "user_id", F.when(F.col("user_id") % 7 != 3, F.col("user_id"))
    )
    keyed = people(spark).filter("user_id < 500").select("user_id", "account_id")
    keyed = keyed.unionByName(keyed.filter("user_id < 3"))  # keys listed twice
    plain = large.join(keyed, "user_id", how)
    salted = salted_join(large, keyed, "user_id", how)
    assert salted.columns == plain.columns
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0


def test_outer_joins_are_refused(spark):
    with pytest.raises(ValueError, match="full"):
        salted_join(hot_events(spark), people(spark), "user_id", "full")


def test_fact_lookup_splits_through_adaptive_execution(spark, tiny_thresholds, tmp_path):
    """Both sides come straight from a shuffle here, so Spark splits by itself."""
    order = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    spark.range(0, ROWS, 1, 8).select(
        order.alias("l_orderkey"), F.lit(1).cast("bigint").alias("l_partkey"), F.lit(1).cast("bigint").alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), F.rand(1).alias("l_quantity"), F.rand(2).alias("l_extendedprice"),
        F.rand(3).alias("l_discount"), F.rand(4).alias("l_tax"), F.lit("R").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"), F.lit(T0).cast("timestamp_ntz").alias("l_shipdate"),
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(0, ROWS, 1, 8).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 100).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), F.lit(T0).cast("timestamp_ntz").alias("o_orderdate"), F.lit("5-LOW").alias("o_orderpriority"),
    ).write.parquet(f"{tmp_path}/orders.parquet")
    billed = marts.customer_billing(DriverTables(spark, str(tmp_path)).invoices().withColumnRenamed("account_id", "customer_id"))
    assert sum(row["total_invoices"] for row in billed.collect()) == ROWS
    assert "SortMergeJoin(skew=true)" in billed._jdf.queryExecution().executedPlan().toString()


def test_usage_shuffles_counts_not_events(spark, tiny_thresholds):
    events = hot_events(spark).withColumn("is_valid_event", F.lit(True))
    counts = marts.user_feature_counts(events)
    assert counts.agg(F.sum("feature_events")).first()[0] == ROWS
    users = people(spark).withColumnRenamed("account_id", "customer_id")
    usage = marts.customer_usage(spark.range(100).withColumnRenamed("id", "customer_id"), users, events)
    assert usage.agg(F.sum("total_events")).first()[0] == ROWS
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange")  # printed top-down: combined below the shuffle


def test_ticket_lookahead_of_a_hot_user(spark, tmp_path):
    """One user owns a third of the events; compare with a plain lookahead."""
    folder = tmp_path / "sf"
    n = 60_000
    user = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1)
    kind = F.when(F.hash("id") % 10 < 8, "error").otherwise("view")
    spark.range(n).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") / 4).cast("bigint")).cast("timestamp_ntz").alias("ts"),
        user.cast("bigint").alias("user_id"),
        kind.alias("event_type"),
        F.lit(1.0).alias("value"),
        F.lit("{}").alias("props"),
    ).write.parquet(f"{folder}/events.parquet")
    found = dict(rows(DriverTables(spark, str(folder)).support(), "ticket_id", "resolved_at"))
    history = {}
    for row in spark.read.parquet(f"{folder}/events.parquet").collect():
        history.setdefault(row["user_id"], []).append((row["ts"], row["event_id"], row["event_type"]))
    expected = {}
    for events in history.values():
        upcoming = None
        for ts, event_id, event_type in sorted(events, reverse=True):
            if event_type == "error":
                expected[event_id] = upcoming
            else:
                upcoming = ts
    assert found == expected


def test_supports_one_account_with_a_third_of_tickets(spark):
    tickets = spark.range(90_000).select(
        F.col("id").alias("ticket_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("account_id"),
        F.lit("High").alias("severity"),
        F.lit(T0).cast("timestamp_ntz").alias("created_at"),
        F.lit(T0 + hours(3)).cast("timestamp_ntz").alias("resolved_at"),
    )
    from tidemark.operators import staging

    support = marts.customer_support(staging.stage_support(tickets))
    assert rows(support.filter("customer_id = 0")) == [(0, 30_000, 30_000, 3.0)]


def test_every_hot_key_is_listed(spark):
    """2,000 equal keys, each due several salts: none is left out."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        listed = hot_keys(spark.range(0, 40_000, 1, 8).select((F.col("id") % 2000).alias("user_id")), "user_id")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "8")
        assert listed.filter("_salts = 4").count() == 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        spark.conf.set("spark.sql.shuffle.partitions", before)
