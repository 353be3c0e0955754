"""Data-quality checks, the suite and gate built from them, and contracts.

Checks that look at the same table share one pass: a grouping by key yields
the volume, the NULL keys and the duplicated keys at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fixed_values import CORE_MESSAGE, MODEL_CONTRACTS, QUALITY_CHECKS

RESULT_SCHEMA = (
    "dq_id int, check_name string, table_name string, check_type string, status string, "
    "actual_value bigint, expected_value bigint, message string"
)
_SPECS = {spec[0]: (number, spec) for number, spec in enumerate(QUALITY_CHECKS, start=1)}


class QualityGateError(RuntimeError):
    """A gate found failing checks or empty tables."""


def _result(check_name: str, actual: Column, minimum: int = 1) -> Column:
    """One result row as a struct, from the measured value."""
    number, (name, table, kind, bad, message, _) = _SPECS[check_name]
    volume = kind == "VOLUME"
    expected = minimum if volume else 0
    passed = actual >= minimum if volume else actual == 0
    return F.struct(
        F.lit(number).alias("dq_id"),
        F.lit(name).alias("check_name"),
        F.lit(f"silver.{table}").alias("table_name"),
        F.lit(kind).alias("check_type"),
        F.when(passed, "PASS").otherwise(bad).alias("status"),
        actual.cast("bigint").alias("actual_value"),
        F.lit(expected).cast("bigint").alias("expected_value"),
        F.lit(message.format(minimum=minimum)).alias("message"),
    )


def _results(measured: DataFrame, *results: Column) -> DataFrame:
    """Turn a one-row measurement into result rows."""
    return measured.select(F.inline(F.array(*results)))


# ---- measurements: one row each --------------------------------------------


def _key_profile(df: DataFrame, key: str) -> DataFrame:
    """volume, null_keys, duplicate_keys of a table.

    Copies of a key collapse before the shuffle; NULL forms a group like any
    other and counts as a duplicate when it occurs more than once.
    """
    copies = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("volume"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("copies"))), F.lit(0)).alias("null_keys"),
        F.count_if(F.col("copies") > 1).alias("duplicate_keys"),
    )


def _orphans(child: DataFrame, parent: DataFrame, on: str) -> DataFrame:
    """Child rows without a parent; rows are counted per key before the join,
    so a hot foreign key travels as one row."""
    per_key = child.groupBy(on).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.join(parent.select(on), on, "left_anti").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("orphans")
    )


def _dated_users(users: DataFrame) -> DataFrame:
    """(user_id, created_at, copies) in a form that leaves Spark free to split
    the events of busy users in a join."""
    user = F.struct("user_id").alias("_user")
    copies = users.groupBy(user, "created_at").agg(F.count(F.lit(1)).alias("copies"))
    return copies.select(F.col("_user.user_id").alias("user_id"), "created_at", "copies")


def _event_profile(events: DataFrame, users: DataFrame) -> DataFrame:
    """orphans and early events, from one join of events to users; an event that
    is early for several rows of its user counts for each."""
    early = F.col("event_timestamp") < F.col("created_at")
    return events.select("user_id", "event_timestamp").join(_dated_users(users), "user_id", "left").agg(
        F.count_if(F.col("copies").isNull()).alias("orphans"),
        F.coalesce(F.sum(F.when(early, F.col("copies"))), F.lit(0)).alias("early"),
    )


def _subscription_profile(subscriptions: DataFrame) -> DataFrame:
    """NULL subscription ids and accounts with several active subscriptions."""
    per_account = subscriptions.groupBy("account_id").agg(
        F.count_if(F.col("subscription_id").isNull()).alias("null_ids"),
        F.count_if(F.col("status") == "Active").alias("active"),
    )
    return per_account.agg(
        F.coalesce(F.sum("null_ids"), F.lit(0)).alias("null_keys"),
        F.count_if(F.col("active") > 1).alias("several_active"),
    )


def _invoice_profile(invoices: DataFrame, plans: DataFrame) -> DataFrame:
    """volume, and invoices whose amount is no plan's price.

    Nearly all invoices share a few amounts: they are counted per amount first,
    and only the amounts meet the prices.
    """
    prices = plans.select(
        F.col("monthly_price").cast(invoices.schema["amount"].dataType).alias("amount"), F.lit(True).alias("listed")
    ).distinct()
    per_amount = invoices.groupBy("amount").agg(F.count(F.lit(1)).alias("rows"))
    return per_amount.join(prices, "amount", "left").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("volume"),
        F.coalesce(F.sum(F.when(F.col("listed").isNull(), F.col("rows"))), F.lit(0)).alias("unpriced"),
    )


# ---- single checks ------------------------------------------------------------


def dq_null_check(df: DataFrame, column: str, check_name: str) -> DataFrame:
    measured = df.agg(F.count_if(F.col(column).isNull()).alias("n"))
    return _results(measured, _result(check_name, F.col("n")))


def dq_duplicate_check(df: DataFrame, key: str, check_name: str) -> DataFrame:
    return _results(_key_profile(df, key), _result(check_name, F.col("duplicate_keys")))


def dq_referential_check(child: DataFrame, parent: DataFrame, on: str, check_name: str) -> DataFrame:
    return _results(_orphans(child, parent, on), _result(check_name, F.col("orphans")))


def dq_events_before_creation(events: DataFrame, users: DataFrame) -> DataFrame:
    return _results(_event_profile(events, users), _result("Product events before user creation", F.col("early")))


def dq_multiple_active(subscriptions: DataFrame) -> DataFrame:
    measured = _subscription_profile(subscriptions)
    return _results(measured, _result("Multiple active subscriptions per account", F.col("several_active")))


def dq_invoice_price(invoices: DataFrame, plans: DataFrame) -> DataFrame:
    return _results(_invoice_profile(invoices, plans), _result("Invoice amount plan price check", F.col("unpriced")))


def dq_min_volume(df: DataFrame, check_name: str, minimum: int = 1) -> DataFrame:
    return _results(df.agg(F.count(F.lit(1)).alias("n")), _result(check_name, F.col("n"), minimum))


# ---- suite and gate ------------------------------------------------------------


def dq_suite(tables: dict[str, DataFrame]) -> DataFrame:
    """All sixteen checks, one row each, in stored order (``dq_id``)."""
    accounts, users, events = tables["accounts"], tables["users"], tables["product_events"]
    parts = [
        _results(
            _key_profile(accounts, "account_id"),
            _result("Accounts account_id NULL check", F.col("null_keys")),
            _result("Accounts duplicate account_id check", F.col("duplicate_keys")),
            _result("Accounts minimum volume", F.col("volume")),
        ),
        _results(
            _key_profile(users, "user_id"),
            _result("Users user_id NULL check", F.col("null_keys")),
            _result("Users duplicate user_id check", F.col("duplicate_keys")),
            _result("Users minimum volume", F.col("volume")),
        ),
        _results(
            _key_profile(events, "event_id"),
            _result("Product events event_id NULL check", F.col("null_keys")),
            _result("Product events duplicate event_id check", F.col("duplicate_keys")),
            _result("Product events minimum volume", F.col("volume")),
        ),
        _results(
            _subscription_profile(tables["subscriptions"]),
            _result("Subscriptions subscription_id NULL check", F.col("null_keys")),
            _result("Multiple active subscriptions per account", F.col("several_active")),
        ),
        _results(
            _orphans(users, accounts, "account_id"),
            _result("Users account reference check", F.col("orphans")),
        ),
        _results(
            _event_profile(events, users),
            _result("Product event user reference check", F.col("orphans")),
            _result("Product events before user creation", F.col("early")),
        ),
        _results(
            _invoice_profile(tables["invoices"], tables["dim_plan"]),
            _result("Invoice amount plan price check", F.col("unpriced")),
            _result("Invoices minimum volume", F.col("volume")),
        ),
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("dq_id")


def dq_core_results(tables: dict[str, DataFrame]) -> DataFrame:
    """The gate's six checks with its own message; raises nothing."""
    accounts, users, events = tables["accounts"], tables["users"], tables["product_events"]
    parts = [
        _results(
            _key_profile(accounts, "account_id"),
            _result("Accounts account_id NULL check", F.col("null_keys")),
            _result("Accounts duplicate account_id check", F.col("duplicate_keys")),
        ),
        _results(
            _orphans(users, accounts, "account_id"),
            _result("Users account reference check", F.col("orphans")),
        ),
        _results(
            _event_profile(events, users),
            _result("Product event user reference check", F.col("orphans")),
            _result("Product events before user creation", F.col("early")),
        ),
        dq_multiple_active(tables["subscriptions"]),
    ]
    before, after = CORE_MESSAGE.split("{status}")
    message = F.concat(F.lit(before), F.col("status"), F.lit(after))
    return reduce(DataFrame.unionByName, parts).withColumn("message", message).orderBy("dq_id")


def run_core_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Run the core checks now and keep their six rows, so that storing and
    judging them costs one evaluation."""
    core = dq_core_results(tables)
    return core.sparkSession.createDataFrame(core.collect(), RESULT_SCHEMA)


def raise_on_failures(results: DataFrame) -> None:
    """Raise when a stored check FAILed; a WARN passes."""
    failed = [row["check_name"] for row in results.filter(F.col("status") == "FAIL").collect()]
    if failed:
        raise QualityGateError(f"{len(failed)} failed checks: {', '.join(failed)}")


def dq_core_gate(tables: dict[str, DataFrame]) -> DataFrame:
    """The core checks' rows; raises if one of them FAILs."""
    results = run_core_checks(tables)
    raise_on_failures(results)
    return results


def nonempty_gate(tables: dict[str, DataFrame], *, fail: bool = True) -> DataFrame:
    """Row count per table of a layer; raises when one is empty.

    Runs one job and brings back one row per table.
    """
    counts = reduce(
        DataFrame.unionByName,
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
         for name, df in tables.items()],
    )
    found = {row["table_name"]: row["row_count"] for row in counts.collect()}
    return counted_gate(counts.sparkSession, found, fail=fail)


def counted_gate(spark: SparkSession, counts: dict[str, int], *, fail: bool = True) -> DataFrame:
    """The same from counts observed while the layer was written: runs no job."""
    rows = [(name, count, count > 0) for name, count in counts.items()]
    empty = [name for name, _, ok in rows if not ok]
    if fail and empty:
        raise QualityGateError(f"empty tables: {', '.join(empty)}")
    return spark.createDataFrame(rows, "table_name string, row_count bigint, ok boolean")


def observed_checks(spark: SparkSession, counts: dict[str, dict[str, int]]) -> DataFrame:
    """The volume checks and NULL checks of the stored tables, from the counts
    (``row_count`` and ``null_keys``) that their writes observed: runs no job."""
    measured = spark.range(1)
    results = []
    for name, (_, table, kind, _, _, _) in ((spec[0], spec) for spec in QUALITY_CHECKS):
        if kind == "VOLUME" and table in counts:
            results.append(_result(name, F.lit(counts[table]["row_count"])))
        elif kind == "NULL" and table in counts:
            results.append(_result(name, F.lit(counts[table]["null_keys"])))
    return _results(measured, *results)


# ---- reports over stored results ---------------------------------------------


def dq_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("check_count")).orderBy("status")


def dq_report(results: DataFrame, order: str = "severity") -> DataFrame:
    """Failures first, then warnings, then the rest; or ``order="inserted"``."""
    if order == "inserted":
        return results.orderBy("dq_id")
    rank = F.when(F.col("status") == "FAIL", 1).when(F.col("status") == "WARN", 2).otherwise(3)
    return results.orderBy(rank, "check_name")


def dq_pass_rate(results: DataFrame) -> DataFrame:
    """Passing and warning checks, and the passing share in whole percent."""
    status = F.lower("status")
    counted = results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(status == "pass").alias("passing"),
        F.count_if(status == "warn").alias("warnings"),
    )
    rate = F.floor(F.col("passing") * 100 / F.nullif(F.col("checks"), F.lit(0)) + 0.5)
    return counted.withColumn("pass_rate_pct", F.coalesce(rate, F.lit(0)).cast("bigint"))


# ---- column contracts ------------------------------------------------------------


def schema_contracts(models: dict[str, DataFrame], contracts: dict = MODEL_CONTRACTS) -> DataFrame:
    """Failures of each not-null and unique contract, one pass per model.

    ``unique`` ignores NULLs, unlike the duplicate check above.
    """
    parts = []
    for model, (unique_key, not_null) in contracts.items():
        df = models[model]
        if unique_key is None:
            measured = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in not_null])
        else:
            others = [name for name in not_null if name != unique_key]
            per_key = df.groupBy(unique_key).agg(
                F.count(F.lit(1)).alias("_copies"),
                *[F.count_if(F.col(name).isNull()).alias(f"_null_{name}") for name in others],
            )
            missing = F.col(unique_key).isNull()
            measured = per_key.agg(
                F.count_if(~missing & (F.col("_copies") > 1)).alias("_duplicates"),
                F.coalesce(F.sum(F.when(missing, F.col("_copies"))), F.lit(0)).alias(unique_key),
                *[F.coalesce(F.sum(f"_null_{name}"), F.lit(0)).alias(name) for name in others],
            )
        rows = [(name, "not_null", F.col(name)) for name in not_null]
        if unique_key is not None:
            rows.append((unique_key, "unique", F.col("_duplicates")))
        parts.append(
            measured.select(
                F.inline(
                    F.array(
                        *[
                            F.struct(
                                F.lit(model).alias("model"),
                                F.lit(column).alias("column_name"),
                                F.lit(test).alias("test"),
                                failures.cast("bigint").alias("failures"),
                            )
                            for column, test, failures in rows
                        ]
                    )
                )
            )
        )
    return reduce(DataFrame.unionByName, parts)
