"""Raw layer (text as delivered) and typed layer (checked casts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.stored import current_table, replace_table

MALFORMED = "malformed_line"
PART = "_part"

# Typed layer: target column -> (raw column, type).
TYPED_TABLES = {
    "accounts": {
        "account_id": ("account_id", "bigint"),
        "industry": ("industry", "string"),
        "size": ("size", "string"),
        "region": ("region", "string"),
        "owner": ("owner", "string"),
    },
    "users": {
        "user_id": ("user_id", "bigint"),
        "account_id": ("account_id", "bigint"),
        "role": ("role", "string"),
        "created_at": ("created_at", "timestamp_ntz"),
    },
    "product_events": {
        "event_id": ("event_id", "bigint"),
        "user_id": ("user_id", "bigint"),
        "feature": ("feature", "string"),
        "event_timestamp": ("timestamp", "timestamp_ntz"),
    },
    "subscriptions": {
        "subscription_id": ("subscription_id", "bigint"),
        "account_id": ("account_id", "bigint"),
        "plan": ("plan", "string"),
        "start_date": ("start_date", "timestamp_ntz"),
        "status": ("status", "string"),
    },
    "invoices": {
        "invoice_id": ("invoice_id", "bigint"),
        "account_id": ("account_id", "bigint"),
        "amount": ("amount", "decimal(18,2)"),
        "due_date": ("due_date", "timestamp_ntz"),
        "status": ("status", "string"),
    },
    "support": {
        "ticket_id": ("ticket_id", "bigint"),
        "account_id": ("account_id", "bigint"),
        "severity": ("severity", "string"),
        "created_at": ("created_at", "timestamp_ntz"),
        "resolved_at": ("resolved_at", "timestamp_ntz"),
    },
    "dim_plan": {
        "plan_id": ("plan_id", "int"),
        "plan_name": ("plan_name", "string"),
        "monthly_price": ("monthly_price", "int"),
    },
}


def bronze_ingest(
    spark: SparkSession, csv_path: str, table_path: str, columns=None, multiline: bool = False
) -> DataFrame:
    """Replace the raw table at ``table_path`` with the CSV's rows, all text.

    Blank cells become NULL, nothing else does.  Lines with more or fewer cells
    than the header are kept whole beside the rows (``malformed_lines``).  The
    CSV is parsed once for both, and both are there or neither: the table is
    switched after they stand, and a failing job leaves the old one.  ``columns``
    names the header, and each file's own must agree; without it the header line
    is read to learn it.  ``multiline`` allows line breaks inside quotes, at the
    price of reading each file in one task.
    """
    reader = spark.read.options(header=True, nullValue="", escape='"', multiLine=multiline, enforceSchema=False)
    if columns is None:
        columns = reader.option("inferSchema", False).csv(csv_path).columns
    text = ", ".join(f"`{name}` string" for name in (*columns, MALFORMED))
    lines = reader.option("columnNameOfCorruptRecord", MALFORMED).schema(text).csv(csv_path)
    bad = F.col(MALFORMED).isNotNull()
    replace_table(
        lines.withColumn(PART, F.when(bad, "malformed").otherwise("rows")), table_path, (PART,),
        good_rows=F.count_if(~bad), malformed_rows=F.count_if(bad),
    )
    return bronze_table(spark, table_path)


def bronze_table(spark: SparkSession, table_path: str) -> DataFrame:
    """The rows of a raw table."""
    return current_table(spark, table_path).filter(F.col(PART) == "rows").drop(PART, MALFORMED)


def malformed_lines(spark: SparkSession, table_path: str) -> DataFrame:
    """(malformed_line): the lines of its CSV that are no rows."""
    return current_table(spark, table_path).filter(F.col(PART) == "malformed").select(MALFORMED)


def _typed(raw: Column, kind: str) -> Column:
    text = F.nullif(F.trim(raw), F.lit(""))
    if kind in ("bigint", "int"):
        # A number column with blanks may have been written as "123.0".
        text = F.regexp_replace(text, r"\.0+$", "")
    return text if kind == "string" else text.try_cast(kind)


def _fails(raw: Column, kind: str) -> Column:
    """Text that the type cannot take, or not without rounding."""
    typed = _typed(raw, kind)
    lost = typed.isNull()
    if kind.startswith("decimal"):
        lost = lost | (typed != _typed(raw, "decimal(38,18)"))
    return (F.trim(raw) != "") & F.coalesce(lost, F.lit(True))


def silver_typed(bronze: DataFrame, spec: dict) -> tuple[DataFrame, DataFrame]:
    """(typed rows, quarantined raw rows with the columns that failed).

    A row is quarantined when a cell holds text its type cannot take, or could take
    only by rounding it; a blank cell is a legal NULL.  Text is trimmed.  Both outputs are narrow passes without a shuffle.
    """
    failures = F.array_compact(
        F.array(
            *[
                F.when(_fails(F.col(raw), kind), F.lit(name))
                for name, (raw, kind) in spec.items()
            ]
        )
    )
    marked = bronze.withColumn("failed_columns", failures)
    clean = F.size("failed_columns") == 0
    typed = marked.filter(clean).select(
        *[_typed(F.col(raw), kind).alias(name) for name, (raw, kind) in spec.items()]
    )
    return typed, marked.filter(~clean)
