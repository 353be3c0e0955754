"""Catalog tables replaced as a whole: write anew, then point the table there.

Parquet has no row-level update, so an upsert or an acknowledgement rewrites
the table.  Readers see the old files until the catalog switches to the new
ones, and a failed write leaves the table as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def publish(df: DataFrame, table: str, folder: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Make ``table`` hold the rows of ``df``, which may read ``table`` itself."""
    spark = df.sparkSession
    location = f"{folder}/{table}/{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(location)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
    else:
        schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema)
        layout = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet {layout} LOCATION '{location}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


def append(df: DataFrame, table: str, folder: str) -> DataFrame:
    """Add rows to ``table``, creating it on first use."""
    spark: SparkSession = df.sparkSession
    if not spark.catalog.tableExists(table):
        return publish(df, table, folder)
    df.select(*spark.table(table).columns).write.mode("append").insertInto(table)
    spark.catalog.refreshTable(table)
    return spark.table(table)
