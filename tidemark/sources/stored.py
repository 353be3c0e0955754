"""Tables in folders, replaced as a whole and counted while they are written.

A table's folder holds versions and a pointer to the current one.  The pointer
is switched after a version stands complete, so a job that fails midway leaves
the old rows readable; the version before stays for readers that began with it.
Counts are observed by the write itself and lie in the pointer: asking for them
reads no rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.shared_files import names_in, read_text, remove, write_text

POINTER = "_current.json"


def observed_write(df: DataFrame, write: Callable[[DataFrame], None], **counts: Column) -> dict[str, int]:
    """Write ``df`` and return its row count and other aggregates, taken on the way.

    What is observed is the last step before the files, so that a repeated task
    does not count twice: ``write`` must not shuffle.
    """
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("row_count"), *[column.alias(name) for name, column in counts.items()]))
    found = seen.get
    return {name: found.get(name) or 0 for name in ("row_count", *counts)}


def replace_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), **counts: Column) -> dict[str, int]:
    """Make the table at ``path`` hold the rows of ``df``; returns what was counted."""
    spark = df.sparkSession
    version = f"version-{uuid.uuid4().hex}"
    found = observed_write(df, lambda rows: rows.write.partitionBy(*partition_by).parquet(f"{path}/{version}"), **counts)
    before = _pointer(spark, path)
    held = {"version": version, "before": before.get("version"), "schema": df.schema.json(), "counts": found}
    write_text(spark, f"{path}/{POINTER}", json.dumps(held))
    for name in names_in(spark, path):
        if name.startswith("version-") and name not in (version, before.get("version")):
            remove(spark, f"{path}/{name}")
    return found


def _pointer(spark: SparkSession, path: str) -> dict:
    text = read_text(spark, f"{path}/{POINTER}")
    return json.loads(text) if text else {}


def current_table(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of the table at ``path``."""
    held = _pointer(spark, path)
    if not held:
        raise FileNotFoundError(f"no table at {path}")
    schema = StructType.fromJson(json.loads(held["schema"]))
    return spark.read.schema(schema).parquet(f"{path}/{held['version']}").select(*schema.names)


def current_counts(spark: SparkSession, path: str) -> dict[str, int]:
    """What was counted when the current rows were written; reads no rows."""
    return _pointer(spark, path).get("counts", {})
