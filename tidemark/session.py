"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Instants of live messages are shown as wall-clock times of one zone.
    "spark.sql.session.timeZone": "UTC",
    # Shuffle partitions are merged, joins re-planned and oversized join
    # partitions split from measured sizes.  "force" also splits when the
    # grouping after the join then needs a (pre-aggregated, small) shuffle.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Keyed streaming state on local disk with incremental checkpoints, so the
    # ids of all events ever seen need not fit in memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session; safe to call again."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the checkpoint folder the cluster names,
    else the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that lost executors cost a
    re-read rather than a recomputation.  Runs a job."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
