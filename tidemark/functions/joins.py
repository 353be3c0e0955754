"""Joining a large table to a keyed one when few keys hold most of the rows.

Spark splits oversized join partitions by itself, at run time and from measured
sizes, but only where both sides come straight from a shuffle.  A side that was
grouped by the join key does not: it is joined where it lies.  ``one_per_key``
groups so that the join shuffles the groups once more, which is cheap and leaves
Spark free to split; filters on the large side reach its scan, and a side that
turns out small is broadcast.  ``salted_join`` spreads hot keys explicitly, for
rows that are to be stored that way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECES_PER_PARTITION = 4


def one_per_key(df: DataFrame, key: str, *aggregates: Column) -> DataFrame:
    """(key, aggregates) with one row per key, from which a join on the key
    shuffles anew: the rows lie grouped by a struct around the key."""
    grouped = df.groupBy(F.struct(key).alias("_key")).agg(*aggregates)
    return grouped.select(F.col("_key")[key].alias(key), *[name for name in grouped.columns if name != "_key"])


def _pieces(df: DataFrame) -> int:
    """How finely the rows should divide: a few pieces per shuffle partition."""
    return PIECES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, salts) for keys holding more than one piece of the rows.

    Keys are counted where their rows lie and added up by key, so no task sees
    more than its keys' counts.  A key listed has more than a piece of all rows;
    hence there are fewer keys than pieces, whatever the data, and the list may
    be broadcast.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows").alias("_total"), F.lit(0).alias("_all"))  # one row
    salts = F.ceil(F.col("_rows") * _pieces(df) / F.col("_total")).cast("int")
    return (
        counts.withColumn("_all", F.lit(0))
        .join(F.broadcast(total), "_all")
        .select(key, salts.alias("_salts"))
        .filter(F.col("_salts") > 1)
    )


def salt_rows(df: DataFrame, hot: DataFrame, key: str, spread_by: tuple[str, ...] = ()) -> DataFrame:
    """Add ``_salt``: 0 for ordinary keys, spread evenly for hot and NULL keys.

    The salt hashes the row (its ``spread_by`` columns, if named: others need not
    be read) and the partition it sits in.  Copies of one row therefore spread
    too, and a retried task assigns the same salts again.  Filters do not move
    below the salt; apply them before the join.
    """
    spread = F.xxhash64(*[F.col(name) for name in spread_by or df.columns], F.spark_partition_id())

    def one_of(n: Column) -> Column:
        return F.pmod(spread, n.cast("bigint")).cast("int")

    salt = (
        F.when(F.col(key).isNull(), one_of(F.lit(_pieces(df))))
        .when(F.col("_salts").isNotNull(), one_of(F.col("_salts")))
        .otherwise(0)
    )
    return df.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_salts")


def salted_join(
    large: DataFrame, keyed: DataFrame, key: str, how: str = "left", spread_by: tuple[str, ...] = ()
) -> DataFrame:
    """``large`` joined to ``keyed`` on ``key``, with hot keys spread out.

    Rows of a hot key go to as many places as their share calls for, and the
    keyed side's rows for it are copied to each.  ``how`` must keep or filter
    the large side's rows: inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    hot = hot_keys(large, key)
    places = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    copies = keyed.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(places)).drop("_salts")
    return salt_rows(large, hot, key, spread_by).join(copies, [key, "_salt"], how).drop("_salt")
