"""Shards of even row counts that keep linked documents together.

Balanced label propagation: every linked document starts in the shard its id
hashes to.  In each round a group of linked documents counts its members by
shard; all others propose to move to the shard that holds most of them (a group
larger than a shard has as many such homes as it needs), or if that is full to
the next one with room; and each shard accepts no more than its quota leaves.  Documents without
links cost no edge wherever they are, so they fill what is left: row counts
end at most one apart, by construction.

A group is a hyperedge, never a list of pairs.  Votes are pre-aggregated by
(group, shard), at most ``shards`` rows per group; acceptance works on hash
slices of the proposals, so no task sees all members of a group; rows are
numbered in slices whose number grows with the rows.  Each round is written to
the shared folder, since it builds on the last.

Equal texts (hashed to 128 bits) are linked.  Null texts are linked with
nothing and have size 16 and checksum 0; empty texts are equal texts.  Repeated
rows get a place each; an empty table gives an empty result.  Ids may be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored, utf8_size

ROWS_PER_SLICE = 200_000
#: Slices of a shard's proposals; whole slices are accepted, so a quota may be
#: left unused by up to one of them until the next round.
PROPOSAL_SLICES = 1024


def numbered(df: DataFrame, by: list[str], order: list[str], rows: int, name: str) -> DataFrame:
    """``df`` with a gapless number from 0 within each ``by``.

    Rows are cut into hash slices, numbered within their slice, and moved on by
    the rows of the slices before.  ``rows`` (of the whole) sets the slices.
    """
    slices = max(1, -(-rows // ROWS_PER_SLICE))
    cut = df.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(slices)))
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy(*by, "_slice")
        .agg(F.count("*").alias("_rows"))
        .select(*by, "_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy(*by, "_slice").orderBy(*order)
    return (
        cut.withColumn("_number", F.row_number().over(within) - 1)
        .join(starts, [*by, "_slice"])
        .withColumn(name, (F.col("_start") + F.col("_number")).cast("long"))
        .drop("_slice", "_number", "_start")
    )


def _shard_rows(df: DataFrame, column: str = "shard") -> dict[int, int]:
    """Rows per shard: as many numbers as there are shards."""
    return {row[0]: row[1] for row in df.groupBy(column).count().collect()}


def _lookup(numbers: list[int], index: Column) -> Column:
    """The number at ``index``, which must not be null: generated code reads a null index as 0."""
    return F.element_at(F.array(*map(F.lit, numbers)), index + 1)


def propagate(linked: DataFrame, quota: int, shards: int, rounds: int) -> DataFrame:
    """Rounds over (group_1, group_2, shard, ...): the same rows with new shards.

    No shard ends above ``quota`` unless it started above it.
    """
    group = ["group_1", "group_2"]
    for _ in range(rounds):
        load = _shard_rows(linked)
        room = [max(0, quota - load.get(shard, 0)) for shard in range(shards)]
        votes = linked.groupBy(*group, "shard").agg(F.count("*").alias("votes"))
        vote = F.struct("votes", (-F.col("shard")).alias("shard"), (_lookup(room, F.col("shard")) > 0).alias("open"))
        # A group needs as many shards as its size asks for: those that hold most of it
        # are its home.  Where no home has room, the next shard that has joins them.
        ranked = votes.groupBy(*group).agg(
            F.sort_array(F.collect_list(vote), asc=False).alias("ranked"),  # a row per shard at most
            F.greatest(F.lit(1), F.ceil(F.sum("votes") / max(1, quota))).cast("int").alias("needs"),
        )
        home = ranked.withColumn("home", F.slice("ranked", 1, F.col("needs"))).withColumn(
            "goal", F.filter("home", lambda each: each["open"])
        )
        spare = F.slice(F.filter("ranked", lambda each: each["open"]), 1, 1)
        targets = home.select(
            *group,
            F.transform("home", lambda each: -each["shard"]).alias("home"),
            F.transform(F.when(F.size("goal") > 0, F.col("goal")).otherwise(spare), lambda each: -each["shard"]).alias("goal"),
        )
        pick = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.greatest(F.lit(1), F.size("goal"))).cast("int")
        stays = F.array_contains(F.concat("home", "goal"), F.col("shard"))
        proposed = (
            linked.join(targets, group)
            .withColumn("target", F.when(~stays, F.get("goal", pick)))
            .withColumn("slice", F.pmod(F.xxhash64("target", "doc_id", "group_1"), F.lit(PROPOSAL_SLICES)))
            .drop("home", "goal")
        )
        proposed = stored(proposed)
        so_far = Window.partitionBy("target").orderBy("slice")
        accepted = (
            proposed.where("target IS NOT NULL")
            .groupBy("target", "slice")
            .agg(F.count("*").alias("rows"))
            .withColumn("total", F.sum("rows").over(so_far))
            .where(F.col("total") <= _lookup(room, F.col("target")))
            .groupBy("target")
            .agg(F.max("slice").alias("last_slice"), F.max("total").alias("moved"))
        ).collect()  # one row per shard
        if not accepted:
            break
        last = {row["target"]: row["last_slice"] for row in accepted}
        moves_to = F.coalesce("target", "shard")
        last_slice = _lookup([last.get(shard, -1) for shard in range(shards)], moves_to)
        linked = proposed.withColumn("shard", F.when(F.col("slice") <= last_slice, moves_to).otherwise(F.col("shard")))
        linked = linked.drop("target", "slice")
    return linked


def shard_documents(
    docs: DataFrame, shards: int = 40, rounds: int = 6, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, size, text_crc32, linked, shard, slot): ``slot`` is gapless from 0
    within a shard, linked documents first."""
    content = F.col(text)
    base = docs.select(
        F.col(key).alias("doc_id"),
        (utf8_size(content) + 16).alias("size"),
        F.coalesce(F.crc32(F.encode(content, "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
        F.when(content.isNotNull(), F.xxhash64(content)).alias("group_1"),
        F.when(content.isNotNull(), F.xxhash64(F.lit(1), content)).alias("group_2"),
    )
    base = stored(base)
    group = ["group_1", "group_2"]
    groups = base.dropna(subset=group).groupBy(*group).agg(F.count("*").alias("members")).where("members > 1")
    marked = stored(base.join(groups, group, "left"))
    rows = marked.count()
    if not rows:
        return marked.select(
            "doc_id", "size", "text_crc32", F.lit(False).alias("linked"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")
        )
    start = F.pmod(F.xxhash64("doc_id", "group_1"), F.lit(shards)).cast("int")
    linked = marked.where("members IS NOT NULL").drop("members").withColumn("shard", start)
    # The hashed start is even only on average: what exceeds a quota is dealt like unlinked rows.
    quota = rows // shards
    linked = propagate(stored(linked), quota, shards, rounds)
    order = ["group_1", "group_2", "doc_id", "text_crc32"]
    linked = stored(numbered(linked, ["shard"], order, rows, "slot"))
    sizes = [rows // shards + (shard < rows % shards) for shard in range(shards)]
    settled = linked.where(F.col("slot") < _lookup(sizes, F.col("shard")))
    over = linked.where(F.col("slot") >= _lookup(sizes, F.col("shard"))).drop("shard", "slot")
    load = _shard_rows(settled)
    free = [sizes[shard] - load.get(shard, 0) for shard in range(shards)]
    single = marked.where("members IS NULL").drop("members").unionByName(over)
    single = numbered(single.withColumn("_all", F.lit(0)), ["_all"], order, rows, "place").drop("_all")
    ends = [sum(free[: shard + 1]) for shard in range(shards)]
    shard = sum((F.when(F.col("place") >= end, 1).otherwise(0) for end in ends), F.lit(0)).cast("int")
    single = single.withColumn("shard", shard).withColumn(
        "slot",
        F.col("place")
        - _lookup([end - each for end, each in zip(ends, free)], F.col("shard"))
        + _lookup([load.get(each, 0) for each in range(shards)], F.col("shard")),
    )
    columns = ["doc_id", "size", "text_crc32", "linked", "shard", "slot"]
    return (
        settled.withColumn("linked", F.lit(True))
        .select(columns)
        .unionByName(single.withColumn("linked", F.lit(False)).withColumn("slot", F.col("slot").cast("long")).select(columns))
    )
