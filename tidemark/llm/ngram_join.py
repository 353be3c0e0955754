"""Documents linked by the Jaccard similarity of their word n-gram sets.

A prefix-tree join.  Every document's set of grams is ordered by one global
order: rare grams first, so that what many documents share comes last.  Two
sets similar enough share a gram among the first few of both.  The tree's first
level is therefore dealt out by Spark, one node per such gram, and sets meet
only below a common node, at positions that leave enough grams to reach the
required overlap.  Each set also has a sketch, the parities of its grams' hash
buckets, two to four bits a gram: where the sketches of two sets differ, so do
the sets, and pairs that differ in too many buckets go before any whole set is
moved.  Below, the sets to be compared with one set are walked in
tree order: a set goes on from the depth it shares with the one before, with
the overlap counted there, and a subtree is left as soon as the grams that
remain cannot reach the requirement.

The order needs counts.  They come from one pass over all documents: a batch
sends its sorted grams, cut to 40 bits, as one packed block per hash range; a
range adds up its blocks.  Grams in at least ``FREQUENT`` documents are the
frequent ones (their counts are the order's first part), and that table is sent
to the workers, at most ``MOST_FREQUENT`` rows: beyond it the limit rises.  The
order only steers the search; any limit gives the same links.

Nodes of grams that are not frequent have fewer sets than the limit, so all
their pairs can be looked at.  A frequent gram can lie on a node with a third
of all sets.  There each set is first compared with the leader of a few of its
nodes, which joins most of a family of copies; then the only pairs left to look
at are those whose sets are in different components.  All sets that meet at
nodes with several components form a family; its sets outside its largest
component are held against all of it, block by block, and only links leave a
block.  Equal sets are one vertex throughout (a 64-bit fingerprint).

Null and empty texts have no grams and are linked with nothing.  A text with
fewer words than a gram is one gram.  Rows with equal or null ids are compared
by their texts like any others and get the smallest id reachable (null if there
is none); repeated rows are returned repeatedly; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import SubstringHashes, range_blocks, run_starts, unpack
from tidemark.llm.common import ZIPPED, drop_finished, lean, lean_group, passing_tables, small_batches, stored, zipped
from tidemark.llm.components import components

FREQUENT = 24
MOST_FREQUENT = 1 << 22
#: Bytes of text behind one hash range of packed blocks.
TEXT_PER_RANGE = 16 << 20
#: Ranges of a small input, for the sake of parallel work.
LEAST_RANGES = 8
#: Grams of the sets that a block of a family holds.
GRAMS_PER_BLOCK = 400_000
#: Nodes of frequent grams at which a set is compared with the leader.
STARS = 6

#: Bits of a gram's 64-bit hash that counts and tree nodes go by.
SLOT_BITS = 40

def gram_hashes(text: str | None, words_in_gram: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams (ASCII lower case, words
    between ASCII white space)."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = np.frombuffer(b" ".join(words), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    span = min(words_in_gram, len(words))
    starts, ends = starts[: len(words) - span + 1], ends[span - 1 :]
    return np.unique(SubstringHashes(joined).of(starts, ends))


def _slots(grams: np.ndarray) -> np.ndarray:
    return grams >> np.uint64(64 - SLOT_BITS)


_BLOCKS = "range int, rows int, block binary"


def _block_batch(blocks: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    ranges, rows, packed = zip(*blocks) if blocks else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(ranges, pa.int32()), pa.array(rows, pa.int32()), pa.array(packed, pa.binary())], names=["range", "rows", "block"]
    )


def _counted(slots: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(slots, kind="stable")
    slots, counts = slots[order], counts[order]
    first = run_starts(slots)
    return slots[first], np.add.reduceat(counts, first)


def frequent_grams(texts: DataFrame, words_in_gram: int, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots, tiers): the frequent gram slots of all documents, sorted, and the
    binary logarithm of their document counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_slots(gram_hashes(text, words_in_gram)) for text in batch.column(0).to_pylist()]
            slots = np.sort(np.concatenate(sets)) if sets else np.empty(0, np.uint64)
            if len(slots):
                slots, counts = _counted(slots, np.ones(len(slots), np.uint32))
                yield _block_batch(list(range_blocks(slots, ranges, SLOT_BITS, counts.astype(np.uint32))))

    def add(blocks: pa.Table) -> pa.Table:
        parts = [unpack(b, n, np.uint64, np.uint32) for b, n in zip(blocks["block"].to_pylist(), blocks["rows"].to_pylist())]
        slots, counts = _counted(np.concatenate([each[0] for each in parts]), np.concatenate([each[1] for each in parts]).astype(np.int64))
        often = counts >= FREQUENT
        return pa.table({"slot": pa.array(slots[often].astype(np.int64)), "documents": pa.array(counts[often])})

    found = stored(texts.mapInArrow(lean(count), _BLOCKS).groupBy("range").applyInArrow(lean_group(add), "slot bigint, documents bigint"))
    tier = F.floor(F.log2("documents")).cast("int")
    by_tier = {row[0]: row[1] for row in found.groupBy(tier.alias("tier")).count().collect()}
    least, rows = 99, 0
    for each in sorted(by_tier, reverse=True):
        rows += by_tier[each]
        if rows <= MOST_FREQUENT:
            least = each
    kept = found.where(tier >= least).select("slot", tier.alias("tier")).toArrow()
    slots, tiers = kept["slot"].to_numpy().astype(np.uint64), kept["tier"].to_numpy().astype(np.uint8)
    order = np.argsort(slots)
    return slots[order], tiers[order]


def in_order(grams: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """The grams in the global order, and how many of them come before the frequent ones."""
    slots, tiers = frequent
    if not len(slots) or not len(grams):
        return grams, len(grams)
    own = _slots(grams)
    at = np.minimum(np.searchsorted(slots, own), len(slots) - 1)
    tier = np.where(slots[at] == own, tiers[at], 0)
    rare = int((tier == 0).sum())
    return (grams if rare == len(grams) else grams[np.argsort(tier, kind="stable")]), rare


def fingerprint(grams: np.ndarray) -> int:
    """64 bits that stand for a set of sorted grams, as a signed number."""
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)


def sketch(grams: np.ndarray) -> bytes:
    """One bit for each bucket that the set's hashes fall into: whether their number
    is odd.  The number of buckets is the power of two from twice the set's size on."""
    buckets = max(8, 1 << (2 * len(grams) - 1).bit_length())
    held = np.bincount((grams & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.packbits((held & 1).astype(np.uint8)).tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """What two sets differ in at least, by their sketches: the grams that only one of
    them holds leave an odd number in each bucket where the sketches differ.  The
    larger sketch is folded to the size of the smaller."""
    a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _prefix(grams: int, percent: int) -> int:
    return grams - -(-percent * grams // 100) + 1


def _enough(overlap: Column, size_a: Column, size_b: Column, percent: int) -> Column:
    return (100 + percent) * overlap >= percent * (size_a + size_b)


def prefixes(
    docs: DataFrame, words_in_gram: int, percent: int, frequent: Broadcast, key: str, text: str
) -> DataFrame:
    """(doc_id, text_hash, n_shingles, vertex, rare, prefix, sketch): the first grams
    of each document's ordered set, as packed 64-bit hashes, how many of the set are
    not frequent, and the set's sketch.  Without grams, vertex, prefix and sketch are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, vertices, rares, packed, sketches = [], [], [], [], []
            for each in batch.column(1).to_pylist():
                grams = gram_hashes(each, words_in_gram)
                ordered, rare = in_order(grams, frequent.value)
                sizes.append(len(grams))
                rares.append(rare)
                vertices.append(fingerprint(grams) if len(grams) else None)
                packed.append(ordered[: _prefix(len(grams), percent)].tobytes() if len(grams) else None)
                sketches.append(sketch(grams) if len(grams) else None)
            numbers = (pa.array(each, pa.int64()) for each in (sizes, vertices, rares))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *numbers, pa.array(packed, pa.binary()), pa.array(sketches, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "vertex", "rare", "prefix", "sketch"],
            )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash bigint, n_shingles bigint, vertex bigint, rare bigint, prefix binary, sketch binary"
    return docs.select(key, text, F.xxhash64(text).alias("text_hash")).mapInArrow(lean(run), schema)


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(vertex, size, rare, prefix), equal sets of the batch once."""
    seen = set()
    for vertex, size, rare, prefix in zip(*(batch.column(at).to_pylist() for at in range(4))):
        if vertex not in seen:
            seen.add(vertex)
            yield vertex, size, rare, np.frombuffer(prefix, np.uint64)


def rare_node_pairs(nodes: DataFrame, percent: int, ranges: int) -> DataFrame:
    """(a, b) that meet at nodes of grams that are not frequent, without repeats."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for vertex, size, rare, prefix in _sets(batch):
                own = prefix[:rare]
                parts.append((_slots(own), np.full(len(own), vertex), np.full(len(own), size, np.uint32), np.arange(len(own), dtype=np.uint32)))
            if parts:
                columns = [np.concatenate(each) for each in zip(*parts)]
                order = np.argsort(columns[0], kind="stable")
                yield _block_batch(list(range_blocks(columns[0][order], ranges, SLOT_BITS, *(each[order] for each in columns[1:]))))

    def meet(blocks: pa.Table) -> pa.Table:
        parts = [
            unpack(b, n, np.uint64, np.int64, np.uint32, np.uint32)
            for b, n in zip(blocks["block"].to_pylist(), blocks["rows"].to_pylist())
        ]
        slots, vertices, sizes, places = (np.concatenate(each) for each in zip(*parts))
        order = np.lexsort((vertices, slots))
        slots, vertices, sizes, places = slots[order], vertices[order], sizes[order].astype(np.int64), places[order].astype(np.int64)
        shared = np.concatenate(([False], slots[1:] == slots[:-1]))
        shared[:-1] |= shared[1:]
        slots, vertices, sizes, places = slots[shared], vertices[shared], sizes[shared], places[shared]
        left, right, step = [], [], 0
        while True:
            step += 1
            at = np.flatnonzero(slots[step:] == slots[:-step])
            if not len(at):
                break
            to = at + step
            rest = 1 + np.minimum(sizes[at] - places[at], sizes[to] - places[to]) - 1
            fits = ((100 + percent) * rest >= percent * (sizes[at] + sizes[to])) & (vertices[at] != vertices[to])
            left.append(vertices[at[fits]])
            right.append(vertices[to[fits]])
        pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1) if left else np.empty((2, 0), np.int64)
        return pa.table({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})

    blocks = nodes.select("vertex", "n_shingles", "rare", "prefix").mapInArrow(lean(deal), _BLOCKS)
    return blocks.groupBy("range").applyInArrow(lean_group(meet), "a bigint, b bigint").distinct()


def frequent_nodes(nodes: DataFrame) -> DataFrame:
    """(slot, vertex, size, star) of prefix grams that are frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [
                (_slots(prefix[rare:]).astype(np.int64), vertex, size)
                for vertex, size, rare, prefix in _sets(batch)
                if rare < len(prefix)
            ]
            if not parts:
                continue
            lengths = [len(each[0]) for each in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([each[0] for each in parts])),
                    pa.array(np.repeat([each[1] for each in parts], lengths)),
                    pa.array(np.repeat([each[2] for each in parts], lengths)),
                    pa.array(np.concatenate([np.arange(length) < STARS for length in lengths])),
                ],
                names=["slot", "vertex", "size", "star"],
            )

    rows = nodes.select("vertex", "n_shingles", "rare", "prefix").mapInArrow(
        lean(run), "slot bigint, vertex bigint, size bigint, star boolean"
    )
    return rows.distinct()


def star_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b): sets with the leaders of a few of their frequent nodes."""
    leader = F.min(F.struct(F.xxhash64("slot", "vertex"), "vertex", "size"))
    leaders = nodes.groupBy("slot").agg(leader.alias("first"), F.count("*").alias("sets")).where("sets > 1")
    met = nodes.where("star").join(leaders.select("slot", "first.vertex", "first.size").toDF("slot", "leader", "leader_size"), "slot")
    fits = _enough(F.least("size", "leader_size"), F.col("size"), F.col("leader_size"), percent)
    return met.where(fits & (F.col("vertex") != F.col("leader"))).select(F.col("vertex").alias("a"), F.col("leader").alias("b")).distinct()


def families(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(family, vertex, root, size, outside) of sets that meet sets of other
    components at a frequent node; ``outside``: not in the family's largest component."""
    labelled = stored(
        nodes.drop("star").join(roots, "vertex", "left").withColumn("root", F.coalesce("root", "vertex")).distinct()
    )
    parted = (
        labelled.groupBy("slot")
        .agg(F.min("vertex").alias("leader"), F.min("root").alias("first"), F.max("root").alias("last"))
        .where("first != last")
        .select("slot", "leader")
    )
    met = labelled.join(parted, "slot")
    ties = components(met.select(F.col("vertex").alias("a"), F.col("leader").alias("b")).distinct())
    rows = stored(
        met.select("vertex", "root", "size").distinct().join(ties.withColumnRenamed("root", "family"), "vertex")
    )
    largest = (
        rows.groupBy("family", "root")
        .agg(F.count("*").alias("sets"))
        .groupBy("family")
        .agg(F.max(F.struct("sets", "root")).alias("largest"))
        .select("family", F.col("largest.root").alias("largest"))
    )
    return rows.join(largest, "family").select("family", "vertex", "root", "size", (F.col("root") != F.col("largest")).alias("outside"))


def links_between(own: list[np.ndarray], others: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """(place in own, place in others) of all similar pairs, from the overlaps of
    each of ``others`` with all of ``own`` at once."""
    sizes = np.array([len(each) for each in own])
    grams = np.concatenate(own)
    order = np.argsort(grams, kind="stable")
    owners = np.repeat(np.arange(len(own)), sizes)[order]
    grams = grams[order]
    starts = run_starts(grams)
    grams, ends = grams[starts], np.append(starts[1:], len(grams))
    for place, other in enumerate(others):
        at = np.minimum(np.searchsorted(grams, other), len(grams) - 1)
        at = at[grams[at] == other]
        lengths = ends[at] - starts[at]
        held = np.repeat(starts[at] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        overlap = np.bincount(owners[held], minlength=len(own))
        for linked in np.flatnonzero((100 + percent) * overlap >= percent * (sizes + len(other))).tolist():
            yield linked, place


def family_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between the components of each family, enough to join those they join."""

    def compare(rows: pa.Table) -> pa.Table:
        outside = rows.filter(rows["role"])
        inside = rows.filter(pc.invert(rows["role"]))
        own, others = ([np.frombuffer(each, np.uint64) for each in part["grams"].to_pylist()] for part in (outside, inside))
        vertices = [part["vertex"].to_pylist() for part in (outside, inside)]
        groups = [part["root"].to_pylist() for part in (outside, inside)]
        joined, a, b = {}, [], []

        def find(root: int) -> int:
            while root in joined:
                root = joined[root]
            return root

        for x, y in links_between(own, others, percent) if own and others else ():
            left, right = find(groups[0][x]), find(groups[1][y])
            if left != right:
                joined[max(left, right)] = min(left, right)
                a.append(vertices[0][x])
                b.append(vertices[1][y])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    def blocks(total: str) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.col(total) / GRAMS_PER_BLOCK)).cast("long")

    totals = members.groupBy("family").agg(
        F.sum("size").alias("all"), F.sum(F.when(F.col("outside"), F.col("size")).otherwise(0)).alias("out")
    )
    counts = totals.select("family", blocks("all").alias("inner"), blocks("out").alias("outer"))
    placed = members.join(counts, "family")
    spot = F.xxhash64("vertex", F.lit(2))
    as_outside = placed.where("outside").select(
        "family", F.pmod(spot, "outer").alias("outer_block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("inner") - 1)).alias("inner_block"),
        F.lit(True).alias("role"), "vertex", "root",
    )
    as_inside = placed.select(
        "family", F.explode(F.sequence(F.lit(0).cast("long"), F.col("outer") - 1)).alias("outer_block"), F.pmod(spot, "inner").alias("inner_block"),
        F.lit(False).alias("role"), "vertex", "root",
    )
    work = as_outside.unionByName(as_inside).join(sets, "vertex")
    return work.groupBy("family", "outer_block", "inner_block").applyInArrow(lean_group(compare), "a bigint, b bigint")


def linked_in_tree(own: np.ndarray, others: list[np.ndarray], percent: int) -> list[bool]:
    """Which of ``others`` reach the similarity with ``own``; all in the global order.

    The others are walked in tree order.  ``counted[d]`` is the overlap of the
    path's first d grams; a set keeps it up to the depth shared with the set
    before.  Where the grams that remain below a depth cannot reach the
    requirement, the subtree is left: sets that go through it are not walked,
    unless they are so much longer that it is within reach for them.
    """
    members = np.sort(own)
    result = [False] * len(others)
    path, counted, short = np.empty(0, np.uint64), np.zeros(1, np.int64), None
    for at in sorted(range(len(others)), key=lambda at: others[at].tobytes()):
        other = others[at]
        need = -(-percent * (len(own) + len(other)) // (100 + percent))
        common = min(len(path), len(other))
        unequal = np.flatnonzero(path[:common] != other[:common])
        depth = int(unequal[0]) if len(unequal) else common
        if short is not None and depth >= short:
            if counted[short] + min(len(other) - short, len(own) - counted[short]) < need:
                continue
        fresh = other[depth:]
        place = np.minimum(np.searchsorted(members, fresh), len(members) - 1)
        counted = np.concatenate((counted[: depth + 1], counted[depth] + np.cumsum(members[place] == fresh)))
        path, short = other, None
        result[at] = int(counted[-1]) >= need
        if not result[at]:
            rest = np.minimum(len(other) - np.arange(len(other) + 1), len(own) - counted)
            short = int(np.flatnonzero(counted + rest < need)[0])
    return result


def ordered_sets(
    vertices: DataFrame, docs: DataFrame, first: DataFrame, words_in_gram: int, frequent: Broadcast, key: str, text: str
) -> DataFrame:
    """(vertex, grams): whole ordered sets, as packed hashes.

    Sets are made again from the texts of the documents needed (``first`` names
    one by vertex): moving those few texts is less than storing all sets.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            texts = [pa.decompress(each, size, codec="zstd", asbytes=True).decode() if size else "" for each, size in packed]
            grams = [gram_hashes(each, words_in_gram) for each in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([fingerprint(each) for each in grams], pa.int64()),
                    pa.array([in_order(each, frequent.value)[0].tobytes() for each in grams], pa.binary()),
                ],
                names=["vertex", "grams"],
            )

    needed = vertices.distinct().join(first, "vertex").select("first_id").distinct()
    packed = zipped(docs.select(key, text), text)
    texts = packed.join(needed, packed[key].eqNullSafe(needed["first_id"]), "left_semi").select(ZIPPED, f"{ZIPPED}_size")
    return stored(texts.mapInArrow(lean(make), "vertex bigint, grams binary").groupBy("vertex").agg(F.first("grams").alias("grams")))


def within_reach(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches leave the similarity within reach; ``sets`` has
    (vertex, n_shingles, sketch), equal sets repeatedly."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.add(batch.column(2), batch.column(4)).to_numpy()
            different = [least_difference(a, b) for a, b in zip(batch.column(3).to_pylist(), batch.column(5).to_pylist())]
            near = (100 + percent) * (size - np.array(different, np.int64)) >= 2 * percent * size
            yield batch.select([0, 1]).filter(pa.array(near))

    once = sets.groupBy("vertex").agg(F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch"))
    met = pairs.join(once.toDF("b", "size_b", "sketch_b"), "b").join(once.toDF("a", "size_a", "sketch_a"), "a")
    rows = met.select("a", "b", "size_a", "sketch_a", "size_b", "sketch_b")
    return rows.mapInArrow(lean(compare), "a bigint, b bigint")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity, counted on whole sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, own, others = (batch.column(at).to_pylist() for at in range(4))
            by_own: dict[int, list[int]] = {}
            for at, vertex in enumerate(a):
                by_own.setdefault(vertex, []).append(at)
            kept = []
            for rows in by_own.values():
                sets = [np.frombuffer(others[at], np.uint64) for at in rows]
                linked = linked_in_tree(np.frombuffer(own[rows[0]], np.uint64), sets, percent)
                kept += [at for at, good in zip(rows, linked) if good]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[at] for at in kept], pa.int64()), pa.array([b[at] for at in kept], pa.int64())], names=["a", "b"]
            )

    of_b = sets.select(F.col("vertex").alias("b"), F.col("grams").alias("others"))
    of_a = sets.select(F.col("vertex").alias("a"), F.col("grams").alias("own"))
    met = pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "own", "others")
    return stored(met.mapInArrow(lean(compare), "a bigint, b bigint"))


def _rooted(docs: DataFrame, words_in_gram: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """From (doc_id, text): (doc_id, text_hash, n_shingles, vertex) of every row, and
    (vertex, first_id, root) of every set.  Tables on the way are deleted."""
    key, text = "doc_id", "text"
    spark = docs.sparkSession
    small_batches(spark)
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    ranges = max(LEAST_RANGES, -(-total // TEXT_PER_RANGE))
    with passing_tables(spark) as keep:
        frequent = spark.sparkContext.broadcast(frequent_grams(docs.select(text), words_in_gram, ranges))
        drop_finished(spark)
        known = stored(prefixes(docs, words_in_gram, percent, frequent, key, text))
        sets = known.where("vertex IS NOT NULL")
        first = sets.groupBy("vertex").agg(F.min("doc_id").alias("first_id"))
        nodes = stored(frequent_nodes(sets))
        met = stored(rare_node_pairs(sets, percent, ranges).unionByName(star_pairs(nodes, percent)).distinct())
        drop_finished(spark)
        pairs = stored(within_reach(met, sets, percent))
        drop_finished(spark)

        def sets_of(vertices: DataFrame) -> DataFrame:
            made = ordered_sets(vertices, docs, first, words_in_gram, frequent, key, text)
            drop_finished(spark)
            return made

        links = verified(pairs, sets_of(pairs.select(F.explode(F.array("a", "b")).alias("vertex"))), percent)
        drop_finished(spark)
        roots = components(links)
        members = stored(families(nodes, roots))
        if not members.isEmpty():
            found = family_links(members, sets_of(members.select("vertex")), percent)
            roots = components(roots.select(F.col("vertex").alias("a"), F.col("root").alias("b")).unionByName(found))
        rooted = first.join(roots, "vertex", "left").withColumn("root", F.coalesce("root", "vertex"))
        result = keep(known.select("doc_id", "text_hash", "n_shingles", "vertex")), keep(rooted)
    drop_finished(spark)
    return result


def ngram_components(
    docs: DataFrame, words_in_gram: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the size of its set and
    the smallest id that links reach."""
    known, rooted = _rooted(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), words_in_gram, percent)
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    own = F.when(F.col("vertex").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        known.join(rooted.join(ids, "root").select("vertex", "component_id"), "vertex", "left")
        .select("doc_id", "n_shingles", own.alias("component_id"))
    )


def without_near_copies(
    docs: DataFrame, words_in_gram: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id
    (nulls last, then by a hash of the text), once even if its row is repeated.
    Documents without grams are linked with nothing and all stay."""
    known, rooted = _rooted(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), words_in_gram, percent)
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    chosen = (
        known.join(rooted.select("vertex", "root"), "vertex")
        .groupBy("root")
        .agg(F.min(place).alias("first"))
        .select(F.col("first.doc_id").alias("_first_id"), F.col("first.text_hash").alias("_first_hash"))
    )
    hashed = docs.withColumn("_text_hash", F.xxhash64(text))
    wordless = F.col(text).isNull() | ~F.col(text).rlike("[^\\x20\\x09-\\x0D]")
    same = F.col(key).eqNullSafe(F.col("_first_id")) & (F.col("_text_hash") == F.col("_first_hash"))
    kept = hashed.where(~wordless).join(chosen, same, "left_semi").dropDuplicates([key, "_text_hash"])
    return kept.drop("_text_hash").unionByName(docs.where(wordless))
