"""Connected components of a link table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean, stored


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace each batch's links by links from its vertices to their smallest one."""
    for batch in batches:
        root: dict[int, int] = {}

        def find(vertex: int) -> int:
            top = vertex
            while root.get(top, top) != top:
                top = root[top]
            while root.get(vertex, vertex) != top:
                root[vertex], vertex = top, root[vertex]
            return top

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        above = [vertex for vertex in root if find(vertex) != vertex]
        yield pa.RecordBatch.from_arrays(
            [pa.array(above, pa.int64()), pa.array([find(vertex) for vertex in above], pa.int64())], names=["a", "b"]
        )


def components(links: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex in ``links`` (a, b); root is the smallest
    vertex reachable.

    Each round shrinks the links batch by batch, hooks every vertex to its
    smallest neighbour, follows the hooks to their roots, and goes on with the
    links between roots until none is left.  Vertices with many links only meet
    pre-aggregated minima and joins, never a collected list of neighbours.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    links = stored(links.mapInArrow(lean(_forest), "a bigint, b bigint"))
    roots = None
    while not links.isEmpty():
        hooks = links.groupBy(F.col("a").alias("vertex")).agg(F.min("b").alias("root"))
        hooks = stored(hooks)
        while True:
            upper = hooks.select(F.col("vertex").alias("root"), F.col("root").alias("above"))
            jumped = stored(
                hooks.join(upper, "root", "left").select(
                    "vertex", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")
                )
            )
            hooks = jumped.select("vertex", "root")
            if jumped.where("moved").isEmpty():
                break
        if roots is None:
            roots = hooks
        else:
            step = hooks.select(F.col("vertex").alias("root"), F.col("root").alias("above"))
            moved = roots.join(step, "root", "left").select("vertex", F.coalesce("above", "root").alias("root"))
            roots = stored(moved.unionByName(hooks.join(roots, "vertex", "left_anti")))
        at_a = hooks.select(F.col("vertex").alias("a"), F.col("root").alias("to_a"))
        at_b = hooks.select(F.col("vertex").alias("b"), F.col("root").alias("to_b"))
        links = (
            links.join(at_a, "a", "left")
            .join(at_b, "b", "left")
            .select(F.coalesce("to_a", "a").alias("x"), F.coalesce("to_b", "b").alias("y"))
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
            .where("a != b")
            .distinct()
        )
        links = stored(links.mapInArrow(lean(_forest), "a bigint, b bigint"))
    if roots is None:
        return links.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    every = roots.select("vertex", "root").unionByName(roots.select(F.col("root").alias("vertex"), "root"))
    return every.distinct()
