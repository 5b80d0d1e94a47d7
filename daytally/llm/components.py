"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import cut

#: Edges, of two numbers each, that one task may hold.
FEW_EDGES = 500_000


def components(edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """From edges (a, b), one row per node: node and root, the smallest node that it is connected with.

    Up to `few` distinct edges are followed in one task. More of them take rounds: each gives every node its smallest
    neighbour as a parent, follows the parents to their ends, and contracts the edges to what still connects different
    ends. Loops and repeated edges do no harm; without edges there are no nodes.
    """
    edges = cut(_between(edges))
    labels = None
    while left := edges.count():
        if left <= few:
            ends = _in_one_task(edges)
        else:
            both = edges.union(edges.select("b", "a")).toDF("node", "other")
            ends = both.groupBy("node").agg(F.min("other").alias("root"))
            ends = _followed(cut(ends.select("node", F.least("node", "root").alias("root"))))
        step = ends.select(F.col("node").alias("at"), F.col("root").alias("to"))
        if labels is None:
            labels = ends
        else:
            moved = labels.join(step, F.col("root") == F.col("at"), "left")
            labels = cut(moved.select("node", F.coalesce("to", "root").alias("root")))
        if left <= few:
            break
        edges = edges.join(step, F.col("a") == F.col("at")).select(F.col("to").alias("a"), "b")
        edges = cut(_between(edges.join(step, F.col("b") == F.col("at")).select("a", F.col("to").alias("b"))))
    return edges.toDF("node", "root") if labels is None else labels


def _in_one_task(edges: DataFrame) -> DataFrame:
    kind = edges.schema["a"].dataType.simpleString()

    def rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches).combine_chunks() if (batches := list(batches)) else None
        if held is None or not len(held):
            return
        ends = [held.column(name).to_numpy() for name in ("a", "b")]
        nodes, at = np.unique(np.concatenate(ends), return_inverse=True)
        a, b = at[: len(held)], at[len(held) :]
        root = np.arange(len(nodes))
        while len(a):
            np.minimum.at(root, np.maximum(root[a], root[b]), np.minimum(root[a], root[b]))
            while (further := root[root]).tobytes() != root.tobytes():
                root = further
            apart = root[a] != root[b]
            a, b = a[apart], b[apart]
        like = held.column("a").type
        yield pa.RecordBatch.from_arrays([pa.array(nodes, like), pa.array(nodes[root], like)], names=["node", "root"])

    return cut(edges.repartition(1).mapInArrow(rooted, f"node {kind}, root {kind}"))


def _between(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _followed(ends: DataFrame) -> DataFrame:
    """Replace each root by the root of the root, until nothing changes; the ways halve with each step."""
    while True:
        further = ends.select(F.col("node").alias("at"), F.col("root").alias("to"))
        moved = cut(ends.join(further, F.col("root") == F.col("at")).select("node", "to", (F.col("to") != F.col("root")).alias("moved")))
        ends = moved.select("node", F.col("to").alias("root"))
        if moved.where("moved").isEmpty():
            return ends
