"""Connected components of a graph whose edges are a DataFrame, by union-find on each partition and shuffles between.

Edges lead from a node to a lesser one. A partition merges what its edges connect and sends one edge from each of its
nodes to the least node it knows; edges are dealt by their upper end, of which a node has one for each partition at most,
so that a node with very many neighbours does not gather them in one task. When no node has two lower ends, what
is left is a forest; pointer jumping along it (a join that Spark can split) gives every node its root. Each round is
written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spark_io import discard, stored

SCHEMA = "u long, v long"
#: Edges of a partition, and nodes that a first, partial merge holds at once.
EDGES = 1 << 20


def merge(batches: Iterator[pa.RecordBatch], limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """One edge from each node of a partition, but the least ones, to the least node that its edges connect it with.

    With a limit what has been merged is sent whenever so many nodes are held, and a node may have an edge of each part.
    """
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent[x]
        return top

    def found() -> Iterator[pa.RecordBatch]:
        nodes = [x for x in parent if parent[x] != x]
        for k in range(0, len(nodes), 100_000):
            part = nodes[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(part, np.int64)), pa.array(np.array([root(x) for x in part], np.int64))], ["u", "v"])

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
                parent.setdefault(min(a, b), min(a, b))
        if limit and len(parent) >= limit:
            yield from found()
            parent.clear()
    yield from found()


def components(edges: DataFrame) -> DataFrame:
    """edges (u long, v long), in any direction, loops and repeats allowed -> (node, root): root is the least node of the component.

    Nodes without an edge to another node are not listed.
    """
    spark = edges.sparkSession
    now = stored(edges.select("u", "v").mapInArrow(lambda batches: merge(batches, EDGES), SCHEMA), "edges")
    while True:
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-now.count() // EDGES))
        old, now = now, stored(now.repartition(parts, "u").mapInArrow(merge, SCHEMA), "edges")
        discard(old)
        if now.groupBy("u").agg(F.min("v").alias("a"), F.max("v").alias("b")).where("a <> b").isEmpty():
            break
    old, now = now, stored(now.groupBy("u").agg(F.min("v").alias("v")), "forest")
    discard(old)
    while True:
        up = now.select(F.col("u").alias("v"), F.col("v").alias("w"))
        jumped = stored(now.join(up, "v", "left").select("u", F.coalesce("w", "v").alias("v"), F.col("w").isNotNull().alias("moved")), "forest")
        discard(now)
        if jumped.where("moved").isEmpty():
            break
        now = jumped.select("u", "v")
        now._stored_at = jumped._stored_at
    now = jumped.select("u", "v")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
