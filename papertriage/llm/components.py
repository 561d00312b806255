"""Connected components of an edge table.

Each round first contracts every partition by itself (union-find over the
partition's edges, so chains and repeated edges shrink before anything is
exchanged) and then links every node's neighbours to its smallest one, larger
neighbours and smaller ones in turn. Rounds end when a count and a checksum of
the edges stay the same; a star around each component's smallest node is left.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of all nodes of the edges."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist()):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)  # positions are in order of the nodes
    return nodes, nodes[np.array([root(x) for x in range(len(nodes))], np.int64)] if len(nodes) else nodes


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node = top = np.empty(0, np.int64)
    for b in batches:  # what is held is one edge per node met
        a = np.concatenate([node, b.column("a").to_numpy()])
        c = np.concatenate([top, b.column("b").to_numpy()])
        node, top = union_find(a, c)
        node, top = node[node != top], top[node != top]
    if len(node):
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(top)], schema=_EDGE)


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, component) of every node of ``edges(a, b)`` (long, not null);
    the component is its smallest node. Loops and repeated edges are fine."""
    links = cut_lineage(edges.select("a", "b").where("a <> b").mapInArrow(_contract, "a long, b long").distinct())
    before = None
    for _ in range(max_rounds):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("x"), F.least("a", "m").alias("m"))
        # larger neighbours to the smallest of the neighbourhood
        large = both.where("b > a").join(low, F.col("a") == F.col("x")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        # what is left points down: smaller neighbours to the smallest
        down = large.where("a <> b").mapInArrow(_contract, "a long, b long").distinct()
        low2 = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "x")
        small = down.join(low2, F.col("a") == F.col("x"))
        links = cut_lineage(
            small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low2.select(F.col("x").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()
        )
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select(F.col("b"), F.col("b"))).distinct()
