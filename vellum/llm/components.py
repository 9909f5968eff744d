"""Connected components by alternating large-star and small-star rounds.

Each round is two aggregations over the edge table and is written to the shared folder,
so lineage stays short and a lost executor costs one round at most.  Nodes never meet in
one task: neighbours are reached through joins with per-node minima, not by collecting
adjacency lists, so a star of any size is dealt over all tasks.

A caller may have edge tables of a bounded size joined by union-find in one task instead: a round costs
some 1,500 tasks on 211 partitions whatever it holds, and their small files and logs exceed the edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dealt, materialize, new_path, remove

SALTS = 8
#: Edges that one task may join: 8 MB.
ONE_TASK = 1 << 19


def _minima(edges: DataFrame) -> DataFrame:
    """Per node u the least of u and its neighbours, from directed edges (u, v)."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _joined(edges: DataFrame) -> DataFrame:
    salted = edges.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    least = _minima(edges).withColumn("s", F.explode(F.array([F.lit(i).cast("long") for i in range(SALTS)])))
    return dealt(salted, least, ["u", "s"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _joined(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    to = _joined(down).select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v"))
    return to.filter("u <> v").distinct()


def united(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges (a, b), ascending, and the least node that each reaches, by union-find."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    root = list(range(len(nodes)))
    for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist()):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        root[max(x, y)] = min(x, y)
    for x, y in enumerate(root):  # y <= x, so y has its root by now
        root[x] = root[y]
    return nodes, nodes[np.array(root, np.int64)]


def _united(edges: DataFrame) -> DataFrame:
    """(node, component) of the edges (u, v), in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = [np.zeros(0, np.int64)]
        told = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches]
        nodes, least = united(np.concatenate(none + [x for x, _ in told]), np.concatenate(none + [y for _, y in told]))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least)], names=["node", "component"])

    return edges.select(F.col("u").cast("long"), F.col("v").cast("long")).repartition(1).mapInArrow(run, "node long, component long")


def connected_components(edges: DataFrame, rounds: int = 60, one_task: int = 0) -> DataFrame:
    """(node, component) of every node on an edge (a, b); component is the least node reachable.  Up to ``one_task``
    edges are joined in one task, more in rounds."""
    spark = edges.sparkSession
    path = new_path(spark, "edges")
    now = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v"), "edges", path)
    if one_task and now.count() <= one_task:
        return _united(now)
    state = None
    for _ in range(rounds):
        after = new_path(spark, "edges")
        now = materialize(_small_star(_large_star(now)), "edges", after)
        remove(spark, path)
        path = after
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.union(roots)
