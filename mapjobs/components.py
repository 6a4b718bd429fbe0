"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mapjobs.session import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node reachable.

    Alternating large-star and small-star steps (Kiveris et al. 2014): every step is a grouped
    minimum with map-side partial aggregation and an equi-join, so a hub or a giant component never
    has to fit one task, and AQE can split its join. Only two scalars a round reach the driver.
    The edge table is checkpointed each round. Self-loops and nulls are ignored.
    """
    e = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
    e = cut(e.where("u is not null and v is not null and u <> v").distinct())
    before = _state(e)
    while before[0]:
        # large star: the larger neighbours of u attach to the least of u and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: the smaller neighbours of u, and u, attach to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.unionByName(least.withColumnRenamed("m", "v")).distinct())
        after = _state(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _least_labels(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Of each of n nodes the least node that edges (u, v) join it to: roots hang on lesser roots, then all paths are shortened."""
    label = np.arange(n)
    while len(u):
        u, v = label[u], label[v]
        apart = u != v
        u, v = u[apart], v[apart]
        np.minimum.at(label, np.maximum(u, v), np.minimum(u, v))
        while (label[label] != label).any():
            label = label[label]
    return label


def networks(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, root) as ``connected_components``, for edges between longs, most of them near ones.

    Edges are dealt into ranges of their lesser node. A task joins up its own edges in memory and gives each of its nodes the least one there; nodes that several tasks have
    met then say which of these belong together. So the rounds of stars work on the borders of ranges, not on the graph; where numbers say nothing of nearness, on all of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
        if whole:
            u, v = (np.concatenate(x) for x in zip(*whole))
            names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
            label = _least_labels(at[:len(u)], at[len(u):], len(names))
            for a in range(0, len(names), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(names[a:a + 100_000]), pa.array(names[label[a:a + 100_000]])], ["node", "root"])

    e = edges.select(F.greatest(src, dst).cast("long").alias("u"), F.least(src, dst).cast("long").alias("v")).where("u <> v")
    near = cut(e.repartitionByRange("v").mapInArrow(run, "node long, root long").groupBy("node").agg(F.collect_set("root").alias("roots")))
    least = F.array_min("roots")
    joined = cut(connected_components(near.where(F.size("roots") > 1).select(F.explode("roots").alias("root"), least.alias("least")), "root", "least"))
    found = near.select("node", least.alias("node_root")).join(joined.select(F.col("node").alias("node_root"), "root"), "node_root", "left")
    return found.select("node", F.coalesce("root", "node_root").alias("root"))
