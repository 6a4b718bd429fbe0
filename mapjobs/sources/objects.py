"""Object tables: key filters, merged extracts, located ways."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from mapjobs.session import shuffled


def with_keys(objects: DataFrame, keys: list[str]) -> DataFrame:
    """Objects that carry at least one of the keys."""
    return objects.where(F.arrays_overlap(F.map_keys("tags"), F.array(*map(F.lit, keys))))


def merged(extracts: list[DataFrame], key: list[str], version: str = "version") -> DataFrame:
    """The union of extracts with each object once, the highest version of it.

    The rank's limit is applied before the shuffle too; equal versions are the same object."""
    union = extracts[0]
    for e in extracts[1:]:
        union = union.unionByName(e)
    newest = F.row_number().over(W.partitionBy(*key).orderBy(F.col(version).desc()))
    return union.withColumn("__r", newest).where("__r = 1").drop("__r")


def way_refs(ways: DataFrame) -> DataFrame:
    """(way_id, seq, ref) of ways (way_id, refs)."""
    return ways.select("way_id", F.posexplode("refs").alias("seq", "ref"))


def located(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Refs with the position of their node; refs without one are dropped. One shuffle on ref."""
    return refs.join(shuffled(nodes.select(F.col("node_id").alias("ref"), "lat7", "lon7")), "ref")


def as_lines(points: DataFrame, least: int = 2) -> DataFrame:
    """(way_id, pts) in order, for ways with ``least`` located points or more."""
    lines = points.groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("seq", "ref", "lat7", "lon7"))).alias("pts"))
    return lines.where(F.size("pts") >= least)
