"""Road graph: junctions, edges cut at junctions and at length, costs, degrees."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from mapjobs.functions import geom as G, tags as R
from mapjobs.session import shuffled

# Longer edges are cut, into pieces of about this length.
LONGEST_M, PIECE_M = 500.0, 400.0
#: A vertex this near before a share counts as at it, whatever the order of summation.
SAME_M = 1e-6


def breaks(refs: DataFrame) -> DataFrame:
    """(ref, uses, is_break): nodes where edges may end: used twice or more over all ways, or an end of a way.

    refs: (way_id, seq, ref). One grouped count; the ends come from the least and the greatest seq of a way."""
    ends = refs.groupBy("way_id").agg(F.array(F.min_by("ref", "seq"), F.max_by("ref", "seq")).alias("e")).select(F.explode("e").alias("ref"), F.lit(0).alias("use"), F.lit(1).alias("end"))
    uses = refs.select("ref", F.lit(1).alias("use"), F.lit(0).alias("end")).unionByName(ends).groupBy("ref").agg(F.sum("use").alias("uses"), F.max("end").alias("end"))
    return uses.select("ref", "uses", ((F.col("uses") >= 2) | (F.col("end") == 1)).alias("is_break"))


def measured(points: DataFrame) -> DataFrame:
    """Points (way_id, seq, lat7, lon7) with ``seg`` (metres from the point before) and ``cum`` (from the way's start), both by the
    longitude scale of the way's first point."""
    w = W.partitionBy("way_id").orderBy("seq")
    first = F.first("lat7").over(w)
    seg = F.coalesce(G.segment_metres(F.col("lat7") - F.lag("lat7").over(w), F.col("lon7") - F.lag("lon7").over(w), first), F.lit(0.0))
    p = points.withColumn("seg", seg)
    return p.withColumn("cum", F.sum("seg").over(w.rowsBetween(W.unboundedPreceding, 0)))


def spans(points: DataFrame, from_edge: bool = False, bbox: tuple[int, int, int, int] | None = None) -> DataFrame:
    """(way_id, edge_no, piece, a, b, length, pts) from located points with ``is_break``.

    A way is split at its break points; an edge over 500 m with an inner vertex is cut into about equal pieces of 400 m at existing vertices,
    never twice at one. A cut is the first vertex that lies a share of the edge's length behind the start of the way
    (``from_edge``: of the edge). A zero-length edge from a node to itself is left out. All of it works on one row per way. Ways whose
    box lies outside ``bbox`` are left out; those that meet it stay whole.
    """
    p = measured(points)
    lines = p.groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("seq", "ref", "lat7", "lon7", "cum", "is_break"))).alias("pts"))
    if bbox is not None:
        lines = lines.where(~G.line_misses(F.col("pts"), bbox))
    at = F.filter(F.transform("pts", lambda x, i: F.when(x["is_break"], i)), lambda i: i.isNotNull())
    e = lines.withColumn("at", at).where(F.size("at") >= 2)
    # points are cut before rows are made, so no row carries more than its own
    cut = lambda i: F.struct(i.alias("edge_no"), F.slice("pts", F.col("at")[i] + 1, F.col("at")[i + 1] - F.col("at")[i] + 1).alias("pts"))
    e = e.select("way_id", F.explode(F.transform(F.sequence(F.lit(0), F.size("at") - 2), cut)).alias("x")).select("way_id", "x.edge_no", "x.pts")
    head, tail = F.col("pts")[0], F.element_at("pts", -1)
    e = e.withColumn("total", tail["cum"] - head["cum"]).where((F.col("total") > 0) | (head["ref"] != tail["ref"]))
    last = F.size("pts") - 1
    n = F.when((F.col("total") > LONGEST_M) & (last >= 2), F.ceil(F.col("total") / PIECE_M).cast("int")).otherwise(1)
    e = e.withColumn("n", n).withColumn("start", F.when(F.lit(from_edge), F.col("pts")[0]["cum"]).otherwise(0.0))

    def step(cuts, k):
        before = F.element_at(cuts, -1)
        want = F.col("total") * k / F.col("n")
        found = F.size(F.filter("pts", lambda x: x["cum"] - F.col("start") < want - SAME_M))
        i = F.least(F.greatest(found, before + 1), last - 1)
        return F.when(i > before, F.concat(cuts, F.array(i))).otherwise(cuts)

    inner = F.when(F.col("n") > 1, F.sequence(F.lit(1), F.col("n") - 1)).otherwise(F.array().cast("array<int>"))
    cuts = F.concat(F.aggregate(inner, F.array(F.lit(0)), step), F.array(last))
    e = e.withColumn("cuts", cuts).select("way_id", "edge_no", "pts", "cuts", F.posexplode(F.slice("cuts", 1, F.size("cuts") - 1)).alias("piece", "p"))
    q = F.col("cuts")[F.col("piece") + 1]
    e = e.select("way_id", "edge_no", "piece", F.slice("pts", F.col("p") + 1, q - F.col("p") + 1).alias("pts"))
    head, tail = F.col("pts")[0], F.element_at("pts", -1)
    return e.select("way_id", "edge_no", "piece", head["ref"].alias("a"), tail["ref"].alias("b"), (tail["cum"] - head["cum"]).alias("length"), F.transform("pts", lambda x: F.struct(x["lat7"].alias("lat7"), x["lon7"].alias("lon7"))).alias("pts"))


def edges(refs: DataFrame, nodes: DataFrame, ways: DataFrame, **options) -> DataFrame:
    """Graph edges of the routable ways: spans with class, flags, name and the four costs; edges that no profile may use are left out.

    refs (way_id, seq, ref), nodes (node_id, lat7, lon7), ways (way_id, tags). Ways are filtered before any join; counts and positions share
    the exchange on ref. Where edges may end is told by all ways, whatever the ``bbox`` (see ``spans``), so neighbouring extracts agree. The edge key is (way_id, edge_no, piece); nodes keep their ids.
    """
    t = R.of_map()
    roads = ways.where(R.routable(t)).select("way_id", R.travel(t).alias("travel"), R.edge_class(t).alias("cls"), R.edge_flags(t).alias("flags"), R.display_name(t).alias("name"))
    used = refs.join(shuffled(roads.select("way_id")), "way_id", "left_semi")
    at = used.join(shuffled(breaks(used).select("ref", "is_break")), "ref").join(shuffled(nodes.select(F.col("node_id").alias("ref"), "lat7", "lon7")), "ref")
    e = spans(at, **options).join(shuffled(roads), "way_id").withColumn("cost", R.edge_costs(F.col("travel"), F.col("length")))
    # the same as some cost not being null, but told before the costs are worked out
    usable = ((F.col("travel.bike") > 0) & (F.col("travel.ahead") | F.col("travel.back"))) | (F.col("travel.foot") > 0)
    return e.where(usable).select("way_id", "edge_no", "piece", "a", "b", "length", "pts", "cls", "flags", "name", "cost")


def used_nodes(edges: DataFrame) -> DataFrame:
    """(node_id, degree) of nodes with an edge; A4: a loop counts twice."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("node_id"))
    return ends.groupBy("node_id").agg(F.count("*").alias("degree"))


def node_table(edges: DataFrame) -> DataFrame:
    """(node_id, lat7, lon7) of the nodes that edges touch."""
    ends = F.array(F.struct(F.col("a").alias("node_id"), F.col("pts")[0].alias("p")), F.struct(F.col("b").alias("node_id"), F.element_at("pts", -1).alias("p")))
    p = edges.select(F.explode(ends).alias("e")).groupBy("e.node_id").agg(F.first("e.p").alias("p"))
    return p.select("node_id", "p.lat7", "p.lon7")


def usage(edges: DataFrame) -> DataFrame:
    """Numbers of edges, of those that bicycles and walkers may use, and of shape points."""
    some = lambda i: F.sum(F.when(F.col("cost")[i].isNotNull() | F.col("cost")[i + 1].isNotNull(), 1).otherwise(0))
    return edges.agg(F.count("*").alias("edges"), some(0).alias("bike_edges"), some(2).alias("foot_edges"), F.sum(F.size("pts")).alias("shape_points"))
