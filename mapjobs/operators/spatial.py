"""Spatial joins on equi-keys: points in polygons, points near points."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from mapjobs.functions import geom as G


def ring_edges(rings: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(poly, ring, y0, x0, y1, x1) from ring points (poly, ring, seq, lat7, lon7); each vertex with the one before it, wrapping. keys: columns to keep."""
    w = W.partitionBy("poly", "ring").orderBy("seq")
    every = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = lambda c: F.coalesce(F.lag(c).over(w), F.last(c).over(every))
    return rings.select("poly", *(keys or []), "ring", F.col("lat7").alias("y0"), F.col("lon7").alias("x0"), before("lat7").alias("y1"), before("lon7").alias("x1"))


def points_in_polygons(points: DataFrame, edges: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(pid, poly): points inside a polygon by the even-odd rule, inside any of its rings. points: (pid, lat7, lon7); keys: columns that must be equal too.

    Whether the corner of a tile is inside is worked out once for each ring and tile of its box, by a running sum over the ring's crossings in the row of
    tiles. From there a path leads to the point, up and then right, and only edges in the point's own tile can cross it. So points in the middle of a large
    polygon meet no edges at all. Corners lie off the integer grid, so no vertex and no crossing is ever on one.
    """
    keys, own, off = keys or [], ["poly", "ring"], 2**0.5 - 1
    wide, high = float(G.TILE_LON7), float(G.TILE_LAT7)
    lo, hi = F.least("y0", "y1"), F.greatest("y0", "y1")
    over = lambda d: F.nullif(d, F.lit(0).cast("long"))  # noqa: E731  an edge along the line has no crossing
    x_at = lambda y: (F.col("x1") - F.col("x0")) * (y - F.col("y0")) / over(F.col("y1") - F.col("y0")) + F.col("x0")

    box = edges.groupBy(*own, *keys).agg(F.min("x0").alias("x0"), F.max("x0").alias("x1"), F.min("y0").alias("y0"), F.max("y0").alias("y1"))
    cover = box.select(*own, *keys, "y0", "y1", F.explode(F.sequence(G.tile_x(F.col("x0")), G.tile_x(F.col("x1")))).alias("ix")).select(*own, *keys, "ix", F.explode(F.sequence(G.tile_y(F.col("y0")), G.tile_y(F.col("y1")))).alias("iy"))
    first, last = F.ceil((lo + off) / high), F.floor((hi + off) / high)
    right = edges.where((F.col("y0") != F.col("y1")) & (first <= last)).withColumn("iy", F.explode(F.sequence(first, last)))
    right = right.groupBy(*own, "iy", F.floor((x_at(F.col("iy") * high - off) + off) / wide).alias("ix")).agg(F.count("*").alias("n"))
    both = cover.withColumn("n", F.lit(0).cast("long")).withColumn("tile", F.lit(True)).unionByName(right.withColumn("tile", F.lit(False)), allowMissingColumns=True)
    corners = both.withColumn("right", F.sum("n").over(W.partitionBy(*own, "iy").orderBy(F.col("ix").desc()))).where("tile").drop("n", "tile")

    rows = edges.withColumn("iy", F.explode(F.sequence(G.tile_y(lo), G.tile_y(hi))))
    in_row = [F.when(F.col("y0") == F.col("y1"), x).otherwise(x_at(y)) for x, y in ((F.col("x0"), F.greatest(lo, F.col("iy") * high - 1)), (F.col("x1"), F.least(hi, (F.col("iy") + 1) * high)))]
    local = rows.withColumn("ix", F.explode(F.sequence(G.tile_x(F.greatest(F.least(*in_row) - 1, F.least("x0", "x1"))), G.tile_x(F.least(F.greatest(*in_row) + 1, F.greatest("x0", "x1"))))))

    p = points.select("pid", *keys, "lat7", "lon7", G.tile_x(F.col("lon7")).alias("ix"), G.tile_y(F.col("lat7")).alias("iy"))
    met = p.join(corners, [*keys, "ix", "iy"]).join(local.drop(*keys), [*own, "ix", "iy"], "left")
    cx, cy, px, py = F.col("ix") * wide - off, F.col("iy") * high - off, F.col("lon7"), F.col("lat7")
    up_at = (F.col("y1") - F.col("y0")) * (cx - F.col("x0")) / over(F.col("x1") - F.col("x0")) + F.col("y0")
    up = ((F.col("x0") > cx) != (F.col("x1") > cx)) & (up_at > cy) & (up_at <= py)
    along = ((F.col("y0") > py) != (F.col("y1") > py)) & (x_at(py) > cx) & ~(px < x_at(py))
    crossed = F.sum(F.coalesce(up.cast("int"), F.lit(0)) + F.coalesce(along.cast("int"), F.lit(0)))
    odd = met.groupBy("pid", *own).agg((F.first("right") + crossed).alias("n")).where("n % 2 = 1")
    return odd.select("pid", "poly").distinct()


def near(queries: DataFrame, others: DataFrame, radius_deg: float, keys: list[str] | None = None) -> DataFrame:
    """Pairs of a query (lat7, lon7, ...) and another point (olat7, olon7, ...) within a square of ``radius_deg`` scaled degrees, and ``d2``.

    d2 is the squared distance in degrees, longitude scaled by the cosine of the query's latitude; all pairs with d2 up to radius_deg squared are
    there. Latitude bands have their own longitude scale; a point is placed in its own and the neighbouring cells of three bands, a query in one.
    keys: columns that must be equal too; they keep cells of common names small. The 180th meridian is not crossed.
    """
    keys, size = keys or [], radius_deg * 1.05
    band = lambda lat: F.floor(G.degrees(lat) / size).cast("long")
    column = lambda lon, b: F.floor(G.degrees(lon) * F.cos(F.radians((b + 0.5) * size)) / size).cast("long")
    q = queries.withColumn("__b", band(F.col("lat7"))).withColumn("__x", column(F.col("lon7"), F.col("__b")))
    o = others.withColumn("__b", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: band(F.col("olat7")) + i)))
    o = o.withColumn("__x", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: column(F.col("olon7"), F.col("__b")) + i)))
    dy = G.degrees(F.col("olat7") - F.col("lat7"))
    dx = G.degrees(F.col("olon7") - F.col("lon7")) * F.cos(F.radians(G.degrees(F.col("lat7"))))
    return q.join(o, [*keys, "__b", "__x"]).withColumn("d2", dy * dy + dx * dx).where(F.col("d2") <= radius_deg * radius_deg).drop("__b", "__x")
