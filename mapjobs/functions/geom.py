"""Geometry on integer coordinates (degrees x 1e7): tiles, lengths, quantised points, deltas."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Tile size in degrees x 1e7, tiles on a side of a bundle, metres per degree.
TILE_LAT7, TILE_LON7, SIDE = 200_000, 300_000, 2
M_LAT, M_LON = 110574.0, 111320.0


def down(x: Column, d: int) -> Column:
    """Floor division, also below zero."""
    return F.floor(x / F.lit(float(d))).cast("long")


def tile_x(lon7: Column) -> Column:
    return down(lon7, TILE_LON7)


def tile_y(lat7: Column) -> Column:
    return down(lat7, TILE_LAT7)


def bundle(i: Column, side: int = SIDE) -> Column:
    """G1: bundle column or row of a tile column or row."""
    return down(i, side)


def slot(ix: Column, iy: Column, side: int = SIDE) -> Column:
    return (F.pmod(iy, F.lit(side)) * side + F.pmod(ix, F.lit(side))).cast("int")


def degrees(x7: Column) -> Column:
    return x7 / F.lit(1e7)


def lon_metres(lat7: Column) -> Column:
    """Metres per degree of longitude at a latitude."""
    return F.lit(M_LON) * F.cos(F.radians(degrees(lat7)))


def segment_metres(dlat7: Column, dlon7: Column, at_lat7: Column) -> Column:
    """Equirectangular length of a step. Factors go in the SQL's order, so that lengths round as there."""
    x, y = degrees(dlon7) * M_LON * F.cos(F.radians(degrees(at_lat7))), degrees(dlat7) * M_LAT
    return F.sqrt(x * x + y * y)


def quantised(x7: Column, tile: Column, size7: int) -> Column:
    """Position in a tile, 0 to 65535."""
    return F.greatest(F.lit(0), F.least(F.lit(65535), F.rint((x7 - tile * size7) / F.lit(float(size7)) * 65535).cast("int")))


#: Points of a piece of a list that is built up one by one.
PIECE = 128


def inner_deltas(a_lat7: Column, a_lon7: Column, points: Column, most: int = 255) -> Column:
    """Steps in 1e-6 degrees from a over the points strictly between an edge's ends.

    points: array of struct(lat7, lon7). A step of more than 30000 units gets filler points; each delta is taken (half to even)
    from the position that the deltas so far have reached. More than ``most`` are thinned to every n-th.
    """
    place = lambda lat, lon: F.struct(lat.cast("long").alias("lat7"), lon.cast("long").alias("lon7"))
    there = F.transform(points, lambda p: place(p["lat7"], p["lon7"]))
    before = F.slice(F.concat(F.array(place(a_lat7, a_lon7)), there), 1, F.size(points))

    def filled(q, p):
        (pa, po), (la, lo) = (q["lat7"], q["lon7"]), (p["lat7"], p["lon7"])
        steps = (F.floor(F.greatest(F.abs((la - pa) / 10.0), F.abs((lo - po) / 10.0)) / 30000) + 1).cast("long")
        return F.transform(F.sequence(F.lit(1).cast("long"), steps), lambda k: place(pa + F.floor((la - pa) * k / steps), po + F.floor((lo - po) * k / steps)))

    stops = F.when(F.size(points) > 0, F.flatten(F.zip_with(before, there, filled))).otherwise(F.array().cast("array<struct<lat7:bigint,lon7:bigint>>"))
    empty = F.array().cast("array<struct<dlat:int,dlon:int>>")
    # what is appended to is short: full pieces are laid aside, so a long edge is not copied at each point
    start = F.struct(a_lat7.cast("long").alias("lat7"), a_lon7.cast("long").alias("lon7"), empty.alias("out"), F.array().cast("array<array<struct<dlat:int,dlon:int>>>").alias("full"))

    def step(s, p):
        dlat, dlon = F.rint((p["lat7"] - s["lat7"]) / 10.0).cast("int"), F.rint((p["lon7"] - s["lon7"]) / 10.0).cast("int")
        aside = F.size(s["out"]) >= PIECE
        out = F.concat(F.when(aside, empty).otherwise(s["out"]), F.array(F.struct(dlat.alias("dlat"), dlon.alias("dlon"))))
        full = F.when(aside, F.concat(s["full"], F.array(s["out"]))).otherwise(s["full"])
        return F.struct((s["lat7"] + dlat * 10).cast("long").alias("lat7"), (s["lon7"] + dlon * 10).cast("long").alias("lon7"), out.alias("out"), full.alias("full"))

    deltas = F.aggregate(stops, start, step, lambda s: F.flatten(F.concat(s["full"], F.array(s["out"]))))
    every = (F.floor(F.size(deltas) / most) + 1).cast("int")
    return F.when(F.size(deltas) > most, F.filter(deltas, lambda x, i: F.pmod(i + 1, every) == 0)).otherwise(deltas)


def box_misses(south: Column, west: Column, north: Column, east: Column, bbox: tuple[int, int, int, int]) -> Column:
    """P10: an object's box lies wholly outside ``bbox`` (south, west, north, east); touching is not outside. Also for rings' boxes."""
    return (north < bbox[0]) | (south > bbox[2]) | (east < bbox[1]) | (west > bbox[3])


def point_in_box(lat7: Column, lon7: Column, bbox: tuple[int, int, int, int]) -> Column:
    """P10: the point is inside ``bbox`` or on its edge."""
    return lat7.between(bbox[0], bbox[2]) & lon7.between(bbox[1], bbox[3])


def line_misses(pts: Column, bbox: tuple[int, int, int, int]) -> Column:
    """P10: the box of a line or ring (a list of points) lies wholly outside ``bbox``."""
    lat, lon = F.transform(pts, lambda p: p["lat7"]), F.transform(pts, lambda p: p["lon7"])
    return box_misses(F.array_min(lat), F.array_min(lon), F.array_max(lat), F.array_max(lon), bbox)
