"""Tiles: lines cut at the grid, grouped features, dense numbers in tile order, string tables, offsets, bundles
(G3, G4, G6, G11, A7, A9, T1, T2, W2, W4, W6-W8, B1-B6)."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mapjobs.functions import geom as G, tags as R
from mapjobs.functions.text import cut_bytes
from mapjobs.operators import areas
from mapjobs.session import shuffled

#: Fixed value: metres to which road lines are simplified.
ROAD_M = 2.0


def split_lines(lines: DataFrame) -> DataFrame:
    """(way_id, piece, ix, iy, pts) of lines (way_id, pts): each line cut at every grid line that it crosses.

    Each segment's crossings are computed as parameters between 0 and 1; a piece belongs to the cell of its middle; consecutive pieces
    in a cell are one polyline, a later return starts another. pts are quantised. The windows run over the way's own rows.
    """
    s = lines.select("way_id", "pts", F.explode(F.sequence(F.lit(0), F.size("pts") - 2)).alias("seg"))
    a, b = F.col("pts")[F.col("seg")], F.col("pts")[F.col("seg") + 1]
    s = s.select("way_id", "seg", a["lon7"].alias("x0"), a["lat7"].alias("y0"), (b["lon7"] - a["lon7"]).alias("dx"), (b["lat7"] - a["lat7"]).alias("dy"))

    def crossings(x0: str, dx: str, size: int) -> Column:
        lo, hi = F.least(F.col(x0), F.col(x0) + F.col(dx)), F.greatest(F.col(x0), F.col(x0) + F.col(dx))
        first, last = G.down(lo, size) + 1, -G.down(-hi, size) - 1  # strictly between the ends
        return F.when((F.col(dx) != 0) & (first <= last), F.transform(F.sequence(first, last), lambda k: (k * size - F.col(x0)) / F.col(dx))).otherwise(F.array().cast("array<double>"))

    ts = F.array_sort(F.concat(F.array(F.lit(0.0), F.lit(1.0)), crossings("x0", "dx", G.TILE_LON7), crossings("y0", "dy", G.TILE_LAT7)))
    s = s.withColumn("ts", ts).select("*", F.posexplode(F.slice("ts", 1, F.size("ts") - 1)).alias("j", "t0")).withColumn("t1", F.col("ts")[F.col("j") + 1])
    s = s.where(F.col("t1") - F.col("t0") >= 1e-12)
    mid = (F.col("t0") + F.col("t1")) * 0.5
    s = s.withColumn("ix", G.tile_x(F.col("x0") + F.col("dx") * mid)).withColumn("iy", G.tile_y(F.col("y0") + F.col("dy") * mid))
    w = W.partitionBy("way_id").orderBy("seg", "j")
    new = F.when((F.lag("ix").over(w) == F.col("ix")) & (F.lag("iy").over(w) == F.col("iy")), 0).otherwise(1)
    s = s.withColumn("new", new).withColumn("piece", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, 0)) - 1)
    at = lambda t: F.struct(G.quantised(F.col("x0") + F.col("dx") * F.col(t), F.col("ix"), G.TILE_LON7).alias("x"), G.quantised(F.col("y0") + F.col("dy") * F.col(t), F.col("iy"), G.TILE_LAT7).alias("y"))
    s = s.withColumn("p0", at("t0")).withColumn("p1", at("t1"))
    g = s.groupBy("way_id", "piece").agg(F.first("ix").alias("ix"), F.first("iy").alias("iy"), F.array_sort(F.collect_list(F.struct("seg", "j", "p0", "p1"))).alias("ps"))
    return g.select("way_id", "piece", "ix", "iy", F.concat(F.array(F.col("ps")[0]["p0"]), F.transform("ps", lambda p: p["p1"])).alias("pts"))


def road_lines(lines: DataFrame, ways: DataFrame, bbox: tuple[int, int, int, int] | None = None) -> DataFrame:
    """(way_id, pts) of the drawn ways whose box meets ``bbox``, simplified. lines: (way_id, pts). The box is that of all located points."""
    drawn = lines.join(shuffled(ways.where(R.road_class(R.of_map()).isNotNull()).select("way_id")), "way_id", "left_semi")
    return areas.simplified(drawn if bbox is None else drawn.where(~G.line_misses(F.col("pts"), bbox)), "way_id", ROAD_M)


def road_features(lines: DataFrame, ways: DataFrame) -> DataFrame:
    """(ix, iy, way_id, piece, cls, flags, name, pts): tile features of drawn ways. lines: ``road_lines``."""
    t = R.of_map()
    drawn = ways.withColumn("cls", R.road_class(t)).where("cls is not null").select("way_id", "cls", R.display_flags(t).alias("flags"), cut_bytes(R.display_name(t), 60).alias("name"))
    return split_lines(lines).join(shuffled(drawn), "way_id")


def string_table(features: DataFrame, order: list[Column]) -> DataFrame:
    """(ix, iy, name, idx): the names of a tile, numbered by first appearance in the written order."""
    f = features.withColumn("pos", F.row_number().over(W.partitionBy("ix", "iy").orderBy(*order)))
    names = f.where("name is not null").groupBy("ix", "iy", "name").agg(F.min("pos").alias("pos"))
    return names.select("ix", "iy", "name", (F.row_number().over(W.partitionBy("ix", "iy").orderBy("pos")) - 1).alias("idx"))



def road_tiles(features: DataFrame) -> DataFrame:
    """(ix, iy, ways, strings): one row per tile; minor ways first, then by way and piece."""
    order = F.struct((-F.col("cls")).alias("minor"), "way_id", "piece", "cls", "flags", "name", "pts")
    g = features.groupBy("ix", "iy").agg(F.array_sort(F.collect_list(order)).alias("ways"))
    # first appearance in the written order is the order in which array_distinct keeps values
    strings = F.array_distinct(F.filter(F.transform("ways", lambda x: x["name"]), lambda n: n.isNotNull()))
    g = g.withColumn("strings", strings)
    row = lambda x: F.struct(x["cls"].alias("cls"), x["flags"].alias("flags"), F.when(x["name"].isNotNull(), F.array_position("strings", x["name"]).cast("int") - 1).alias("name_idx"), x["pts"].alias("pts"))
    return g.select("ix", "iy", F.transform("ways", row).alias("ways"), "strings")


def with_dense_ids(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Dense numbers from 0 in the order of (ix, iy, order).

    Two prefix sums: over the tiles of a column, and over the columns (some thousands on the whole globe); rows are
    ranked within their tile only, so no task ever sorts everything.
    """
    firsts = tile_counts(df, "n").select("ix", "iy", F.col("first").alias("__first"))
    rank = F.row_number().over(W.partitionBy("ix", "iy").orderBy(*order)) - 1
    return df.withColumn("__rank", rank).join(firsts, ["ix", "iy"]).withColumn(name, (F.col("__first") + F.col("__rank")).cast("long")).drop("__first", "__rank")


def tile_counts(df: DataFrame, count: str = "n") -> DataFrame:
    """(ix, iy, n, first): rows per tile, and rows in all tiles before it in (ix, iy) order."""
    tiles = df.groupBy("ix", "iy").agg(F.count("*").alias(count))
    columns = tiles.groupBy("ix").agg(F.sum(count).alias("__c"))
    before = F.coalesce(F.sum("__c").over(W.orderBy("ix").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    columns = columns.select("ix", before.alias("__before"))
    within = F.coalesce(F.sum(count).over(W.partitionBy("ix").orderBy("iy").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return tiles.withColumn("__w", within).join(columns, "ix").select("ix", "iy", count, (F.col("__before") + F.col("__w")).alias("first"))


def sparse_index(tiles: DataFrame, every: int = 64) -> DataFrame:
    """Every 64th tile in (ix, iy) order. tiles: distinct (ix, iy, ...)."""
    numbered = with_dense_ids(tiles.select("ix", "iy"), ["ix"], "tile_no")
    return tiles.join(numbered.where(F.pmod("tile_no", F.lit(every)) == 0), ["ix", "iy"])


def size_statistics(sizes: DataFrame, group: str, size: str) -> DataFrame:
    """Count, sum, median s[n // 2], 95th percentile s[int(n * 0.95)] and maximum of a size, exact.

    Works on (group, size) counts, so equal sizes are one row in the running sum."""
    c = sizes.groupBy(group, size).agg(F.count("*").alias("c"))
    w = W.partitionBy(group)
    c = c.withColumn("n", F.sum("c").over(w)).withColumn("upto", F.sum("c").over(w.orderBy(size).rowsBetween(W.unboundedPreceding, 0)))
    pick = lambda i: F.min(F.when(F.col("upto") > i, F.col(size)))
    return c.groupBy(group).agg(F.max("n").alias("n"), F.sum(F.col("c") * F.col(size)).alias("total"), pick(F.floor(F.col("n") / 2)).alias("median"), pick(F.floor(F.col("n") * 0.95)).alias("p95"), F.max(size).alias("largest"))


def offsets(items: DataFrame, group: list[str], order: list[str], length: Column, start: int = 0) -> DataFrame:
    """Items with ``at``: the bytes of the items before it in its group."""
    before = F.sum(length).over(W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    return items.withColumn("at", (F.coalesce(before, F.lit(0)) + start).cast("long"))


def bundle_directory(tiles: DataFrame, side: int = G.SIDE) -> DataFrame:
    """(layer, bx, by, slots): offset and length of each of the side x side tiles, 0 and 0 for an absent one.

    tiles: (layer, ix, iy, size)."""
    t = tiles.select("layer", G.bundle(F.col("ix"), side).alias("bx"), G.bundle(F.col("iy"), side).alias("by"), G.slot(F.col("ix"), F.col("iy"), side).alias("slot"), "size")
    t = offsets(t, ["layer", "bx", "by"], ["slot"], F.col("size"), 8 + 8 * side * side)
    found = t.groupBy("layer", "bx", "by").agg(F.map_from_entries(F.collect_list(F.struct("slot", F.struct("at", "size")))).alias("m"))
    slots = F.transform(F.sequence(F.lit(0), F.lit(side * side - 1)), lambda s: F.struct(F.coalesce(F.col("m")[s]["at"], F.lit(0)).alias("at"), F.coalesce(F.col("m")[s]["size"], F.lit(0)).alias("size")))
    return found.select("layer", "bx", "by", slots.alias("slots"))


# --- binary tiles: the little-endian layouts of the device, packed row by row from nested rows ---------------------------------


class TooMany(ValueError):
    """A tile has more members than its layout can count."""


def _strings(items) -> bytes:
    return b"".join(bytes([len(b)]) + b for b in (s.encode() for s in items))


def pack_road_tile(ways, strings) -> bytes:
    """B1: header 'M', version, counts; per way class, flags, name index (65535 for none), points; string table."""
    if len(ways) > 65535 or len(strings) > 65534:
        raise TooMany("too many ways or names for one tile")
    out = [struct.pack("<BBHH", ord("M"), 1, len(ways), len(strings))]
    for w in ways:
        out.append(struct.pack("<BBHH", w["cls"], w["flags"], 65535 if w["name_idx"] is None else int(w["name_idx"]), len(w["pts"])))
        out.extend(struct.pack("<HH", p["x"], p["y"]) for p in w["pts"])
    return b"".join([*out, _strings(strings)])


def pack_area_tile(polygons, building: bool = False) -> bytes:
    """B2: header 'A' or 'B'; per polygon type, hole flag, points."""
    if len(polygons) > 65535:
        raise TooMany("too many polygons for one tile")
    out = [struct.pack("<BBH", ord("B" if building else "A"), 1, len(polygons))]
    for g in polygons:
        out.append(struct.pack("<BBH", g["typ"], g["hole"], len(g["pts"])))
        out.extend(struct.pack("<HH", p["x"], p["y"]) for p in g["pts"])
    return b"".join(out)


def pack_bundle(slots, side: int = G.SIDE) -> bytes:
    """B6: 'PAK1', side; offset and length of each slot; the tiles in slot order. slots: the tiles' bytes or None."""
    table, body, at = [], [], 8 + 8 * side * side
    for s in slots:
        table.append(struct.pack("<II", at if s else 0, len(s) if s else 0))
        if s:
            body.append(s)
            at += len(s)
    return b"".join([b"PAK1", struct.pack("<HH", side, 0), *table, *body])


def with_bytes(tiles: DataFrame, pack, *columns: str) -> DataFrame:
    """tiles with ``data``, packed from nested columns; Arrow batches of tiles, no shuffle. A tile with more members than the device's layout can count has
    null data; its nested row is whole, and no other tile suffers."""
    schema = "ix long, iy long, data binary"

    def packed(*row) -> bytes | None:
        try:
            return pack(*row)
        except TooMany:
            return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"ix": b["ix"], "iy": b["iy"], "data": [packed(*r) for r in zip(*(b[c] for c in columns))]})

    return tiles.select("ix", "iy", *columns).mapInPandas(run, schema)


def bundles(tiles: DataFrame, layer: str, side: int = G.SIDE) -> DataFrame:
    """(layer, bx, by, data) from tiles (ix, iy, data): side x side tiles a group, no more."""
    t = tiles.select(G.bundle(F.col("ix"), side).alias("bx"), G.bundle(F.col("iy"), side).alias("by"), G.slot(F.col("ix"), F.col("iy"), side).alias("slot"), "data")

    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        found = dict(zip(group["slot"], group["data"]))
        return pd.DataFrame({"layer": [layer], "bx": [key[0]], "by": [key[1]], "data": [pack_bundle([found.get(s) for s in range(side * side)], side)]})

    return t.groupBy("bx", "by").applyInPandas(run, "layer string, bx long, by long, data binary")


def region_summary(features: DataFrame, points: DataFrame) -> DataFrame:
    """One row with the numbers of tiles, features and points, and the box of the points of kept ways (lat7, lon7)."""
    tiles = features.groupBy("ix", "iy").agg(F.count("*").alias("f"), F.sum(F.size("pts")).alias("p")).agg(F.count("*").alias("tiles"), F.sum("f").alias("features"), F.sum("p").alias("points"))
    box = points.agg(F.min("lat7").alias("south"), F.min("lon7").alias("west"), F.max("lat7").alias("north"), F.max("lon7").alias("east"))
    return tiles.join(F.broadcast(box))  # one row each


def write_layers(bundled: DataFrame, path: str) -> None:
    """Bundles partitioned by layer and bundle column."""
    bundled.write.mode("overwrite").partitionBy("layer", "bx").parquet(path)
