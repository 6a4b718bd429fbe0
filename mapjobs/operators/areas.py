"""Areas: rings from relations, cleaning, simplification, tiles."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from mapjobs.functions import geom as G, tags as R
from mapjobs.operators import spatial
from mapjobs.session import shuffled

#: The area type of buildings, a layer of their own; size of a tile (lon7, lat7).
BUILDING, GRID = 4, np.array([G.TILE_LON7, G.TILE_LAT7])


def simplify_all(x: np.ndarray, y: np.ndarray, at: np.ndarray, eps: np.ndarray) -> np.ndarray:
    """Whether Douglas and Peucker's method keeps each point of many lines, whose points are ``at[i]`` to ``at[i + 1]``. Distance is to the segment; of equal maxima the first
    counts; a point stays if it is farther than its line's eps. A round cuts the open ranges of all lines once."""
    keep, some = np.zeros(len(x), bool), at[1:] > at[:-1]
    a, b, least = at[:-1][some], at[1:][some] - 1, (eps * eps)[some]
    keep[a] = keep[b] = True
    while True:
        open_ = b - a >= 2
        a, b, least = a[open_], b[open_], least[open_]
        if not len(a):
            return keep
        n = b - a - 1
        starts = np.cumsum(n) - n
        of = np.repeat(np.arange(len(a)), n)
        i = np.arange(len(of)) - starts[of] + a[of] + 1
        dx, dy = x[b] - x[a], y[b] - y[a]
        size, px, py, dx, dy = (dx * dx + dy * dy)[of], x[i] - x[a][of], y[i] - y[a][of], dx[of], dy[of]
        t = np.clip(np.divide(px * dx + py * dy, size, out=np.zeros(len(of)), where=size != 0), 0, 1)
        d = (px - t * dx) ** 2 + (py - t * dy) ** 2
        most = np.maximum.reduceat(d, starts)
        ties = np.flatnonzero(d == most[of])
        far = i[ties[np.searchsorted(ties, starts)]]
        cut = most > least
        keep[far[cut]] = True
        a, b, least = np.concatenate([a[cut], far[cut]]), np.concatenate([far[cut], b[cut]]), np.concatenate([least[cut], least[cut]])


def simplify(x: np.ndarray, y: np.ndarray, eps: float) -> np.ndarray:
    """Indices of the points of one line that stay."""
    return np.flatnonzero(simplify_all(x, y, np.array([0, len(x)]), np.array([float(eps)])))


def _points(batch: pa.RecordBatch, name: str = "pts") -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(points of all rows in one array, where each row's begin and end, lat7, lon7) of a column of point lists."""
    column = batch.column(name)
    values, sizes = column.flatten(), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    part = lambda k: pc.struct_field(values, k).to_numpy(zero_copy_only=False)
    return values, np.concatenate([[0], np.cumsum(sizes)]), part("lat7"), part("lon7")


def _list_of(values: pa.Array, sizes: list[int] | np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def simplified(lines: DataFrame, key: str, eps, ring: bool = False) -> DataFrame:
    """Lines (key, pts, ...) with simplified pts: no shuffle, Arrow batches. ``eps`` is metres or a column with metres; a ring is closed by
    its first point for the test, and dropped if fewer than three points stay."""
    names = lines.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, at, lat7, lon7 = _points(b)
            some, lines = at[1:] > at[:-1], len(b)
            order = np.insert(np.arange(len(lat7)), at[1:][some], at[:-1][some]) if ring else np.arange(len(lat7))
            row = np.repeat(np.arange(lines), np.diff(at) + some * ring)
            # the scale is one number, as in the SQL and the reference: points as far but for rounding stay so
            scale = np.zeros(lines)
            scale[some] = [G.M_LON * math.cos(math.radians(v)) for v in (lat7[at[:-1][some]] / 1e7).tolist()]
            keep = simplify_all((lon7[order] / 1e7) * scale[row], (lat7[order] / 1e7) * G.M_LAT, np.searchsorted(row, np.arange(lines + 1)), b.column("__eps").to_numpy(zero_copy_only=False))
            if ring:
                keep[np.cumsum(np.diff(at)[some] + 1) - 1] = False
            sizes = np.bincount(row[keep], minlength=lines)
            pts = _list_of(values.take(pa.array(order[keep])), sizes)
            out = pa.RecordBatch.from_arrays([pts if c == "pts" else b.column(c) for c in names], names)
            yield out.filter(pa.array(sizes >= 3)) if ring else out

    width = eps if not isinstance(eps, (int, float)) else F.lit(float(eps))
    return lines.withColumn("__eps", width.cast("double")).mapInArrow(run, lines.schema)


def assembled(ways: DataFrame, relations: DataFrame) -> DataFrame:
    """(area_id, ring, role, refs, tags): closed rings of areas. ways: (way_id, refs, tags); relations: (rel_id, members, tags).

    A closed way of four refs or more is an area by itself unless tagged area=no; its id is twice the way's. A relation of type multipolygon or boundary is
    one whose id is twice its own and one, with its member ways stitched; members of role inner are holes.
    """
    closed = (F.size("refs") >= 4) & (F.col("refs")[0] == F.element_at("refs", -1)) & ~F.coalesce(F.col("tags")["area"], F.lit("")).eqNullSafe("no")
    own = ways.where(closed).select((F.col("way_id") * 2).alias("area_id"), F.lit(0).alias("ring"), F.lit("outer").alias("role"), F.slice("refs", 1, F.size("refs") - 1).alias("refs"), "tags")
    made = relations.where(F.col("tags")["type"].isin("multipolygon", "boundary")).withColumn("area_id", F.col("rel_id") * 2 + 1)
    members = made.select("area_id", F.posexplode("members").alias("seq", "m")).where("m.type = 'way'")
    members = members.select("area_id", "seq", F.when(F.col("m.role") == "inner", "inner").otherwise("outer").alias("role"), F.col("m.ref").alias("way_id")).join(shuffled(ways.select("way_id", "refs")), "way_id")
    rings = stitched(members.select("area_id", "seq", "role", "refs")).join(shuffled(made.select("area_id", "tags")), "area_id")
    return own.unionByName(rings.select("area_id", "ring", "role", "refs", "tags"))


def located_rings(rings: DataFrame, nodes: DataFrame) -> DataFrame:
    """S3: rings (area_id, ring, role, refs, ...) with ``pts`` in place of refs; refs without a position are dropped, and rings under three points."""
    p = rings.select("area_id", "ring", F.posexplode("refs").alias("seq", "ref")).join(shuffled(nodes.select(F.col("node_id").alias("ref"), "lat7", "lon7")), "ref")
    p = p.groupBy("area_id", "ring").agg(F.array_sort(F.collect_list(F.struct("seq", "lat7", "lon7"))).alias("pts")).where(F.size("pts") >= 3)
    return rings.drop("refs").join(shuffled(p), ["area_id", "ring"])


def with_outer(rings: DataFrame) -> DataFrame:
    """Rings (area_id, ring, role, pts, ...) with ``outer``: the ring that a hole lies in, the one of the least box where several contain its first point. An outer ring has
    its own number. Holes in no outer ring of their area are dropped. The join is on the tile and the area (``spatial``)."""
    box = (F.array_max(F.transform("pts", lambda p: p["lon7"])) - F.array_min(F.transform("pts", lambda p: p["lon7"]))) * (F.array_max(F.transform("pts", lambda p: p["lat7"])) - F.array_min(F.transform("pts", lambda p: p["lat7"])))
    key = F.struct("area_id", "ring")
    holes = rings.where("role = 'inner'").select(key.alias("pid"), "area_id", F.col("pts")[0]["lat7"].alias("lat7"), F.col("pts")[0]["lon7"].alias("lon7"))
    outers = rings.where("role <> 'inner'").join(holes.select("area_id").distinct(), "area_id", "left_semi")
    points = outers.select(key.alias("poly"), "area_id", F.posexplode("pts").alias("seq", "p")).select("poly", "area_id", F.lit(0).alias("ring"), "seq", "p.lat7", "p.lon7")
    inside = spatial.points_in_polygons(holes, spatial.ring_edges(points, ["area_id"]), ["area_id"])
    inside = inside.join(outers.select(key.alias("poly"), box.alias("box")), "poly").groupBy("pid").agg(F.min_by("poly.ring", F.struct("box", "poly.ring")).alias("outer"))
    held = inside.select("pid.area_id", "pid.ring", "outer")
    own = rings.where("role <> 'inner'").withColumn("outer", F.col("ring"))
    return own.unionByName(rings.where("role = 'inner'").join(held, ["area_id", "ring"]).select(own.columns))


def _with_their_outer(rings: DataFrame) -> DataFrame:
    """Rings without the holes whose outer ring is not there."""
    outers = rings.where("hole = 0").select("area_id", F.col("ring").alias("outer"))
    return rings.where("hole = 0").unionByName(rings.where("hole = 1").join(outers, ["area_id", "outer"], "left_semi").select(rings.columns))


def kept(rings: DataFrame, buildings: bool = False) -> DataFrame:
    """The rings (area_id, ring, role, outer, typ, pts) worth drawing, cleaned, with ``hole``. A hole goes with its outer ring; buildings are
    left out unless asked for, and have no holes."""
    r = rings.where(F.lit(buildings) | (F.col("typ") != BUILDING)).where((F.col("typ") != BUILDING) | (F.col("role") != "inner"))
    r = cleaned(r.withColumn("hole", F.when(F.col("role") == "inner", 1).otherwise(0)))
    return _with_their_outer(r.select("area_id", "ring", "outer", "typ", "hole", "pts"))


def drawn(rings: DataFrame, buildings: bool = False) -> DataFrame:
    """``kept`` rings, simplified by their type; a ring that is left with under three points goes, and takes its holes along."""
    eps = F.create_map(*[F.lit(x) for kv in R.SIMPLIFY_M.items() for x in kv])[F.col("typ")]
    return _with_their_outer(simplified(kept(rings, buildings), "area_id", eps, ring=True))


def rings_of(ends: list[tuple[int, int]]) -> list[list[tuple[int, bool]]]:
    """Rings made of ways with the given end nodes: of each the ways in order, with whether they run forwards.

    Ways that lead to a loose end are taken away first. A walk then follows unused ways; as soon as it is at a node of its path again, the loop is a
    ring and leaves the path, so rings that touch come apart; at a dead end the walk steps back over its last way, which is in no ring. Each way is walked over once. A ring
    begins with its first way, forwards, and rings go by their first way.
    """
    there = defaultdict(list)  # ways at a node, the first on top
    for i in range(len(ends) - 1, -1, -1):
        for node in set(ends[i]):
            there[node].append(i)
    free, used, rings = {n: len(w) for n, w in there.items()}, [False] * len(ends), []
    for i, (a, b) in enumerate(ends):
        if a == b:  # a ring by itself
            used[i], free[a] = True, free[a] - 1
            rings.append([(i, True)])
    loose = [n for n, k in free.items() if k == 1]
    while loose:
        n = loose.pop()
        if free[n] == 1:
            i = next(i for i in there[n] if not used[i])
            used[i] = True
            for node in ends[i]:
                free[node] -= 1
                if free[node] == 1:
                    loose.append(node)
    for start in range(len(ends)):
        if used[start]:
            continue
        path, on = [], {ends[start][0]: 0}  # ways so far; how many of them lead to each node of the path
        at = ends[start][0]
        while True:
            while there[at] and used[there[at][-1]]:
                there[at].pop()
            if there[at]:
                i = there[at].pop()
                used[i] = True
                path.append((i, ends[i][0] == at))
                at = ends[i][1] if ends[i][0] == at else ends[i][0]
                if at in on:
                    loop, path = path[on[at]:], path[:on[at]]
                    for way, forwards in loop[:-1]:
                        del on[ends[way][forwards]]
                    rings.append(loop)
                else:
                    on[at] = len(path)
            elif path:
                del on[at]
                way, forwards = path.pop()
                at = ends[way][not forwards]
            else:
                break
    whole = []
    for r in rings:
        k = r.index(min(r))
        r = r[k:] + r[:k]
        whole.append(r if r[0][1] else [(i, not f) for i, f in [r[0], *r[:0:-1]]])
    return sorted(whole)


def stitched(members: DataFrame) -> DataFrame:
    """(area_id, ring, role, refs): closed rings from member ways (area_id, seq, role, refs) of one area.

    Ways of a role are joined at shared ends, either way round (``rings_of``); what does not close is dropped, and a way that is there twice makes no ring of its own. A group holds the
    member ways of one relation, in time linear in them."""
    def rings(ways: list[dict]) -> list[tuple[str, list[int]]]:
        found, roles = [], {}
        for w in sorted(ways, key=lambda w: (w["role"], w["seq"])):
            roles.setdefault(w["role"], []).append(w["refs"])
        for role, part in roles.items():
            once: dict[tuple, list] = {}
            for r in part:
                if len(r) > 1:
                    once.setdefault(min(tuple(r), tuple(r[::-1])), r)
            lines = list(once.values())
            for ring in rings_of([(r[0], r[-1]) for r in lines]):
                line = [x for i, forwards in ring for x in (lines[i] if forwards else lines[i][::-1])[:-1]]
                if len(line) > 2:
                    found.append((role, line))
        return found

    names = ["area_id", "ring", "role", "refs"]
    kinds = pa.schema(list(zip(names, (pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int64())))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for area, ways in zip(b.column("area_id").to_pylist(), b.column("ways")):
                rows += [(area, i, role, line) for i, (role, line) in enumerate(rings(ways.as_py()))]
                if sum(len(r[3]) for r in rows[-1:]) > 100_000 or len(rows) > 20_000:  # long rings leave at once
                    yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), kinds)], schema=kinds)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), kinds)], schema=kinds)

    # many relations enter a task in one batch: a call for each would take most of the time
    whole = members.groupBy(F.col("area_id").cast("long").alias("area_id")).agg(F.collect_list(F.struct("role", "seq", "refs")).alias("ways"))
    return whole.mapInArrow(run, "area_id long, ring int, role string, refs array<long>")


def cleaned(rings: DataFrame) -> DataFrame:
    """Rings (…, typ, pts) without a closing duplicate, of three points or more, whose box has the least size in square metres of their type."""
    p = F.col("pts")
    again = (F.size(p) > 1) & (p[0]["lat7"] == F.element_at(p, -1)["lat7"]) & (p[0]["lon7"] == F.element_at(p, -1)["lon7"])
    r = rings.withColumn("pts", F.when(again, F.slice(p, 1, F.size(p) - 1)).otherwise(p)).where(F.size("pts") >= 3)
    lat, lon = F.transform("pts", lambda x: x["lat7"]), F.transform("pts", lambda x: x["lon7"])
    high = (F.array_max(lat) - F.array_min(lat)) / 1e7 * G.M_LAT
    wide = (F.array_max(lon) - F.array_min(lon)) / 1e7 * G.lon_metres(F.col("pts")[0]["lat7"])
    least = F.create_map(*[F.lit(x) for kv in R.LEAST_M2.items() for x in kv])[F.col("typ")]
    return r.where(high * wide >= least)


def cover(rings: DataFrame) -> DataFrame:
    """Rings with (ix, iy) of every tile of their box and ``alone`` if it is one. Points stay behind: a ring is cut by ``clipped``."""
    lat, lon = F.transform("pts", lambda x: x["lat7"]), F.transform("pts", lambda x: x["lon7"])
    r = rings.withColumn("x0", G.tile_x(F.array_min(lon))).withColumn("x1", G.tile_x(F.array_max(lon))).withColumn("y0", G.tile_y(F.array_min(lat))).withColumn("y1", G.tile_y(F.array_max(lat)))
    r = r.withColumn("alone", (F.col("x0") == F.col("x1")) & (F.col("y0") == F.col("y1"))).withColumn("ix", F.explode(F.sequence("x0", "x1"))).drop("pts")
    return r.withColumn("iy", F.explode(F.sequence("y0", "y1"))).drop("x0", "x1", "y0", "y1")


def clip_half(poly: np.ndarray, axis: int, at: float, keep_above: bool) -> np.ndarray:
    """The part of a polygon on one side of a line across an axis (Sutherland and Hodgman), all edges at once."""
    if not len(poly):
        return poly
    before = np.roll(poly, 1, axis=0)
    inside, was = (poly[:, axis] >= at, before[:, axis] >= at) if keep_above else (poly[:, axis] <= at, before[:, axis] <= at)
    step = poly[:, axis] - before[:, axis]
    t = np.divide(at - before[:, axis], step, out=np.zeros(len(poly)), where=step != 0)
    cut = before + t[:, None] * (poly - before)
    cut[:, axis] = at
    out = np.stack([cut, poly], axis=1)
    return out[np.stack([inside != was, inside], axis=1)]


def tiles_of(p: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(ix, iy, part) of a polygon (lon7, lat7) for every tile that it has three points or more in. The polygon is halved at a grid line until a part
    lies in one tile, so each point is copied as often as halves are made, not once for every tile."""
    todo = [p]
    while todo:
        p = todo.pop()
        if len(p) < 3:
            continue
        lo, hi = np.floor(p.min(0) / GRID).astype(int), np.floor(p.max(0) / GRID).astype(int)
        hi = np.where((hi > lo) & (p.max(0) == hi * GRID), hi - 1, hi)  # a part that only touches the next line
        axis = int(np.argmax(hi - lo))
        if hi[axis] == lo[axis]:
            yield int(lo[0]), int(lo[1]), p
            continue
        at = float((lo[axis] + hi[axis] + 1) // 2 * GRID[axis])
        todo += [clip_half(p, axis, at, True), clip_half(p, axis, at, False)]


def clipped(rings: DataFrame, most: int = 200_000) -> DataFrame:
    """(area_id, ring, typ, hole, ix, iy, pts) with the quantised part of each ring in each tile; parts under three points are dropped.

    No shuffle: a ring's parts leave its task in batches of about ``most`` points."""
    schema = "area_id long, ring int, typ int, hole int, ix long, iy long, pts array<struct<x:int,y:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, at, lat7, lon7 = _points(b)
            rows, parts = [], []

            def flush():
                q = np.concatenate(parts)
                pts = _list_of(pa.StructArray.from_arrays([pa.array(q[:, 0], pa.int32()), pa.array(q[:, 1], pa.int32())], ["x", "y"]), [len(x) for x in parts])
                of, ix, iy = (pa.array(x, pa.int64()) for x in zip(*rows))
                own = [b.column(c).take(of) for c in ("area_id", "ring", "typ", "hole")]
                rows.clear(), parts.clear()
                return pa.RecordBatch.from_arrays([*own, ix, iy, pts], ["area_id", "ring", "typ", "hole", "ix", "iy", "pts"])

            held = 0
            for i in range(len(b)):
                for ix, iy, p in tiles_of(np.stack([lon7[at[i]:at[i + 1]], lat7[at[i]:at[i + 1]]], 1).astype(float)):
                    rows.append((i, ix, iy))
                    parts.append(np.clip(np.rint((p - GRID * (ix, iy)) / GRID * 65535), 0, 65535).astype(np.int32))
                    held += len(p)
                    if held > most:
                        yield flush()
                        held = 0
            if rows:
                yield flush()

    return rings.select(F.col("area_id").cast("long"), F.col("ring").cast("int"), F.col("typ").cast("int"), F.col("hole").cast("int"), "pts").mapInArrow(run, schema)


def drawing_order() -> Column:
    return F.create_map(*[F.lit(x) for kv in R.DRAW_ORDER.items() for x in kv])[F.col("typ")]


def area_tiles(polygons: DataFrame, buildings: bool = False) -> DataFrame:
    """(ix, iy, polygons) of the area layer, or of the buildings': in drawing order (built-up, park, forest, water), fills before holes, then by area and ring."""
    polygons = polygons.where((F.col("typ") == BUILDING) == F.lit(buildings))
    order = drawing_order()
    g = polygons.groupBy("ix", "iy").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "hole", "area_id", "ring", "typ", "pts"))).alias("ps"))
    return g.select("ix", "iy", F.transform("ps", lambda p: F.struct(p["typ"].alias("typ"), p["hole"].alias("hole"), p["pts"].alias("pts"))).alias("polygons"))
