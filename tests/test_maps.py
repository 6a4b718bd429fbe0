"""Map jobs: hand-made cases, and helpers against plain restatements of their rules."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Row, functions as F

from mapjobs.components import connected_components
from mapjobs.functions import geom as G, tags as R, text as X
from mapjobs.operators import address, areas, graph, manifest, network, spatial, tiles
from mapjobs.sources import objects
from mapjobs.plans import registry


def values(spark, column, kind, items):
    d = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r.y for r in d.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def tagged(spark, rows, **columns):
    d = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, tags map<string,string>")
    return d.select("i", *[c.alias(n) for n, c in columns.items()]).orderBy("i").collect()


def test_road_class_and_flags(spark):
    t = R.of_map()
    rows = [{}, {"highway": "primary"}, {"highway": "proposed", "railway": "rail"}, {"railway": "light_rail"}, {"waterway": "canal"}, {"highway": "footway", "footway": "sidewalk"}, {"highway": "service", "service": "driveway"}, {"highway": "path", "area": "yes"}, {"highway": "motorway", "bridge": "yes", "tunnel": "no"}]
    got = tagged(spark, rows, cls=R.road_class(t), flags=R.display_flags(t))
    assert [r.cls for r in got] == [None, 2, None, 10, 11, None, None, None, 0]
    assert got[8].flags == 3


def test_speeds_and_costs(spark):
    t = R.of_map()
    rows = [{"highway": "cycleway"}, {"highway": "residential", "access": "private"}, {"highway": "residential", "access": "private", "bicycle": "yes"}, {"highway": "trunk"}, {"highway": "primary", "cycleway": "lane"}, {"highway": "steps", "bicycle": "dismount"}, {"highway": "track", "tracktype": "grade5", "surface": "mud", "smoothness": "bad"}, {"highway": "residential", "oneway": "yes"}]
    got = tagged(spark, rows, bike=R.bike_speed(t), foot=R.foot_speed(t), cost=R.edge_costs(R.travel(t), F.lit(100.0)))
    assert [None if r.bike is None else round(r.bike, 6) for r in got] == [20.0, None, 17.0, None, 12.0, 4.0, round(6 * 0.55 * 0.7, 6), 17.0]
    assert [None if r.foot is None else round(r.foot, 6) for r in got] == [4.2, None, None, None, 2.4, 3.0, round(4.6 * 0.8 * 0.85, 6), 5.0]
    assert got[7].cost == [round((100 / (17 / 3.6) + 0.5) * 10), None, 720, 720]
    assert tagged(spark, rows[:1], c=R.saturated(F.lit(None).cast("long")), d=R.saturated(F.lit(65535)))[0][1:] == (65535, 65534)


def test_text(spark):
    assert values(spark, X.fold, "string", ["Straße", "  Rue de l’Église ", "a-b_c/d", "", "\t", "Müller\tWeg", "x" * 30, "A234567890123456789012 BC"]) == ["STRASSE", "RUE DE LEGLISE", "A B C D", "", "", "MULLERWEG", "X" * 24, "A234567890123456789012 B"]
    assert values(spark, X.house_number, "string", ["23²", " 4 a ", "12345678", ""]) == ["23", "4a", "1234567", ""]
    assert values(spark, X.number_key, "string", ["12a3", "a", ""]) == [123, 0, 0]
    for s, cut in zip(["ä" * 40, "a" * 61, "short", ""], values(spark, lambda c: X.cut_bytes(c, 60), "string", ["ä" * 40, "a" * 61, "short", ""])):
        assert cut == s.encode()[:60].decode("utf-8", "ignore")
    assert values(spark, R.max_speed, "string", ["50", "30 mph", "none", "walk", "abc", None, " 80 ", "7.5"]) == [50.0, 30 * 1.609, 130.0, 7.0, None, None, 80.0, 7.5]


def test_inner_deltas(spark):
    r = random.Random(4)
    cases = []
    for _ in range(60):
        a = (r.randint(-900000000, 900000000), r.randint(-1800000000, 1800000000))
        pts, at = [], a
        for _ in range(r.randint(0, 6)):
            at = (at[0] + r.choice((5, 15, r.randint(-3000, 3000), r.randint(-900000, 900000))), at[1] + r.choice((-5, 25, r.randint(-900000, 900000))))
            pts.append(at)
        cases.append((a, pts))
    d = spark.createDataFrame([(i, *a, [Row(lat7=x, lon7=y) for x, y in p]) for i, (a, p) in enumerate(cases)], "i int, la long, lo long, pts array<struct<lat7:long,lon7:long>>")
    got = [r.x for r in d.select("i", G.inner_deltas(F.col("la"), F.col("lo"), F.col("pts")).alias("x")).orderBy("i").collect()]
    for (a, pts), found in zip(cases, got):
        stops, before = [], a
        for p in pts:
            n = int(max(abs((p[0] - before[0]) / 10), abs((p[1] - before[1]) / 10)) // 30000) + 1
            stops += [(before[0] + (p[0] - before[0]) * k // n, before[1] + (p[1] - before[1]) * k // n) for k in range(1, n + 1)]
            before = p
        want, c = [], a
        for s in stops:
            step = (round((s[0] - c[0]) / 10), round((s[1] - c[1]) / 10))
            want.append(step)
            c = (c[0] + step[0] * 10, c[1] + step[1] * 10)
        assert [tuple(x) for x in found] == want


def test_split_keeps_the_line(spark):
    lines = [(1, [(-300001, 0), (300001, 10)]), (2, [(10, 10), (20, 20)]), (3, [(10, 10), (310000, 10), (20, 10)]), (4, [(0, 0), (0, 500000)]), (5, [(5, 5), (5, 5)])]
    d = spark.createDataFrame([(i, [Row(seq=k, ref=k, lat7=y, lon7=x) for k, (x, y) in enumerate(p)]) for i, p in lines], "way_id int, pts array<struct<seq:int,ref:long,lat7:long,lon7:long>>")
    got = {}
    for r in tiles.split_lines(d).orderBy("way_id", "piece").collect():
        got.setdefault(r.way_id, []).append((r.ix, r.iy, [tuple(p) for p in r.pts]))
    assert [g[:2] for g in got[1]] == [(-2, 0), (-1, 0), (0, 0), (1, 0)] and [g[:2] for g in got[2]] == [(0, 0)]
    assert [g[:2] for g in got[3]] == [(0, 0), (1, 0), (0, 0)] and [g[1] for g in got[4]] == [0, 1, 2]
    assert got[4][0][2] == [(0, 0), (0, 65535)]


def ways_of(spark, lines, lat=490000000):
    rows = [(w, k, ref, lat + y, x) for w, pts in lines.items() for k, (ref, x, y) in enumerate(pts)]
    return spark.createDataFrame(rows, "way_id long, seq long, ref long, lat7 long, lon7 long")


def test_edges(spark):
    long_way = [(100 + i, i * 20000, 0) for i in range(9)]
    p = ways_of(spark, {1: [(1, 0, 0), (2, 1000, 0), (3, 2000, 0)], 2: [(2, 1000, 0), (9, 1000, 900)], 3: long_way, 4: [(5, 0, 0), (5, 0, 0)], 5: [(7, 0, 5000), (8, 500, 5000), (6, 500, 5500), (7, 0, 5000)]})
    refs = p.select("way_id", "seq", "ref")
    uses = {r.ref: (r.uses, r.is_break) for r in graph.breaks(refs).collect()}
    assert uses[2] == (2, True) and uses[1] == (1, True) and uses[8] == (1, False) and uses[5] == (2, True)
    tags = spark.createDataFrame([(i, {"highway": "residential"}) for i in range(1, 6)], "way_id long, tags map<string,string>")
    nodes = p.select(F.col("ref").alias("node_id"), "lat7", "lon7").distinct()
    e = graph.edges(refs, nodes, tags).orderBy("way_id", "edge_no", "piece").collect()
    by = {}
    for r in e:
        by.setdefault(r.way_id, []).append((r.a, r.b, len(r.pts)))
    assert by[1] == [(1, 2, 2), (2, 3, 2)] and by[2] == [(2, 9, 2)] and 4 not in by and by[5] == [(7, 7, 4)]
    step = 0.002 * G.M_LON * math.cos(math.radians(49))
    total, cuts = 8 * step, [0]
    n = math.ceil(total / 400)
    for k in range(1, n):
        i = min(max(math.ceil(total * k / n / step - 1e-9), cuts[-1] + 1), 7)
        if i > cuts[-1]:
            cuts.append(i)
    assert by[3] == [(100 + a, 100 + b, b - a + 1) for a, b in zip(cuts, [*cuts[1:], 8])]


def test_dense_ids_and_index(spark):
    d = spark.createDataFrame([(i, i % 7 - 3, i % 5 - 2) for i in range(200)], "k long, ix long, iy long")
    got = tiles.with_dense_ids(d, ["k"], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(200)) and [(r.ix, r.iy, r.k) for r in got] == sorted((r.ix, r.iy, r.k) for r in got)
    t = tiles.tile_counts(d).orderBy("ix", "iy").collect()
    assert all(a.first + a.n == b.first for a, b in zip(t, t[1:]))


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 6000 + i) for i in range(50)] + [(9, 9)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {x.node: x.root for x in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def grid_arcs(spark, side, seed):
    r = random.Random(seed)
    arcs = []
    for x in range(side):
        for y in range(side):
            for nx, ny in ((x + 1, y), (x, y + 1)):
                if nx < side and ny < side:
                    a, b = x * side + y, nx * side + ny
                    arcs += [(a, b, r.randint(1, 50))] if r.random() < 0.9 else []
                    arcs += [(b, a, r.randint(1, 50))] if r.random() < 0.9 else []
    return arcs, spark.createDataFrame(arcs, "from long, to long, w long")


def test_shortest_paths_and_hierarchy(spark):
    import heapq

    arcs, d = grid_arcs(spark, 6, 1)
    out = {}
    for a, b, w in arcs:
        out.setdefault(a, []).append((b, w))

    def plain(s):
        best, todo = {}, [(0, s)]
        while todo:
            c, v = heapq.heappop(todo)
            if v not in best:
                best[v] = c
                for u, w in out.get(v, ()):
                    heapq.heappush(todo, (c + w, u))
        return best
    pairs = [(i, i * 7 % 36, i * 11 % 36) for i in range(20)] + [(20, 3, 3), (21, 0, 999)]
    p = spark.createDataFrame(pairs, "pair_id long, s long, t long")
    want = {i: plain(s).get(t) for i, s, t in pairs}
    assert {r.pair_id: r.cost for r in network.shortest_paths(d, p).collect()} == want
    every, order = network.hierarchy(d, core=8, rounds=6)
    found = network.hierarchy_query(*network.split_by_rank(every, order), p)
    assert {r.pair_id: r.cost for r in found.where("t <> 999").collect()} == {i: c for i, c in want.items() if i != 21}


def test_main_mask(spark):
    rows = [(1, i, 0, i, i + 1, [5, None, None, None]) for i in range(12)] + [(2, 0, 0, 100, 101, [5, 5, 7, 7])]
    e = spark.createDataFrame(rows, "way_id long, edge_no int, piece int, a long, b long, cost array<long>")
    got = network.main_mask(e, least_nodes=5).collect()
    assert {(r.way_id, r.main_mask) for r in got} == {(1, 1), (2, 0)}


def test_simplify_and_clip():
    r = random.Random(1)

    def plain(pts, eps):
        if len(pts) < 3:
            return pts
        (ax, ay), (bx, by) = pts[0], pts[-1]
        best, at = -1.0, 0
        for i, (px, py) in enumerate(pts[1:-1], 1):
            size = (bx - ax) ** 2 + (by - ay) ** 2
            t = min(1, max(0, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / size)) if size else 0
            d = (ax + t * (bx - ax) - px) ** 2 + (ay + t * (by - ay) - py) ** 2
            if d > best:
                best, at = d, i
        return plain(pts[:at + 1], eps)[:-1] + plain(pts[at:], eps) if best > eps * eps else [pts[0], pts[-1]]
    for _ in range(100):
        pts = [(r.randint(0, 50), r.randint(0, 50)) for _ in range(r.randint(2, 25))]
        x, y = np.array(pts, float).T
        assert [pts[i] for i in areas.simplify(x, y, 5.0)] == plain(pts, 5.0)
    size = lambda p: abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, np.roll(p, -1, axis=0)))) / 2
    octagon = np.array([(10 + 9 * math.cos(k * math.pi / 4), 10 + 9 * math.sin(k * math.pi / 4)) for k in range(8)])
    parts = 0.0
    for x in (0, 10):
        for y in (0, 10):
            q = octagon
            for axis, at, above in ((0, x, True), (0, x + 10, False), (1, y, True), (1, y + 10, False)):
                q = areas.clip_half(q, axis, at, above)
            parts += size(q)
    assert math.isclose(parts, size(octagon))


def test_point_in_polygon(spark):
    square = [(0, 0), (0, 450000), (450000, 450000), (450000, 0)]
    rings = spark.createDataFrame([(1, 0, k, y, x) for k, (x, y) in enumerate(square)], "poly long, ring int, seq int, lat7 long, lon7 long")
    points = spark.createDataFrame([(1, 10, 10), (2, 440000, 300000), (3, 500000, 10), (4, -5, 10)], "pid long, lat7 long, lon7 long")
    assert {r.pid for r in spatial.points_in_polygons(points, spatial.ring_edges(rings)).collect()} == {1, 2}


def test_near_is_complete(spark):
    r = random.Random(6)
    spot = lambda: (r.randint(600000000, 601500000), r.randint(-1500000, 1500000))
    q, o = [(i, *spot()) for i in range(80)], [(i, *spot()) for i in range(80)]
    got = spatial.near(spark.createDataFrame(q, "q long, lat7 long, lon7 long"), spark.createDataFrame(o, "o long, olat7 long, olon7 long"), 0.03)
    want = {(a, b) for a, la, lo in q for b, pa, po in o if ((pa - la) / 1e7) ** 2 + ((po - lo) / 1e7 * math.cos(math.radians(la / 1e7))) ** 2 <= 0.03**2}
    assert {(x.q, x.o) for x in got.collect()} == want


def test_house_number_ties_and_doubles(spark):
    s = spark.createDataFrame([(5, "A", [Row(lat7=0, lon7=0)]), (6, "A", [Row(lat7=0, lon7=2000)])], "street_id long, fold string, samples array<struct<lat7:long,lon7:long>>")
    a = spark.createDataFrame([(1, "a", "7 B", 0, 1000), (2, "A", "7b", 0, 100), (3, "a", "²", 0, 0), (4, "a", "9", 900000, 0), (5, "b", "1", 0, 0)], "obj_id long, street string, hn string, lat7 long, lon7 long")
    assert [tuple(r) for r in address.house_numbers(a, s).collect()] == [(5, "7B", 0, 1000)]


def test_manifest(spark, tmp_path):
    for side in ("a", "b"):
        (tmp_path / side / "sub").mkdir(parents=True)
    for name, left, right in (("same", b"1", b"1"), ("sub/size", b"1", b"12"), ("content", b"1", b"2"), ("gone", b"1", None), ("more", None, b"1")):
        for side, data in (("a", left), ("b", right)):
            if data is not None:
                (tmp_path / side / name).write_bytes(data)
    a, b = (manifest.read_manifest(spark, str(tmp_path / s)) for s in ("a", "b"))
    got = manifest.compare(a, b)
    assert {r.path: r.status for r in got.collect()} == {"same": "ok", "sub/size": "wrong size", "content": "wrong content", "gone": "missing", "more": "extra"}
    assert {r.path for r in manifest.to_repair(got).collect()} == {"sub/size", "content", "gone"}
    assert [r.path for r in manifest.extra(a, b).collect()] == ["more"] and manifest.report(got, 1).count() == 5


def test_merge_and_stitch(spark):
    one = spark.createDataFrame([("n", 1, 1), ("n", 2, 3)], "type string, id long, version int")
    two = spark.createDataFrame([("n", 1, 2), ("w", 1, 1), ("n", 2, 3)], "type string, id long, version int")
    assert sorted(map(tuple, objects.merged([one, two], ["type", "id"]).collect())) == [("n", 1, 2), ("n", 2, 3), ("w", 1, 1)]
    m = spark.createDataFrame([(1, 0, "outer", [1, 2, 3]), (1, 1, "outer", [5, 4, 3]), (1, 2, "outer", [5, 1]), (1, 3, "inner", [8, 9, 10, 8]), (2, 0, "outer", [1, 2, 3])], "area_id long, seq int, role string, refs array<long>")
    assert sorted((r.area_id, r.role, sorted(r.refs)) for r in areas.stitched(m).collect()) == [(1, "inner", [8, 9, 10]), (1, "outer", [1, 2, 3, 4, 5])]


def test_packed_tiles():
    import struct

    data = tiles.pack_road_tile([{"cls": 2, "flags": 1, "name_idx": 0, "pts": [{"x": 1, "y": 65535}]}, {"cls": 0, "flags": 0, "name_idx": None, "pts": []}], ["é"])
    assert struct.unpack_from("<BBHH", data) == (77, 1, 2, 1) and struct.unpack_from("<BBHHHH", data, 6) == (2, 1, 0, 1, 1, 65535) and data[-3:] == b"\x02\xc3\xa9"
    assert struct.unpack_from("<BBHH", data, 16) == (0, 0, 65535, 0)
    pak = tiles.pack_bundle([b"ab", None, b"c", None])
    assert pak[:4] == b"PAK1" and struct.unpack_from("<8I", pak, 8) == (40, 2, 0, 0, 42, 1, 0, 0) and pak[40:] == b"abc"
    with pytest.raises(ValueError):
        tiles.pack_area_tile([None] * 70000)


def test_every_sql_has_its_query():
    assert set(registry.oracle_sql()) <= set(registry.queries()) and len(registry.queries()) > 55


def test_far_pairs_and_both_profiles(spark, monkeypatch):
    from mapjobs.plans import area_plans

    rows = [(1, 0, 0, 1, 2, [9000, 9000, 15000, 15000]), (1, 1, 0, 2, 3, [9000, 9000, 15000, 15000]), (2, 0, 0, 4, 5, [7, None, None, None]), (3, 0, 0, 3, 1, [40000, 40000, 5, None])]
    e = spark.createDataFrame(rows, "way_id long, edge_no int, piece int, a long, b long, cost array<int>")
    monkeypatch.setattr(area_plans.GP, "_edges", lambda spark, sf_dir: e)
    far = 10**9
    for p, nodes in ((0, (1, 2, 3, 4)), (1, (1, 2, 3))):
        d = {(a, b): 0 if a == b else far for a in range(1, 6) for b in range(1, 6)}
        for _, _, _, a, b, c in rows:
            d[a, b], d[b, a] = min(d[a, b], c[2 * p] or far), min(d[b, a], c[2 * p + 1] or far)
        for k in range(1, 6):
            for a, b in d:
                d[a, b] = min(d[a, b], d[a, k] + d[k, b])
        got = [r for r in area_plans.h2_shortest_paths(spark, "").collect() if r.profile == p]
        assert sorted(r.s for r in got) == sorted(r.t for r in got) == list(nodes)
        assert all((far if r.cost is None else r.cost) == d[r.s, r.t] for r in got)
    counts = {r.status: r.n for r in area_plans.h3_h4_h5_h6_hierarchy(spark, "").collect()}
    assert set(counts) <= {"ok", "unreachable"} and sum(counts.values()) == 7


def test_costs_must_settle(spark):
    arcs = spark.createDataFrame([(i, i + 1, 1) for i in range(9)], "from long, to long, w long")
    s = spark.createDataFrame([(0,)], "source long")
    assert {r.node: r.d for r in network.distances(arcs, s).collect()} == {i: i for i in range(10)}
    assert {r.node for r in network.distances(arcs, s, hops=1, limit=3).collect()} == {0, 1, 2, 3}
    with pytest.raises(RuntimeError):
        network.distances(arcs, s, hops=1, most_rounds=4)


def polygon_area(p):
    x, y = np.asarray(p, float).T
    return abs((x * np.roll(y, 1) - y * np.roll(x, 1)).sum()) / 2


def test_areas_from_ways_and_relations(spark):
    at = {i: (i * 10, 0) for i in range(100)}
    square = lambda first, y, x, size: {first: (y, x), first + 1: (y, x + size), first + 2: (y + size, x + size), first + 3: (y + size, x)}
    pos = square(0, 0, 0, 100_000) | square(10, 20_000, 20_000, 10_000) | square(20, 500_000, 500_000, 200_000) | square(30, 550_000, 550_000, 1000) | square(40, 900_000, 0, 10) | square(50, 510_000, 510_000, 100_000)
    nodes = spark.createDataFrame([(i, *p) for i, p in pos.items()], "node_id long, lat7 long, lon7 long")
    ways = [(1, [0, 1, 2, 3, 0], {"landuse": "forest"}), (2, [0, 1, 2, 3, 0], {"area": "no", "leisure": "park"}), (3, [0, 1, 2], {"natural": "water"}), (4, [0, 1, 0], {"natural": "water"}),
            (11, [0, 1, 2], {}), (12, [0, 3, 2], {}), (13, [10, 11, 12, 13, 10], {}), (14, [20, 21, 22, 23, 20], {}), (15, [33, 32, 31, 30, 33], {}), (16, [40, 41, 42, 43, 40], {}), (17, [50, 51, 52, 53, 50], {})]
    m = lambda *x: [Row(type="way", ref=r, role=role) for r, role in x]
    relations = [(7, m((11, "outer"), (13, "inner"), (16, "inner"), (12, ""), (14, "outer"), (15, "inner"), (17, "outer")), {"type": "multipolygon", "natural": "water"}), (8, m((14, "outer")), {"type": "route"})]
    w = spark.createDataFrame(ways, "way_id long, refs array<long>, tags map<string,string>")
    r = spark.createDataFrame(relations, "rel_id long, members array<struct<type:string,ref:long,role:string>>, tags map<string,string>")
    rings = areas.located_rings(areas.assembled(w, r), nodes)
    got = areas.with_outer(rings).collect()
    by = {}
    for x in got:
        by.setdefault(x.area_id, []).append(x)
    assert set(by) == {2, 15, 26, 28, 30, 32, 34} and len(by[2]) == 1  # way 2 is no area, ways 3 and 4 are none
    corner = lambda x: min((p.lat7, p.lon7) for p in x.pts)
    name = {x.ring: corner(x) for x in by[15]}
    assert sorted(corner(x) for x in by[15] if x.role == "outer") == [(0, 0), (500_000, 500_000), (510_000, 510_000)]
    holes = {corner(x): name[x.outer] for x in by[15] if x.role == "inner"}
    assert holes == {(20_000, 20_000): (0, 0), (550_000, 550_000): (510_000, 510_000)}  # the smaller of two; the third hole lies in none


def test_stitching_is_linear(spark):
    n = 20_000
    rows = [(1, i, "outer", [i, (i + 1) % n] if i % 2 else [(i + 1) % n, i]) for i in range(n)]
    random.Random(1).shuffle(rows)
    d = spark.createDataFrame([(a, k, b, c) for k, (a, _, b, c) in enumerate(rows)], "area_id long, seq int, role string, refs array<long>")
    assert [len(r.refs) for r in areas.stitched(d).collect()] == [n]


def test_clipping_by_halves():
    r = np.random.default_rng(3)
    angle = np.sort(r.uniform(0, 2 * math.pi, 400))
    radius = r.uniform(0.3, 1.0, 400)
    p = np.stack([np.cos(angle) * radius * 9_000_000 - 100_000, np.sin(angle) * radius * 5_000_000 + 50_000], 1).round()
    got = {(ix, iy): q for ix, iy, q in areas.tiles_of(p)}
    assert len(got) > 1000 and math.isclose(sum(map(polygon_area, got.values())), polygon_area(p), rel_tol=1e-9)
    for ix, iy in [*got][::37]:
        x, y, q = ix * G.TILE_LON7, iy * G.TILE_LAT7, p
        for axis, at, above in ((0, x, True), (0, x + G.TILE_LON7, False), (1, y, True), (1, y + G.TILE_LAT7, False)):
            q = areas.clip_half(q, axis, at, above)
        assert math.isclose(polygon_area(q), polygon_area(got[ix, iy]), rel_tol=1e-6, abs_tol=1.0)


def test_holes_and_buildings(spark):
    ring = lambda y, x, size: [Row(seq=k, lat7=y + a * size, lon7=x + b * size) for k, (a, b) in enumerate(((0, 0), (0, 1), (1, 1), (1, 0)))]
    rows = [(1, 0, "outer", 0, 2, ring(0, 0, 150_000)), (1, 1, "inner", 0, 2, ring(20_000, 20_000, 50_000)), (2, 0, "outer", 0, 2, ring(0, 0, 10)), (2, 1, "inner", 0, 2, ring(0, 0, 90_000)), (3, 0, "outer", 0, 4, ring(0, 0, 5000)), (3, 1, "inner", 0, 4, ring(1000, 1000, 1000))]
    d = spark.createDataFrame(rows, "area_id long, ring int, role string, outer int, typ int, pts array<struct<seq:int,lat7:long,lon7:long>>")
    of = lambda x: sorted((r.area_id, r.ring, r.hole) for r in x.collect())
    assert of(areas.drawn(d)) == [(1, 0, 0), (1, 1, 1)]  # the tiny outer ring takes its large hole along
    both = areas.drawn(d, buildings=True)
    assert of(both) == [(1, 0, 0), (1, 1, 1), (3, 0, 0)]
    p = areas.clipped(both)
    (a,), (b,) = areas.area_tiles(p).collect(), areas.area_tiles(p, True).collect()
    assert [(x.typ, x.hole) for x in a.polygons] == [(2, 0), (2, 1)] and [(x.typ, x.hole) for x in b.polygons] == [(4, 0)]
    assert tiles.pack_area_tile(b.polygons, building=True)[:4] == b"B\x01\x01\x00"


def test_points_in_odd_polygons(spark):
    r = random.Random(5)
    polys = []
    for k in range(12):
        cx, cy, n = r.randint(-2_000_000, 2_000_000), r.randint(-1_000_000, 1_000_000), r.randint(3, 40)
        size = r.choice((30_000, 300_000, 3_000_000))
        polys.append([(cx + int(math.cos(a) * size * q), cy + int(math.sin(a) * size * q)) for a, q in zip(sorted(r.uniform(0, 6.283) for _ in range(n)), (r.uniform(0.2, 1) for _ in range(n)))])
    polys.append([(0, 0), (600_000, 0), (600_000, 400_000), (0, 400_000)])  # along grid lines
    points = [(r.randint(-3_000_000, 3_000_000), r.randint(-2_000_000, 2_000_000)) for _ in range(600)] + [p for q in polys for p in q] + [(300_000 * i, 200_000 * j) for i in range(-3, 4) for j in range(-3, 4)]
    rings = spark.createDataFrame([(k, 0, i, y, x) for k, q in enumerate(polys) for i, (x, y) in enumerate(q)], "poly int, ring int, seq int, lat7 long, lon7 long")
    d = spark.createDataFrame([(i, y, x) for i, (x, y) in enumerate(points)], "pid int, lat7 long, lon7 long")

    def inside(x, y, q):
        odd = False
        for (x0, y0), (x1, y1) in zip(q, [q[-1], *q]):
            if (y0 > y) != (y1 > y) and x < (x1 - x0) * (y - y0) / (y1 - y0) + x0:
                odd = not odd
        return odd
    want = {(i, k) for i, (x, y) in enumerate(points) for k, q in enumerate(polys) if inside(x, y, q)}
    assert {(r.pid, r.poly) for r in spatial.points_in_polygons(d, spatial.ring_edges(rings)).collect()} == want


def test_running_sums(spark):
    r = random.Random(6)
    rows = [(i, r.choice("abcdefgh") * r.randint(1, 3), r.randint(0, 9)) for i in range(500)]
    d = spark.createDataFrame(rows, "i int, k string, v long").withColumn("one", F.lit(1)).repartition(7)
    got = {x.i: (x.pos, x.before) for x in address.running_before(d, ["k", "i"], {"pos": "one", "before": "v"}).collect()}
    total = 0
    for pos, (i, _, v) in enumerate(sorted(rows, key=lambda x: (x[1], x[0]))):
        assert got[i] == (pos, total)
        total += v


def test_routing_tiles(spark):
    import struct

    from mapjobs.operators import routing_tiles

    p = lambda *x: [Row(lat7=a, lon7=b) for a, b in x]
    rows = [(1, 0, 0, 10, 11, 123.44, p((100, 100), (5000, 5000), (100, 9000)), 3, 1, "High Street", [50, None, 70, 70], 3), (1, 1, 0, 11, 12, 7000.0, p((100, 9000), (100, 400_000)), 3, 0, None, [70_000, 70_000, None, None], 1), (2, 0, 0, 12, 10, 10.0, p((100, 400_000), (100, 100)), 5, 2, "High Street", [1, 1, 1, 1], 3)]
    e = spark.createDataFrame(rows, "way_id long, edge_no int, piece int, a long, b long, length double, pts array<struct<lat7:long,lon7:long>>, cls int, flags int, name string, cost array<long>, main_mask int")
    nodes, edges = routing_tiles.numbered(e)
    ids = {r.node_id: r.new_id for r in nodes.collect()}
    assert ids == {10: 0, 11: 1, 12: 2}
    packed = {(r.ix, r.iy): r.data for r in tiles.with_bytes(routing_tiles.geometry_tiles(nodes, edges), routing_tiles.pack_geometry_tile, "nodes", "edges", "strings").collect()}
    assert set(packed) == {(0, 0), (1, 0)}
    b = packed[0, 0]
    magic, version, n, m, names, strings = struct.unpack_from("<BBHHHI", b)
    assert (chr(magic), version, n, m, names) == ("G", 1, 2, 2, 1)
    assert [struct.unpack_from("<iiB3x", b, 12 + 12 * i) for i in range(2)] == [(100, 100, 2), (100, 9000, 2)]
    first = struct.unpack_from("<IIiiiiHBBBBHH4H", b, 36)
    assert first == (0, 1, 100, 100, 100, 9000, 1234, 3, 1, 1, 3, 0, 0, 50, 65535, 70, 70)
    second = struct.unpack_from("<IIiiiiHBBBBHH4H", b, 36 + 42)
    assert second[6:] == (65535, 3, 0, second[9], 1, 65535, 1, 65534, 65534, 65535, 65535)
    assert struct.unpack_from("<hh", b, 36 + 84) == (490, 490) and b[strings:] == struct.pack("<H", 0) + bytes([11]) + b"High Street"
    # the hierarchy: arcs 10 -> 11 -> 12 on foot-like costs, 11 contracted first
    arcs = spark.createDataFrame([(10, 11, 5, None), (11, 12, 6, None), (10, 12, 11, 11)], "from long, to long, w long, mid long")
    ranks = spark.createDataFrame([(11, 0), (10, 1), (12, 2)], "node long, turn int")
    via = routing_tiles.arcs_with_via(arcs, nodes, edges.withColumn("costs", F.array(F.lit(5).cast("long"), F.lit(None).cast("long"))))
    up, down = routing_tiles.sides(via, ranks)
    got = {}
    for r in tiles.with_bytes(routing_tiles.hierarchy_tiles(nodes, up, down), routing_tiles.pack_hierarchy_tile, "nodes").collect():
        magic, version, n, _ = struct.unpack_from("<BBHH", r.data)
        at = struct.unpack_from(f"<{n + 1}I", r.data, 6)
        assert chr(magic) == "C" and at[-1] == len(r.data)
        for i in range(n):
            out, into = struct.unpack_from("<HH", r.data, at[i])
            got[(r.ix, i)] = [[struct.unpack_from("<III", r.data, at[i] + 4 + 12 * k) for k in range(a, z)] for a, z in ((0, out), (out, out + into))]
    original = routing_tiles.ORIGINAL
    assert got[0, 0] == [[(2, 11, 1)], []] and got[1, 0] == [[], []]  # 10: the shortcut over 11
    assert got[0, 1] == [[(2, 6, original + 2 * 1)], [(0, 5, original + 0)]]


def test_address_objects(spark):
    nodes = spark.createDataFrame([(1, 10, 20, {"addr:housenumber": "4", "addr:street": "A"}), (2, 10, 20, {"addr:housenumber": "5"}), (3, 1, 1, {})], "node_id long, lat7 long, lon7 long, tags map<string,string>")
    ways = spark.createDataFrame([(1, {"addr:housenumber": "6", "addr:street": "B", "building": "yes"}), (2, {"addr:street": "B"})], "way_id long, tags map<string,string>")
    points = spark.createDataFrame([(1, 0, 0, 0), (1, 1, 0, 30), (1, 2, 30, 30), (1, 3, 0, 0), (2, 0, 5, 5)], "way_id long, seq int, lat7 long, lon7 long")
    got = sorted((r.obj_id.type, r.obj_id.id, r.street, r.hn, r.lat7, r.lon7) for r in address.address_objects(nodes, ways, points).collect())
    assert got == [(0, 1, "A", "4", 10.0, 20.0), (1, 1, "B", "6", 7.5, 15.0)]
    streets = spark.createDataFrame([(9, "B", [Row(lat7=0, lon7=0)])], "street_id long, fold string, samples array<struct<lat7:long,lon7:long>>")
    assert [tuple(r) for r in address.house_numbers(address.address_objects(nodes, ways, points), streets).collect()] == [(9, "6", 8, 15)]
