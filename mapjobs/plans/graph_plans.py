"""Queries of the road graph and of tiles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from mapjobs import jobs
from mapjobs.functions import geom as G, tags as R
from mapjobs.operators import address, graph, tiles
from mapjobs.plans import tag_plans as P
from mapjobs.session import shared_dir
from mapjobs.sources import objects, standins

WN = standins.oracle("way_nodes")
BOTH = standins.oracle("way_nodes", "ways_flat")
SHAPES = standins.oracle("way_nodes", "ways_flat", "shape_nodes")


def _refs(spark, sf_dir):
    return standins.view(spark, sf_dir, "way_nodes").select("way_id", "seq", "ref")


def _nodes(spark, sf_dir):
    n = standins.view(spark, sf_dir, "way_nodes").groupBy(F.col("ref").alias("node_id")).agg(F.min("lat7").alias("lat7"), F.min("lon7").alias("lon7"))
    return n


def _edges(spark, sf_dir):
    return graph.edges(_refs(spark, sf_dir), _nodes(spark, sf_dir), standins.ways(spark, sf_dir))


def _text(pts, a="x", b="y"):
    return F.array_join(F.transform(pts, lambda p: F.concat_ws(",", p[a].cast("string"), p[b].cast("string"))), ";")


def s3_j1_located_ways(spark, sf_dir):
    """Nodes whose id is a multiple of 7 have no position."""
    nodes = _nodes(spark, sf_dir).where("node_id % 7 <> 0")
    ways = _refs(spark, sf_dir).groupBy("way_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "ref"))), lambda x: x["ref"]).alias("refs"))
    lines = objects.as_lines(objects.located(objects.way_refs(ways), nodes))
    return lines.select("way_id", F.size("pts").alias("n"), _text("pts", "lat7", "lon7").alias("line"))


def a1_u1_breaks(spark, sf_dir):
    return graph.breaks(_refs(spark, sf_dir))


def g1_tile_keys(spark, sf_dir):
    n = _nodes(spark, sf_dir).withColumn("ix", G.tile_x(F.col("lon7"))).withColumn("iy", G.tile_y(F.col("lat7")))
    return n.select("node_id", "ix", "iy", G.bundle(F.col("ix")).alias("bx"), G.bundle(F.col("iy")).alias("by"), G.slot(F.col("ix"), F.col("iy")).alias("slot"))


def g2_lengths(spark, sf_dir):
    p = graph.measured(standins.view(spark, sf_dir, "way_nodes"))
    return p.select("way_id", "seq", F.rint(F.col("seg") * 1000).cast("long").alias("seg_mm"), F.rint(F.col("cum") * 1000).cast("long").alias("cum_mm"))


def w1_w3_p17_p18_edges(spark, sf_dir):
    e = _edges(spark, sf_dir)
    return e.select("way_id", "edge_no", "piece", "a", "b", F.rint(F.col("length") * 1000).cast("long").alias("length_mm"), F.size("pts").alias("n"), "cls", "flags", "name", *[F.col("cost")[i].alias(f"c{i}") for i in range(4)])


def u2_a4_degrees(spark, sf_dir):
    return graph.used_nodes(_edges(spark, sf_dir))


def a8_s6_usage(spark, sf_dir):
    return graph.usage(_edges(spark, sf_dir))


def p19_saturated(spark, sf_dir):
    e = _edges(spark, sf_dir)
    return e.select("way_id", "edge_no", "piece", *[R.saturated(F.col("cost")[i] * 20).alias(f"c{i}") for i in range(4)], F.least(F.rint(F.col("length") * 10), F.lit(65535.0)).cast("int").alias("dm"))


def g3_g4_split(spark, sf_dir):
    lines = objects.as_lines(standins.view(spark, sf_dir, "way_nodes"))
    s = tiles.split_lines(lines)
    return s.select("way_id", "piece", "ix", "iy", _text("pts").alias("line"))


def _roads(spark, sf_dir):
    return jobs.road_layer(objects.as_lines(standins.view(spark, sf_dir, "shape_nodes")), standins.ways(spark, sf_dir))


def tile_rows(t):
    """Road tiles as text: class, flags, name's number and number of points of each way; names."""
    row = F.transform("ways", lambda w: F.concat_ws(":", w["cls"].cast("string"), w["flags"].cast("string"), F.coalesce(w["name_idx"], F.lit(65535)).cast("string"), F.size(w["pts"]).cast("string")))
    return t.select("ix", "iy", F.array_join(row, ";").alias("ways"), F.array_join("strings", "|").alias("strings"))


def t1_w6_b1_road_tiles(spark, sf_dir):
    """The flagship: simplified road pieces by tile, in drawing order, with the tile's names."""
    return tile_rows(_roads(spark, sf_dir).tiles)


def w6_string_tables(spark, sf_dir):
    return tiles.string_table(_roads(spark, sf_dir).features, [F.col("cls").desc(), F.col("way_id"), F.col("piece")])


def _tiled(spark, sf_dir):
    return _nodes(spark, sf_dir).withColumn("ix", G.tile_x(F.col("lon7"))).withColumn("iy", G.tile_y(F.col("lat7")))


def w2_dense_ids(spark, sf_dir):
    return tiles.with_dense_ids(_tiled(spark, sf_dir), ["node_id"], "new_id").select("node_id", "new_id")


def a9_b5_tile_index(spark, sf_dir):
    return tiles.tile_counts(_tiled(spark, sf_dir))


def w4_sparse_index(spark, sf_dir):
    return tiles.sparse_index(tiles.tile_counts(_tiled(spark, sf_dir)), 64)


def a7_size_statistics(spark, sf_dir):
    c = tiles.tile_counts(_tiled(spark, sf_dir)).withColumn("layer", F.concat(F.lit("c"), F.pmod("ix", F.lit(3)))).withColumnRenamed("n", "size")
    return tiles.size_statistics(c, "layer", "size")


def w8_b6_bundles(spark, sf_dir):
    c = tiles.tile_counts(_tiled(spark, sf_dir)).select(F.lit("m").alias("layer"), "ix", "iy", F.col("n").alias("size"))
    d = tiles.bundle_directory(c)
    return d.select("layer", "bx", "by", _text("slots", "at", "size").alias("slots"))


def b1_b6_road_bundles(spark, sf_dir):
    packed = tiles.with_bytes(_roads(spark, sf_dir).tiles, tiles.pack_road_tile, "ways", "strings")
    return tiles.bundles(packed, "m").select("layer", "bx", "by", F.length("data").alias("size"), F.md5("data").alias("md5"))


BBOX = (490200000, -1500000, 492000000, 500000)


def p10_boxes(spark, sf_dir):
    """Ways by their box, and by their first point."""
    n = standins.view(spark, sf_dir, "way_nodes")
    b = n.groupBy("way_id").agg(F.min("lat7").alias("s"), F.min("lon7").alias("w"), F.max("lat7").alias("n"), F.max("lon7").alias("e"), F.min_by(F.struct("lat7", "lon7"), "seq").alias("p"))
    return b.select("way_id", G.box_misses(F.col("s"), F.col("w"), F.col("n"), F.col("e"), BBOX).alias("outside"), G.point_in_box(F.col("p.lat7"), F.col("p.lon7"), BBOX).alias("inside"))


def s6_g11_region(spark, sf_dir):
    return _roads(spark, sf_dir).summary


def s5_layers(spark, sf_dir):
    """Bundles written by layer and column, and read back."""
    packed = tiles.with_bytes(_roads(spark, sf_dir).tiles, tiles.pack_road_tile, "ways", "strings")
    path = f"{shared_dir(spark)}/layers-{uuid.uuid4().hex}"
    tiles.write_layers(tiles.bundles(packed, "m"), path)
    return spark.read.parquet(path).select("layer", F.col("bx").cast("long").alias("bx"), "by")


def g9_inner_deltas(spark, sf_dir):
    lines = objects.as_lines(standins.view(spark, sf_dir, "way_nodes"), 3)
    a = F.col("pts")[0]
    return lines.select("way_id", _text(G.inner_deltas(a["lat7"], a["lon7"], F.slice("pts", 2, F.size("pts") - 2), 12), "dlat", "dlon").alias("deltas"))


def g10_midpoints(spark, sf_dir):
    lines = objects.as_lines(standins.view(spark, sf_dir, "way_nodes")).withColumn("name", F.lit(""))
    return address.street_ways(lines, samples=3).select("way_id", "lat7", "lon7", _text("samples", "lat7", "lon7").alias("samples"))


_SEG = "hypot((lon7 - lag(lon7) OVER w) / 1e7 * 111320.0 * cos(radians(first_value(lat7) OVER w / 1e7)), (lat7 - lag(lat7) OVER w) / 1e7 * 110574.0)"
_SEG = _SEG.replace("hypot(", "sqrt(pow(").replace(", (lat7 - lag", ", 2) + pow((lat7 - lag") .replace("110574.0)", "110574.0, 2))")
_CUM = f"""m AS (SELECT *, coalesce({_SEG}, 0.0) AS seg FROM pts WINDOW w AS (PARTITION BY way_id ORDER BY seq)),
  c AS (SELECT *, sum(seg) OVER (PARTITION BY way_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS cum FROM m)"""
_BREAKS = """br AS (SELECT ref, count(*) AS uses, count(*) >= 2 OR max(CASE WHEN seq = 0 OR seq = last THEN 1 ELSE 0 END) = 1 AS is_break
  FROM (SELECT ref, seq, max(seq) OVER (PARTITION BY way_id) AS last FROM {src}) x GROUP BY ref)"""
_TILED = "n AS (SELECT DISTINCT ref AS node_id, cast(floor(lon7 / 300000.0) AS BIGINT) AS ix, cast(floor(lat7 / 200000.0) AS BIGINT) AS iy FROM way_nodes)"
_EDGES = f"""{BOTH}, ok AS (SELECT * FROM ways_flat WHERE {P.ROUTABLE_SQL}),
  src AS (SELECT n.* FROM way_nodes n JOIN ok USING (way_id)), {_BREAKS.format(src='src')},
  pts AS (SELECT src.*, br.is_break FROM src JOIN br USING (ref)), {_CUM},
  k AS (SELECT way_id, seq, ref, cum, row_number() OVER (PARTITION BY way_id ORDER BY seq) - 1 AS edge_no, lead(seq) OVER w AS seq2, lead(ref) OVER w AS ref2, lead(cum) OVER w AS cum2 FROM c WHERE is_break WINDOW w AS (PARTITION BY way_id ORDER BY seq)),
  e AS (SELECT *, cum2 - cum AS total, CASE WHEN cum2 - cum > 500 AND seq2 - seq >= 2 THEN ceil((cum2 - cum) / 400)::INTEGER ELSE 1 END AS pieces FROM k WHERE seq2 IS NOT NULL AND (cum2 - cum > 0 OR ref <> ref2)),
  j AS (SELECT e.way_id, e.edge_no, u.j, any_value(e.seq2 - e.seq) AS last, count(*) FILTER (WHERE c.cum < e.total * u.j / e.pieces - 1e-6) AS g
        FROM e, unnest(range(1, e.pieces)) AS u(j), c WHERE c.way_id = e.way_id AND c.seq BETWEEN e.seq AND e.seq2 GROUP BY ALL),
  q AS (SELECT way_id, edge_no, least(j + max(g - j) OVER (PARTITION BY way_id, edge_no ORDER BY j), last - 1) AS cut FROM (SELECT way_id, edge_no, j, last, greatest(g, j) AS g FROM j) z),
  cuts AS (SELECT way_id, edge_no, 0 AS cut FROM e UNION SELECT way_id, edge_no, cut FROM q UNION SELECT way_id, edge_no, seq2 - seq FROM e),
  pc AS (SELECT way_id, edge_no, row_number() OVER w - 1 AS piece, cut, lead(cut) OVER w AS cut2 FROM cuts WINDOW w AS (PARTITION BY way_id, edge_no ORDER BY cut)),
  g AS (SELECT pc.way_id, pc.edge_no::INTEGER AS edge_no, pc.piece::INTEGER AS piece, a.ref AS a, b.ref AS b, b.cum - a.cum AS length, (b.seq - a.seq + 1)::INTEGER AS n
        FROM pc JOIN e ON e.way_id = pc.way_id AND e.edge_no = pc.edge_no JOIN c a ON a.way_id = pc.way_id AND a.seq = e.seq + pc.cut JOIN c b ON b.way_id = pc.way_id AND b.seq = e.seq + pc.cut2 WHERE pc.cut2 IS NOT NULL),
  s AS (SELECT *, {P.BIKE_SQL} AS v_bike, {P.FOOT_SQL} AS v_foot, {P.FWD_SQL} AS fwd, {P.BWD_SQL} AS bwd, {P.CONTRA_SQL} AS contra, {P._CASES('highway', P.R.CLASSES.items())} AS cls, {P.EDGE_FLAGS_SQL} AS flags, coalesce(nullif(name, ''), nullif(ref, '')) AS label FROM ok),
  x AS (SELECT g.*, s.cls, s.flags, s.label AS name, CASE WHEN fwd OR contra THEN round_even((length / (v_bike / 3.6) + 0.5) * 10, 0)::BIGINT END AS c0, CASE WHEN bwd OR contra THEN round_even((length / (v_bike / 3.6) + 0.5) * 10, 0)::BIGINT END AS c1,
        round_even(length / (v_foot / 3.6) * 10, 0)::BIGINT AS c2, round_even(length / (v_foot / 3.6) * 10, 0)::BIGINT AS c3 FROM g JOIN s USING (way_id)),
  edges AS (SELECT * FROM x WHERE coalesce(c0, c1, c2, c3) IS NOT NULL)"""
_SPLIT = """sg AS (SELECT way_id, seq AS seg, lon7 AS x0, lat7 AS y0, lead(lon7) OVER w - lon7 AS dx, lead(lat7) OVER w - lat7 AS dy FROM way_nodes WINDOW w AS (PARTITION BY way_id ORDER BY seq)),
  ts AS (SELECT *, list_sort(list_concat([0.0, 1.0], list_concat(
     CASE WHEN dx <> 0 THEN list_transform(range(cast(floor(least(x0, x0 + dx) / 300000.0) AS BIGINT) + 1, cast(ceil(greatest(x0, x0 + dx) / 300000.0) AS BIGINT)), lambda k: (k * 300000 - x0)::DOUBLE / dx) ELSE [] END,
     CASE WHEN dy <> 0 THEN list_transform(range(cast(floor(least(y0, y0 + dy) / 200000.0) AS BIGINT) + 1, cast(ceil(greatest(y0, y0 + dy) / 200000.0) AS BIGINT)), lambda k: (k * 200000 - y0)::DOUBLE / dy) ELSE [] END))) AS ts
     FROM sg WHERE dx IS NOT NULL),
  sub AS (SELECT way_id, seg, x0, y0, dx, dy, j, ts[j] AS t0, ts[j + 1] AS t1 FROM ts, unnest(range(1, len(ts))) AS u(j)),
  cell AS (SELECT *, cast(floor((x0 + dx * ((t0 + t1) * 0.5)) / 300000.0) AS BIGINT) AS ix, cast(floor((y0 + dy * ((t0 + t1) * 0.5)) / 200000.0) AS BIGINT) AS iy FROM sub WHERE t1 - t0 >= 1e-12),
  isl AS (SELECT *, CASE WHEN lag(ix) OVER w = ix AND lag(iy) OVER w = iy THEN 0 ELSE 1 END AS new FROM cell WINDOW w AS (PARTITION BY way_id ORDER BY seg, j)),
  num AS (SELECT *, sum(new) OVER (PARTITION BY way_id ORDER BY seg, j ROWS UNBOUNDED PRECEDING)::BIGINT - 1 AS piece FROM isl),
  pos AS (SELECT way_id, piece, ix, iy, seg, j, 1 AS e, t1 AS t, x0, y0, dx, dy FROM num UNION ALL SELECT way_id, piece, ix, iy, seg, j, 0, t0, x0, y0, dx, dy FROM num WHERE new = 1),
  qz AS (SELECT *, greatest(0, least(65535, round_even((x0 + dx * t - ix * 300000) / 300000.0 * 65535, 0)::INTEGER)) AS x, greatest(0, least(65535, round_even((y0 + dy * t - iy * 200000) / 200000.0 * 65535, 0)::INTEGER)) AS y FROM pos),
  pieces AS (SELECT way_id, piece, ix, iy, count(*) AS n, string_agg(x || ',' || y, ';' ORDER BY seg, j, e) AS line FROM qz GROUP BY way_id, piece, ix, iy)"""
#: G5 by recursion: of each range the farthest point beyond 2 m, the first of equal ones.
SIMPLIFY = """ln AS (SELECT way_id, seq, lat7 / 1e7 * 110574.0 AS y, lon7 / 1e7 * (111320.0 * cos(radians(first_value(lat7) OVER (PARTITION BY way_id ORDER BY seq) / 1e7))) AS x, count(*) OVER (PARTITION BY way_id) AS n FROM {src}),
  seg(way_id, a, b) AS (
    SELECT way_id, min(seq), max(seq) FROM ln WHERE n >= 2 GROUP BY way_id
    UNION ALL
    SELECT way_id, CASE k WHEN 0 THEN a ELSE m END, CASE k WHEN 0 THEN m ELSE b END FROM (
      SELECT way_id, a, b, arg_max(seq, (d2, -seq)) AS m FROM (
        SELECT way_id, a, b, seq, pow(px - t * dx, 2) + pow(py - t * dy, 2) AS d2 FROM (
          SELECT way_id, a, b, seq, px, py, dx, dy, CASE WHEN dx = 0 AND dy = 0 THEN 0 ELSE least(1, greatest(0, (px * dx + py * dy) / (dx * dx + dy * dy))) END AS t FROM (
            SELECT s.way_id, s.a, s.b, p.seq, p.x - f.x AS px, p.y - f.y AS py, e.x - f.x AS dx, e.y - f.y AS dy
            FROM seg s JOIN ln f ON f.way_id = s.way_id AND f.seq = s.a JOIN ln e ON e.way_id = s.way_id AND e.seq = s.b JOIN ln p ON p.way_id = s.way_id AND p.seq > s.a AND p.seq < s.b) z1) z2) z3
      GROUP BY way_id, a, b HAVING max(d2) > 2.0 * 2.0) z4, (VALUES (0), (1)) AS v(k)),
  simple AS (SELECT n.* FROM {src} n JOIN (SELECT way_id, a AS seq FROM seg UNION SELECT way_id, b FROM seg) k USING (way_id, seq))"""
_FEATURES = f"""{SHAPES}, {SIMPLIFY.format(src='shape_nodes')}, {_SPLIT.replace('FROM way_nodes', 'FROM simple')}, w AS (SELECT way_id, {P.CLASS_SQL} AS cls, (CASE WHEN coalesce(oneway IN ('yes', '1', 'true'), false) OR coalesce(junction, '') = 'roundabout' OR highway IN ('motorway', 'motorway_link') THEN 1 ELSE 0 END + CASE WHEN bridge <> 'no' THEN 2 ELSE 0 END + CASE WHEN tunnel <> 'no' THEN 4 ELSE 0 END) AS flags, coalesce(nullif(name, ''), nullif(ref, '')) AS name FROM ways_flat),
  f AS (SELECT p.*, cls, flags, name, row_number() OVER (PARTITION BY ix, iy ORDER BY cls DESC, way_id, piece) AS pos FROM pieces p JOIN w USING (way_id) WHERE cls IS NOT NULL),
  st AS (SELECT ix, iy, name, (row_number() OVER (PARTITION BY ix, iy ORDER BY min(pos)) - 1)::INTEGER AS idx FROM f WHERE name IS NOT NULL GROUP BY ix, iy, name)"""
_COUNTS = f"{WN}, {_TILED}, t AS (SELECT ix, iy, count(*) AS n, (coalesce(sum(count(*)) OVER (ORDER BY ix, iy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS first FROM n GROUP BY ix, iy)"

ORACLES = {
    "g9_inner_deltas": f"""{WN}, q AS (SELECT *, lag(lat7) OVER w AS pa, lag(lon7) OVER w AS po, max(seq) OVER (PARTITION BY way_id) AS last FROM way_nodes WINDOW w AS (PARTITION BY way_id ORDER BY seq)),
        st AS (SELECT *, (floor(greatest(abs((lat7 - pa) / 10.0), abs((lon7 - po) / 10.0)) / 30000) + 1)::BIGINT AS steps FROM q WHERE seq > 0 AND seq < last),
        stops AS (SELECT way_id, row_number() OVER (PARTITION BY way_id ORDER BY seq, k) AS i, (pa + floor((lat7 - pa) * k / steps::DOUBLE))::BIGINT AS la, (po + floor((lon7 - po) * k / steps::DOUBLE))::BIGINT AS lo FROM st, unnest(range(1, steps + 1)) AS u(k)),
        fold(way_id, i, la, lo, dlat, dlon) AS (
          SELECT way_id, 0::BIGINT, lat7, lon7, 0::BIGINT, 0::BIGINT FROM way_nodes WHERE seq = 0
          UNION ALL
          SELECT f.way_id, s.i, f.la + 10 * round_even((s.la - f.la) / 10.0, 0)::BIGINT, f.lo + 10 * round_even((s.lo - f.lo) / 10.0, 0)::BIGINT, round_even((s.la - f.la) / 10.0, 0)::BIGINT, round_even((s.lo - f.lo) / 10.0, 0)::BIGINT
          FROM fold f JOIN stops s ON s.way_id = f.way_id AND s.i = f.i + 1),
        d AS (SELECT *, count(*) OVER (PARTITION BY way_id) AS n FROM fold WHERE i > 0)
        SELECT way_id, string_agg(dlat || ',' || dlon, ';' ORDER BY i) AS deltas FROM d WHERE n <= 12 OR i % (n // 12 + 1) = 0 GROUP BY way_id""",
    "s3_j1_located_ways": f"{WN} SELECT way_id, count(*)::INTEGER AS n, string_agg(lat7 || ',' || lon7, ';' ORDER BY seq) AS line FROM way_nodes WHERE ref % 7 <> 0 GROUP BY way_id HAVING count(*) >= 2",
    "a1_u1_breaks": f"{WN}, {_BREAKS.format(src='way_nodes')} SELECT ref, uses, is_break FROM br",
    "g1_tile_keys": f"{WN}, {_TILED} SELECT node_id, ix, iy, cast(floor(ix / 2.0) AS BIGINT) AS bx, cast(floor(iy / 2.0) AS BIGINT) AS by, (((iy % 2 + 2) % 2) * 2 + (ix % 2 + 2) % 2)::INTEGER AS slot FROM n",
    "g2_lengths": f"{WN}, pts AS (SELECT * FROM way_nodes), {_CUM} SELECT way_id, seq, round_even(seg * 1000, 0)::BIGINT AS seg_mm, round_even(cum * 1000, 0)::BIGINT AS cum_mm FROM c",
    "w1_w3_p17_p18_edges": f"{_EDGES} SELECT way_id, edge_no, piece, a, b, round_even(length * 1000, 0)::BIGINT AS length_mm, n, cls, flags, name, c0, c1, c2, c3 FROM edges",
    "u2_a4_degrees": f"{_EDGES} SELECT node_id, count(*) AS degree FROM (SELECT a AS node_id FROM edges UNION ALL SELECT b FROM edges) GROUP BY node_id",
    "a8_s6_usage": f"{_EDGES} SELECT count(*) AS edges, count(coalesce(c0, c1)) AS bike_edges, count(coalesce(c2, c3)) AS foot_edges, sum(n)::BIGINT AS shape_points FROM edges",
    "p19_saturated": f"{_EDGES} SELECT way_id, edge_no, piece, {', '.join(f'CASE WHEN c{i} IS NULL THEN 65535 ELSE least(c{i} * 20, 65534) END::INTEGER AS c{i}' for i in range(4))}, least(round_even(length * 10, 0), 65535)::INTEGER AS dm FROM edges",
    "g3_g4_split": f"{WN}, {_SPLIT} SELECT way_id, piece, ix, iy, line FROM pieces",
    "t1_w6_b1_road_tiles": f"{_FEATURES} SELECT f.ix, f.iy, string_agg(cls || ':' || flags || ':' || coalesce(idx, 65535) || ':' || n, ';' ORDER BY pos) AS ways, coalesce((SELECT string_agg(name, '|' ORDER BY idx) FROM st s WHERE s.ix = f.ix AND s.iy = f.iy), '') AS strings FROM f LEFT JOIN st ON st.ix = f.ix AND st.iy = f.iy AND st.name = f.name GROUP BY f.ix, f.iy",
    "w6_string_tables": f"{_FEATURES} SELECT * FROM st",
    "w2_dense_ids": f"{WN}, {_TILED} SELECT node_id, row_number() OVER (ORDER BY ix, iy, node_id) - 1 AS new_id FROM n",
    "a9_b5_tile_index": f"{_COUNTS} SELECT * FROM t",
    "w4_sparse_index": f"{_COUNTS} SELECT ix, iy, n, first, tile_no FROM (SELECT *, row_number() OVER (ORDER BY ix, iy) - 1 AS tile_no FROM t) z WHERE tile_no % 64 = 0",
    "a7_size_statistics": f"""{_COUNTS}, s AS (SELECT 'c' || ((ix % 3 + 3) % 3) AS layer, n AS size, row_number() OVER (PARTITION BY (ix % 3 + 3) % 3 ORDER BY n) - 1 AS i, count(*) OVER (PARTITION BY (ix % 3 + 3) % 3) AS m FROM t)
        SELECT layer, count(*) AS n, sum(size)::BIGINT AS total, max(size) FILTER (WHERE i = m // 2) AS median, max(size) FILTER (WHERE i = floor(m * 0.95)) AS p95, max(size) AS largest FROM s GROUP BY layer""",
    "w8_b6_bundles": f"""{_COUNTS}, b AS (SELECT cast(floor(ix / 2.0) AS BIGINT) AS bx, cast(floor(iy / 2.0) AS BIGINT) AS by, ((iy % 2 + 2) % 2) * 2 + (ix % 2 + 2) % 2 AS slot, n FROM t),
        o AS (SELECT *, 40 + coalesce(sum(n) OVER (PARTITION BY bx, "by" ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at FROM b)
        SELECT 'm' AS layer, k.bx, k."by", string_agg(coalesce(o.at, 0) || ',' || coalesce(o.n, 0), ';' ORDER BY s) AS slots FROM (SELECT DISTINCT bx, "by" FROM b) k CROSS JOIN (VALUES (0), (1), (2), (3)) v(s) LEFT JOIN o ON o.bx = k.bx AND o."by" = k."by" AND o.slot = s GROUP BY k.bx, k."by" """,
    "p10_boxes": f"""{WN} SELECT way_id, NOT (max(lat7) >= {BBOX[0]} AND min(lat7) <= {BBOX[2]} AND max(lon7) >= {BBOX[1]} AND min(lon7) <= {BBOX[3]}) AS outside,
        arg_min(lat7, seq) >= {BBOX[0]} AND arg_min(lat7, seq) <= {BBOX[2]} AND arg_min(lon7, seq) >= {BBOX[1]} AND arg_min(lon7, seq) <= {BBOX[3]} AS inside FROM way_nodes GROUP BY way_id""",
    "s6_g11_region": f"""{_FEATURES}, tl AS (SELECT count(DISTINCT ix * 1000000 + iy) AS tiles, count(*) AS features, sum(n)::BIGINT AS points FROM f),
        bx AS (SELECT min(lat7) AS south, min(lon7) AS west, max(lat7) AS north, max(lon7) AS east FROM simple WHERE way_id IN (SELECT way_id FROM w WHERE cls IS NOT NULL)) SELECT * FROM tl, bx""",
    "s5_layers": f"""{_FEATURES} SELECT DISTINCT 'm' AS layer, cast(floor(ix / 2.0) AS BIGINT) AS bx, cast(floor(iy / 2.0) AS BIGINT) AS "by" FROM f""",
    "g10_midpoints": f"""{WN}, l AS (SELECT *, count(*) OVER (PARTITION BY way_id) AS n FROM way_nodes)
        SELECT way_id, max(lat7) FILTER (WHERE seq = n // 2) AS lat7, max(lon7) FILTER (WHERE seq = n // 2) AS lon7, string_agg(lat7 || ',' || lon7, ';' ORDER BY seq) FILTER (WHERE seq % greatest(1, n // 3) = 0) || ';' || max(lat7 || ',' || lon7) FILTER (WHERE seq = n - 1) AS samples
        FROM l WHERE n >= 2 GROUP BY way_id""",
}
QUERIES = {f.__name__: f for f in (s3_j1_located_ways, a1_u1_breaks, g1_tile_keys, g2_lengths, w1_w3_p17_p18_edges, u2_a4_degrees, a8_s6_usage, p19_saturated, g3_g4_split, t1_w6_b1_road_tiles, w6_string_tables, w2_dense_ids, a9_b5_tile_index, w4_sparse_index, a7_size_statistics, w8_b6_bundles, b1_b6_road_bundles, p10_boxes, s6_g11_region, s5_layers, g9_inner_deltas, g10_midpoints)}
