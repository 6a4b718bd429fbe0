"""Queries of the address index and of spatial joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from mapjobs.functions import tags as R
from mapjobs.operators import address, areas, spatial
from mapjobs.plans import tag_plans as P
from mapjobs.session import cut
from mapjobs.sources import objects, standins


def _rings(spark, sf_dir):
    m = standins.view(spark, sf_dir, "muni_points")
    return m.select(F.col("muni_id").alias("poly"), F.lit(0).alias("ring"), "seq", "lat7", "lon7")


def _munis(spark, sf_dir):
    return standins.view(spark, sf_dir, "munis").select("muni_id", "level", "name")


def _streets(spark, sf_dir):
    t = R.of_map()
    named = standins.ways(spark, sf_dir).where(R.named_street(t)).select("way_id", t("name").alias("name"))
    lines = objects.as_lines(standins.view(spark, sf_dir, "way_nodes").join(named.select("way_id"), "way_id", "left_semi"))
    return address.street_ways(lines.join(named, "way_id"))


def _kept(spark, sf_dir):
    return address.kept_municipalities(_munis(spark, sf_dir), _rings(spark, sf_dir))


def _all(spark, sf_dir):
    s = cut(address.streets(cut(_streets(spark, sf_dir)), cut(_kept(spark, sf_dir)), _rings(spark, sf_dir), standins.view(spark, sf_dir, "places")))
    return s, cut(address.house_numbers(standins.view(spark, sf_dir, "addresses"), s))


def g8_points_in_polygons(spark, sf_dir):
    points = standins.view(spark, sf_dir, "way_nodes").where("seq = 0").select(F.col("way_id").alias("pid"), "lat7", "lon7")
    return spatial.points_in_polygons(points, spatial.ring_edges(_rings(spark, sf_dir)))


def p7_g11_j4_municipalities(spark, sf_dir):
    return _kept(spark, sf_dir).select("muni_id", "level", "name", F.rint("lat").cast("long").alias("lat7"), F.rint("lon").cast("long").alias("lon7"))


def p7_municipality_objects(spark, sf_dir):
    """Boundaries as objects. Every third one is a relation of two outer rings, the second a small square; others are closed ways; some are no municipality."""
    p = standins.view(spark, sf_dir, "muni_points").withColumn("node_id", F.col("muni_id") * 16 + F.col("seq"))
    small = p.where("seq < 4").select("muni_id", "level", "name", (F.col("seq") + 8).alias("seq"), (F.col("lat7") - 900000 + F.when(F.col("seq").isin(2, 3), 40000).otherwise(0)).alias("lat7"), (F.lit(0) + F.when(F.col("seq").isin(1, 2), 50000).otherwise(0)).alias("lon7")).withColumn("node_id", F.col("muni_id") * 16 + F.col("seq"))
    nodes = p.select("node_id", "lat7", "lon7").unionByName(small.where("muni_id % 3 = 0").select("node_id", "lat7", "lon7"))
    entries = F.array(F.struct(F.lit("boundary").alias("key"), F.when(F.col("muni_id") % 5 == 2, "political").otherwise("administrative").alias("value")), F.struct(F.lit("admin_level").alias("key"), F.col("level").cast("string").alias("value")), F.struct(F.lit("name").alias("key"), F.when(F.col("muni_id") % 7 != 3, F.col("name")).alias("value")), F.struct(F.lit("type").alias("key"), F.when(F.col("muni_id") % 3 == 0, "boundary").alias("value")))
    tags = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    ring = lambda d, no: d.groupBy("muni_id", "level", "name").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "node_id"))), lambda x: x["node_id"]).alias("refs")).withColumn("refs", F.concat("refs", F.slice("refs", 1, 1))).withColumn("way_id", F.col("muni_id") * 2 + no)
    first, second = ring(p, 0), ring(small, 1).where("muni_id % 3 = 0")
    none = F.create_map().cast("map<string,string>")
    ways = first.select("way_id", "refs", F.when(F.col("muni_id") % 3 == 0, none).otherwise(tags).alias("tags")).unionByName(second.select("way_id", "refs", none.alias("tags")))
    m = lambda no: F.struct(F.lit("way").alias("type"), (F.col("muni_id") * 2 + no).alias("ref"), F.lit("outer").alias("role"))
    relations = first.where("muni_id % 3 = 0").select(F.col("muni_id").alias("rel_id"), F.array(m(1), m(0)).alias("members"), tags.alias("tags"))
    munis, rings = address.municipality_objects(areas.located_rings(areas.assembled(ways, relations), nodes))
    labels = address.label_points(rings).withColumnRenamed("poly", "muni_id")
    count = rings.groupBy(F.col("poly").alias("muni_id")).agg(F.count_distinct("ring").alias("rings"), F.count("*").alias("points"))
    return munis.join(labels, "muni_id").join(count, "muni_id").select("muni_id", "level", "name", "rings", "points", F.rint("lat").cast("long").alias("lat7"), F.rint("lon").cast("long").alias("lon7"))


def p9_address_objects(spark, sf_dir):
    """Addresses on nodes and on ways; every third way is closed, every seventh object has no street."""
    a = standins.view(spark, sf_dir, "addresses").where("obj_id % 2 = 0")
    entry = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    tags = lambda d, i, street, hn: F.map_from_entries(F.filter(F.array(entry("addr:housenumber", hn), entry("addr:street", F.when(i % 7 != 0, street))), lambda e: e["value"].isNotNull()))
    nodes = a.select(F.col("obj_id").alias("node_id"), "lat7", "lon7", tags(a, F.col("obj_id"), F.col("street"), F.col("hn")).alias("tags"))
    w = standins.view(spark, sf_dir, "ways_flat").where("way_id % 2 = 1")
    ways = w.select("way_id", tags(w, F.col("way_id"), F.col("name"), (F.col("way_id") % 90 + 1).cast("string")).alias("tags"))
    p = standins.view(spark, sf_dir, "way_nodes").select("way_id", "seq", "lat7", "lon7")
    closing = p.where("way_id % 3 = 0 and seq = 0").withColumn("seq", F.lit(99).cast("long"))
    found = address.address_objects(nodes, ways, p.unionByName(closing))
    return found.select(F.col("obj_id.type").alias("type"), F.col("obj_id.id").alias("id"), "street", "hn", F.rint("lat7").cast("long").alias("lat7"), F.rint("lon7").cast("long").alias("lon7"))


def s6_address_summary(spark, sf_dir):
    return address.summary(*address.address_tables(*_all(spark, sf_dir)))


def j3_street_municipality(spark, sf_dir):
    return address.municipality_of(_streets(spark, sf_dir), _kept(spark, sf_dir), _rings(spark, sf_dir))


def j5_district_towns(spark, sf_dir):
    s = _streets(spark, sf_dir)
    placed = s.join(address.municipality_of(s, _kept(spark, sf_dir), _rings(spark, sf_dir)), "way_id")
    return address.town_of(placed.select("way_id", "muni_id", "lat7", "lon7"), _kept(spark, sf_dir), _rings(spark, sf_dir), standins.view(spark, sf_dir, "places"))


def j6_nearest_place(spark, sf_dir):
    return address.nearest_place(_streets(spark, sf_dir), standins.view(spark, sf_dir, "places"))


def a2_streets(spark, sf_dir):
    s, _ = _all(spark, sf_dir)
    return s.select("street_id", "muni", "muni_name", "fold", "sub", "name", "lat7", "lon7", F.size("samples").alias("samples"))


def p9_j7_a3_house_numbers(spark, sf_dir):
    return _all(spark, sf_dir)[1]


def t3_w5_b7_places(spark, sf_dir):
    return address.address_tables(*_all(spark, sf_dir))[0]


def t3_w5_b7_streets(spark, sf_dir):
    return address.address_tables(*_all(spark, sf_dir))[1]


def t3_w5_b7_numbers(spark, sf_dir):
    return address.address_tables(*_all(spark, sf_dir))[2]


def w7_name_pool(spark, sf_dir):
    p, s, _ = address.address_tables(*_all(spark, sf_dir))
    return address.name_pool(cut(p), cut(s))


_IN = lambda pts, rings: f"""SELECT pid, poly FROM (SELECT p.pid, e.poly, count(*) AS n FROM {pts} p JOIN {rings} e
   ON (e.y0 > p.lat7) <> (e.y1 > p.lat7) AND p.lon7 < (e.x1 - e.x0) * (p.lat7 - e.y0)::DOUBLE / (e.y1 - e.y0) + e.x0 GROUP BY ALL) z WHERE n % 2 = 1"""  # noqa: E731
_RE = "re AS (SELECT muni_id AS poly, level, lat7 AS y0, lon7 AS x0, lag(lat7, 1, NULL) OVER w AS py, lag(lon7, 1, NULL) OVER w AS px, last_value(lat7) OVER v AS ly, last_value(lon7) OVER v AS lx FROM muni_points WINDOW w AS (PARTITION BY muni_id ORDER BY seq), v AS (PARTITION BY muni_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), e AS (SELECT poly, level, y0, x0, coalesce(py, ly) AS y1, coalesce(px, lx) AS x1 FROM re)"
_KEPT = f"""lab AS (SELECT muni_id, level, name, (sum(lat7) + arg_min(lat7, seq)) / (count(*) + 1) AS lat7, (sum(lon7) + arg_min(lon7, seq)) / (count(*) + 1) AS lon7 FROM muni_points GROUP BY ALL), l8 AS (SELECT muni_id AS pid, lat7, lon7 FROM lab WHERE level = 8), e6 AS (SELECT * FROM e WHERE level = 6),
  fullm AS ({_IN('l8', 'e6')}), kept AS (SELECT * FROM lab WHERE muni_id NOT IN (SELECT poly FROM fullm)), ek AS (SELECT * FROM e WHERE poly IN (SELECT muni_id FROM kept))"""
_BASE = f"""{standins.oracle('muni_points', 'way_nodes', 'ways_flat', 'places', 'addresses')}, {_RE}, {_KEPT},
  ln AS (SELECT n.*, w.name, count(*) OVER (PARTITION BY way_id) AS n FROM way_nodes n JOIN ways_flat w USING (way_id) WHERE {P.STREET_SQL.replace('area', 'w.area')}),
  st AS (SELECT way_id, name, lat7, lon7 FROM ln WHERE n >= 2 AND seq = n // 2), sp AS (SELECT way_id AS pid, lat7, lon7 FROM st),
  sm AS (SELECT pid AS way_id, min(poly) AS muni_id FROM ({_IN('sp', 'ek')}) z GROUP BY pid),
  pp AS (SELECT place_id AS pid, lat7, lon7 FROM places WHERE kind IN ('city', 'town', 'village')), ek6 AS (SELECT * FROM ek WHERE level = 6), pin AS ({_IN('pp', 'ek6')}),
  tw AS (SELECT way_id, muni_id, arg_min(place_id, (m / reach, place_id)) AS place_id FROM (
     SELECT s.way_id, sm.muni_id, p.place_id, CASE p.kind WHEN 'city' THEN 12000.0 WHEN 'town' THEN 5000.0 ELSE 2000.0 END::DOUBLE AS reach,
       sqrt(pow((p.lon7 - s.lon7) / 1e7 * (111320.0 * cos(radians(s.lat7 / 1e7))), 2) + pow((p.lat7 - s.lat7) / 1e7 * 110574.0, 2)) AS m
     FROM st s JOIN sm USING (way_id) JOIN pin ON pin.poly = sm.muni_id JOIN places p ON p.place_id = pin.pid) z WHERE m <= reach GROUP BY way_id, muni_id),
  np AS (SELECT way_id, arg_min(place_id, (d2, place_id)) AS place_id FROM (SELECT s.way_id, p.place_id, pow((p.lat7 - s.lat7) / 1e7, 2) + pow((p.lon7 - s.lon7) / 1e7 * cos(radians(s.lat7 / 1e7)), 2) AS d2 FROM st s, places p) z WHERE d2 < 0.08 * 0.08 GROUP BY way_id),
  sx AS (SELECT s.*, sm.muni_id || coalesce('/' || tw.place_id, '') AS muni, coalesce(t.name, k.name) AS muni_name, coalesce(t.lat7, k.lat7)::DOUBLE AS mlat7, coalesce(t.lon7, k.lon7)::DOUBLE AS mlon7, {P.FOLD_SQL('s.name')} AS fold, pl.name AS part
     FROM st s JOIN sm USING (way_id) JOIN kept k ON k.muni_id = sm.muni_id LEFT JOIN tw ON tw.way_id = s.way_id LEFT JOIN places t ON t.place_id = tw.place_id LEFT JOIN np ON np.way_id = s.way_id LEFT JOIN places pl ON pl.place_id = np.place_id),
  sy AS (SELECT *, CASE WHEN {P.FOLD_SQL('part')} <> {P.FOLD_SQL('muni_name')} THEN part END AS sub FROM sx WHERE fold <> ''),
  streets AS (SELECT min(way_id) AS street_id, muni, muni_name, mlat7, mlon7, fold, sub, arg_min(name, way_id) AS name, arg_min(lat7, way_id) AS lat7, arg_min(lon7, way_id) AS lon7, list(way_id) AS ways FROM sy GROUP BY muni, muni_name, mlat7, mlon7, fold, sub),
  sw AS (SELECT street_id, fold, unnest(ways) AS way_id FROM streets),
  smp AS (SELECT sw.street_id, sw.fold, l.lat7, l.lon7 FROM sw JOIN ln l USING (way_id) WHERE l.seq % greatest(1, l.n // 12) = 0 OR l.seq = l.n - 1),
  ad AS (SELECT *, {P.FOLD_SQL('street')} AS fold, substr(regexp_replace(replace(trim(hn), ' ', ''), '[^\\x00-\\x7F]', '', 'g'), 1, 7) AS number FROM addresses),
  best AS (SELECT obj_id, any_value(number) AS number, any_value(alat) AS lat7, any_value(alon) AS lon7, arg_min(street_id, (d2, street_id)) AS street_id FROM (
     SELECT a.obj_id, a.number, a.lat7 AS alat, a.lon7 AS alon, s.street_id, pow((s.lat7 - a.lat7) / 1e7, 2) + pow((s.lon7 - a.lon7) / 1e7 * cos(radians(a.lat7 / 1e7)), 2) AS d2
     FROM ad a JOIN smp s ON s.fold = a.fold AND abs(s.lat7 - a.lat7) <= 60000) z WHERE d2 <= 0.006 * 0.006 AND number <> '' GROUP BY obj_id),
  numbers AS (SELECT street_id, arg_min(number, obj_id) AS number, arg_min(lat7, obj_id) AS lat7, arg_min(lon7, obj_id) AS lon7 FROM best GROUP BY street_id, upper(number)),
  cnt AS (SELECT s.*, {P.FOLD_SQL('muni_name')} AS mfold, (SELECT count(*) FROM numbers n WHERE n.street_id = s.street_id) AS numbers FROM streets s),
  ord AS (SELECT *, row_number() OVER o - 1 AS pos, (sum(numbers) OVER o - numbers)::BIGINT AS first_number FROM cnt WINDOW o AS (ORDER BY mfold, muni, fold, coalesce(sub, ''), street_id ROWS UNBOUNDED PRECEDING)),
  pl AS (SELECT row_number() OVER (ORDER BY mfold, muni) - 1 AS pos, mfold AS fold, muni_name AS name, round_even(mlat7, 0)::BIGINT AS lat7, round_even(mlon7, 0)::BIGINT AS lon7, min(pos) AS first_street, count(*) AS streets FROM ord GROUP BY muni, mfold, muni_name, mlat7, mlon7)"""
ORACLES = {
    "g8_points_in_polygons": f"{standins.oracle('muni_points', 'way_nodes')}, {_RE}, p AS (SELECT way_id AS pid, lat7, lon7 FROM way_nodes WHERE seq = 0) {_IN('p', 'e')}",
    "p7_g11_j4_municipalities": f"{standins.oracle('muni_points')}, {_RE}, {_KEPT} SELECT muni_id, level, name, round_even(lat7, 0)::BIGINT AS lat7, round_even(lon7, 0)::BIGINT AS lon7 FROM kept",
    "p7_municipality_objects": f"""{standins.oracle('muni_points')} SELECT CASE WHEN muni_id % 3 = 0 THEN muni_id * 2 + 1 ELSE muni_id * 4 END AS muni_id, level::INTEGER AS level, name, CASE WHEN muni_id % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS rings,
        (count(*) + CASE WHEN muni_id % 3 = 0 THEN 4 ELSE 0 END)::BIGINT AS points, round_even((sum(lat7) + arg_min(lat7, seq)) / (count(*) + 1), 0)::BIGINT AS lat7, round_even((sum(lon7) + arg_min(lon7, seq)) / (count(*) + 1), 0)::BIGINT AS lon7
        FROM muni_points m WHERE muni_id % 5 <> 2 AND muni_id % 7 <> 3 GROUP BY m.muni_id, level, name""",
    "p9_address_objects": f"""{standins.oracle('addresses', 'ways_flat', 'way_nodes')}, pt AS (SELECT way_id, lat7, lon7 FROM way_nodes UNION ALL SELECT way_id, lat7, lon7 FROM way_nodes WHERE seq = 0 AND way_id % 3 = 0)
        SELECT 0 AS type, obj_id AS id, street, hn, lat7, lon7 FROM addresses WHERE obj_id % 2 = 0 AND obj_id % 7 <> 0
        UNION ALL SELECT 1, w.way_id, w.name, (w.way_id % 90 + 1)::VARCHAR, round_even(avg(p.lat7), 0)::BIGINT, round_even(avg(p.lon7), 0)::BIGINT FROM ways_flat w JOIN pt p USING (way_id) WHERE w.way_id % 2 = 1 AND w.way_id % 7 <> 0 AND w.name IS NOT NULL GROUP BY w.way_id, w.name""",
    "s6_address_summary": f"{_BASE} SELECT (SELECT count(*) FROM pl) AS places, (SELECT count(*) FROM ord) AS streets, (SELECT count(*) FROM numbers) AS numbers",
    "j3_street_municipality": f"{_BASE} SELECT * FROM sm",
    "j5_district_towns": f"{_BASE} SELECT * FROM tw",
    "j6_nearest_place": f"{_BASE} SELECT * FROM np",
    "a2_streets": f"{_BASE} SELECT street_id, muni, muni_name, fold, sub, name, lat7, lon7, ((SELECT count(*) FROM (SELECT l.seq FROM ln l WHERE l.way_id IN (SELECT unnest(ways)) AND l.seq % greatest(1, l.n // 12) = 0) q) + len(ways))::INTEGER AS samples FROM streets",
    "p9_j7_a3_house_numbers": f"{_BASE} SELECT street_id, number, lat7, lon7 FROM numbers",
    "t3_w5_b7_places": f"{_BASE} SELECT pos, fold, name, lat7, lon7, first_street, streets FROM pl",
    "t3_w5_b7_streets": f"{_BASE} SELECT pos, fold, name, sub, lat7, lon7, first_number, numbers FROM ord",
    "t3_w5_b7_numbers": f"{_BASE} SELECT o.first_number + row_number() OVER (PARTITION BY n.street_id ORDER BY coalesce(try_cast(regexp_replace(number, '[^0-9]', '', 'g') AS BIGINT), 0), number) - 1 AS pos, number, n.lat7, n.lon7 FROM numbers n JOIN ord o USING (street_id)",
    "w7_name_pool": f"""{_BASE}, u AS (SELECT sub AS name, (pos, 0, 0) AS k FROM ord WHERE sub IS NOT NULL UNION ALL SELECT name, (pos, 0, 1) FROM ord UNION ALL SELECT name, (first_street + streets - 1, 1, 0) FROM pl),
        f AS (SELECT name, min(k) AS k FROM u GROUP BY name) SELECT name, (sum(strlen(name) + 1) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) - strlen(name) - 1)::BIGINT AS at FROM f""",
}
QUERIES = {f.__name__: f for f in (g8_points_in_polygons, p7_g11_j4_municipalities, p7_municipality_objects, p9_address_objects, s6_address_summary, j3_street_municipality, j5_district_towns, j6_nearest_place, a2_streets, p9_j7_a3_house_numbers, t3_w5_b7_places, t3_w5_b7_streets, t3_w5_b7_numbers, w7_name_pool)}
