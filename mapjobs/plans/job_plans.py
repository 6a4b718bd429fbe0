"""The three workloads over tables of objects (``mapjobs.jobs``), restricted to a box."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from mapjobs import jobs
from mapjobs.plans import address_plans as AP, area_plans as ARP, graph_plans as GP
from mapjobs.session import cut, shuffled
from mapjobs.sources import standins

#: South, west, north, east: about the middle half of the stand-in ways of every size.
BBOX = (490100000, -1000000, 490900000, 600000)
#: Ids of nodes and ways that stand for municipalities, places and addresses, beyond those of ways' own.
MUNI, PLACE, ADDRESS = 4 * 10**12, 5 * 10**12, 6 * 10**12


def _refs(points):
    """(way_id, refs) of (way_id, seq, ref)."""
    return points.groupBy("way_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "ref"))), lambda x: x["ref"]).alias("refs"))


def _roads(spark, sf_dir, view):
    """(nodes, ways) of the stand-in ways."""
    points = cut(standins.view(spark, sf_dir, view))
    nodes = points.groupBy(F.col("ref").alias("node_id")).agg(F.min("lat7").alias("lat7"), F.min("lon7").alias("lon7"))
    return nodes, _refs(points).join(shuffled(standins.ways(spark, sf_dir)), "way_id")


def _tags(**values):
    entries = F.array(*[F.struct(F.lit(k.replace("__", ":")).alias("key"), v.alias("value")) for k, v in values.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def p10_b1_roads_in_box(spark, sf_dir):
    return GP.tile_rows(jobs.display_roads(*_roads(spark, sf_dir, "shape_nodes"), BBOX).tiles)


def p10_s6_roads_summary_in_box(spark, sf_dir):
    return jobs.display_roads(*_roads(spark, sf_dir, "shape_nodes"), BBOX).summary


def p10_g6_areas_in_box(spark, sf_dir):
    rings = jobs.area_rings(*ARP._objects(spark, sf_dir), BBOX)
    return rings.select("area_id", "ring", "role", "typ", F.size("pts").alias("n"))


def p10_w1_graph_in_box(spark, sf_dir):
    """Edges of the graph with the nodes' numbers; junctions are those of all ways."""
    edges = jobs.road_graph(*_roads(spark, sf_dir, "way_nodes"), BBOX).edges
    return edges.select("way_id", "edge_no", "piece", "new_a", "new_b", F.rint(F.col("length") * 1000).cast("long").alias("length_mm"))


def p10_t3_addresses_in_box(spark, sf_dir):
    """The streets of the address index, from municipalities as closed ways and places and addresses as nodes."""
    nodes, ways = _roads(spark, sf_dir, "way_nodes")
    no_tags = F.create_map().cast("map<string,string>")
    m = standins.view(spark, sf_dir, "muni_points").withColumn("ref", F.col("muni_id") * 16 + F.col("seq") + MUNI)
    outlines = _refs(m.select((F.col("muni_id") + MUNI).alias("way_id"), "seq", "ref")).withColumn("refs", F.concat("refs", F.slice("refs", 1, 1)))
    munis = standins.view(spark, sf_dir, "munis").select((F.col("muni_id") + MUNI).alias("way_id"), _tags(boundary=F.lit("administrative"), admin_level=F.col("level").cast("string"), name=F.col("name")).alias("tags"))
    places = standins.view(spark, sf_dir, "places").select((F.col("place_id") + PLACE).alias("node_id"), "lat7", "lon7", _tags(place=F.col("kind"), name=F.col("name")).alias("tags"))
    numbers = standins.view(spark, sf_dir, "addresses").select((F.col("obj_id") + ADDRESS).alias("node_id"), "lat7", "lon7", _tags(addr__street=F.col("street"), addr__housenumber=F.col("hn")).alias("tags"))
    every = nodes.withColumn("tags", no_tags).unionByName(m.select(F.col("ref").alias("node_id"), "lat7", "lon7", no_tags.alias("tags"))).unionByName(places).unionByName(numbers)
    none = spark.createDataFrame([], "rel_id long, members array<struct<type:string,ref:bigint,role:string>>, tags map<string,string>")
    index = jobs.address_index(cut(every), cut(ways.unionByName(outlines.join(shuffled(munis), "way_id"))), none, BBOX)
    return index.streets.select("fold", "name", "sub", "lat7", "lon7", "numbers")


_MEETS = f"max(lat7) >= {BBOX[0]} AND min(lat7) <= {BBOX[2]} AND max(lon7) >= {BBOX[1]} AND min(lon7) <= {BBOX[3]}"
_INSIDE = f"lat7 BETWEEN {BBOX[0]} AND {BBOX[2]} AND lon7 BETWEEN {BBOX[1]} AND {BBOX[3]}"
_IN_BOX = GP._FEATURES.replace("ln AS (", f"met AS (SELECT way_id FROM shape_nodes GROUP BY way_id HAVING {_MEETS}), boxed AS (SELECT * FROM shape_nodes WHERE way_id IN (SELECT way_id FROM met)), ln AS (", 1)
_IN_BOX = re.sub(r"FROM shape_nodes(?=\)|,| n JOIN)", "FROM boxed", _IN_BOX)


def _address_box() -> str:
    """The SQL of the address index over the municipalities, places, streets and addresses that the box leaves."""
    views = standins.oracle("muni_points", "way_nodes", "ways_flat", "places", "addresses")
    rest = AP._BASE[len(views):]
    for name in ("muni_points", "places", "addresses"):
        rest = re.sub(rf"\b{name}\b", f"{name}_in", rest)
    rest = rest.replace("FROM ln WHERE n >= 2 AND seq = n // 2)", f"FROM ln WHERE n >= 2 AND seq = n // 2 AND {_INSIDE})")
    return f"""{views}, muni_points_in AS (SELECT * FROM muni_points WHERE muni_id IN (SELECT muni_id FROM muni_points GROUP BY muni_id HAVING {_MEETS})),
        places_in AS (SELECT * FROM places WHERE {_INSIDE}), addresses_in AS (SELECT * FROM addresses WHERE {_INSIDE}){rest}"""


ORACLES = {
    "p10_b1_roads_in_box": GP.ORACLES["t1_w6_b1_road_tiles"].replace(GP._FEATURES, _IN_BOX),
    "p10_s6_roads_summary_in_box": GP.ORACLES["s6_g11_region"].replace(GP._FEATURES, _IN_BOX),
    "p10_g6_areas_in_box": f"{ARP._AREAS} SELECT area_id, ring, role, typ, count(*)::INTEGER AS n FROM s4 WHERE typ IS NOT NULL GROUP BY area_id, ring, role, typ HAVING {_MEETS}",
    "p10_w1_graph_in_box": f"""{GP._EDGES}, met AS (SELECT way_id FROM way_nodes GROUP BY way_id HAVING {_MEETS}), own AS (SELECT * FROM edges WHERE way_id IN (SELECT way_id FROM met)),
        {ARP._NUMBERED.replace('FROM edges', 'FROM own')} SELECT e.way_id, edge_no, piece, p.id AS new_a, q.id AS new_b, round_even(length * 1000, 0)::BIGINT AS length_mm FROM own e JOIN i p ON p.ref = e.a JOIN i q ON q.ref = e.b""",
    "p10_t3_addresses_in_box": f"{_address_box()} SELECT fold, name, sub, lat7, lon7, numbers FROM ord",
}
QUERIES = {f.__name__: f for f in (p10_b1_roads_in_box, p10_s6_roads_summary_in_box, p10_g6_areas_in_box, p10_w1_graph_in_box, p10_t3_addresses_in_box)}
