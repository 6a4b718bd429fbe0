"""Queries of the tag and text rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mapjobs.functions import tags as R, text as X
from mapjobs.sources import objects, standins
from mapjobs.session import table

T = R.of_map()


def _ways(spark, sf_dir, **columns) -> DataFrame:
    return standins.ways(spark, sf_dir).select("way_id", *[c.alias(n) for n, c in columns.items()])


def s1_key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects.with_keys(standins.ways(spark, sf_dir), ["bridge", "tunnel", "junction"]).select("way_id")


def p1_road_class(spark, sf_dir):
    return _ways(spark, sf_dir, cls=R.road_class(T))


def p2_area_type(spark, sf_dir):
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in standins.AREA_TAGS])
    areas = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("area_id"), F.map_from_entries(F.array(F.element_at(pairs, (F.col("p_partkey") % 14 + 1).cast("int")))).alias("tags"))
    return areas.select("area_id", R.area_type(T).alias("typ"))


def p3_p4_flags(spark, sf_dir):
    return _ways(spark, sf_dir, display=R.display_flags(T), edge=R.edge_flags(T))


def p5_p6_filters(spark, sf_dir):
    return _ways(spark, sf_dir, routable=R.routable(T), street=R.named_street(T))


def p8_places(spark, sf_dir):
    p = standins.view(spark, sf_dir, "places").select("place_id", F.create_map(F.lit("place"), "kind", F.lit("name"), "name").alias("tags"))
    return p.where(R.place_node(T)).select("place_id")


def p11_p12_p13_directions(spark, sf_dir):
    forward, backward = R.directions(T)
    return _ways(spark, sf_dir, fwd=forward, bwd=backward, contra=R.contraflow(T), infra=R.cycle_lanes(T))


def p14_surface(spark, sf_dir):
    return _ways(spark, sf_dir, bike=F.round(R.surface_factor(T, "bike"), 6), foot=F.round(R.surface_factor(T, "foot"), 6))


def p15_p16_speeds(spark, sf_dir):
    return _ways(spark, sf_dir, bike=F.round(R.bike_speed(T), 6), foot=F.round(R.foot_speed(T), 6)).where("way_id is not null")


def p20_max_speed(spark, sf_dir):
    return _ways(spark, sf_dir, kmh=F.round(R.max_speed(T("maxspeed")), 6))


def p21_names(spark, sf_dir):
    name = R.display_name(T)
    return _ways(spark, sf_dir, name=name, shown=X.cut_bytes(F.repeat(name, 6), 60))


def f1_fold(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "[ \n]")).alias("w")).distinct()
    return words.select("w", X.fold(F.col("w")).alias("fold"))


def f2_f3_house_numbers(spark, sf_dir):
    a = standins.view(spark, sf_dir, "addresses").select("obj_id", X.house_number(F.col("hn")).alias("num"))
    return a.select("obj_id", "num", X.number_key(F.col("num")).alias("key"))


def _in(c: str, values) -> str:
    return f"coalesce({c} IN ({', '.join(repr(v) for v in values)}), false)"


W = standins.oracle("ways_flat")
_BIG, _MID = _in("highway", R.BIG), _in("highway", R.MIDDLE)
_FREE = _in("bicycle", R.ALLOWED)
_INFRA = f"({_in('bicycle', ['designated'])} OR {_in('cycleway', R.CYCLE_LANES)})"
_CASES = lambda c, rows: f"CASE {c} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in rows) + " END"
CLASS_SQL = f"""CASE WHEN coalesce(area, '') = 'yes' OR (highway = 'footway' AND {_in('footway', R.SIDE_FOOTWAYS)}) OR (highway = 'service' AND {_in('service', R.PRIVATE_SERVICE)}) THEN NULL
  ELSE {_CASES('highway', R.CLASSES.items())} END"""


def surface_sql(mode: int, rough: float) -> str:
    return "(CASE " + " ".join(f"WHEN {_in('surface', s[0])} THEN {s[mode]}" for s in R.SURFACES) + f" ELSE 1.0 END * CASE WHEN {_in('smoothness', R.ROUGH)} THEN {rough} ELSE 1.0 END)::DOUBLE"


BIKE_SQL = f"""CASE WHEN coalesce(coalesce(bicycle, vehicle, access) IN ('no', 'private'), false) AND NOT {_FREE} THEN NULL
  WHEN bicycle = 'dismount' THEN 4.0::DOUBLE WHEN {_BIG} AND NOT {_FREE} THEN NULL
  ELSE {surface_sql(1, 0.7)} * (CASE WHEN {_BIG} THEN 10.0 WHEN {_MID} AND {_INFRA} THEN least(1.6 * {_CASES('highway', [('tertiary', 15.0), ('tertiary_link', 15.0), ('secondary', 10.5), ('secondary_link', 10.5), ('primary', 7.5), ('primary_link', 7.5)])}, 17.0)
    ELSE CASE highway WHEN 'cycleway' THEN 20.0 WHEN 'residential' THEN 17.0 WHEN 'unclassified' THEN 17.0 WHEN 'road' THEN 17.0 WHEN 'living_street' THEN 13.0 WHEN 'service' THEN 14.0
      WHEN 'pedestrian' THEN CASE WHEN {_FREE} THEN 8.0 ELSE 4.5 END
      WHEN 'track' THEN coalesce({_CASES('tracktype', [('grade1', 17.0), ('grade2', 14.0), ('grade3', 11.0), ('grade4', 7.0), ('grade5', 6.0)])}, 12.0)
      WHEN 'path' THEN CASE WHEN bicycle = 'designated' THEN 15.0 WHEN {_FREE} THEN 12.0 ELSE 10.0 END WHEN 'bridleway' THEN CASE WHEN bicycle = 'designated' THEN 15.0 WHEN {_FREE} THEN 12.0 ELSE 10.0 END
      WHEN 'footway' THEN CASE WHEN {_FREE} THEN 12.0 ELSE 4.5 END WHEN 'steps' THEN 1.5 WHEN 'tertiary' THEN 15.0 WHEN 'tertiary_link' THEN 15.0 WHEN 'secondary' THEN 10.5 WHEN 'secondary_link' THEN 10.5
      WHEN 'primary' THEN 7.5 WHEN 'primary_link' THEN 7.5 ELSE 12.0 END END)::DOUBLE END"""
FOOT_SQL = f"""CASE WHEN (coalesce(coalesce(foot, access) IN ('no', 'private'), false) AND NOT {_in('foot', R.ALLOWED)}) OR {_BIG} OR (highway = 'cycleway' AND coalesce(foot, '') = 'no') THEN NULL
  ELSE {surface_sql(2, 0.85)} * (CASE WHEN highway = 'cycleway' THEN 4.2 WHEN {_in('highway', 'footway pedestrian path living_street residential unclassified road bridleway'.split())} THEN 5.0 WHEN highway = 'steps' THEN 3.0
    WHEN highway IN ('service', 'track') THEN 4.6 WHEN highway LIKE 'tertiary%' THEN 4.4 WHEN highway LIKE 'secondary%' THEN 3.4 WHEN highway LIKE 'primary%' THEN 2.4 ELSE 4.5 END)::DOUBLE END"""
ONEWAY_IMPLIED = "(coalesce(junction IN ('roundabout', 'circular'), false) OR coalesce(highway IN ('motorway', 'motorway_link'), false))"
FWD_SQL = "NOT coalesce(oneway IN ('-1', 'reverse'), false)"
BWD_SQL = f"CASE WHEN coalesce(oneway IN ('yes', 'true', '1'), false) THEN false WHEN coalesce(oneway IN ('-1', 'reverse', 'no'), false) THEN true ELSE NOT {ONEWAY_IMPLIED} END"
CONTRA_SQL = "(coalesce(oneway_bicycle, '') = 'no' OR coalesce(cycleway, '') LIKE 'opposite%' OR (coalesce(bicycle IN ('yes', 'designated'), false) AND coalesce(oneway IN ('yes', '-1'), false) AND coalesce(oneway_bicycle, '') <> 'yes' AND highway IN ('cycleway', 'path', 'track')))"
EDGE_FLAGS_SQL = "(CASE WHEN junction IN ('roundabout', 'circular') THEN 1 ELSE 0 END + CASE WHEN bridge <> 'no' THEN 2 ELSE 0 END + CASE WHEN tunnel <> 'no' THEN 4 ELSE 0 END)::INTEGER"
ROUTABLE_SQL = f"({_in('highway', R.CLASSES)} AND coalesce(area, '') <> 'yes')"
STREET_SQL = f"({_in('highway', R.STREETS)} AND coalesce(name, '') <> '' AND NOT (highway = 'service' AND {_in('service', R.PRIVATE_SERVICE)}))"
FOLD_SQL = lambda c: f"substr(trim(regexp_replace(translate(regexp_replace(upper(replace(translate({c}, '{X.ACCENTS}', '{X.BASES}'), 'ß', 'SS')), '[^A-Z0-9 _/-]', '', 'g'), '-_/', '   '), ' +', ' ', 'g')), 1, 24)"

ORACLES = {
    "s1_key_filter": f"{W} SELECT way_id FROM ways_flat WHERE bridge IS NOT NULL OR tunnel IS NOT NULL OR junction IS NOT NULL",
    "p1_road_class": f"{W} SELECT way_id, {CLASS_SQL} AS cls FROM ways_flat",
    "p2_area_type": "SELECT p_partkey AS area_id, ([0, 3, 1, 2, 4, NULL, 0, 1, 1, 2, 3, NULL, 1, 4])[p_partkey % 14 + 1] AS typ FROM part",
    "p3_p4_flags": f"{W} SELECT way_id, (CASE WHEN coalesce(oneway IN ('yes', '1', 'true'), false) OR coalesce(junction, '') = 'roundabout' OR highway IN ('motorway', 'motorway_link') THEN 1 ELSE 0 END + CASE WHEN bridge <> 'no' THEN 2 ELSE 0 END + CASE WHEN tunnel <> 'no' THEN 4 ELSE 0 END)::INTEGER AS display, {EDGE_FLAGS_SQL} AS edge FROM ways_flat",
    "p5_p6_filters": f"{W} SELECT way_id, {ROUTABLE_SQL} AS routable, {STREET_SQL} AS street FROM ways_flat",
    "p8_places": standins.oracle("places") + " SELECT place_id FROM places",
    "p11_p12_p13_directions": f"{W} SELECT way_id, {FWD_SQL} AS fwd, {BWD_SQL} AS bwd, {CONTRA_SQL} AS contra, {_INFRA} AS infra FROM ways_flat",
    "p14_surface": f"{W} SELECT way_id, round({surface_sql(1, 0.7)}, 6) AS bike, round({surface_sql(2, 0.85)}, 6) AS foot FROM ways_flat",
    "p15_p16_speeds": f"{W} SELECT way_id, round({BIKE_SQL}, 6) AS bike, round({FOOT_SQL}, 6) AS foot FROM ways_flat",
    "p20_max_speed": f"""{W} SELECT way_id, round(CASE WHEN trim(maxspeed) IN ('none', 'signals') THEN 130.0::DOUBLE WHEN trim(maxspeed) = 'walk' THEN 7.0::DOUBLE
        ELSE try_cast(nullif(regexp_extract(lower(trim(maxspeed)), '^([0-9]+([.][0-9]+)?)', 1), '') AS DOUBLE) * CASE WHEN maxspeed LIKE '%mph' THEN 1.609 ELSE 1 END END, 6) AS kmh FROM ways_flat""",
    "p21_names": f"""{W}, n AS (SELECT way_id, coalesce(nullif(name, ''), nullif(ref, '')) AS name FROM ways_flat)
        SELECT way_id, name, substr(repeat(name, 6), 1, list_max(list_filter(range(0, 61), lambda i: strlen(substr(repeat(name, 6), 1, i::INTEGER)) <= 60))::INTEGER) AS shown FROM n""",
    "f1_fold": f"SELECT DISTINCT w, {FOLD_SQL('w')} AS fold FROM (SELECT unnest(regexp_split_to_array(text, '[ \n]')) AS w FROM documents)",
    "f2_f3_house_numbers": standins.oracle("addresses") + """, x AS (SELECT obj_id, substr(regexp_replace(replace(trim(hn), ' ', ''), '[^\\x00-\\x7F]', '', 'g'), 1, 7) AS num FROM addresses)
        SELECT obj_id, num, coalesce(try_cast(regexp_replace(num, '[^0-9]', '', 'g') AS BIGINT), 0) AS key FROM x""",
}
QUERIES = {f.__name__: f for f in (s1_key_filter, p1_road_class, p2_area_type, p3_p4_flags, p5_p6_filters, p8_places, p11_p12_p13_directions, p14_surface, p15_p16_speeds, p20_max_speed, p21_names, f1_fold, f2_f3_house_numbers)}
