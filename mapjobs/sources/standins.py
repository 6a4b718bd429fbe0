"""Stand-in map objects derived from the test tables by integer formulas, written once for Spark and for DuckDB.

Each view is SQL text; ``{pick(...)}`` is the one construct that the two dialects spell differently. ``views`` registers
nothing: it returns the text of the WITH clause, so Spark and DuckDB see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mapjobs.session import table

HIGHWAYS = "residential unclassified tertiary secondary primary trunk motorway service track path footway cycleway steps living_street pedestrian bridleway primary_link road residential proposed".split()
NAMES = ["Hauptstraße", "Bahnhofstr.", "Rue de l’Église", "Café-Gasse", "Am Mühlbach", "High Street", "Schloßplatz", "Señor-Weg", "Côte d Or", "Gartenweg", "Unter-den  Linden", None]
#: tag, values, formula of the index
TAGS = [
    ("oneway", [None, None, "yes", "no", "-1", "reverse"], "o_custkey%6"),
    ("surface", [None, "asphalt", "sett", "compacted", "gravel", "ground", "cobblestone", "fine_gravel"], "o_custkey%8"),
    ("smoothness", [None, "good", "bad", None, "very_bad", "excellent", None], "o_orderkey%7"),
    ("bicycle", [None, None, "yes", "no", "designated", "dismount", "private", "permissive", None, None, None], "o_orderkey%11"),
    ("foot", [None, None, None, "yes", "no", "designated", "private", None, None, None, None, None, None], "o_orderkey%13"),
    ("access", [None, None, None, None, "private", "no", "yes", None, None, None, None, None, None, None, None, None, None], "o_orderkey%17"),
    ("vehicle", [None, None, None, None, None, "private", "no", "yes"] + [None] * 11, "o_orderkey%19"),
    ("cycleway", [None, None, "lane", "track", "opposite", "opposite_lane", None, "shared_busway", "no"], "o_custkey%9"),
    ("oneway_bicycle", [None, None, None, "no", "yes"], "o_custkey%5"),
    ("tracktype", [None, "grade1", "grade3", "grade4", "grade5"], "o_custkey%5"),
    ("service", [None, None, "parking_aisle", "driveway", None, "alley", "drive-through", None, None, None], "o_orderkey%10"),
    ("footway", [None, None, "sidewalk", None, "crossing", None, None, "traffic_island", None, None, None, None], "o_orderkey%12"),
    ("area", ["yes"] + ["no"] + [None] * 21, "o_orderkey%23"),
    ("bridge", ["yes", "no"] + [None] * 12, "o_orderkey%14"),
    ("tunnel", [None, None, "yes", "no", "culvert"] + [None] * 10, "o_orderkey%15"),
    ("junction", ["roundabout", "circular"] + [None] * 19, "o_orderkey%21"),
    ("maxspeed", [None, "50", "30 mph", "none", "signals", "walk", "7.5", "abc", " 80 ", "100;80"], "o_custkey%10"),
    ("ref", [None, "B 3", "", None], "o_custkey%4"),
]
#: The library knows these tags by their names with a colon.
COLON = {"oneway_bicycle": "oneway:bicycle"}
AREA_TAGS = [("landuse", "forest"), ("landuse", "residential"), ("natural", "water"), ("leisure", "park"), ("building", "yes"), ("building", "no"), ("natural", "wood"), ("landuse", "reservoir"), ("waterway", "riverbank"), ("landuse", "grass"), ("landuse", "industrial"), ("landuse", "farmland"), ("landuse", "basin"), ("building", "house")]


def pick(values: list[str | None], index: str, dialect: str) -> str:
    items = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"element_at(array({items}), cast(({index}) + 1 as int))" if dialect == "spark" else f"([{items}])[({index}) + 1]"


def sql(dialect: str) -> dict[str, str]:
    """The text of each view, in the order in which they build on each other."""
    p = lambda values, index: pick(values, index, dialect)
    div = (lambda a, b: f"cast(floor({a} / {b}.0) as bigint)")
    return {
        "way_nodes": f"""
            SELECT way_id, seq, ref, cast(490000000 + {div('an', 25)} * 100000 + (ref * 7919) % 100000 as bigint) AS lat7,
                   cast(-1800000 + (an % 25) * 150000 + (ref * 104729) % 150000 as bigint) AS lon7
            FROM (SELECT way_id, seq, CASE WHEN shared THEN a + CASE l_partkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 25 END ELSE a END AS an,
                         CASE WHEN shared THEN (a + CASE l_partkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 25 END) * 8 + l_suppkey % 8 ELSE 1000000000 + way_id * 64 + seq END AS ref
                  FROM (SELECT l_orderkey AS way_id, l_partkey, l_suppkey, {div('l_orderkey', 30)} AS a, (l_partkey + l_linenumber) % 3 = 0 AS shared,
                               cast(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 as bigint) AS seq
                        FROM lineitem) x) y""",
        "ways_flat": f"""
            SELECT o_orderkey AS way_id, o_custkey, {p(HIGHWAYS, '(o_orderkey*7 + o_custkey) % 20')} AS highway,
                   {p(NAMES, f'(o_orderkey*13 + {div("o_orderkey", 30)}) % 12')} AS name,
                   {", ".join(f"{p(v, i)} AS {k}" for k, v, i in TAGS)}
            FROM orders""",
        "shape_nodes": f"""
            SELECT way_id, seq * 2 AS seq, ref, lat7, lon7 FROM way_nodes
            UNION ALL
            SELECT way_id, seq * 2 + 1, cast(2000000000000 + way_id * 64 + seq as bigint), cast({div('(lat7 + lat2)', 2)} + (way_id + seq) % 5 * 100 as bigint), {div('(lon7 + lon2)', 2)}
            FROM (SELECT way_id, seq, lat7, lon7, lead(lat7) OVER (PARTITION BY way_id ORDER BY seq) AS lat2, lead(lon7) OVER (PARTITION BY way_id ORDER BY seq) AS lon2 FROM way_nodes) z
            WHERE lat2 IS NOT NULL""",
        "addresses": f"""
            SELECT o.o_orderkey AS obj_id, w.name AS street, cast(o.o_custkey % 120 + 1 as {'string' if dialect == 'spark' else 'varchar'}) || {p(['', 'a', ' b', '²', ''], 'o.o_orderkey % 5')} AS hn,
                   cast(490000000 + {div(div('o.o_orderkey', 30), 25)} * 100000 + (n.ref * 7919) % 100000 + (o.o_custkey % 600) * 100 as bigint) AS lat7, n.lon7 AS lon7
            FROM orders o JOIN ways_flat w ON w.way_id = o.o_orderkey JOIN way_nodes n ON n.way_id = o.o_orderkey AND n.seq = 0
            WHERE w.name IS NOT NULL""",
        "places": f"""
            SELECT s_suppkey AS place_id, {p("city town village suburb hamlet quarter neighbourhood borough".split(), 's_suppkey % 8')} AS kind, concat('Ort ', s_suppkey) AS name,
                   cast(490000000 + {div('s_suppkey', 5)} * 100000 + (s_suppkey * 7919) % 100000 as bigint) AS lat7,
                   cast(-1800000 + (s_suppkey % 5) * 750000 + (s_suppkey * 104729) % 750000 as bigint) AS lon7
            FROM supplier""",
        "munis": f"""
            SELECT m AS muni_id, CASE WHEN m % 3 = 0 OR m % 7 = 1 THEN 6 ELSE 8 END AS level,
                   CASE WHEN m % 4 = 0 THEN concat('Ort ', m * 10) ELSE concat('Gemeinde ', m) END AS name,
                   cast(490000000 + {div('m', 2)} * 400000 as bigint) AS y0, cast(-1800000 + (m % 2) * 1875000 as bigint) AS x0
            FROM (SELECT {div('s_suppkey', 10)} AS m FROM supplier WHERE s_suppkey % 10 = 0) x""",
        "muni_points": """
            SELECT muni_id, level, name, k AS seq,
                   y0 + CASE k WHEN 0 THEN 0 WHEN 1 THEN 30000 WHEN 2 THEN 0 WHEN 3 THEN 400000 WHEN 4 THEN 430000 ELSE 400000 END AS lat7,
                   x0 + CASE k WHEN 0 THEN 0 WHEN 1 THEN 937500 WHEN 2 THEN 1875000 WHEN 3 THEN 1875000 WHEN 4 THEN 937500 ELSE 0 END AS lon7
            FROM munis CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5)) AS v(k)""",
        "area_points": f"""
            SELECT area_id, tag_no, r, ring, seq, cast(cy + dy as bigint) AS lat7, cast(cx + dx as bigint) AS lon7
            FROM (SELECT p_partkey AS area_id, p_partkey % 14 AS tag_no, p_size * 2000 AS r,
                         490000000 + {div('p_partkey', 100)} * 100000 + (p_partkey * 7919) % 100000 AS cy,
                         -1800000 + (p_partkey % 100) * 37500 + (p_partkey * 104729) % 37500 AS cx, 0 AS ring, k AS seq,
                         CASE WHEN k IN (0, 4) THEN 0 WHEN k IN (1, 3) THEN {div('p_size * 2000 * 7', 10)} WHEN k = 2 THEN p_size * 2000 WHEN k IN (5, 7) THEN -{div('p_size * 2000 * 7', 10)} ELSE -p_size * 2000 END AS dy,
                         CASE WHEN k IN (2, 6) THEN 0 WHEN k IN (1, 7) THEN {div('p_size * 2000 * 7', 10)} WHEN k = 0 THEN p_size * 2000 WHEN k IN (3, 5) THEN -{div('p_size * 2000 * 7', 10)} ELSE -p_size * 2000 END AS dx
                  FROM part CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5), (6), (7)) AS v(k)
                  UNION ALL
                  SELECT p_partkey, p_partkey % 14, p_size * 2000,
                         490000000 + {div('p_partkey', 100)} * 100000 + (p_partkey * 7919) % 100000,
                         -1800000 + (p_partkey % 100) * 37500 + (p_partkey * 104729) % 37500, 1, k,
                         CASE WHEN k < 2 THEN {div('p_size * 2000', 4)} ELSE -{div('p_size * 2000', 4)} END,
                         CASE WHEN k IN (0, 3) THEN {div('p_size * 2000', 4)} ELSE -{div('p_size * 2000', 4)} END
                  FROM part CROSS JOIN (VALUES (0), (1), (2), (3)) AS v(k) WHERE p_partkey % 3 = 0) x""",
    }


USES = {"shape_nodes": ("way_nodes",), "addresses": ("ways_flat", "way_nodes"), "muni_points": ("munis",)}
TABLES = {"way_nodes": ("lineitem",), "ways_flat": ("orders",), "shape_nodes": (), "addresses": ("orders",), "places": ("supplier",), "munis": ("supplier",), "muni_points": (), "area_points": ("part",)}


def needed(names: tuple[str, ...]) -> list[str]:
    wanted = {x for n in names for x in (n, *USES.get(n, ()))}
    return [n for n in TABLES if n in wanted]


def oracle(*names: str) -> str:
    """``WITH`` clause of the views for DuckDB, without the last comma."""
    text = sql("duckdb")
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({text[n]})" for n in needed(names))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in as a DataFrame."""
    order, text = needed((name,)), sql("spark")
    sources = {t: table(spark, sf_dir, t) for n in order for t in TABLES[n]}
    with_ = ", ".join(f"{n} AS ({text[n]})" for n in order[:-1])
    # tables enter by name as parameters of the statement
    full = (f"WITH {with_} " if with_ else "") + text[name]
    for t in sources:
        full = full.replace(f"FROM {t}", f"FROM {{{t}}}")
    return spark.sql(full, **sources)


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(way_id, tags) with the tags as a map, as the library reads them."""
    w = view(spark, sf_dir, "ways_flat")
    names = ["highway", "name", *(k for k, _, _ in TAGS)]
    entries = F.array(*[F.struct(F.lit(COLON.get(k, k)).alias("key"), F.col(k).alias("value")) for k in names])
    return w.select("way_id", F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("tags"))
