"""Address index: municipalities, streets, house numbers, and their ordered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from mapjobs.functions import geom as G, tags as R, text as X
from mapjobs.operators import spatial
from mapjobs.session import cut

# How far a place reaches (metres); the nearest place and the street of a number (degrees).
REACH = {"city": 12000.0, "town": 5000.0, "village": 2000.0}
NEAREST_DEG, NUMBER_DEG = 0.08, 0.006


def municipality_objects(areas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(municipalities (muni_id, level, name), their outer rings (poly, ring, seq, lat7, lon7)) of located rings (area_id, ring, role, tags, pts)."""
    a = areas.where(R.municipality(R.of_map()) & (F.col("role") != "inner"))
    munis = a.groupBy(F.col("area_id").alias("muni_id")).agg(F.first("tags").alias("tags")).select("muni_id", F.col("tags")["admin_level"].cast("int").alias("level"), F.col("tags")["name"].alias("name"))
    return munis, a.select(F.col("area_id").alias("poly"), "ring", F.posexplode("pts").alias("seq", "p")).select("poly", "ring", "seq", "p.lat7", "p.lon7")


def address_objects(nodes: DataFrame, ways: DataFrame, points: DataFrame) -> DataFrame:
    """(obj_id, street, hn, lat7, lon7) of nodes (node_id, lat7, lon7, tags) and ways (way_id, tags) with a house number and a street.

    obj_id is (0, node) or (1, way), so that nodes go before ways. A way lies at the mean of its located points (way_id, seq, lat7, lon7); a closed one
    counts the point where it closes twice."""
    t = R.of_map()
    told = lambda kind, key: (F.struct(F.lit(kind).alias("type"), F.col(key).alias("id")).alias("obj_id"), t("addr:street").alias("street"), t("addr:housenumber").alias("hn"))
    n = nodes.where(R.address(t)).select(*told(0, "node_id"), F.col("lat7").cast("double").alias("lat7"), F.col("lon7").cast("double").alias("lon7"))
    w = ways.where(R.address(t))
    mean = points.join(w.select("way_id"), "way_id", "left_semi").groupBy("way_id").agg(F.avg("lat7").alias("lat7"), F.avg("lon7").alias("lon7"))
    return n.unionByName(w.join(mean, "way_id").select(*told(1, "way_id"), "lat7", "lon7"))


def label_points(rings: DataFrame) -> DataFrame:
    """(poly, lat, lon): mean of the vertices of the ring with the largest box, the one where it closes counted twice. rings: (poly, ring, seq, lat7, lon7)."""
    area = (F.max("lon7") - F.min("lon7")) * (F.max("lat7") - F.min("lat7"))
    mean = lambda c: (F.sum(c) + F.min_by(c, "seq")) / (F.count("*") + 1)
    r = rings.groupBy("poly", "ring").agg(area.alias("box"), mean("lat7").alias("lat"), mean("lon7").alias("lon"))
    best = r.groupBy("poly").agg(F.max_by(F.struct("lat", "lon"), F.struct("box", -F.col("ring"))).alias("p"))
    return best.select("poly", "p.lat", "p.lon")


def kept_municipalities(munis: DataFrame, rings: DataFrame) -> DataFrame:
    """All of level 8, and those of level 6 without the label point of one of level 8. munis: (muni_id, level, name)."""
    labels = label_points(rings)
    m = munis.join(labels.withColumnRenamed("poly", "muni_id"), "muni_id")
    points = m.where("level = 8").select(F.col("muni_id").alias("pid"), F.col("lat").alias("lat7"), F.col("lon").alias("lon7"))
    outer = rings.join(munis.where("level = 6").select(F.col("muni_id").alias("poly")), "poly", "left_semi")
    full = spatial.points_in_polygons(points, spatial.ring_edges(outer)).select(F.col("poly").alias("muni_id")).distinct()
    return m.join(full, "muni_id", "left_anti")


def street_ways(lines: DataFrame, samples: int = 12) -> DataFrame:
    """(way_id, name, lat7, lon7, samples): the middle vertex, and every max(1, n // ``samples``)-th one with the last. lines: (way_id, name, pts)."""
    mid = F.col("pts")[F.floor(F.size("pts") / 2).cast("int")]
    every = F.greatest(F.lit(1), F.floor(F.size("pts") / samples)).cast("int")
    taken = F.concat(F.filter("pts", lambda p, i: F.pmod(i, every) == 0), F.array(F.element_at("pts", -1)))
    return lines.select("way_id", "name", mid["lat7"].alias("lat7"), mid["lon7"].alias("lon7"), taken.alias("samples"))


def municipality_of(streets: DataFrame, munis: DataFrame, rings: DataFrame) -> DataFrame:
    """(way_id, muni_id): the first municipality that contains the middle vertex."""
    own = rings.join(munis.select(F.col("muni_id").alias("poly")), "poly", "left_semi")
    inside = spatial.points_in_polygons(streets.select(F.col("way_id").alias("pid"), "lat7", "lon7"), spatial.ring_edges(own))
    return inside.groupBy(F.col("pid").alias("way_id")).agg(F.min("poly").alias("muni_id"))


def town_of(streets: DataFrame, munis: DataFrame, rings: DataFrame, places: DataFrame) -> DataFrame:
    """(way_id, muni_id, place_id): for streets (way_id, muni_id, lat7, lon7) of level-6 districts the city, town or village inside the district
    whose distance over its reach is least (and at most 1); the first of equal ones. Other streets are not in the result."""
    reach = F.create_map(*[F.lit(x) for kv in REACH.items() for x in kv])[F.col("kind")]
    p = places.withColumn("reach", reach).where("reach is not null")
    districts = munis.where("level = 6").select("muni_id")
    own = rings.join(districts.select(F.col("muni_id").alias("poly")), "poly", "left_semi")
    inside = spatial.points_in_polygons(p.select(F.col("place_id").alias("pid"), "lat7", "lon7"), spatial.ring_edges(own))
    p = p.join(inside.select(F.col("pid").alias("place_id"), F.col("poly").alias("muni_id")), "place_id").select("muni_id", "place_id", "reach", F.col("lat7").alias("olat7"), F.col("lon7").alias("olon7"))
    pairs = spatial.near(streets.join(districts, "muni_id", "left_semi"), p, max(REACH.values()) / 110000.0, ["muni_id"])
    metres = F.hypot(G.degrees(F.col("olon7") - F.col("lon7")) * G.lon_metres(F.col("lat7")), G.degrees(F.col("olat7") - F.col("lat7")) * G.M_LAT)
    pairs = pairs.withColumn("m", metres).where("m <= reach")
    return pairs.groupBy("way_id", "muni_id").agg(F.min_by("place_id", F.struct(F.col("m") / F.col("reach"), F.col("place_id"))).alias("place_id"))


def nearest_place(streets: DataFrame, places: DataFrame) -> DataFrame:
    """(way_id, place_id): the nearest place nearer than 0.08 scaled degrees, the first of equal ones.

    An eighth of that is searched first, in cells as much smaller: where places are dense, few of them are met, and streets with an answer
    take no part in the wide search."""
    o = places.select("place_id", F.col("lat7").alias("olat7"), F.col("lon7").alias("olon7"))
    best = lambda q, r: spatial.near(q, o, r).where(F.col("d2") < r**2).groupBy("way_id").agg(F.min_by("place_id", F.struct("d2", "place_id")).alias("place_id"))
    q = streets.select("way_id", "lat7", "lon7")
    close = cut(best(q, NEAREST_DEG / 8))
    return close.unionByName(best(q.join(close, "way_id", "left_anti"), NEAREST_DEG))


def streets(ways: DataFrame, munis: DataFrame, rings: DataFrame, places: DataFrame) -> DataFrame:
    """A2: (street_id, muni, muni_name, mlat7, mlon7, fold, sub, name, lat7, lon7, samples), one row for each street of a municipality and part of town.

    ways: see street_ways. A street belongs to its municipality, or in a district to its town; its part of town is the nearest place, unless that has
    the municipality's name. The first way gives the shown name and position, and the street's number. Ways outside all municipalities and
    names that fold to nothing are left out.
    """
    placed = cut(ways.join(municipality_of(ways, munis, rings), "way_id"))  # three joins start from it
    towns = town_of(placed.select("way_id", "muni_id", "lat7", "lon7"), munis, rings, places).select("way_id", F.col("place_id").alias("town_id"))
    part = nearest_place(placed, places).join(places.select("place_id", F.col("name").alias("part")), "place_id").select("way_id", "part")
    town = places.select(F.col("place_id").alias("town_id"), F.col("name").alias("town"), F.col("lat7").cast("double").alias("tlat"), F.col("lon7").cast("double").alias("tlon"))
    s = placed.join(towns, "way_id", "left").join(town, "town_id", "left").join(part, "way_id", "left").join(munis.select("muni_id", F.col("name").alias("muni_label"), "lat", "lon"), "muni_id")
    s = s.withColumn("fold", X.fold(F.col("name"))).where("fold <> ''")
    s = s.withColumn("muni", F.concat_ws("/", F.col("muni_id").cast("string"), F.col("town_id").cast("string"))).withColumn("muni_name", F.coalesce("town", "muni_label"))
    s = s.withColumn("sub", F.when(~X.fold(F.col("part")).eqNullSafe(X.fold(F.col("muni_name"))), F.col("part")))
    g = s.groupBy("muni", "muni_name", F.coalesce("tlat", "lat").alias("mlat7"), F.coalesce("tlon", "lon").alias("mlon7"), "fold", "sub").agg(
        F.min("way_id").alias("street_id"), F.min_by(F.struct("name", "lat7", "lon7"), "way_id").alias("w"), F.flatten(F.collect_list("samples")).alias("samples"))
    return g.select("street_id", "muni", "muni_name", "mlat7", "mlon7", "fold", "sub", "w.name", "w.lat7", "w.lon7", "samples")


def house_numbers(addresses: DataFrame, streets: DataFrame) -> DataFrame:
    """(street_id, number, lat7, lon7). addresses: (obj_id, street, hn, lat7, lon7); streets: (street_id, fold, samples).

    A number goes to the street of the same folded name with the nearest sample within 0.006 scaled degrees (the first of equal ones); the
    join is on name and cell, so a name that thousands of streets share meets few at a time. Of equal numbers of a street the first object's stays.
    """
    a = addresses.withColumn("fold", X.fold(F.col("street"))).withColumn("number", X.house_number(F.col("hn")))
    o = streets.select("street_id", "fold", F.explode("samples").alias("p")).select("street_id", "fold", F.col("p.lat7").alias("olat7"), F.col("p.lon7").alias("olon7"))
    best = spatial.near(a, o, NUMBER_DEG, ["fold"]).groupBy("obj_id").agg(F.min_by("street_id", F.struct("d2", "street_id")).alias("street_id"), F.first(F.struct("number", "lat7", "lon7")).alias("n"))
    best = best.where("n.number <> ''")
    kept = best.groupBy("street_id", F.upper("n.number")).agg(F.min_by("n", "obj_id").alias("n"))
    return kept.select("street_id", "n.number", F.rint("n.lat7").cast("long").alias("lat7"), F.rint("n.lon7").cast("long").alias("lon7"))


def summary(places: DataFrame, streets: DataFrame, numbers: DataFrame) -> DataFrame:
    """One row with the numbers of places, streets and house numbers of the written tables."""
    count = lambda d, name: d.agg(F.count("*").alias(name))
    return count(places, "places").join(F.broadcast(count(streets, "streets"))).join(F.broadcast(count(numbers, "numbers")))  # one row each


def running_before(df: DataFrame, order: list, sums: dict[str, str]) -> DataFrame:
    """df with, for each (name: value) of ``sums``, the sum of ``value`` over all rows before each one in ``order``.

    Rows are dealt into ranges of the order, about equal ones whatever the values; one window runs over the ranges' totals, and one within each range."""
    d = cut(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    ahead = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    totals = d.groupBy("__part").agg(*[F.sum(v).alias(f"__t_{n}") for n, v in sums.items()])
    totals = totals.select("__part", *[F.coalesce(F.sum(f"__t_{n}").over(ahead), F.lit(0)).alias(f"__b_{n}") for n in sums])
    here = W.partitionBy("__part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    within = {f"__w_{n}": F.coalesce(F.sum(v).over(here), F.lit(0)) for n, v in sums.items()}
    out = d.withColumns(within).join(totals, "__part").withColumns({n: (F.col(f"__b_{n}") + F.col(f"__w_{n}")).cast("long") for n in sums})
    return out.drop("__part", *within, *[f"__b_{n}" for n in sums])


def address_tables(streets: DataFrame, numbers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(places, streets, numbers) in written order with pointers from each to the next.

    places: pos, fold, name, lat7, lon7, first_street, streets. streets: pos, fold, name, sub, lat7, lon7, first_number, numbers. numbers: pos, number,
    lat7, lon7. Places go by folded name, streets by place, folded name and part of town, numbers by street, digits and text. Places without streets
    do not occur. All running positions are two-phase sums (``running_before``).
    """
    counts = numbers.groupBy("street_id").agg(F.count("*").alias("numbers"))
    s = streets.join(counts, "street_id", "left").withColumn("numbers", F.coalesce("numbers", F.lit(0))).withColumn("one", F.lit(1)).withColumn("mfold", X.fold(F.col("muni_name")))
    order = ["mfold", "muni", "fold", F.coalesce("sub", F.lit("")), "street_id"]
    s = cut(running_before(s, order, {"pos": "one", "first_number": "numbers"}))  # the places and the numbers start from it
    p = s.groupBy("muni", "mfold", "muni_name", "mlat7", "mlon7").agg(F.min("pos").alias("first_street"), F.count("*").alias("streets")).withColumn("one", F.lit(1))
    p = running_before(p, ["mfold", "muni"], {"pos": "one"})
    n = numbers.join(s.select("street_id", "first_number"), "street_id")
    rank = F.row_number().over(W.partitionBy("street_id").orderBy(X.number_key(F.col("number")), "number")) - 1
    whole = lambda c: F.rint(c).cast("long")
    return (
        p.select("pos", F.col("mfold").alias("fold"), F.col("muni_name").alias("name"), whole(F.col("mlat7")).alias("lat7"), whole(F.col("mlon7")).alias("lon7"), "first_street", "streets"),
        s.select("pos", "fold", "name", "sub", "lat7", "lon7", "first_number", "numbers"),
        n.select((F.col("first_number") + rank).alias("pos"), "number", "lat7", "lon7"),
    )


def name_pool(places: DataFrame, streets: DataFrame) -> DataFrame:
    """(name, at): each distinct name (cut to 120 bytes) once, with its byte offset; a length byte stands before every name.

    Names come in order of first use: a street's part of town, the street, and after a place's streets the place itself."""
    s = streets.select(F.col("pos").alias("k"), F.lit(0).alias("kind"), F.array(F.struct(F.lit(0).alias("i"), F.col("sub").alias("name")), F.struct(F.lit(1).alias("i"), F.col("name").alias("name"))).alias("ns"))
    p = places.select((F.col("first_street") + F.col("streets") - 1).alias("k"), F.lit(1).alias("kind"), F.array(F.struct(F.lit(0).alias("i"), F.col("name").alias("name"))).alias("ns"))
    every = s.unionByName(p).select("k", "kind", F.explode("ns").alias("n")).where("n.name is not null")
    first = every.groupBy("n.name").agg(F.min(F.struct("k", "kind", "n.i")).alias("u")).withColumn("name", X.cut_bytes(F.col("name"), 120))
    first = first.withColumn("bytes", (F.octet_length("name") + 1).cast("long"))
    return running_before(first, ["u"], {"at": "bytes"}).select("name", "at")
