"""Tag rules as Column expressions. ``t`` gives the Column of a tag (null when the tag is missing)."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, functions as F

Tags = Callable[[str], Column]

# Road classes, most important first, and the highway tags of each.
CLASSES = {
    "motorway": 0, "motorway_link": 0, "trunk": 1, "trunk_link": 1, "primary": 2, "primary_link": 2, "secondary": 3, "secondary_link": 3,
    "tertiary": 4, "tertiary_link": 4, "unclassified": 5, "residential": 5, "living_street": 5, "pedestrian": 5, "road": 5,
    "service": 6, "track": 7, "path": 8, "footway": 8, "steps": 8, "bridleway": 8, "cycleway": 9,
}
RAIL, WATER, PATH = 10, 11, 8
# Groups of tag values that the rules name.
SIDE_FOOTWAYS = ("sidewalk", "crossing", "traffic_island")
PRIVATE_SERVICE = ("parking_aisle", "driveway", "drive-through")
STREETS = ("motorway_link", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential", "living_street", "pedestrian", "service", "road", "primary_link", "secondary_link", "tertiary_link", "trunk_link")
BIG = ("motorway", "motorway_link", "trunk", "trunk_link")
MIDDLE = ("tertiary", "tertiary_link", "secondary", "secondary_link", "primary", "primary_link")
ALLOWED = ("yes", "true", "1", "designated", "permissive")
DENIED = ("no", "private")
CYCLEWAYS = ("cycleway", "cycleway:left", "cycleway:right", "cycleway:both")
CYCLE_LANES = ("lane", "track", "shared_busway", "share_busway", "opposite_lane", "opposite_track")
SURFACES = [  # values, factor by bicycle, factor on foot
    (("sett", "cobblestone", "unhewn_cobblestone", "cobblestone:flattened", "paving_stones:lanes"), 0.65, 0.9),
    (("compacted", "fine_gravel", "pebblestone"), 0.85, 0.95),
    (("gravel", "ground", "dirt", "earth", "sand", "grass", "mud", "unpaved", "woodchips", "grass_paver"), 0.55, 0.8),
]
ROUGH, ROUGH_FACTOR = ("bad", "very_bad", "horrible", "very_horrible", "impassable"), {"bike": 0.7, "foot": 0.85}
FOREST, LAKE, PARK, BUILT_UP, BUILDING = range(5)
DRAW_ORDER = {BUILT_UP: 0, PARK: 1, FOREST: 2, LAKE: 3, BUILDING: 4}
LEAST_M2 = {FOREST: 3000.0, LAKE: 400.0, PARK: 800.0, BUILT_UP: 4000.0, BUILDING: 0.0}
SIMPLIFY_M = {FOREST: 6.0, LAKE: 4.0, PARK: 4.0, BUILT_UP: 8.0, BUILDING: 0.6}
PLACE_KINDS = ("city", "town", "village", "suburb", "hamlet", "quarter", "neighbourhood", "borough")
#: Largest cost that an edge may have.
COST_LIMIT = 2**32 - 2


def of_map(column: str = "tags") -> Tags:
    return lambda key: F.col(column)[key]


def among(c: Column, values) -> Column:
    """Membership that is false, not null, for a missing tag."""
    return F.coalesce(c.isin(*values), F.lit(False))


def lookup(c: Column, table: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[c]


def road_class(t: Tags) -> Column:
    """Display class, null for what is not drawn. A way with a highway tag never becomes a railway or a river."""
    hw = t("highway")
    hidden = among(t("area"), ("yes",)) | (hw.eqNullSafe("footway") & among(t("footway"), SIDE_FOOTWAYS)) | (hw.eqNullSafe("service") & among(t("service"), PRIVATE_SERVICE))
    road = F.when(~hidden, lookup(hw, CLASSES))
    other = F.when(among(t("railway"), ("rail", "light_rail")), RAIL).when(among(t("waterway"), ("river", "canal")), WATER)
    return F.when(hw.isNotNull(), road).otherwise(other)


def area_type(t: Tags) -> Column:
    """Building, forest, water, park, built-up area, in this priority."""
    return (
        F.when(t("building").isNotNull() & ~among(t("building"), ("no",)), BUILDING)
        .when(among(t("natural"), ("wood",)) | among(t("landuse"), ("forest",)), FOREST)
        .when(among(t("natural"), ("water",)) | among(t("landuse"), ("reservoir", "basin")) | among(t("waterway"), ("riverbank",)), LAKE)
        .when(among(t("leisure"), ("park",)) | among(t("landuse"), ("grass", "village_green", "recreation_ground")), PARK)
        .when(among(t("landuse"), ("residential", "commercial", "industrial", "retail")), BUILT_UP)
    )


def _present(c: Column) -> Column:
    return c.isNotNull() & ~among(c, ("no",))


def _bits(*conditions: Column) -> Column:
    total = F.lit(0)
    for i, c in enumerate(conditions):
        total = total + F.when(c, 1 << i).otherwise(0)
    return total


def display_flags(t: Tags) -> Column:
    """1 one-way, 2 bridge, 4 tunnel."""
    one_way = among(t("oneway"), ("yes", "1", "true")) | among(t("junction"), ("roundabout",)) | among(t("highway"), ("motorway", "motorway_link"))
    return _bits(one_way, _present(t("bridge")), _present(t("tunnel")))


def edge_flags(t: Tags) -> Column:
    """1 roundabout, 2 bridge, 4 tunnel."""
    return _bits(among(t("junction"), ("roundabout", "circular")), _present(t("bridge")), _present(t("tunnel")))


def routable(t: Tags) -> Column:
    """P5, without the number of points."""
    return among(t("highway"), CLASSES) & ~among(t("area"), ("yes",))


def edge_class(t: Tags) -> Column:
    return F.coalesce(lookup(t("highway"), CLASSES), F.lit(PATH))


def named_street(t: Tags) -> Column:
    """P6, without the number of points."""
    return among(t("highway"), STREETS) & (F.coalesce(t("name"), F.lit("")) != "") & ~(t("highway").eqNullSafe("service") & among(t("service"), PRIVATE_SERVICE))


def municipality(t: Tags) -> Column:
    """P7, without the rings."""
    return among(t("boundary"), ("administrative",)) & among(t("admin_level"), ("6", "8")) & (F.coalesce(t("name"), F.lit("")) != "")


def place_node(t: Tags) -> Column:
    """P8."""
    return among(t("place"), PLACE_KINDS) & (F.coalesce(t("name"), F.lit("")) != "")


def address(t: Tags) -> Column:
    """P9, without the position."""
    return (F.coalesce(t("addr:housenumber"), F.lit("")) != "") & (F.coalesce(t("addr:street"), F.lit("")) != "")


def directions(t: Tags) -> tuple[Column, Column]:
    """(forward, backward) allowed for vehicles."""
    ow = t("oneway")
    implied = among(t("junction"), ("roundabout", "circular")) | among(t("highway"), ("motorway", "motorway_link"))
    forward = F.when(among(ow, ("-1", "reverse")), False).otherwise(True)
    backward = F.when(among(ow, ("yes", "true", "1")), False).when(among(ow, ("-1", "reverse", "no")), True).otherwise(~implied)
    return forward, backward


def contraflow(t: Tags) -> Column:
    """Bicycles may ride against the one-way direction."""
    opposite = F.lit(False)
    for k in CYCLEWAYS:
        opposite = opposite | F.coalesce(t(k).startswith("opposite"), F.lit(False))
    shared = among(t("bicycle"), ("yes", "designated")) & among(t("oneway"), ("yes", "-1")) & ~among(t("oneway:bicycle"), ("yes",)) & among(t("highway"), ("cycleway", "path", "track"))
    return among(t("oneway:bicycle"), ("no",)) | opposite | shared


def cycle_lanes(t: Tags) -> Column:
    """P13."""
    found = among(t("bicycle"), ("designated",))
    for k in CYCLEWAYS:
        found = found | among(t(k), CYCLE_LANES)
    return found


def surface_factor(t: Tags, mode: str) -> Column:
    """Speed factor of surface and smoothness; mode is bike or foot. Both factors' product is that of the decimals, rounded once."""
    rough = Decimal(str(ROUGH_FACTOR[mode]))

    def of_surface(by: Decimal) -> Column:
        f = F.lit(float(by))
        for values, bike, foot in reversed(SURFACES):
            f = F.when(among(t("surface"), values), float(Decimal(str(bike if mode == "bike" else foot)) * by)).otherwise(f)
        return f

    return F.when(among(t("smoothness"), ROUGH), of_surface(rough)).otherwise(of_surface(Decimal(1)))


def bike_speed(t: Tags) -> Column:
    """Effective km/h, null if not allowed."""
    hw, bike = t("highway"), t("bicycle")
    free = among(bike, ALLOWED)
    is_ = lambda *v: among(hw, v)
    grade = F.coalesce(lookup(t("tracktype"), {"grade1": 17.0, "grade2": 14.0, "grade3": 11.0, "grade4": 7.0, "grade5": 6.0}), F.lit(12.0))
    v = (
        F.when(is_("cycleway"), 20.0).when(is_("residential", "unclassified", "road"), 17.0).when(is_("living_street"), 13.0)
        .when(is_("service"), 14.0).when(is_("pedestrian"), F.when(free, 8.0).otherwise(4.5)).when(is_("track"), grade)
        .when(is_("path", "bridleway"), F.when(bike.eqNullSafe("designated"), 15.0).when(free, 12.0).otherwise(10.0))
        .when(is_("footway"), F.when(free, 12.0).otherwise(4.5)).when(is_("steps"), 1.5)
        .when(is_("tertiary", "tertiary_link"), 15.0).when(is_("secondary", "secondary_link"), 10.5).when(is_("primary", "primary_link"), 7.5)
        .otherwise(12.0)
    )
    v = F.when(is_(*MIDDLE) & cycle_lanes(t), F.least(v * 1.6, F.lit(17.0))).otherwise(v)
    v = F.when(is_(*BIG), F.when(free, 10.0)).otherwise(v)
    denied = among(F.coalesce(bike, t("vehicle"), t("access")), DENIED) & ~free
    return F.when(denied, None).when(bike.eqNullSafe("dismount"), 4.0).otherwise(v * surface_factor(t, "bike"))


def foot_speed(t: Tags) -> Column:
    """Effective km/h, null if not allowed."""
    hw, foot = t("highway"), t("foot")
    is_ = lambda *v: among(hw, v)
    v = (
        F.when(is_("cycleway"), 4.2)
        .when(is_("footway", "pedestrian", "path", "living_street", "residential", "unclassified", "road", "bridleway"), 5.0)
        .when(is_("steps"), 3.0).when(is_("service", "track"), 4.6).when(is_("tertiary", "tertiary_link"), 4.4)
        .when(is_("secondary", "secondary_link"), 3.4).when(is_("primary", "primary_link"), 2.4).otherwise(4.5)
    )
    denied = among(F.coalesce(foot, t("access")), DENIED) & ~among(foot, ALLOWED)
    denied = denied | is_(*BIG) | (is_("cycleway") & foot.eqNullSafe("no"))
    return F.when(~denied, v * surface_factor(t, "foot"))


def cost(length_m: Column, kmh: Column, extra_s: float = 0.0) -> Column:
    """Travel time in 0.1 s, null if the speed is."""
    return F.when(kmh > 0, F.least(F.rint((length_m / (kmh / 3.6) + extra_s) * 10).cast("long"), F.lit(COST_LIMIT)))


def travel(t: Tags) -> Column:
    """What costs need to know of a way: both speeds, and the directions open to bicycles. Worked out once a way, before edges are joined."""
    forward, backward = directions(t)
    against = contraflow(t)
    return F.struct(bike_speed(t).alias("bike"), foot_speed(t).alias("foot"), (forward | against).alias("ahead"), (backward | against).alias("back"))


def edge_costs(travel: Column, length_m: Column) -> Column:
    """Bicycle forward and backward, foot forward and backward."""
    bike, foot = cost(length_m, travel["bike"], 0.5), cost(length_m, travel["foot"])
    return F.array(F.when(travel["ahead"], bike), F.when(travel["back"], bike), foot, foot)


def saturated(c: Column) -> Column:
    """A cost as the tiles hold it, 65535 for not usable."""
    return F.when(c.isNotNull(), F.least(c, F.lit(65534))).otherwise(65535).cast("int")


def max_speed(v: Column) -> Column:
    """P20: km/h of a maxspeed text."""
    s = F.lower(F.trim(v))
    number = F.regexp_extract(s, r"^(\d+(?:\.\d+)?)\s*(mph)?", 1)
    mph = F.regexp_extract(s, r"^(\d+(?:\.\d+)?)\s*(mph)?", 2) == "mph"
    n = F.when(number != "", number.cast("double"))
    return F.when(s.isin("none", "signals"), 130.0).when(s == "walk", 7.0).when(mph, n * 1.609).otherwise(n)


def display_name(t: Tags) -> Column:
    """Name, else ref, else null."""
    return F.coalesce(F.nullif(t("name"), F.lit("")), F.nullif(t("ref"), F.lit("")))
