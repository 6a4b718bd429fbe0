"""Deltas of edges of many points, laid aside in pieces, against a plain loop."""

import random

import pytest
from pyspark.sql import Row, functions as F

from mapjobs.functions import geom as G
from mapjobs.operators import routing_tiles, tiles


def test_inner_deltas_of_long_edges(spark):
    r = random.Random(6)
    cases = []
    for n in (127, 128, 129, 256, 257, 1000):
        at, pts = (0, 0), []
        for _ in range(n):
            at = (at[0] + r.randint(-3000, 3000), at[1] + r.choice((5, 15, -25, r.randint(-3000, 3000))))
            pts.append(at)
        cases.append(pts)
    d = spark.createDataFrame([(i, [Row(lat7=x, lon7=y) for x, y in p]) for i, p in enumerate(cases)], "i int, pts array<struct<lat7:long,lon7:long>>")
    got = [r.x for r in d.select("i", G.inner_deltas(F.lit(0), F.lit(0), F.col("pts"), 10_000).alias("x")).orderBy("i").collect()]
    for pts, found in zip(cases, got):
        want, c = [], (0, 0)
        for p in pts:
            step = (round((p[0] - c[0]) / 10), round((p[1] - c[1]) / 10))
            want.append(step)
            c = (c[0] + step[0] * 10, c[1] + step[1] * 10)
        assert [tuple(x) for x in found] == want


def test_offsets_beyond_the_layout():
    """An edge whose inner points lie beyond a 16-bit offset has no bytes; without inner points it needs none."""
    edge = {"new_a": 0, "new_b": 1, "a_lat7": 0, "a_lon7": 0, "b_lat7": 1, "b_lon7": 1, "dm": 1, "cls": 0, "flags": 0, "main_mask": 0, "name_idx": None, "at": 65536, "costs": [1, 2, 3, 4], "deltas": []}
    nodes = [{"lat7": 0, "lon7": 0, "degree": 1}] * 2
    assert routing_tiles.pack_geometry_tile(nodes, [edge], [])[:1] == b"G"
    with pytest.raises(tiles.TooMany):
        routing_tiles.pack_geometry_tile(nodes, [edge | {"deltas": [{"dlat": 1, "dlon": 1}]}], [])
