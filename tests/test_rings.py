"""Rings of relations: loops that touch, loose ends, broken outlines, against what must hold of any assembly."""

import random
import time

from pyspark.sql import functions as F

from mapjobs.operators import areas


def has_cycle(ends):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in ends:
        if find(a) == find(b):
            return True
        parent[find(a)] = find(b)
    return False


def check(ends):
    rings = areas.rings_of(ends)
    used = [i for r in rings for i, _ in r]
    assert len(used) == len(set(used))
    for r in rings:
        nodes = [ends[i] if f else ends[i][::-1] for i, f in r]
        assert all(x[1] == y[0] for x, y in zip(nodes, nodes[1:] + nodes[:1]))
        assert len({x[0] for x in nodes}) == len(nodes)  # no node twice: touching rings are apart
        assert r[0][1] and r[0][0] == min(i for i, _ in r)
    assert not has_cycle([e for i, e in enumerate(ends) if i not in set(used)])
    return rings


def test_random_outlines():
    r = random.Random(2)
    for _ in range(2000):
        ends = []
        for _ in range(r.randint(1, 4)):  # rings over few nodes touch often
            n = r.sample(range(12), r.randint(1, 5))
            ends += [(a, b) if r.random() < 0.5 else (b, a) for a, b in zip(n, n[1:] + n[:1])]
        even = len(ends)
        for _ in range(r.choice((0, 0, 2))):
            ends.append((r.randrange(12), r.randrange(12, 16)))
        r.shuffle(ends)
        rings = check(ends)
        if even == len(ends):  # every node has an even number of ends: nothing is left
            assert sum(map(len, rings)) == even


def test_two_rings_at_one_node_in_any_order():
    # both pass node 0; a walk that goes on from 0 into the other ring would close neither by itself
    ends = [(0, 1), (0, 11), (2, 0), (12, 0), (1, 2), (11, 12)]
    assert areas.rings_of(ends) == [[(0, True), (4, True), (2, True)], [(1, True), (5, True), (3, True)]]


def test_long_outline_is_linear():
    n = 100_000
    ends = [(i, (i + 1) % n) for i in range(n)] + [(i, n + i) for i in range(0, n, 10)]  # with loose ends
    random.Random(1).shuffle(ends)
    began = time.time()
    rings = areas.rings_of(ends)
    assert len(rings) == 1 and len(rings[0]) == n and time.time() - began < 10


def test_relations(spark):
    rows = [
        (1, 0, "outer", [1, 2, 3]), (1, 1, "outer", [1, 8, 9]), (1, 2, "outer", [9, 7, 1]), (1, 3, "outer", [3, 4, 1]),  # two rings touch at 1
        (1, 4, "inner", [20, 21, 22, 20]), (1, 5, "inner", [20, 21, 22, 20]),  # the same hole twice
        (2, 0, "outer", [1, 2, 3]), (2, 1, "outer", [3, 4, 5]),  # open
        (3, 0, "outer", [5, 6, 7]), (3, 1, "outer", [50, 51, 5]), (3, 2, "outer", [5, 9, 7]),  # a ring with a way that leads away
        (4, 0, "outer", [1]), (4, 1, "outer", [1, 2]), (4, 2, "outer", [2, 1]),  # too short
    ]
    d = spark.createDataFrame(rows, "area_id long, seq int, role string, refs array<long>").orderBy(F.rand(1))
    got = sorted((r.area_id, r.ring, r.role, r.refs) for r in areas.stitched(d).collect())
    assert got == [(1, 0, "inner", [20, 21, 22]), (1, 1, "outer", [1, 2, 3, 4]), (1, 2, "outer", [1, 8, 9, 7]), (3, 0, "outer", [5, 6, 7, 9])]
