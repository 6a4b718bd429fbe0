"""Networks by ranges against plain search."""

import random

from mapjobs.components import networks
from mapjobs.operators import network


def plain(edges):
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    while True:
        better = {n: min(root[a], root[b]) for a, b in edges if a != b for n in (a, b) if min(root[a], root[b]) < root[n]}
        if not better:
            return root
        root.update(better)


def test_networks(spark):
    r = random.Random(5)
    chain = [(i, i + 1) for i in range(0, 400) if i % 130]
    far = [(r.randint(-500, 500), r.randint(-500, 500)) for _ in range(250)]
    for edges in (chain, far, [(7, 7)], []):
        d = spark.createDataFrame(edges, "a long, b long").repartition(3)
        assert {x.node: x.root for x in networks(d, "a", "b").collect()} == plain(edges)


def test_main_mask_finds_networks_of_both_profiles_at_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(network, "networks", lambda *a: seen.append(1) or networks(*a))
    edges = [(1, 0, 0, i, i + 1, [5, None, 9 if i < 6 else None, None]) for i in range(10)] + [(2, 0, 0, 100, 101, [None, 4, 4, 4]), (3, 0, 0, -8, -7, [None, None, None, None])]
    d = spark.createDataFrame(edges, "way_id long, edge_no int, piece int, a long, b long, cost array<long>")
    got = {(x.way_id, x.a): x.main_mask for x in network.main_mask(d, least_nodes=3).collect()}
    assert got == {**{(1, i): 3 if i < 6 else 1 for i in range(10)}, (2, 100): 0, (3, -8): 0} and len(seen) == 1
