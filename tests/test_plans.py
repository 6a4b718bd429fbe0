"""Plans of queries whose tables grow: what must not reach the driver."""

from mapjobs.operators import areas
from mapjobs.plans import area_plans, graph_plans, job_plans

DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ways_are_not_broadcast(spark):
    for view in ("way_nodes", "shape_nodes"):
        assert "Broadcast" not in plan(job_plans._roads(spark, DIR, view)[1])
    assert "Broadcast" not in plan(graph_plans._edges(spark, DIR))
    assert "Broadcast" not in plan(graph_plans._roads(spark, DIR).features)


def test_relations_are_stitched_in_batches(spark):
    members = spark.createDataFrame([(a, s, r, refs) for a in (1, 2) for s, r, refs in [(0, "outer", [1, 2, 3]), (1, "inner", [7, 8, 9, 7]), (2, "outer", [1, 4, 3])]], "area_id long, seq int, role string, refs array<long>")
    rings = areas.stitched(members)
    assert "InPandas" not in plan(rings)
    assert sorted(map(tuple, rings.collect())) == sorted((a, i, role, refs) for a in (1, 2) for i, (role, refs) in enumerate([("inner", [7, 8, 9]), ("outer", [1, 2, 3, 4])]))


def test_paths_of_two_arcs_are_shuffled_once(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for query in (area_plans.u3_two_hops, area_plans.j8_remapped_arcs):
            assert plan(query(spark, DIR)).count("Exchange hashpartitioning") <= 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
