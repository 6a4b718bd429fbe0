"""All registered queries of the map jobs, and their SQL."""

from __future__ import annotations

from mapjobs.plans import address_plans, area_plans, graph_plans, job_plans, tag_plans

PLANS = (tag_plans, graph_plans, address_plans, area_plans, job_plans)
FLAGSHIP = graph_plans.t1_w6_b1_road_tiles


def queries() -> dict:
    return {name: q for plan in PLANS for name, q in plan.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for plan in PLANS for name, text in plan.ORACLES.items()}
