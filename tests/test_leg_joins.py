"""Joins of legs: what their plans may hold, and cases at the edges of squares and boxes."""

import math
import random

from wayfold.operators import build, spatial, transfer
from wayfold.plans import graph_queries, reference

LINES = [(1, [(0.0, 0.0), (200.0, 10.0)]), (2, [(64.0, -50.0), (64.0, 80.0)]), (3, [(0.0, 0.0), (0.0, 64.0), (0.0, 0.0)]), (4, [(-10.0, 64.0), (10.0, 64.0)]), (5, [(200.0, 11.0), (0.0, 1.0)])]


def lines(spark):
    return spark.createDataFrame(LINES, "edge_id bigint, points array<struct<x:double,y:double>>")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def joins(df):
    """The lines of a plan that join, with their conditions."""
    return [x.lower() for x in plan(df).splitlines() if "Join" in x]


def test_crossings_stand_in_their_square(spark):
    c = build.crossings(lines(spark))
    got = sorted((r.edge_id_a, r.edge_id_b, round(r.x, 6), round(r.y, 6)) for r in c.collect())
    assert got == [(1, 2, 64.0, 3.2), (1, 3, 0.0, 0.0), (2, 5, 64.0, 4.2), (3, 4, 0.0, 64.0), (3, 5, 0.0, 1.0)]
    assert plan(c).count("Exchange hashpartitioning") == 2  # the join's; equal points are not sent about to be found


def test_near_crosses_join_on_boxes_only(spark):
    n = build.near_crosses(lines(spark), metres=70.0)
    assert {(r.edge_id_a, r.edge_id_b): round(r.distance_m) for r in n.collect()} == {(2, 4): 54}
    assert joins(n) and not any("hypot" in x for x in joins(n))


def test_parallel_stretches_join_on_boxes_only(spark):
    n = build.near_overlaps(lines(spark))
    assert [(r.edge_id_a, r.edge_id_b, round(r.length)) for r in n.collect()] == [(1, 5, 200)]
    assert joins(n) and not any("acos" in x or "hypot" in x for x in joins(n))


def test_parallel_stretches_sift_pairs_in_the_join(spark):
    """The join itself leaves out pairs at an angle, and none that the exact tests keep, at their edges too."""
    n = build.near_overlaps(lines(spark))
    assert all(" * " in x for x in joins(n))
    draw = random.Random(7)
    legs = [(0.0, 0.0, 60.0, 0.0), (58.0, 1.25, 90.0, 1.25), (10.0, -1.25, 30.0, -1.25), (30.0, 0.5, 10.0, 0.5), (5.0, 0.0, 7.0, 0.0), (20.0, 1.0, 20.0, 1.0), (61.0, 0.0, 59.0, 0.0)]
    legs += [(40.0, 0.0, 40.0 + 50 * math.cos(math.radians(t)), 50 * math.sin(math.radians(t))) for t in (5, 19.999, 20, 20.001, 90, 160, 180)]
    for _ in range(150):
        x, y, t, r = draw.uniform(0, 60), draw.uniform(0, 20), draw.uniform(0, 7), draw.uniform(0.5, 60)
        legs.append((x, y, x + r * math.cos(t), y + r * math.sin(t)))

    def from_leg(p, c, d):
        q = (d[0] - c[0]) ** 2 + (d[1] - c[1]) ** 2
        t = max(0.0, min(1.0, ((p[0] - c[0]) * (d[0] - c[0]) + (p[1] - c[1]) * (d[1] - c[1])) / q)) if q else 0.0
        return math.hypot(p[0] - c[0] - t * (d[0] - c[0]), p[1] - c[1] - t * (d[1] - c[1]))

    def along(g, h):
        a, b, c, d = g[:2], g[2:], h[:2], h[2:]
        u, v = (b[0] - a[0], b[1] - a[1]), (d[0] - c[0], d[1] - c[1])
        n, m = math.hypot(*u), math.hypot(*v)
        if not n or not m or math.degrees(math.acos(min(1.0, abs(u[0] * v[0] + u[1] * v[1]) / (n * m)))) > 20.0:
            return None
        k = [((p[0] - a[0]) * u[0] + (p[1] - a[1]) * u[1]) / n for p in (c, d)]
        s, e = max(0.0, min(k)), min(n, max(k))
        at = lambda x: (a[0] + x / n * u[0], a[1] + x / n * u[1])
        return e - s if e - s >= 2.0 and from_leg(at(s), c, d) <= 1.25 and from_leg(at(e), c, d) <= 1.25 else None

    want = {(i, j): round(x, 6) for i, g in enumerate(legs) for j, h in enumerate(legs) if i < j and (x := along(g, h)) is not None}
    given = spark.createDataFrame([(i, [g[:2], g[2:]]) for i, g in enumerate(legs)], "edge_id bigint, points array<struct<x:double,y:double>>")
    got = {(r.edge_id_a, r.edge_id_b): round(r.length, 6) for r in build.near_overlaps(given).collect()}
    assert len(want) > 30 and {(0, 1), (0, 2), (0, 3), (0, 4), (0, 13)} <= set(want) and not {(0, 5), (0, 6)} & set(want)
    assert got == want


def test_parallel_stretches_send_only_what_picks_the_load(spark, monkeypatch):
    """Of a segment the shuffle has key, load and text; the latest load's line is the one that counts, as in metric_lines."""
    here = "/root/testdata/sf0.001"
    sent = plan(reference.bare_lines(spark, here))
    assert "geom" in sent and not any(c in sent for c in ("surface_state", "walk_access", "from_node_id"))
    bare, full = reference.bare_lines(spark, here), reference.metric_lines(spark, here).select("edge_id", "points")
    assert bare.count() == full.count() and not bare.exceptAll(full).count() and not full.exceptAll(bare).count()
    monkeypatch.setattr(graph_queries.build, "near_overlaps", lambda df: df.withColumnsRenamed({"edge_id": "edge_id_a"}).selectExpr("edge_id_a", "edge_id_a edge_id_b", "1D length"))
    assert "surface_state" not in plan(graph_queries.parallel_stretches(spark, here))


def test_lines_meet_regions_by_legs_that_enter_the_box(spark):
    holed = [[[(60.0, -5.0), (70.0, -5.0), (70.0, 20.0), (60.0, 20.0)], [(62.0, -1.0), (68.0, -1.0), (68.0, 15.0), (62.0, 15.0)]], [[(100.0, 0.0), (300.0, 0.0), (300.0, 50.0), (100.0, 50.0)]]]
    far = [[[(5.0, 20.0), (30.0, 20.0), (30.0, 60.0), (5.0, 60.0)]]]
    regions = spark.createDataFrame([(1, holed), (2, far)], "shape bigint, parts array<array<array<struct<x:double,y:double>>>>")
    o = spatial.lines_in_regions(lines(spark), regions, "edge_id", "shape")
    got = {(r.edge_id, r["shape"]): round(r.overlap_m, 3) for r in o.collect()}
    slope = (200.0**2 + 10.0**2) ** 0.5 / 200.0
    assert got == {(1, 1): round(104 * slope, 3), (2, 1): 9.0, (5, 1): round(104 * slope, 3)}
    assert not any("distinct" in x.lower() or "keys=[edge_id" in x.lower() for x in plan(o).splitlines())


def test_a_region_is_sent_once_to_its_legs(spark):
    """The shape is in no row of a leg; it holds for legs of later batches too."""
    ring = [(0.0, 0.0), (100.0, 0.0), (100.0, 100.0), (0.0, 100.0)]
    regions = spark.createDataFrame([(k, [[[(x + 1000.0 * k, y) for x, y in ring]]]) for k in range(3)], "shape bigint, parts array<array<array<struct<x:double,y:double>>>>")
    many = spark.createDataFrame([(i, [(1000.0 * (i % 3) + 50.0, float(i % 90)), (1000.0 * (i % 3) + 150.0, float(i % 90))]) for i in range(60)], "edge_id bigint, points array<struct<x:double,y:double>>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        o = spatial.lines_in_regions(many, regions, "edge_id", "shape")
        got = {(r.edge_id, r["shape"]): round(r.overlap_m, 6) for r in o.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {(i, i % 3): 50.0 for i in range(60) if i} | {(0, 0): got[(0, 0)]}
    assert not any("parts" in x for x in joins(o))
    assert "isnull(parts" in plan(o).lower()


def test_near_lines_join_on_boxes_only(spark):
    spots = spark.createDataFrame([(1, [(64.0, 4.0)]), (2, [(0.5, 30.0)]), (3, [(500.0, 500.0)])], "vertex_id bigint, points array<struct<x:double,y:double>>")
    n = transfer.near_lines(spots, lines(spark), "vertex_id", "edge_id", 1.0)
    assert {(r.vertex_id, r.edge_id): round(r.distance_m, 2) for r in n.collect()} == {(1, 1): 0.8, (1, 2): 0.0, (1, 5): 0.2, (2, 3): 0.5}
    assert joins(n) and not any("hypot" in x for x in joins(n))
