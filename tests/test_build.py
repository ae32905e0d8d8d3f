"""Graph building on small fixtures."""

import random

from pyspark.sql import functions as F

from wayfold.functions import geo
from wayfold.operators import build

LINES = "edge_id long, points array<struct<x:double,y:double>>"


def test_corners_and_crossings(spark):
    df = spark.createDataFrame([(1, [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (12.0, 20.0)]), (2, [(0.0, 5.0), (20.0, 5.0)]), (3, [(100.0, 0.0), (150.0, 90.0)]), (4, [(100.0, 90.0), (150.0, 0.0)])], LINES)
    assert {(r.edge_id, r.m) for r in build.corner_cuts(df, 45.0).collect()} == {(1, 10.0)}
    assert {(r.edge_id_a, r.edge_id_b, round(r.x, 6), round(r.y, 6)) for r in build.crossings(df).collect()} == {(1, 2, 10.0, 5.0), (3, 4, 125.0, 45.0)}


def test_chains(spark):
    df = spark.createDataFrame([(1, 1, 2), (2, 2, 3), (3, 3, 4), (4, 3, 5), (5, 5, 6), (6, 8, 8)], "edge_id long, from_node_id long, to_node_id long")
    assert {r.edge_id: r.chain for r in build.chains(df).collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6}


def test_crossings_of_long_legs_equal_brute_force(spark):
    rnd = random.Random(6)
    at = lambda: (rnd.random() * 3000, rnd.random() * 3000)
    rows = [(i, [at(), at(), at()] if i % 3 else [(v := at()), (v[0] + 9, v[1] + 5)]) for i in range(60)]
    df = spark.createDataFrame(rows, LINES)

    def meet(a, b, c, d):
        den = (b[0] - a[0]) * (d[1] - c[1]) - (b[1] - a[1]) * (d[0] - c[0])
        if not den:
            return False
        t = ((c[0] - a[0]) * (d[1] - c[1]) - (c[1] - a[1]) * (d[0] - c[0])) / den
        u = ((c[0] - a[0]) * (b[1] - a[1]) - (c[1] - a[1]) * (b[0] - a[0])) / den
        return 0 <= t <= 1 and 0 <= u <= 1

    want = {(i, j) for i, p in rows for j, q in rows if i < j for a, b in zip(p, p[1:]) for c, d in zip(q, q[1:]) if meet(a, b, c, d)}
    assert len(want) > 100 and {(r.edge_id_a, r.edge_id_b) for r in build.crossings(df).collect()} == want


def test_near_crosses_and_overlaps(spark):
    df = spark.createDataFrame([(1, [(0.0, 0.0), (100.0, 0.0)]), (2, [(50.0, 2.0), (50.0, 40.0)]), (3, [(20.0, 1.0), (60.0, 1.2)]), (4, [(300.0, 2.0), (400.0, 2.0)])], LINES)
    assert {(r.edge_id_a, r.edge_id_b): (round(r.distance_m, 3), round(r.turn, 1)) for r in build.near_crosses(df).collect()} == {(1, 2): (2.0, 90.0), (2, 3): (0.85, 89.7)}
    got = {(r.edge_id_a, r.edge_id_b): (round(r.length, 2), round(r.x, 1)) for r in build.near_overlaps(df).collect()}
    assert got == {(1, 3): (40.0, 40.0)}


def test_self_scan(spark):
    kind = lambda i, *ps: (i, "SIDE_LEFT", [(float(x), float(y)) for x, y in ps])
    rows = [
        kind(1, (0, 0), (100, 0)), kind(2, (100, 0), (200, 0)), kind(3, (100, 0), (100, 12)),  # a dangling tail of 12 m
        kind(4, (200, 0), (200.2, 5)), kind(5, (200.2, 5), (300, 9)), kind(6, (200, 0), (300, 40)),  # 4: short, both ends shared
        kind(7, (900, 900), (905, 900)),  # stands alone
        (8, "GAP_BRIDGE", [(0.0, 0.0), (0.0, 13.0)]), kind(9, (0, 13), (0, 90)),  # a short bridge with both ends shared
        kind(10, (500, 0), (540, 0)), kind(11, (500, 0), (500, 70)), kind(12, (500, 0), (430, 0)), kind(13, (500, 0), (500, -70)),  # four ends at one place, 10 is below 42 m
        (14, "OTHER", [(0.0, 0.0), (0.0, -5.0)]),
    ]
    df = spark.createDataFrame(rows, "edge_id long, segment_type string, points array<struct<x:double,y:double>>")
    assert {r.edge_id: r.reason for r in build.anomalies(df).collect()} == {3: "DANGLING_TAIL", 4: "MICRO_LOOP", 8: "BRIDGE_ARTIFACT", 10: "DENSE_TAIL"}
    left, removed, settled = build.self_scan(df)
    assert removed[0] == 4 and removed[-1] == 0 and settled and {7, 14} <= {r.edge_id for r in left.collect()}
    assert build.anomalies(df.withColumn("made_by_repair", F.lit(True))).count() == 0


def test_edits(spark):
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (2, 10.0, 0.0), (3, 50.0, 0.0)], "vertex_id long, x double, y double")
    seg = spark.createDataFrame([(1, 1, 2), (2, 2, 3)], "edge_id long, from_node_id long, to_node_id long")
    edits = spark.createDataFrame(
        [(1, "delete_segment", 2, None, None, None, None, None), (2, "delete_node", None, 3, None, None, None, None), (3, "delete_node", None, 1, None, None, None, None), (4, "add_segment", None, None, 10.4, 0.0, 30.0, 0.0), (5, "add_segment", None, None, 30.3, 0.0, 40.0, 0.0)],
        "seq long, action string, edge_id long, vertex_id long, x double, y double, x2 double, y2 double",
    )
    n, s = build.apply_edits(nodes, seg, edits)
    assert {r.vertex_id for r in n.collect()} == {1, 2, 4, 5}
    assert {(r.edge_id, r.from_node_id, r.to_node_id) for r in s.collect()} == {(1, 1, 2), (3, 2, 4), (4, 4, 5)}


def test_regions(spark):
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (2, 10.0, 0.0)], "vertex_id long, x double, y double")
    seg = spark.createDataFrame([(1, 1, 2)], "edge_id long, from_node_id long, to_node_id long")
    more = spark.createDataFrame([(1, 12.0, 0.0), (2, 90.0, 0.0)], "vertex_id long, x double, y double")
    n, s = build.merge_regions(nodes, seg, more, seg)
    assert {(r.vertex_id, r.x) for r in n.collect()} == {(1, 0.0), (2, 10.0), (3, 90.0)}
    assert {(r.edge_id, r.from_node_id, r.to_node_id) for r in s.collect()} == {(1, 1, 2), (2, 2, 3)}


def test_learned_lengths(spark):
    e = spark.createDataFrame([("delete_segment", float(v)) for v in (5, 10, 20, 30)] + [("add_segment", float(v)) for v in (4, 8, 16)], "action string, length double")
    r = build.learned_lengths(e).first()
    assert (r.delete_max, r.add_min, r.add_max) == (20.0, 4.0, 20.0)
    assert build.learned_lengths(e.where(F.lit(False))).first().delete_max == 35.0


def test_side_lines_and_zones(spark):
    df = spark.createDataFrame([(1, [(0.0, 0.0), (10.0, 0.0)], 6.0), (2, [(0.0, 0.0), (10.0, 0.0)], None)], LINES + ", width double")
    got = {(r.edge_id, r.side): r.points[0].y for r in build.side_lines(df).collect()}
    assert got == {(1, "LEFT"): 3.0, (1, "RIGHT"): -3.0, (2, "LEFT"): 1.0, (2, "RIGHT"): -1.0}
    shape = spark.createDataFrame([(7, [[[(900000.0, 1630000.0), (900100.0, 1630000.0), (900100.0, 1630100.0), (900000.0, 1630100.0)]]])], "zone long, parts array<array<array<struct<x:double,y:double>>>>")
    at = geo.to_degrees(F.col("x"), F.col("y")).alias("d")
    cells = spark.createDataFrame([(1, 900010.0, 1630010.0, 2.0), (2, 900020.0, 1630020.0, 4.0), (3, 900200.0, 1630020.0, 9.0)], "cell long, x double, y double, z double").select("cell", "z", at).select("cell", "z", "d.lon", "d.lat")
    r = build.zone_stats(cells, shape, "zone").first()
    assert (r.zone, r.n, r["mean"], r.least, r.greatest) == (7, 2, 3.0, 2.0, 4.0)
