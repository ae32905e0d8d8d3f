"""Topology repair, connections, validation, routing costs and requests on small graphs with known results."""

import pytest
from pyspark.sql import functions as F

from wayfold.functions import geo, text
from wayfold.operators import routing, spatial, topology

NODES = "vertex_id long, x double, y double"
SEGS = "edge_id long, from_node_id long, to_node_id long, segment_type string, points array<struct<x:double,y:double>>"
#: metres of a degree at 35.08 north
LON, LAT = 91100.0, 110950.0


def graph_of(spark, nodes, edges, kind="SIDE_LINE"):
    at = {i: (x, y) for i, x, y in nodes}
    rows = [(e, a, b, kind, [at[a], *rest, at[b]]) for e, a, b, *rest in edges]
    return spark.createDataFrame(nodes, NODES), spark.createDataFrame(rows, SEGS)


def metres(points):
    return [(i, (lon - 128.88) * LON, (lat - 35.08) * LAT) for i, lon, lat in points]


def test_connections_of_three_components(spark):
    nodes = metres([(1, 128.88000, 35.08), (2, 128.88005, 35.08), (3, 128.88010, 35.08), (4, 128.88011, 35.08), (5, 128.880025, 35.080005), (6, 128.880025, 35.08002)])
    found = topology.connectivity(*graph_of(spark, nodes, [(10, 1, 2), (20, 3, 4), (30, 5, 6)])).collect()
    kinds = {r.kind for r in found}
    assert {"ENDPOINT_TO_ENDPOINT", "SPLIT_AND_CONNECT"} <= kinds and {"orange", "yellow"} <= {r.colour for r in found}
    split = next(r for r in found if r.kind == "SPLIT_AND_CONNECT")
    assert (split.from_id, split.to_edge) == (5, 10) and abs(split.distance_m - 0.555) < 0.01
    # an end that a split takes is not paired with other ends
    assert all(5 not in (r.from_id, r.to_id) for r in found if r.kind == "ENDPOINT_TO_ENDPOINT")
    assert [r.candidate_id for r in sorted(found, key=lambda r: r.candidate_id) if r.candidate_id.startswith("conn")][0] == "conn-00001"


def test_far_ends_are_of_low_priority(spark):
    nodes = metres([(1, 128.88, 35.08), (2, 128.88001, 35.08), (3, 128.88015, 35.08), (4, 128.88016, 35.08)])
    found = topology.connectivity(*graph_of(spark, nodes, [(10, 1, 2), (20, 3, 4)])).collect()
    assert found and all(r.priority == "LOW" for r in found)


def test_ends_that_point_away_are_of_low_priority(spark):
    nodes = [(1, 0.0, 0.0), (2, 50.0, 0.0), (3, 50.0, 8.0), (4, 90.0, 8.0)]  # side by side, both leading away
    found = topology.connectivity(*graph_of(spark, nodes, [(10, 1, 2), (20, 3, 4)])).collect()
    assert {(r.from_id, r.to_id): r.priority for r in found}[2, 3] == "LOW"


def test_topology_repair_cuts_the_touched_edge(spark):
    nodes = metres([(1, 128.88, 35.08), (2, 128.8801, 35.08), (3, 128.88005, 35.080002), (4, 128.88005, 35.08005)])
    n, s, log = topology.repair_topology(*graph_of(spark, nodes, [(10, 1, 2), (20, 3, 4)]))
    got = {(r.edge_id, r.from_node_id, r.to_node_id) for r in s.collect()}
    assert got == {(20, 5, 4), (21, 1, 5), (22, 5, 2)} and {r.vertex_id for r in n.collect()} == {1, 2, 4, 5} and log.count() == 0
    assert s.where("from_node_id = to_node_id").count() == 0


def test_topology_repair_merges_ends_guards_shifts_and_reports_ambiguity(spark):
    nodes = [(1, 0.0, 0.0), (2, 50.0, 0.0), (3, 50.4, 0.3), (4, 90.0, 0.0), (5, 200.0, 0.0), (6, 260.0, 0.0), (7, 200.0, 0.9), (8, 260.0, 0.9), (9, 230.0, 0.45), (10, 230.0, 60.0)]
    _n, s, log = topology.repair_topology(*graph_of(spark, nodes, [(10, 1, 2), (20, 3, 4), (30, 5, 6), (40, 7, 8), (50, 9, 10)], "A"))
    ends = {r.edge_id: (r.from_node_id, r.to_node_id) for r in s.collect()}
    assert ends[10] == (1, 2) and ends[20] == (2, 4)  # 2 and 3 would become each other: the lower one stays
    # 9 lies between two like lines, whose own ends merge
    assert ("AMBIGUOUS", 9) in {(r.reason, r.vertex_id) for r in log.collect()}


def test_candidates_are_applied_until_settled(spark):
    nodes = [(1, 0.0, 0.0), (2, 50.0, 0.0), (3, 55.0, 0.0), (4, 90.0, 0.0), (5, 30.0, 0.4), (6, 30.0, 40.0), (7, 91.0, 1.0), (8, 140.0, 1.0)]
    n, s, counts, settled = topology.connect_until_settled(*graph_of(spark, nodes, [(10, 1, 2), (20, 3, 4), (30, 5, 6), (40, 7, 8)]))
    from wayfold.operators import graph

    label = graph.components(s, "from_node_id", "to_node_id")
    assert settled and counts[-1] == 0 and label.select("component").distinct().count() == 1
    assert {r.vertex_id for r in n.collect()} >= {1, 6, 8}


def test_bridges_from_ends_and_closed_components(spark):
    from wayfold.operators import graph

    nodes = [(1, 0.0, 0.0), (2, 100.0, 0.0), (3, 100.0, 80.0), (9, 100.0, 120.0), (10, 100.0, 160.0), (4, 40.0, 2.0), (5, 40.0, 30.0), (6, 70.0, 2.5), (7, 80.0, 20.0), (8, 60.0, 20.0)]
    nodes, segs = graph_of(spark, nodes, [(10, 1, 2), (11, 2, 3), (12, 3, 9), (13, 9, 10), (20, 4, 5), (30, 6, 7), (31, 7, 8), (32, 8, 6)])
    links = topology.bridge_links(nodes, segs, 30.0)
    got = {r.component: (r.main_edge, round(r.main_m, 3), round(r.distance_m, 3), r.tier) for r in links.collect()}
    assert got == {4: (10, 40.0, 2.0, "AUTO"), 6: (10, 70.0, 2.5, "AUTO")}  # from an open end, and from a closed component's corner
    _n, out, _log = topology.apply_bridges(nodes, segs, links)
    assert graph.components(out, "from_node_id", "to_node_id").select("component").distinct().count() == 1


def test_validation_and_gate(spark):
    nodes = spark.createDataFrame([(1, "a", "POINT(126 34)"), (1, "a", "POINT(126 34)"), (2, "b", "POINT(126.001 34)"), (3, "c", "nowhere"), (9, "z", "POINT(126 34.5)")], "vertex_id long, source_node_key string, point string")
    seg = spark.createDataFrame([(1, 1, 2, "LINESTRING(126 34, 126.001 34)", "A"), (2, 2, 1, "LINESTRING(126.0005 34, 126 34)", "B"), (2, 2, 2, "LINESTRING(126 34, 126 34)", "A"), (4, 1, 77, "nothing", None)], "edge_id long, from_node_id long, to_node_id long, geom string, segment_type string")
    checks = topology.validate(nodes, seg, text.point_lon_lat(F.col("point")), text.parse_linestring(F.col("geom")), {"segment_type": ("A",)})
    got = {r.check_name: r.n for r in checks.collect()}
    want = {"duplicate_node_ids": 1, "duplicate_edge_ids": 1, "bad_node_points": 1, "bad_geometries": 2, "endpoint_mismatches": 1, "self_loops": 1, "duplicate_node_pairs": 1, "distinct_node_pairs": 3, "bad_references": 1, "isolated_nodes": 2, "enum_segment_type": 2, "components": 1, "main_component_rows": 4, "main_component_pairs": 3}
    assert {k: got[k] for k in want} == want and got["missing_segment_columns"] == len(topology.SEGMENT_COLUMNS) - 5
    with pytest.raises(ValueError, match="bad_geometries"):
        topology.require_sound(checks)
    with pytest.raises(ValueError, match="no rows"):
        topology.require_sound(spark.createDataFrame([("n_segments", 0)], "check_name string, n long"))


def test_sectors_and_pruning(spark):
    nodes = [(0, 0.0, 0.0), (1, 10.0, 0.0), (2, 10.0, 1.0), (3, 0.0, 10.0), (4, -10.0, 0.0), (5, 10.0, -1.0)]
    n, s = graph_of(spark, nodes, [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 0, 5)])
    got = {(r.vertex_id, r.sector): (round(r.low, 2), round(r.high, 2)) for r in topology.sectors(topology.intersection_roots(s.withColumn("width", F.lit(5.0))), s).collect()}
    assert got == {(0, 1): (0.0, 90.0), (0, 2): (90.0, 180.0), (0, 3): (180.0, 0.0)}  # three arms near 0 are one
    edges = [(1, 1, 2, 50.0), (2, 2, 3, 60.0), (3, 2, 4, 4.0), (4, 4, 5, 4.0), (5, 3, 1, 40.0), (6, 3, 6, 30.0), (7, 7, 8, 3.0)]
    left, settled = topology.prune_dangling(spark.createDataFrame(edges, "edge_id long, from_node_id long, to_node_id long, length double"), "length", 10.0)
    assert settled and {r.edge_id for r in left.collect()} == {1, 2, 5, 6, 7}


def test_route_costs_and_requests(spark):
    s = spark.createDataFrame([(1, 10.0, "YES", "NO", "PAVED", 9.0, "NARROW")], "edge_id long, length double, walk_access string, stairs_state string, surface_state string, slope double, width_state string")
    s = s.withColumn("signal_state", F.lit("NO")).withColumn("slope_state", F.lit("RISK")).withColumn("braille_block_state", F.lit(None).cast("string")).withColumn("audio_signal_state", F.lit("YES"))
    p = {r.profile: round(r.priority, 6) for r in routing.profile_priorities(s).collect()}
    assert p["wheelchair_manual_safe"] == round(0.12 * 0.1 * 0.45, 6) and p["visual_safe"] == round(1.1 * 0.65, 6) and p["pedestrian_fast"] == 1.0 and len(p) == 8
    r = spark.createDataFrame([(1, 126.0, 34.0, 126.1, 34.1, None), (2, None, 34.0, 126.1, 34.1, ["SAFE"]), (3, 126.0, 34.0, 226.1, 34.1, [])], "request_id long, from_lon double, from_lat double, to_lon double, to_lat double, options array<string>")
    c = routing.checked_requests(r)
    assert {(x.request_id, x.option, x.problem) for x in c.collect()} == {(1, "SAFE", None), (1, "SHORTEST", None), (2, "SAFE", "FROM_MISSING"), (3, "SAFE", "TO_OUT_OF_RANGE"), (3, "SHORTEST", "TO_OUT_OF_RANGE")}
    found = spark.createDataFrame([(1, "SAFE", 100.0, 2.0)], "request_id long, option string, metres double, minutes double")
    assert {(x.request_id, x.option): x.reason for x in routing.answers(c, found).collect()}[1, "SHORTEST"] == "NO_PATH"


def test_connected_ends_prefer_one_component(spark):
    nodes = spark.createDataFrame([(1, 126.0, 34.0), (2, 126.0001, 34.0), (3, 126.01, 34.0), (4, 126.0101, 34.0)], "vertex_id long, lon double, lat double")
    label = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 2)], "vertex_id long, component long")
    q = spark.createDataFrame([(7, 126.0, 34.0, 126.01, 34.0)], "request_id long, from_lon double, from_lat double, to_lon double, to_lat double")
    r = routing.connected_ends(q, nodes, label).first()
    assert (r.from_vertex, r.to_vertex, r.connected) == (2, 4, True)
    r = routing.connected_ends(q, nodes, label.where("vertex_id <> 4"), metres=100.0).first()
    assert (r.from_vertex, r.to_vertex, r.connected) == (1, 3, False)


def test_lines_inside_discs_and_polygons(spark):
    line = spark.createDataFrame([([(0.0, 0.0), (10.0, 0.0), (10.0, 10.0)], [(0.0, 0.0, 2.0), (10.0, 10.0, 3.0), (10.0, 0.0, 1.0)])], "p array<struct<x:double,y:double>>, d array<struct<x:double,y:double,r:double>>")
    k = line.select(geo.outside_discs(geo.measured(F.col("p")), F.col("d")).alias("k")).first().k
    assert [(round(v.s, 6), round(v.e, 6)) for v in k] == [(2.0, 9.0), (11.0, 17.0)]
    parts = [[[(-1.0, -1.0), (4.0, -1.0), (4.0, 4.0), (-1.0, 4.0)], [(1.0, -0.5), (2.0, -0.5), (2.0, 0.5), (1.0, 0.5)]], [[(9.0, 5.0), (12.0, 5.0), (12.0, 7.0), (9.0, 7.0)]]]
    df = line.withColumn("parts", F.lit(None).cast("string")).drop("parts").crossJoin(spark.createDataFrame([(parts,)], "parts array<array<array<struct<x:double,y:double>>>>"))
    assert abs(df.select(geo.length_inside(F.col("p"), F.col("parts")).alias("n")).first().n - (4 - 1 + 2)) < 1e-9


def test_connecting_looks_again_only_where_something_changed(spark, monkeypatch):
    import random

    rnd = random.Random(4)
    nodes, edges, ids = [], [], iter(range(1, 10_000))
    for e in range(90):
        a, b = next(ids), next(ids)
        x, y, turn = rnd.uniform(0, 150), rnd.uniform(0, 150), rnd.choice([(1, 0), (0, 1), (1, 1)])
        far = rnd.choice([0.5, 20.0, 60.0])
        nodes += [(a, x, y), (b, x + far * turn[0], y + far * turn[1])]
        edges.append((100 + e, a, b))
    nodes, segs = graph_of(spark, nodes + [(5_000, 1.0, 1.0)], edges + [(900, 1, 5_000)])
    # an edge that starts away from its node, and one whose node is unknown
    odd = spark.createDataFrame([(901, 3, 4, None, [(70.0, 70.0), (71.0, 90.0)]), (902, 5, 9_999, None, [(10.0, 10.0), (30.0, 10.0)])], SEGS)
    segs = segs.unionByName(odd)
    n0, s0, counts0 = nodes, segs, []
    while True:  # every round from the beginning
        found = topology.connectivity(n0, s0).where("priority <> 'LOW' and colour <> 'red'")
        counts0.append(found.count())
        if not counts0[-1]:
            break
        n0, s0, _log = topology.apply_candidates(n0, s0, found)
    looked, touching = [], topology.touching
    monkeypatch.setattr(topology, "touching", lambda points, lines, metres: looked.append(points.count() * lines.count()) or touching(points, lines, metres))
    n, s, counts, settled = topology.connect_until_settled(nodes, segs)
    rows = lambda df: sorted(str(r) for r in df.collect())
    assert settled and counts == counts0 and len(counts) >= 3 and rows(s) == rows(s0) and rows(n) == rows(n0)
    assert max(looked[1:5]) < looked[0] / 2  # after the first round, ends that are new and edges that are


def test_touching_meets_legs_of_any_length(spark):
    from wayfold.operators import transfer

    points = [(i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (6000.5, 4000), (-1, 5), (12000, 8000.9), (64, 64), (5, 0.999), (5, 1.001), (3000, -0.5)])]
    lines = [(1, 90, 91, "A", [(0.0, 0.0), (12000.0, 8000.0)]), (2, 92, 93, "A", [(0.0, 0.0), (0.0, 9.0), (0.0, 9.0), (64.0, 64.0)]), (3, 94, 95, "A", [(-5000.0, 0.0), (5000.0, 0.0)]), (4, 96, 97, "A", [(5.0, 0.0), (5.0, 0.0)])]
    nodes, segs = spark.createDataFrame(points, NODES), spark.createDataFrame(lines, SEGS)
    want = transfer.near_lines(nodes.select("vertex_id", F.array(F.struct("x", "y")).alias("points")), segs, "vertex_id", "edge_id", 1.0)
    got = topology.touching(nodes, segs, 1.0)
    key = lambda df, d: sorted((r.vertex_id, r.edge_id, round(r[d], 9)) for r in df.collect())
    assert key(got, "d") == key(want, "distance_m") and len(key(got, "d")) > 8
    # a leg of 12 km passes some squares of its level, not hundreds of small ones
    assert spatial.leg_squares(segs, "edge_id", 1.0).where("edge_id = 1").count() < 40
