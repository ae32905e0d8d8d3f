"""Reference operators on small fixtures with known results."""

import heapq
import random
import re
import statistics
import struct

import pytest
from pyspark.sql import functions as F

from wayfold.functions import arrow, geo, states, text
from wayfold.operators import fuse, graph, nearest, repair, routing, rules
from wayfold.sources import files
from wayfold.streaming import flow


def column(spark, value, kind, expr):
    return spark.createDataFrame([(v,) for v in value], f"v {kind}").select(expr(F.col("v")).alias("r")).collect()


def test_states_and_numbers(spark):
    assert [r.r for r in column(spark, [None, 0.0, 1.0, 1.2, 1.5], "double", states.width_state)] == ["UNKNOWN", "UNKNOWN", "NARROW", "ADEQUATE_120", "ADEQUATE_150"]
    assert [r.r for r in column(spark, [None, 2.9, 3.0, 5.56, 8.33], "double", states.slope_state)] == ["UNKNOWN", "FLAT", "MODERATE", "STEEP", "RISK"]
    assert [r.r for r in column(spark, ["1,5 m", "wide", None, "25"], "string", states.osm_width)] == [1.5, None, None, None]
    assert [r.r for r in column(spark, ["5%", "-3,5", "up", "60"], "string", states.osm_incline)] == [5.0, 3.5, None, None]
    assert [r.r for r in column(spark, ["1", " 2.5 ", "x", "", None, "nan", "inf"], "string", text.to_double)] == [1.0, 2.5, None, None, None, None, None]
    assert [r.r for r in column(spark, ["예", "YES", "0", None], "string", text.to_bool)] == [True, True, False, False]
    assert [r.r for r in column(spark, ["YES", "NO", "x", None], "string", text.signal_state)] == ["TRAFFIC_SIGNALS", "NO", "UNKNOWN", "UNKNOWN"]
    assert [r.r for r in column(spark, [None, 2.6, 900.0], "double", lambda c: states.quantize(c, 0.25, 9))] == [0.0, 2.5, 127.75]


def test_text_functions(spark):
    df = spark.createDataFrame([("갤힘시 주덜구 날갱헐로2번길 13-5 (볼챙동)", "달빛(본관) 모텔㈜", "a|b", "abcd", "abxy")], "a string, n string, l string, p string, q string")
    r = df.select(
        text.address_tokens(F.col("a")).alias("t"), text.normalize_name(F.col("n")).alias("n"), text.list_add(F.col("l"), "b", "c").alias("add"), text.list_drop(F.col("l"), "a").alias("drop"),
        text.common_prefix_length(F.col("p"), F.col("q")).alias("k"), text.district_of(F.col("a"), ["덜구", "주덜구"]).alias("d"), text.terms_in(F.col("n"), ["모텔", "약국"]).alias("terms"),
    ).first()
    assert "날갱헐로2번길13-5" in r.t and r.n == "달빛모텔" and r["add"] == "a|b|c" and r["drop"] == "b" and r.k == 2 and r.d == "주덜구" and r.terms == ["모텔"]
    with pytest.raises(Exception, match="no entry"):
        spark.createDataFrame([("z",)], "c string").select(text.lookup(F.col("c"), {"a": "b"}, strict=True)).collect()


def test_normalized_places_keep_dirty_rows(spark, tmp_path):
    from wayfold.plans import reference

    texts = [None, "", "  ", "갤힘시 턴헌구 헐로 1", "\u3000갤힘시\u3000턴헌구\u00a0헐로", "\t갤힘시\n턴헌구", "１２３번 – 길", "\u1100\u1161 가·나 Äb (본관) Z9", "\ufffd\ufffd x", "A(미완 b", "\x85a\x1cb c"]
    rows = [(i * len(texts) + j, n, a) for i, n in enumerate(texts) for j, a in enumerate(texts)]
    spark.createDataFrame(rows, "place_id long, name string, address string").write.parquet(str(tmp_path / "places.parquet"))
    plain = lambda v: None if v is None else re.sub("[^0-9a-z가-힣]", "", re.sub(r"\([^)]*\)", "", v.lower()))
    prefix = lambda v: None if v is None else " ".join(v.split()[:2])
    got = {tuple(r) for r in reference.normalized_places(spark, str(tmp_path)).collect()}
    assert got == {(k, plain(n), prefix(a)) for k, n, a in rows}


def test_lines(spark):
    df = spark.createDataFrame([("LINESTRING(0 0, 10 0, 10 10)",), ("LINESTRING(0 0)",), ("LINESTRING(0 0, a 1)",), (None,)], "g string").select(text.parse_linestring(F.col("g")).alias("p"))
    assert [r.p is not None for r in df.collect()] == [True, False, False, False]
    line = df.limit(1).select(geo.measured(F.col("p")).alias("l"), "p")
    r = line.select(geo.line_length(F.col("p")).alias("n"), geo.interpolate(F.col("l"), F.lit(15.0)).alias("i"), geo.substring(F.col("l"), F.lit(5.0), F.lit(12.0)).alias("s"), arrow.offset("p", F.lit(1.0)).alias("o"), arrow.simplified("p", F.lit(20.0)).alias("d")).first()
    assert r.n == 20 and (r.i.x, r.i.y) == (10, 5) and [(p.x, p.y) for p in r.s] == [(5, 0), (10, 0), (10, 2)]
    assert [(p.x, p.y) for p in r.o] == [(0, 1), (9, 1), (9, 10)] and len(r.d) == 2
    c = spark.createDataFrame([((0.0, 0.0), (4.0, 4.0), (0.0, 4.0), (4.0, 0.0))], "a struct<x:double,y:double>, b struct<x:double,y:double>, c struct<x:double,y:double>, d struct<x:double,y:double>")
    assert tuple(c.select(geo.leg_crossing(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("p")).first().p) == (2, 2)
    assert abs(c.select(geo.turn_angle(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)).alias("t")).first().t - 90) < 1e-9
    ratio = spark.createDataFrame([("abcd", "bcde"), (None, "a")], "a string, b string").select(arrow.longest_blocks_ratio("a", "b").alias("r")).collect()
    assert ratio[0].r == 0.75 and ratio[1].r is None


def test_components_and_paths(spark):
    rnd = random.Random(3)
    e = [(rnd.randrange(120), rnd.randrange(120), float(rnd.randint(1, 9))) for _ in range(110)] + [(500, 501, 2.0), (None, 3, 1.0), (7, 7, 1.0)]
    df = spark.createDataFrame([(i, a, b, c, 0) for i, (a, b, c) in enumerate(e)], "edge_id long, from_node_id long, to_node_id long, c double, component int")
    adj: dict = {}
    for a, b, c in e:
        if a is not None:
            adj.setdefault(a, []).append((b, c))
            adj.setdefault(b, []).append((a, c))
    seen: dict = {}
    for v in sorted(adj):
        if v not in seen:
            todo, seen[v] = [v], v
            while todo:
                for w, _ in adj[todo.pop()]:
                    if w not in seen:
                        seen[w] = v
                        todo.append(w)
    assert {r.vertex_id: r.component for r in graph.components(df, "from_node_id", "to_node_id").collect()} == seen
    source = next(v for v in adj if sum(seen[x] == seen[v] for x in seen) > 5)
    cost, heap = {}, [(0.0, source)]
    while heap:
        d, v = heapq.heappop(heap)
        if v not in cost:
            cost[v] = d
            for w, c in adj[v]:
                heapq.heappush(heap, (d + c, w))
    for size in (7, 10_000):  # many small blocks, one block
        got = routing.shortest_paths(df, spark.createDataFrame([(1, source)], "source_id long, vertex_id long"), "c", edge="edge_id", block_size=size)
        assert {r.vertex_id: r.cost for r in got.collect()} == cost
    rows = routing.path_rows(got, spark.createDataFrame([(1, v) for v in cost], "source_id long, target_id long")).collect()
    price = {i: c for i, (_, _, c) in enumerate(e)}
    for target in cost:
        mine = sorted((r.seq, r.vertex_id, r.edge_id) for r in rows if r.target_id == target)
        assert mine[0][1:] == (source, None) and mine[-1][1] == target and [m[0] for m in mine] == list(range(len(mine)))
        assert sum(price[m[2]] for m in mine[1:]) == cost[target]
        assert all({e[m[2]][0], e[m[2]][1]} == {k[1], m[1]} for k, m in zip(mine, mine[1:]))
    assert graph.components(df.limit(0), "from_node_id", "to_node_id").count() == 0


def test_redirect_chains_and_cycles(spark):
    df = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (8, 9), (7, 8), (6, 6)], "a long, b long")
    assert {(r.a, r.final) for r in graph.resolve_redirects(df, "a", "b").collect()} == {(5, 3), (4, 3), (9, 8), (8, 8), (7, 8)}


def test_repair_joins_near_ends(spark):
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (2, 10.0, 0.0), (3, 10.5, 0.0), (4, 20.0, 0.0), (5, 26.0, 0.0), (6, 40.0, 0.0)], "vertex_id long, x double, y double")
    seg = spark.createDataFrame([(1, 1, 2, "A"), (2, 3, 4, "A"), (3, 5, 6, "A"), (4, 2, 3, "A")][:3], "edge_id long, from_node_id long, to_node_id long, segment_type string")
    label = graph.components(seg, "from_node_id", "to_node_id")
    got = {(r.vertex_id_a, r.vertex_id_b): r.kind for r in repair.connection_candidates(repair.endpoints(nodes, seg, label)).collect()}
    assert got == {(2, 3): "NODE_MERGE", (2, 4): "ENDPOINT_TO_ENDPOINT", (4, 5): "ENDPOINT_TO_ENDPOINT"}
    fixed, done = repair.repair(nodes, seg)
    assert done == [1, 0] and {(r.from_node_id, r.to_node_id) for r in fixed.collect()} == {(1, 2), (2, 4), (5, 6)}
    tiers = {r.component: r.tier for r in repair.bridges(nodes, seg, label, 30.0).collect()}
    assert tiers == {3: "AUTO", 5: "HELD"}


def test_split_segments(spark):
    seg = spark.createDataFrame([(1, [(0.0, 0.0), (10.0, 0.0)]), (2, [(0.0, 0.0), (0.0, 4.0)])], "edge_id long, points array<struct<x:double,y:double>>")
    cuts = spark.createDataFrame([(1, 4.0), (1, 4.4), (1, 9.99)], "edge_id long, m double")
    got = {(r.edge_id, r.part_no): round(r.length, 3) for r in repair.split_segments(seg, cuts).collect()}
    assert got == {(1, 0): 4.2, (1, 1): 5.8, (2, 0): 4.0}


def test_fusing(spark):
    v = spark.createDataFrame([(1, "A", 3), (1, "B", 1), (1, "B", 4), (1, "A", 9), (1, "UNKNOWN", 0), (2, None, 1)], "k int, s string, o int")
    assert [(r.k, r.s, r.votes) for r in fuse.majority(v, ["k"], "s", "o").collect()] == [(1, "B", 2)]
    assert {r.new_id: r.o for r in fuse.renumber(v.select("o").distinct(), "new_id", "o").collect()} == {1: 0, 2: 1, 3: 3, 4: 4, 5: 9}
    big = spark.range(2_000_000).select(F.xxhash64("id").alias("k"), F.repeat(F.lit("x"), 40).alias("payload"), F.rand(3).alias("noise"))
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    n = fuse.renumber(big, "new_id", "k").agg(F.count_distinct("new_id").alias("d"), F.min("new_id").alias("lo"), F.max("new_id").alias("hi"), F.corr(F.col("new_id"), F.col("k")).alias("c")).first()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert (n.d, n.lo, n.hi) == (2_000_000, 1, 2_000_000) and n.c > 0.99
    up = fuse.upsert(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"])
    assert {tuple(r) for r in up.collect()} == {(1, "a"), (2, "c"), (3, "d")}
    asof = fuse.as_of(spark.createDataFrame([(1, 5, "x"), (1, 1, "y")], "k int, t int, n string"), spark.createDataFrame([(1, 2, "r"), (1, 5, "s")], "k int, at int, m string"), ["k"], "t", "at")
    assert {(r.n, r.m) for r in asof.collect()} == {("x", "s"), ("y", None)}
    rnd = random.Random(9)
    lefts = [(rnd.randrange(3), rnd.randrange(500), i) for i in range(400)]
    rights = [(rnd.randrange(4), t, t * 10 + k) for k, t in enumerate(rnd.sample(range(500), 120))]
    sides = spark.createDataFrame(lefts, "k int, t int, n int"), spark.createDataFrame(rights, "k int, at int, m int")
    for forward in (False, True):
        got = {r.n: r.m for r in fuse.as_of(*sides, ["k"], "t", "at", forward=forward, chunk_rows=50).collect()}
        after = lambda k, t: min(((at, m) for q, at, m in rights if q == k and at >= t), default=(0, None))[1]
        before = lambda k, t: max(((at, m) for q, at, m in rights if q == k and at <= t), default=(0, None))[1]
        pick = after if forward else before
        assert got == {i: pick(k, t) for k, t, i in lefts}
    edges = [(i, rnd.randrange(8), rnd.randrange(8), None if rnd.random() < 0.4 else float(rnd.randrange(6))) for i in range(60)] + [(100, None, 3, None), (101, 90, 91, None), (102, 5, 5, 4.0), (103, 5, 5, None)]
    filled = {r.e: r.filled for r in fuse.neighbour_median(spark.createDataFrame(edges, "e int, a int, b int, v double"), "e", ["a", "b"], "v").collect()}
    want = {}
    for i, a, b, own in edges:
        mine = [w for j, c, d, w in edges if w is not None and {a, b} & {c, d} - {None}]
        if own is None and mine:
            want[i] = round(statistics.median(mine), 4)
    assert filled == want
    diff = fuse.positional_diff(spark.createDataFrame([(1, "a"), (2, "b")], "i int, v string"), spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], "i int, v string"), "i")
    assert {r.i for r in diff.collect()} == {2, 3}
    scoped = fuse.scope_replace(v.select("k"), spark.createDataFrame([(1,), (3,)], "k int"), F.col("k") == 1)
    assert sorted(r.k for r in scoped.collect()) == [1, 2]
    plan = spark.createDataFrame([(1, "RENAME", "new"), (2, "REMOVE", None)], "id int, action string, new_value string")
    master = spark.createDataFrame([(1, "old", "c"), (2, "gone", "c"), (3, "stay", "c")], "id int, name string, category string")
    assert {(r.id, r.name) for r in rules.apply_plan(master, plan, "id").collect()} == {(1, "new"), (3, "stay")}


def test_nearest(spark):
    a = spark.createDataFrame([(1, 126.4, 34.6), (2, 126.5, 34.7)], "p long, lon double, lat double")
    b = spark.createDataFrame([(10, 126.40005, 34.6), (11, 126.4002, 34.6)], "q long, lon double, lat double")
    t = {r.p: (r.q, r.tier) for r in nearest.tiered_nearest(a, b, "p", "q", 5.0, 50.0).collect()}
    assert t == {1: (10, "MATCHED"), 2: (None, "UNMATCHED")}
    assert [r.p for r in nearest.without_near(a, b, "p", "q", 50.0).collect()] == [2]


def test_nearest_leg_of_any_length(spark):
    points = spark.createDataFrame([(1, 5000.0, 3.0), (2, 10.0, 12.0), (3, 150000.0, -7.0), (4, 5000.0, 900.0)], "p long, x double, y double")
    lines = spark.createDataFrame([(10, [(0.0, 0.0), (9000.0, 0.0)]), (11, [(0.0, 20.0), (30.0, 20.0)]), (12, [(100000.0, 0.0), (200000.0, 0.0)])], "l long, points array<struct<x: double, y: double>>")
    assert {tuple(r) for r in nearest.nearest_leg(points, lines, "p", "l", 40.0).collect()} == {(1, 10, 3.0), (2, 11, 8.0), (3, 12, 7.0)}
    assert nearest.nearest_leg(points, lines.limit(0), "p", "l", 40.0).count() == 0


def test_profile_of_all_states(spark, tmp_path):
    from wayfold.plans import reference

    states_ = ["walk_access", "braille_block_state", "audio_signal_state", "stairs_state", "slope_state", "width_state", "surface_state", "signal_state", "segment_type", "avg_slope_percent", "width_meter"]
    rows = [(1, 1, *["YES"] * 11), (2, 1, *[None] * 11), (3, 1, *["no"] * 11)]
    spark.createDataFrame(rows, "edge_id long, load_id long, " + ", ".join(f"{c} string" for c in states_)).write.parquet(str(tmp_path / "road_segments.parquet"))
    got = {r.column_name: r for r in reference.quality_profile_all(spark, str(tmp_path)).collect()}
    assert set(got) == set(states_) and all((r.n_rows, r.n_blank, r.n_masks) == (3, 1, 2) for r in got.values())
    assert got["stairs_state"].n_violations == 0 and got["slope_state"].n_violations == 2


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿"이름", 값\n" 가 ",1\n나,\n'.encode("cp949", "ignore"))
    df = files.read_csv(spark, str(tmp_path / "a.csv"), required=["이름", "값"])
    assert [tuple(r) for r in df.collect()] == [("가", "1"), ("나", None)]
    (tmp_path / "many").mkdir()
    (tmp_path / "many/a.csv").write_bytes("\ufeff이름,값\n가,1\n".encode())
    (tmp_path / "many/b.csv").write_bytes("이름,값\n".encode("cp949") + "x,2\n".encode() * 200_000 + "나,3\n".encode("cp949"))  # not UTF-8 by its last line only
    many = files.read_csv(spark, str(tmp_path / "many"))
    assert many.count() == 200_002 and {tuple(r) for r in many.distinct().collect()} == {("가", "1"), ("x", "2"), ("나", "3")}
    assert {(r.encoding, r.n_lines) for r in files.folder_manifest(spark, str(tmp_path / "many")).collect()} == {("UTF-8", 2), ("x-windows-949", 200_002)}
    with pytest.raises(ValueError, match="lacks"):
        files.read_csv(spark, str(tmp_path / "a.csv"), required=["없음"])
    (tmp_path / "w.js").write_text('window.DATA = [{"a": 1, "b": "x"}, {"a": 2, "b": null}];')
    assert [tuple(r) for r in files.read_wrapped_json(spark, str(tmp_path / "w.js"), "a: int, b: string").collect()] == [(1, "x"), (2, None)]
    files.write_csv(df, str(tmp_path / "out"), ["값", "이름"], single=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).columns == ["값", "이름"]


def test_shapes(spark, tmp_path):
    ring = [(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (0.0, 0.0)]
    body = struct.pack("<i4d2ii", 5, 0, 0, 2, 2, 1, len(ring), 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    (tmp_path / "d").mkdir()
    (tmp_path / "d/x.shp").write_bytes(b"\0" * 100 + struct.pack(">2i", 1, len(body) // 2) + body)
    field = b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([10]) + b"\0" * 15
    (tmp_path / "d/x.dbf").write_bytes(b"\3\0\0\0" + struct.pack("<IHH", 1, 32 + 32 + 1, 11) + b"\0" * 20 + field + b"\r" + b" " + "도로".encode("cp949").ljust(10))
    r = files.read_shapes(spark, str(tmp_path / "d")).first()
    assert [(p.x, p.y) for p in r.rings[0]] == ring and r.attributes == {"NAME": "도로"} and r.record_no == 0


def test_osm_export(spark):
    nodes = spark.createDataFrame([(1, 126.0, 34.0), (2, 126.1, 34.0)], "vertex_id long, lon double, lat double")
    seg = spark.createDataFrame([(10, 1, 2, [(126.0, 34.0), (126.05, 34.05), (126.05, 34.05), (126.09999, 34.0)], None, 'a"<b')], "edge_id long, from_node_id long, to_node_id long, points array<struct<x:double,y:double>>, walk string, note string")
    osm = files.osm_nodes(nodes, seg)
    way = files.osm_ways(seg, osm, {"walk": "walk", "note": "note"}, prefix="x:").first()
    # the drawn end is off its node, and yet the way ends there
    assert osm.count() == 3 and way.refs == [1, -1, 2] and way.tags == {"highway": "footway", "foot": "yes", "oneway": "no", "source": "graph", "x:walk": "UNKNOWN", "x:note": 'a"<b'}
    assert any("a&quot;&lt;b" in r.value for r in files.osm_lines(osm, files.osm_ways(seg, osm, {"note": "note"})).collect())
    with pytest.raises(Exception, match="does not exist"):
        files.osm_ways(seg.withColumn("to_node_id", F.lit(7).cast("long")), osm, {}).collect()


def test_raster(spark):
    pts = spark.createDataFrame([(1, 0.5, 9.5), (2, 9.9, 0.1), (3, 50.0, 0.0)], "id long, x double, y double")
    cells = spark.createDataFrame([(0, 0, 7.0), (9, 9, 8.0)], "row long, col long, z double")
    assert {r.id: r.z for r in files.sample_raster(pts, cells, 0.0, 10.0, 1.0).collect()} == {1: 7.0, 2: 8.0, 3: None}


def test_stream_sessions(spark, tmp_path):
    spark.createDataFrame([(1, "2026-01-01 00:00:00"), (1, "2026-01-01 00:05:00"), (1, "2026-01-01 02:00:00")], "u long, t string").selectExpr("u", "cast(t as timestamp) t").write.parquet(str(tmp_path / "s"))
    s = flow.read_table(spark, str(tmp_path / "s"))
    seen = []
    flow.fold(s, lambda batch, number: seen.append(batch.count()))
    assert sum(seen) == 3
    got = flow.drain_complete(flow.window_counts(s, "t", "1 day", "1 hour", None))
    assert sorted(r.n for r in got.collect()) == [1, 2]
