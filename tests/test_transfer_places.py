"""Attribute transfer and place matching on small fixtures and against brute force."""

import math
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from wayfold.functions import states, text
from wayfold.operators import places, spatial, transfer

LINES = "edge_id long, points array<struct<x:double,y:double>>"


def test_overlap_with_polygons_equals_sampling(spark):
    rnd = random.Random(2)
    boxes = []
    for i in range(25):
        x, y, w, h = 900000 + rnd.random() * 400, 1630000 + rnd.random() * 400, 20 + rnd.random() * 150, 20 + rnd.random() * 90
        boxes.append((i, [[[(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]]], float(i % 4)))
    lines = [(100 + i, [(900000 + rnd.random() * 500, 1630000 + rnd.random() * 500) for _ in range(3)]) for i in range(25)]
    regions = spark.createDataFrame(boxes, "shape long, parts array<array<array<struct<x:double,y:double>>>>, v double")
    df = spark.createDataFrame(lines, LINES)
    got = {(r.edge_id, r["shape"]): r.overlap_m for r in spatial.lines_in_regions(df, regions, "edge_id", "shape").collect()}
    n = 4000
    for e, ps in lines:
        for s, parts, _ in boxes:
            (x0, y0), (x1, y1) = parts[0][0][0], parts[0][0][2]
            near = 0.0
            for a, b in zip(ps, ps[1:]):
                size = ((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2) ** 0.5
                near += size * sum(x0 < a[0] + (k + 0.5) / n * (b[0] - a[0]) < x1 and y0 < a[1] + (k + 0.5) / n * (b[1] - a[1]) < y1 for k in range(n)) / n
            assert abs(near - got.get((e, s), 0.0)) < 1.0
    means = {r.edge_id: r.v for r in transfer.polygon_means(df, regions, "edge_id", "shape", ["v"], 0.1).collect()}
    best = {}
    for (e, s), o in got.items():
        best[s] = max(best.get(s, (0, 0, 0)), (o, -e, e))
    length = {e: sum(((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2) ** 0.5 for a, b in zip(ps, ps[1:])) for e, ps in lines}
    want = {}
    for s, (o, _, e) in best.items():
        if o / length[e] >= 0.1:
            want.setdefault(e, []).append(s % 4)
    mean = lambda vs: sum(v for v in vs if v) / len([v for v in vs if v]) if any(vs) else None
    assert means == pytest.approx({e: mean(vs) for e, vs in want.items()})


def test_nearest_line_ties_filter_and_radius(spark):
    lines = spark.createDataFrame([(1, [(0.0, 0.0), (100.0, 0.0)], "A"), (2, [(20.0, 0.0), (60.0, 0.0)], "B"), (3, [(0.0, 5.0), (100.0, 5.0)], "A")], LINES + ", kind string")
    src = spark.createDataFrame([(10, [(10.0, 0.0), (50.0, 0.0)], 3.0), (11, [(50.0, 4.0)], 0.5), (12, [(50.0, 4.0)], 2.0), (13, [(500.0, 4.0)], 9.0)], "source long, points array<struct<x:double,y:double>>, r double")
    got = {r.source: (r.edge_id, r.distance_m, r.overlap_m) for r in transfer.nearest_line(src, lines, "source", "edge_id", 10.0).collect()}
    assert got == {10: (1, 0.0, 40.0), 11: (3, 1.0, 0.0), 12: (3, 1.0, 0.0)}  # equally near: more overlap
    assert {r.source for r in transfer.nearest_line(src, lines, "source", "edge_id", 10.0, radius="r").collect()} == {10, 12}
    only = {r.source: r.edge_id for r in transfer.nearest_line(src, lines, "source", "edge_id", 10.0, only=F.col("kind") == "B").collect()}
    assert only == {10: 2, 11: 2, 12: 2}
    c = transfer.mapping_counts(src, transfer.nearest_line(src, lines, "source", "edge_id", 10.0), "source", "edge_id", F.col("r") > 0.6).first()
    assert (c.n_sources, c.n_invalid, c.n_mapped, c.n_unmapped, c.n_edges) == (4, 1, 3, 1, 2)
    best = transfer.best_source(spark.createDataFrame([(1, 7, 3.0, 1.0), (2, 7, 3.0, 0.5), (3, 7, 2.0, 0.0)], "s long, e long, overlap_m double, distance_m double"), "s", "e").first()
    assert best.s == 2


def test_fills(spark):
    edges = spark.createDataFrame([(1, None, "UNKNOWN"), (2, 1.0, "NARROW"), (3, None, None)], "k long, w double, s string")
    a, b = spark.createDataFrame([(1, 1.3, None)], "k long, w double, s string"), spark.createDataFrame([(1, 9.0, "PAVED"), (2, 9.0, "PAVED")], "k long, w double, s string")
    got = {r.k: (r.w, r.s) for r in transfer.fill_in_order(edges, [a, b], "k", ["w", "s"]).collect()}
    assert got == {1: (1.3, "PAVED"), 2: (1.0, "NARROW"), 3: (None, None)}
    assert {r.k: r.w for r in transfer.fill_from(edges, b, "k", ["w"], overwrite=True).collect()} == {1: 9.0, 2: 9.0, 3: None}
    assert {r.k: r.s for r in transfer.backfill_states(edges.withColumn("w", F.lit(1.3)), {"s": ("w", states.width_state)}).collect()} == {1: "ADEQUATE_120", 2: "NARROW", 3: "ADEQUATE_120"}
    m = spark.createDataFrame([(1, 2.0, True), (1, 4.0, True), (1, 90.0, False), (2, 7.0, False)], "e long, v double, first boolean")
    assert {r.e: r.v for r in transfer.mean_with_fallback(m, "e", "v", F.col("first")).collect()} == {1: 3.0, 2: 7.0}
    t = spark.createDataFrame([(3.0, 10.0, 10.0), (7.0, 10.0, 10.0), (3.0, 100.0, 10.0), (None, 1.0, 1.0), (70.0, 10.0, 10.0)], "d double, e double, s double").select(transfer.guarded_tier(F.col("d"), F.col("e"), F.col("s"), 5.0, 10.0).alias("t"))
    assert [r.t for r in t.collect()] == ["MATCHED", "REVIEW", "CONFLICT", "UNMATCHED", "UNMATCHED"]
    kinds = transfer.load_stats(t, "t").first()
    assert (kinds.n_source, kinds.n_matched, kinds.n_unmatched, kinds.n_conflict, kinds.n_duplicate) == (5, 1, 2, 1, 0)


def test_place_tiers(spark):
    p = spark.createDataFrame([(10, "가", "갤힘시 주덜구 1", 129.0, 35.0), (11, "가", "갤힘시 주덜구 1", 129.1, 35.0), (20, "나", "갤힘시 주덜구 2", 129.1185, 35.1535), (21, "다", "갤힘시 주덜구 3", 129.1189, 35.1537), (30, "라", None, None, None)], "place_id long, name string, address string, lon double, lat double")
    s = spark.createDataFrame([(1, "가", "갤힘시 주덜구 1", 129.0, 35.0), (2, "나", "갤힘시 주덜구 99", 129.1185001, 35.1535001), (3, "마", "갤힘시 주덜구 2", None, None), (4, "라", None, 129.0, 35.0), (5, "x", "다른시 구 1", 129.1185, 35.1535)], "source_id long, name string, address string, lon double, lat double")
    m = places.match_places(s, p, spark.createDataFrame([(11,)], "place_id long"))
    got = {r.source_id: (r.place_id, r.status, r.has_features) for r in m.collect()}
    assert got == {1: (11, "exact_name_address_multi", True), 2: (20, "nearest", False), 3: (20, "exact_address", False), 4: (None, "unmatched", False), 5: (None, "unmatched", False)}
    assert next(r.distance_m for r in m.collect() if r.source_id == 2) < 20
    rows = places.feature_rows(m.withColumn("category", F.lit("T")), spark.createDataFrame([(11, "z"), (11, "ramp")], "place_id long, feature string"), {"T": ("step", "ramp")}, ("ramp", "step"))
    assert {tuple(r) for r in rows.collect()} == {(1, 11, "ramp"), (2, 11, "z"), (3, 20, "ramp"), (4, 20, "step")}


def test_scores_spots_and_answers(spark):
    kind = "name string, address string, lon double, lat double"
    f = spark.createDataFrame([(1, "달빛 모텔", "주덜구 날갱헐로2번길 13-5", 126.4, 34.6), (2, None, None, 126.4, 34.6)], "facility_id long, " + kind)
    p = spark.createDataFrame([(7, "달빛모텔", "갤힘 날갱헐로 2길 13-5, 2층", 126.4001, 34.6), (8, "별빛식당", "갤힘 날갱헐로 77", 126.4, 34.6), (9, "먼 곳", None, 126.5, 34.6)], "poi_id long, " + kind)
    got = {r.facility_id: (r.poi_id, r.score, r.status) for r in places.scored_candidates(f, p).collect()}
    assert got == {1: (7, 45 + 35 + 25, "STRONG"), 2: (8, 45, "WEAK")}
    a = spark.createDataFrame([(1, 1, 50.0, 10.0), (1, 2, 85.0, 20.0), (1, 3, 99.0, 1.0), (2, 1, 10.0, 500.0), (2, 2, 30.0, 90.0)], "k long, q int, s double, d double")
    assert {r.k: r.q for r in places.first_good_answers(a, "k", "q", "s", "d").collect()} == {1: 2, 2: 2}
    spots = places.same_spot(spark.createDataFrame([(1, "가나", "다", 126.0, 34.0)], "id long, " + kind), spark.createDataFrame([(5, "가나", "라", 126.00000001, 34.0), (6, "가", "다", 126.0, 34.0), (7, "가나", "다", 126.1, 34.0)], "id long, " + kind)).collect()
    assert [(r.left_id, r.right_id) for r in spots] == [(1, 6)]
    c = spark.createDataFrame([(1, "a", 0.0, 0.0), (2, "a", 10.0, 0.0), (3, "b", 5.0, 0.0), (4, "a", 22.0, 0.0), (5, None, 0.0, 1.0)], "id long, g string, x double, y double")
    assert {r.id: (r.cluster_id, r.cluster_size) for r in places.clusters_within(c, "id", "g", 15.0, "C").collect()} == {1: ("C-0001", 3), 2: ("C-0001", 3), 4: ("C-0001", 3), 3: ("C-0002", 1), 5: ("C-0003", 1)}
    t = {"a": spark.createDataFrame([(1,), (1,), (None,)], "k long"), "b": spark.createDataFrame([(1,), (9,)], "r long")}
    checks = places.load_checks(t, {"a": "k"}, [("b", "r", "a", "k")])
    assert {r.check_name: r.n for r in checks.collect()} == {"rows:a": 3, "rows:b": 2, "repeated:a.k": 1, "null:a.k": 1, "orphan:b.r": 1}
    with pytest.raises(ValueError, match="orphan"):
        places.require_loaded(checks, {"repeated:a.k": 1, "null:a.k": 1})


def test_scored_candidates_equal_brute_force_and_compare_few_names(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("가나다라마바사아자차") for _ in range(rnd.randint(0, 6)))
    row = lambda i: (i, word() if rnd.random() < 0.9 else None, f"중앙로 {rnd.randint(1, 9)}" if rnd.random() < 0.7 else None, 126.0 + rnd.random() * 0.01, 34.0 + rnd.random() * 0.01)
    left, right = [row(i) for i in range(60)], [row(1000 + i) for i in range(300)]
    kind = " long, name string, address string, lon double, lat double"
    found = places.scored_candidates(spark.createDataFrame(left, "facility_id" + kind), spark.createDataFrame(right, "poi_id" + kind))
    assert "least_" in found._jdf.queryExecution().executedPlan().toString()
    got = {r.facility_id: (r.poi_id, r.score) for r in found.collect()}

    def haversine(a, b):
        p, q = math.radians(a[4]), math.radians(b[4])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[3] - a[3]) / 2) ** 2
        return 2 * 6371008.8 * math.asin(math.sqrt(h))

    want = {}
    for a in left:
        scored = []
        for b in right:
            d = haversine(a, b)
            if d <= 300:
                ratio = 0.0 if a[1] is None or b[1] is None else SequenceMatcher(None, a[1], b[1]).ratio()
                x, y = ((v[2] or "").replace(" ", "") for v in (a, b))
                points = 25 if x and x == y else 18 if x and y and (x in y or y in x) else 0
                scored.append((-(next(v for bound, v in places.DISTANCE_POINTS if d <= bound) + math.floor(ratio * 35) + points), d, -ratio, b[0]))
        if scored:
            want[a[0]] = (min(scored)[3], -min(scored)[0])
    assert got == want


def test_letters_bound_the_likeness(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("가나다라ab𐐀") for _ in range(rnd.randint(0, 9)))
    df = spark.createDataFrame([(word(), word()) for _ in range(300)], "a string, b string")
    each = lambda c: (F.length(c), text.letter_mask(F.col(c)))
    for r in df.select("a", "b", text.blocks_ratio_bound(*each("a"), *each("b")).alias("most")).collect():
        assert SequenceMatcher(None, r.a, r.b).ratio() <= r.most <= 1.0


def test_shapes_as_text(spark):
    df = spark.createDataFrame([("POLYGON((0 0, 4 0, 4 4, 0 4))",), ("MULTILINESTRING((0 0, 1 1),(5 5),(2 2, 3 3, 4 4))",)], "g string")
    r = df.select(text.wkt_multipolygon(text.parse_multipolygon(F.col("g"))).alias("w"), text.parse_multilinestring(F.col("g")).alias("m")).collect()
    assert r[0].w == "MULTIPOLYGON(((0.000 0.000,4.000 0.000,4.000 4.000,0.000 4.000,0.000 0.000)))" and [len(x) for x in r[1].m] == [2, 3]
