"""Problems 2, 4 and 6 on small fixtures against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wayfold.functions import geo, text
from wayfold.operators import quality_profile as qp
from wayfold.operators import spatial
from wayfold.sources import reject_csv

pytestmark = pytest.mark.usefixtures("spark")


def test_projection_round_trip_and_known_point(spark):
    df = spark.createDataFrame([(127.5, 38.0), (126.4, 34.6), (131.0, 38.9)], "lon double, lat double")
    r = df.select("lon", "lat", geo.to_metres(F.col("lon"), F.col("lat")).alias("m")).withColumn("b", geo.to_degrees(F.col("m.x"), F.col("m.y"))).collect()
    assert abs(r[0].m.x - 1_000_000) < 1e-6 and abs(r[0].m.y - 2_000_000) < 1e-6
    for x in r:
        assert abs(x.b.lon - x.lon) < 1e-10 and abs(x.b.lat - x.lat) < 1e-10


def test_points_within_distance_equal_brute_force(spark):
    rnd = random.Random(4)
    a = [(i, 126.4 + rnd.random() * 0.01, 34.6 + rnd.random() * 0.01) for i in range(150)] + [(900, None, 34.6), (901, 126.4, None)]
    b = [(i, 126.4 + rnd.random() * 0.01, 34.6 + rnd.random() * 0.01) for i in range(80)]
    got = spatial.within_distance(spark.createDataFrame(a, "ia long, lon double, lat double"), spark.createDataFrame(b, "ib long, lon double, lat double"), 90.0)

    def hav(p, q):
        la1, la2 = math.radians(p[2]), math.radians(q[2])
        h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2
        return 2 * 6_371_008.8 * math.asin(math.sqrt(h))

    want = {(p[0], q[0]) for p in a if None not in p for q in b if hav(p, q) <= 90.0}
    assert want and {(r.ia, r.ib) for r in got.collect()} == want


def test_points_in_regions_with_parts_holes_and_empty(spark):
    shapes = [
        (1, "MULTIPOLYGON(((0 0, 100 0, 100 100, 0 100, 0 0),(40 40, 60 40, 60 60, 40 60, 40 40)),((200 0,210 0,210 10,200 10,200 0)))"),
        (2, "MULTIPOLYGON EMPTY"),
        (3, None),
        (4, "multipolygon (((  -900 -900 , 900 -900, 900 900, -900 900, -900 -900)))"),
        (5, "nonsense"),
    ]
    pts = [(1, 10.0, 10.0), (2, 50.0, 50.0), (3, 205.0, 5.0), (4, 150.0, 5.0), (5, 5000.0, 5.0)]
    s = spark.createDataFrame(shapes, "edge long, g string").select("edge", text.parse_multipolygon(F.concat(F.col("g"))).alias("parts"))
    off = lambda v, o: F.transform(v, lambda part: F.transform(part, lambda ring: F.transform(ring, lambda p: F.struct((p.x + 900000).alias("x"), (p.y + 1630000).alias("y")))))
    s = s.withColumn("parts", off(F.col("parts"), 0))
    p = spark.createDataFrame(pts, "id long, x double, y double").select("id", geo.to_degrees(F.col("x") + 900000, F.col("y") + 1630000).alias("d")).select("id", "d.lon", "d.lat")
    got = {(r.id, r.edge) for r in spatial.in_regions(p, s).collect()}
    assert got == {(1, 1), (3, 1), (1, 4), (2, 4), (3, 4), (4, 4)}
    assert spatial.in_regions(p.limit(0), s).count() == 0 and spatial.in_regions(p, s.limit(0)).count() == 0


def test_quality_findings(spark):
    rows = [(1, "FLAT", "1.5", "2.0", "PAVED", 1), (2, "FLAT", "1.5", "2.00", "PAVED", 1), (3, "flat", "31", "-1", "paved", 2), (3, "flat", "31", "-1", "paved", 2), (4, None, "", "5.555", "UNPAVED", 2), (5, "STEEP", "3", "9", "UNPAVED", 2), (6, " ", "2.5", "100", None, 3)]
    seg = spark.createDataFrame(rows, "edge_id long, slope_state string, width_meter string, avg_slope_percent string, surface_state string, load_id long")
    loads = spark.createDataFrame([(1, None), (2, 1), (3, 2), (9, 3)], "load_id long, prior_load_id long")
    got = {tuple(r) for r in qp.findings(seg, loads).collect()}
    values = {("VALUE", "slope_state", 3), ("VALUE", "width_meter", 3), ("VALUE", "avg_slope_percent", 3), ("VALUE", "surface_state", 3), ("VALUE", "avg_slope_percent", 4), ("VALUE", "slope_state", 6)}
    assert {g for g in got if g[0] == "VALUE"} == values
    assert {("LOAD", "slope_state", 2), ("LOAD", "surface_state", 2), ("LOAD", "width_meter", 2), ("LOAD", "avg_slope_percent", 2)} <= got
    assert qp.findings(seg.limit(0), loads).count() == 0
    counts = qp.value_counts(seg, qp.ROAD_DOMAINS, "load_id")
    bad = {(r.column_name, r.value): (r["mask"], r.reason) for r in qp.bad_values(counts, qp.ROAD_DOMAINS).collect()}
    assert bad == {("slope_state", "flat"): ("aaaa", "MASK"), ("slope_state", " "): (" ", "MASK"), ("surface_state", "paved"): ("aaaaa", "MASK"), ("width_meter", "31"): ("99", "VALUE"), ("avg_slope_percent", "-1"): ("-9", "MASK"), ("avg_slope_percent", "5.555"): ("9.999", "MASK")}
    # masks decide: with a domain check that lets everything pass, values of alien masks are still found
    lax = [type("Lax", (), {"column": d.column, "number": d.number, "mask_allows": staticmethod(d.mask_allows), "allows": staticmethod(lambda v: v.isNotNull())}) for d in qp.ROAD_DOMAINS]
    assert {(r.column_name, r.value) for r in qp.bad_values(counts, lax).collect()} == {k for k, v in bad.items() if v[1] == "MASK"}
    prof = {(r.load_id, r.column_name): r for r in qp.profile(seg, qp.ROAD_DOMAINS, "load_id").collect()}
    assert prof[2, "width_meter"].n_blank == 1 and prof[2, "width_meter"].n_violations == 2


def test_rare_masks_and_divergence_are_queries(spark, tmp_path):
    rows = [(i, 1 if i < 300 else 2, "FLAT", "1.5" if i % 150 else "12.25", "2.5", "PAVED" if i < 300 else "X1") for i in range(500)] + [(900, None, "FLAT", "1.5", "", None)]
    spark.createDataFrame(rows, "edge_id long, load_id long, slope_state string, width_meter string, avg_slope_percent string, surface_state string").write.parquet(str(tmp_path / "road_segments.parquet"))
    spark.createDataFrame([(1, None), (2, 1)], "load_id long, prior_load_id long").write.parquet(str(tmp_path / "road_loads.parquet"))
    queries = __import__("__spark_entry__").queries()
    rare = queries["p2_rare_masks"](spark, str(tmp_path)).collect()
    assert {(r.edge_id, r.load_id, r.column_name, r.mask) for r in rare} == {(0, 1, "width_meter", "99.99"), (150, 1, "width_meter", "99.99")}  # 2 of 300; in load 2 it is 2 of 200
    apart = {r.column_name: r.mask_distance for r in queries["p2_divergence"](spark, str(tmp_path)).collect()}
    assert set(apart) == {"slope_state", "width_meter", "avg_slope_percent", "surface_state"} and apart["surface_state"] == 1.0 and apart["slope_state"] == 0.0


def test_rejected_lines(spark):
    good = '1,"a ""b"" c",CAT,"x,y",POINT(126.1 34.2),77'
    lines = [good, good + "\r", '2,a"b,c,d,POINT(126 34),', '3,"open,c,d,POINT(126 34),', '4,"a"b,c,d,POINT(126 34),', "5,a,b", "", None, "x,a,b,c,POINT(126 34),", "7,a,b,c,POINT(34 126),", good, '8,a,b,"two\nlines",point( 1.265e2  +34.0 ),', "0,a,b,c,POINT(126 34),", "9,a,b,c,d,e,f"]
    df = spark.createDataFrame([(i, "places", t, "clash") for i, t in enumerate(lines)] + [(99, "other", "x", "clash")], "line_id long, target_table string, line_text string, reason string").coalesce(1)
    got = {r.line_id: (r.reason, r.fields) for r in reject_csv.split_lines(df, reject_csv.RAW_FORMATS).collect()}
    assert {i: v[0] for i, v in got.items()} == {0: None, 1: None, 2: "QUOTING", 3: "QUOTING", 4: "QUOTING", 5: "COLUMN_COUNT", 6: "COLUMN_COUNT", 7: "COLUMN_COUNT", 8: "INVALID_VALUE", 9: "INVALID_VALUE", 10: None, 11: None, 12: "INVALID_VALUE", 13: "COLUMN_COUNT", 99: "UNKNOWN_TARGET"}
    assert got[0][1] == ["1", 'a "b" c', "CAT", "x,y", "POINT(126.1 34.2)", "77"] and got[11][1][3] == "two\nlines"
    assert reject_csv.split_lines(df.limit(0), reject_csv.RAW_FORMATS).count() == 0


def test_loaded_rows_are_all_that_are_not_set_apart(spark, tmp_path):
    fac = "facility_priority_manual_removed_applied"
    lines = [(1, "places", '7,"a, b",C,addr,POINT(126.5 34.5),9'), (2, "places", "x,a,C,addr,POINT(126 34),9"), (3, fac, "k,n,c,pn,pa,gu,ad, 34.5 ,126.5,9,2024-01-02T03:04:05\r"), (4, fac, "k,n,c,pn,pa,gu,ad,0,126.5,9,"), (5, fac, "k,n,c,pn,pa,gu,ad,34.5,126.5,9,soon")]
    tables = {
        "raw_csv_lines": (lines, "line_id long, target_table string, line_text string"),
        "places": ([(1, "n", "C", "a", "POINT(126 34)", "5"), (2, "n", "C", "a", "nowhere", None)], "place_id long, name string, category string, address string, point string, provider_place_id string"),
        fac: ([(1, "k", "n", "c", "pn", "pa", "gu", "a", "34.5", "126.5", None), (2, "k", "n", "c", "pn", "pa", "gu", "a", "x", "126.5", None)], "removed_id long, source_key string, name string, db_category string, public_facility_name string, public_facility_address string, district_gu string, address string, lat string, lng string, removed_at timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    queries = __import__("__spark_entry__").queries()
    got = {(r.record_source, r.record_id): r for r in queries["p6_loaded"](spark, str(tmp_path)).collect()}
    bad = {(r.record_source, r.record_id) for r in queries["p6_found"](spark, str(tmp_path)).collect()}
    assert set(got) == {("raw_csv_lines", 1), ("raw_csv_lines", 3), ("raw_csv_lines", 5), ("places", 1), (fac, 1)} and not bad & set(got) and len(bad) == 4
    a, b, c = (got["raw_csv_lines", i] for i in (1, 3, 5))
    assert (a.place_id, a.name, a.lon, a.lat) == (7, "a, b", 126.5, 34.5) and (b.lon, b.lat, b.removed_at.year) == (126.5, 34.5, 2024)
    assert c.removed_at is None and c.removed_at_text == "soon"


def test_point_text(spark):
    good = ["POINT(126 34)", "srid=4326;point( 126.5   34.5 )", "  POINT (+1.265e2 34.5)  "]
    bad = ["POINT(34 126)", "POINT(126, 34)", "POINT EMPTY", "", None, "SRID=5179;POINT(126 34)", "POINT(126 34 1)", "POINT(126 34))", "POINT(inf 34)"]
    df = spark.createDataFrame([(p,) for p in good + bad], "p string").select("p", text.point_lon_lat(F.col("p")).alias("v"))
    assert [r.v is not None for r in df.collect()] == [True] * len(good) + [False] * len(bad)
