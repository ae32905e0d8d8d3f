"""Building and editing road graphs: crossings, corner splits, chains, pruning, edits, merging of regions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.functions import arrow, geo
from wayfold.operators import fuse, graph, repair, spatial
from wayfold.plans.runtime import materialize, once


def corner_cuts(segments: DataFrame, degrees: float) -> DataFrame:
    """edge_id, m: measures of inner vertices where a line (edge_id, points) turns by at least so many degrees."""
    line = segments.select("edge_id", geo.measured(F.col("points")).alias("l")).where(F.size("l") >= 3)
    n = F.size("l") - 2
    mid = F.zip_with(F.slice("l", F.lit(1), n), F.slice("l", F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    three = F.zip_with(mid, F.slice("l", F.lit(3), n), lambda ab, c: F.struct(ab.b.m.alias("m"), geo.turn_angle(ab.a.x, ab.a.y, ab.b.x, ab.b.y, c.x, c.y).alias("turn")))
    return line.select("edge_id", F.explode(three).alias("t")).where(F.col("t.turn") >= degrees).select("edge_id", "t.m")


def met_legs(lines: DataFrame, key: str, margin: float = 0.001) -> DataFrame:
    """key_a < key_b, the ends (spatial.leg_ends) and the square (cell) of legs of two polylines that share a square and whose boxes come within twice the margin."""
    celled = spatial.leg_cells(materialize(lines.select(key, "points")), key, margin).select(key, "a.x", "a.y", F.col("b.x").alias("p"), F.col("b.y").alias("q"), "cell")
    mine = lambda side, k: celled.toDF(f"{key}_{side}", f"xa{k}", f"ya{k}", f"xb{k}", f"yb{k}", "cell")
    near = spatial.legs_near(*spatial.leg_ends(), 2 * margin)
    return mine("a", 1).join(mine("b", 2), "cell").where(F.col(f"{key}_a") < F.col(f"{key}_b")).where(near)


def crossings(lines: DataFrame, key: str = "edge_id") -> DataFrame:
    """key_a < key_b, x, y of points where legs of two polylines (planar points) cross, ends that touch included.

    A crossing counts in the square that holds it, which both legs pass, so equal ones stand together
    and nothing is sent about to find them. Legs that nearly are on one line may give a point beyond
    an end; it counts where their boxes meet.
    """
    met = once(met_legs(lines, key), p=geo.leg_crossing(*spatial.leg_ends())).where("p is not null")

    def held(c: str) -> Column:
        v, a, b, d, e = F.col(f"p.{c}"), *[getattr(s, c) for s in spatial.leg_ends()]
        low, high = F.greatest(F.least(a, b), F.least(d, e)), F.least(F.greatest(a, b), F.greatest(d, e))
        return F.when(v < low - 1e-6, low).when(v > high + 1e-6, high).otherwise(v)

    met = once(met, hx=held("x"), hy=held("y"))
    met = once(met, own=geo.morton(spatial.cell_of(F.col("hx")), spatial.cell_of(F.col("hy")))).where("own = cell")
    return met.select("cell", f"{key}_a", f"{key}_b", "p.x", "p.y").distinct().drop("cell")


def near_crosses(lines: DataFrame, key: str = "edge_id", metres: float = 2.5, degrees: float = 25.0) -> DataFrame:
    """key_a < key_b, distance_m, turn of legs that come within metres of each other without crossing, at an angle of at least so many degrees; the nearest of each two lines."""
    a, b, c, d = spatial.leg_ends()
    far = lambda p, q, r: geo.point_leg(p.x, p.y, q.x, q.y, r.x, r.y).d
    met = once(met_legs(lines, key, metres), d1=far(a, c, d), d2=far(b, c, d), d3=far(c, a, b), d4=far(d, a, b)).withColumn("distance_m", F.least("d1", "d2", "d3", "d4")).where(F.col("distance_m") <= metres)
    met = once(met, p=geo.leg_crossing(a, b, c, d)).where("p is null")
    met = once(met, turn=geo.axis_angle(b.x - a.x, b.y - a.y, d.x - c.x, d.y - c.y)).where(F.col("turn") >= degrees)
    return met.groupBy(f"{key}_a", f"{key}_b").agg(F.min(F.struct("distance_m", "turn")).alias("m")).select(f"{key}_a", f"{key}_b", "m.*")


def maybe_along(met: DataFrame, metres: float, degrees: float, least_m: float) -> DataFrame:
    """Pairs of met_legs that can have a stretch of near_overlaps: its tests in plain arithmetic, a little wider.

    Only they are fit to sift all pairs: the join does the first in compiled code, which holds for
    few expressions only. What rounding could decide otherwise is left to the exact tests.
    """
    a, b, c, d = spatial.leg_ends()
    ux, uy, vx, vy, wx, wy = b.x - a.x, b.y - a.y, d.x - c.x, d.y - c.y, c.x - a.x, c.y - a.y
    turned = (math.cos(math.radians(min(degrees, 90.0))) ** 2 - 1e-9) * (ux * ux + uy * uy) * (vx * vx + vy * vy)
    met = met.where((ux * vx + uy * vy) * (ux * vx + uy * vy) >= turned)
    # all along a-b is times its length here
    met = once(met, n=ux * ux + uy * uy, u=ux * wx + uy * wy, v=ux * wx + uy * wy + ux * vx + uy * vy)
    met = once(met, s=F.greatest(F.lit(0.0), F.least("u", "v")), e=F.least("n", F.greatest("u", "v"))).where(F.col("e") - F.col("s") >= (least_m - 1e-6) * F.sqrt("n"))
    met = once(met, off=vx * wy - vy * wx, turn=(ux * vy - uy * vx) / F.nullif(F.col("n"), F.lit(0.0)), reach=(metres + 1e-6) * F.sqrt(vx * vx + vy * vy))
    off = lambda at: F.abs(F.col("off") + F.col(at) * F.col("turn")) <= F.col("reach")
    return met.where(off("s") & off("e")).drop("n", "u", "v", "s", "e", "off", "turn", "reach")


def near_overlaps(lines: DataFrame, key: str = "edge_id", metres: float = 1.25, degrees: float = 20.0, least_m: float = 2.0) -> DataFrame:
    """key_a < key_b, length, x, y: stretches of at least least_m along which two legs run side by side; x, y is the stretch's middle.

    Legs count if their directions differ by at most so many degrees and the ends of the common
    stretch, on the first leg, are within metres of the second. The longest stretch of each two lines.
    """
    a, b, c, d = spatial.leg_ends()
    along = lambda p: ((p.x - a.x) * (b.x - a.x) + (p.y - a.y) * (b.y - a.y)) / F.nullif(F.hypot(b.x - a.x, b.y - a.y), F.lit(0.0))
    met = maybe_along(met_legs(lines, key, metres), metres, degrees, least_m)
    met = once(met, angle=geo.axis_angle(b.x - a.x, b.y - a.y, d.x - c.x, d.y - c.y)).where(F.col("angle") <= degrees)
    met = once(met, n=F.hypot(b.x - a.x, b.y - a.y), u=along(c), v=along(d))
    met = once(met, s=F.greatest(F.lit(0.0), F.least("u", "v")), e=F.least(F.col("n"), F.greatest("u", "v"))).withColumn("length", F.col("e") - F.col("s")).where(F.col("length") >= least_m)
    at = lambda m: F.struct((a.x + m / F.col("n") * (b.x - a.x)).alias("x"), (a.y + m / F.col("n") * (b.y - a.y)).alias("y"))
    met = once(met, ps=at(F.col("s")), pe=at(F.col("e")), pm=at((F.col("s") + F.col("e")) / 2))
    gap = lambda p: geo.point_leg(F.col(p).x, F.col(p).y, c.x, c.y, d.x, d.y).d
    met = once(met, gs=gap("ps"), ge=gap("pe")).where((F.col("gs") <= metres) & (F.col("ge") <= metres))
    return met.groupBy(f"{key}_a", f"{key}_b").agg(F.max(F.struct("length", "pm.x", "pm.y")).alias("m")).select(f"{key}_a", f"{key}_b", "m.*")


def chains(segments: DataFrame) -> DataFrame:
    """edge_id, chain: maximal paths through nodes of degree two; a chain is named by its least edge."""
    d = graph.degrees(segments).where("degree = 2").select("vertex_id")
    ends = segments.where("from_node_id <> to_node_id").select("edge_id", F.explode(F.array("from_node_id", "to_node_id")).alias("vertex_id"))
    links = ends.join(d, "vertex_id").groupBy("vertex_id").agg(F.min("edge_id").alias("a"), F.max("edge_id").alias("b")).where("a <> b")
    label = graph.components(links, "a", "b").select(F.col("vertex_id").alias("edge_id"), F.col("component").alias("chain"))
    return segments.select("edge_id").distinct().join(label, "edge_id", "left").select("edge_id", F.coalesce("chain", "edge_id").alias("chain"))


def dense_ends(ends: DataFrame, metres: float = 13.0, least: int = 4) -> DataFrame:
    """kx, ky of places (end_id, kx, ky, x, y: one row a segment end) with at least so many ends, itself counted, within metres."""
    placed = ends.groupBy("kx", "ky", "x", "y").agg(F.count("*").alias("n"), F.min("end_id").alias("place"))
    pairs = repair.near_pairs(placed, "place", metres)
    each = pairs.select(F.col("place_a").alias("place"), F.col("place_b").alias("other")).unionByName(pairs.select(F.col("place_b").alias("place"), F.col("place_a").alias("other")))
    about = each.join(placed.select(F.col("place").alias("other"), F.col("n").alias("more")), "other").groupBy("place").agg(F.sum("more").alias("more"))
    return placed.join(about, "place", "left").where(F.col("n") + F.coalesce("more", F.lit(0)) >= least).select("kx", "ky").distinct()


def side_lines(segments: DataFrame, least_m: float = 1.0) -> DataFrame:
    """edge_id, side (LEFT, RIGHT), points: lines parallel to each polyline at half its width, at least least_m. segments: edge_id, points, width."""
    half = F.greatest(F.coalesce("width", F.lit(0.0)) / 2, F.lit(least_m))
    sides = F.explode(F.array(F.struct(F.lit("LEFT").alias("side"), F.lit(1.0).alias("sign")), F.struct(F.lit("RIGHT").alias("side"), F.lit(-1.0).alias("sign")))).alias("s")
    both = segments.select("edge_id", "points", half.alias("half"), sides).select("edge_id", "points", "s.side", (F.col("half") * F.col("s.sign")).alias("by"))
    return both.select("edge_id", "side", arrow.offset("points", "by").alias("points"))


def zone_stats(cells: DataFrame, regions: DataFrame, key: str, parts: str = "parts") -> DataFrame:
    """key, n, mean, least, greatest of the values z of raster cells (cell, lon, lat, z) whose centre lies in a region."""
    inside = spatial.in_regions(cells.select("cell", "lon", "lat"), regions, parts).select("cell", key)
    return inside.join(cells.select("cell", "z"), "cell").groupBy(key).agg(F.count("z").alias("n"), F.avg("z").alias("mean"), F.min("z").alias("least"), F.max("z").alias("greatest"))


#: fixed values: lengths in metres below which an anomaly is removed, in order of precedence; the grid of ends in metres; dense: ends within a radius
MICRO_LOOP_M, BRIDGE_M, DENSE_TAIL_M, TAIL_M, END_GRID_M, DENSE_ENDS, DENSE_RADIUS_M = 8.0, 14.0, 42.0, 18.0, 0.75, 4, 13.0
#: fixed values: kinds of segments
SIDE_KINDS = ("SIDE_LEFT", "SIDE_RIGHT")
BRIDGE_KINDS = ("SAME_SIDE_CORNER_BRIDGE", "CROSS_SIDE_CORNER_BRIDGE", "GAP_BRIDGE")


def segment_ends(segments: DataFrame) -> DataFrame:
    """end_id, edge_id, end (0, 1), x, y, kx, ky: both ends of every line (planar points) and the grid square they snap to."""
    at = F.array(F.struct(F.lit(0).alias("end"), F.get("points", F.lit(0)).alias("p")), F.struct(F.lit(1).alias("end"), F.element_at("points", -1).alias("p")))
    e = segments.select("edge_id", F.explode(at).alias("e")).select((F.col("edge_id") * 2 + F.col("e.end")).alias("end_id"), "edge_id", "e.end", "e.p.x", "e.p.y")
    key = lambda c: F.bround(F.col(c) / END_GRID_M, 0).cast("bigint")
    return e.withColumn("kx", key("x")).withColumn("ky", key("y"))


def anomalies(segments: DataFrame, sides: tuple[str, ...] = SIDE_KINDS, bridges: tuple[str, ...] = BRIDGE_KINDS) -> DataFrame:
    """edge_id, reason of edges (edge_id, segment_type, points, optionally made_by_repair) to remove; the first reason that applies.

    MICRO_LOOP: short, both ends shared; BRIDGE_ARTIFACT: a short bridge with both ends shared;
    DENSE_TAIL: a side with an end among many ends, shared by at least DENSE_ENDS, the other end in at
    most two segments; DANGLING_TAIL: a side with just one free end. Ends are shared if they snap to one
    square. Other kinds of segments and those a repair made are left alone.
    """
    ends = materialize(segment_ends(segments))
    degree = ends.groupBy("kx", "ky").agg(F.count("*").alias("degree"))
    dense = dense_ends(ends, DENSE_RADIUS_M, DENSE_ENDS).withColumn("dense", F.lit(True))
    e = ends.join(degree, ["kx", "ky"]).join(dense, ["kx", "ky"], "left").withColumn("dense", F.coalesce("dense", F.lit(False)))
    pick = lambda end, c: F.max(F.when(F.col("end") == end, F.col(c)))
    both = e.groupBy("edge_id").agg(pick(0, "degree").alias("d0"), pick(1, "degree").alias("d1"), pick(0, "dense").alias("x0"), pick(1, "dense").alias("x1"))
    s = segments.select("edge_id", "segment_type", geo.line_length(F.col("points")).alias("length"), (F.col("made_by_repair") if "made_by_repair" in segments.columns else F.lit(False)).alias("made")).join(both, "edge_id")
    s = s.where(F.col("segment_type").isin(*sides, *bridges) & ~F.coalesce("made", F.lit(False)))
    side, shared = F.col("segment_type").isin(*sides), (F.col("d0") >= 2) & (F.col("d1") >= 2)
    crowd = (F.col("x0") & (F.col("d0") >= DENSE_ENDS) & (F.col("d1") <= 2)) | (F.col("x1") & (F.col("d1") >= DENSE_ENDS) & (F.col("d0") <= 2))
    free = ((F.col("d0") <= 1) & (F.col("d1") > 1)) | ((F.col("d1") <= 1) & (F.col("d0") > 1))
    reason = F.when(shared & (F.col("length") <= MICRO_LOOP_M), "MICRO_LOOP").when(~side & shared & (F.col("length") <= BRIDGE_M), "BRIDGE_ARTIFACT")
    reason = reason.when(side & crowd & (F.col("length") <= DENSE_TAIL_M), "DENSE_TAIL").when(side & free & (F.col("length") <= TAIL_M), "DANGLING_TAIL")
    return s.withColumn("reason", reason).where("reason is not null").select("edge_id", "reason")


def self_scan(segments: DataFrame, rounds: int = 8, sides: tuple[str, ...] = SIDE_KINDS, bridges: tuple[str, ...] = BRIDGE_KINDS) -> tuple[DataFrame, list[int], bool]:
    """Remove anomalies until none is left or the rounds are used: segments, the number removed each round, and whether none is left."""
    removed = []
    for _ in range(rounds):
        bad = materialize(anomalies(segments, sides, bridges))
        removed.append(bad.count())
        if not removed[-1]:
            return segments, removed, True
        segments = materialize(segments.join(bad.select("edge_id"), "edge_id", "left_anti"))
    return segments, removed, anomalies(segments, sides, bridges).isEmpty()


def apply_edits(nodes: DataFrame, segments: DataFrame, edits: DataFrame, snap_m: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Nodes and segments after edits (seq, action, edge_id, vertex_id, x, y, x2, y2).

    delete_segment; delete_node if no segment uses it; add_node at (x, y); add_segment from (x, y) to
    (x2, y2), whose ends take the nearest node within snap_m, new or old, or become nodes. New ids
    follow the greatest ones in the order of seq.
    """
    kept = segments.join(edits.where("action = 'delete_segment'").select("edge_id"), "edge_id", "left_anti")
    top = nodes.agg(F.max("vertex_id").alias("top_v")).crossJoin(segments.agg(F.max("edge_id").alias("top_e")))  # one row each
    adds = edits.where("action = 'add_segment'")
    wanted = edits.where("action = 'add_node'").select("seq", F.lit(0).alias("end"), "x", "y").unionByName(adds.select("seq", F.lit(1).alias("end"), "x", "y")).unionByName(adds.select("seq", F.lit(2).alias("end"), F.col("x2").alias("x"), F.col("y2").alias("y")))
    wanted = materialize(wanted.withColumn("vertex_id", F.col("seq") * 3 + F.col("end")))
    old = repair.near_pairs(wanted, "vertex_id", snap_m, nodes).groupBy("vertex_id_a").agg(F.min(F.struct("distance_m", "vertex_id_b")).alias("m")).select(F.col("vertex_id_a").alias("vertex_id"), F.col("m.vertex_id_b").alias("old_id"))
    fresh = materialize(wanted.join(old.select("vertex_id"), "vertex_id", "left_anti"))
    same = repair.near_pairs(fresh, "vertex_id", snap_m)  # ends that meet become one node
    label = graph.components(same, "vertex_id_a", "vertex_id_b")
    fresh = fresh.join(label, "vertex_id", "left").withColumn("lead", F.coalesce("component", "vertex_id"))
    numbered = fuse.renumber(fresh.select("lead").distinct(), "n", "lead").crossJoin(F.broadcast(top)).select("lead", (F.col("top_v") + F.col("n")).alias("new_id"))
    placed = materialize(fresh.join(numbered, "lead").select("vertex_id", F.col("new_id").alias("id"), "x", "y", (F.col("vertex_id") == F.col("lead")).alias("first")).unionByName(old.select("vertex_id", F.col("old_id").alias("id"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"), F.lit(False).alias("first"))))
    a, b = placed.select((F.col("vertex_id") - 1).alias("k"), F.col("id").alias("from_node_id")), placed.select((F.col("vertex_id") - 2).alias("k"), F.col("id").alias("to_node_id"))
    rows = adds.select((F.col("seq") * 3).alias("k"), "seq").join(a, "k").join(b, "k")
    new = fuse.renumber(rows, "n", "seq").crossJoin(F.broadcast(top)).select((F.col("top_e") + F.col("n")).alias("edge_id"), "from_node_id", "to_node_id")
    out = kept.unionByName(new, allowMissingColumns=True)
    used = out.select(F.explode(F.array("from_node_id", "to_node_id")).alias("vertex_id")).distinct()
    gone = edits.where("action = 'delete_node'").select("vertex_id").join(used, "vertex_id", "left_anti")
    left = nodes.join(gone, "vertex_id", "left_anti").unionByName(placed.where("first").select(F.col("id").alias("vertex_id"), "x", "y"), allowMissingColumns=True)
    return left, out


def merge_regions(nodes: DataFrame, segments: DataFrame, more_nodes: DataFrame, more_segments: DataFrame, snap_m: float = 5.0) -> tuple[DataFrame, DataFrame]:
    """Union of two graphs: nodes of the second within snap_m of one of the first become it, the rest get new ids after the first's."""
    near = repair.near_pairs(more_nodes, "vertex_id", snap_m, nodes).groupBy("vertex_id_a").agg(F.min(F.struct("distance_m", "vertex_id_b")).alias("m"))
    taken = near.select(F.col("vertex_id_a").alias("vertex_id"), F.col("m.vertex_id_b").alias("id"))
    rest = fuse.renumber(more_nodes.join(taken.select("vertex_id"), "vertex_id", "left_anti"), "n_", "vertex_id").crossJoin(F.broadcast(nodes.agg(F.max("vertex_id").alias("top_"))))
    rest = materialize(rest.withColumn("id", F.col("top_") + F.col("n_")).drop("n_", "top_"))
    ids = materialize(taken.unionByName(rest.select("vertex_id", "id")))
    moved = more_segments
    for end in ("from_node_id", "to_node_id"):
        moved = moved.join(ids.select(F.col("vertex_id").alias(end), F.col("id").alias("id_")), end).withColumn(end, F.col("id_")).drop("id_")
    moved = fuse.renumber(moved, "n_", "edge_id").crossJoin(F.broadcast(segments.agg(F.max("edge_id").alias("top_")))).withColumn("edge_id", F.col("top_") + F.col("n_")).drop("n_", "top_")
    return nodes.unionByName(rest.withColumn("vertex_id", F.col("id")).drop("id"), allowMissingColumns=True), segments.unionByName(moved, allowMissingColumns=True)


def percentile_at(values: Column, ratio: float, low: float, high: float, default: float) -> Column:
    """Element number round((n - 1) * ratio) of the sorted values, half to even, held within low and high; default if there is none."""
    s = F.sort_array(values)
    at = F.bround((F.size(s) - 1) * F.lit(ratio), 0).cast("int")
    return F.greatest(F.lit(low), F.least(F.lit(high), F.when(F.size(s) > 0, F.get(s, at)).otherwise(F.lit(default))))


def learned_lengths(edits: DataFrame) -> DataFrame:
    """delete_max, add_min, add_max from lengths of manual edits (action, length). The edits are a person's, so their lists are short."""
    lists = edits.agg(F.collect_list(F.when(F.col("action") == "delete_segment", F.col("length"))).alias("d"), F.collect_list(F.when(F.col("action") == "add_segment", F.col("length"))).alias("a"))
    return lists.select(percentile_at(F.col("d"), 0.75, 8.0, 80.0, 35.0).alias("delete_max"), percentile_at(F.col("a"), 0.10, 2.0, 15.0, 4.0).alias("add_min"), percentile_at(F.transform("a", lambda v: v * 1.25), 0.75, 12.0, 85.0, 35.0).alias("add_max"))
