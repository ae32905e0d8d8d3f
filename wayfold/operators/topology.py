"""Hardening a road graph: near nodes merged, lines cut where nodes touch them, components connected, the result validated.

Graphs are nodes (vertex_id, x, y) and segments (edge_id, from_node_id, to_node_id, segment_type,
points) in planar metres; other columns of segments are kept.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfold.functions import geo
from wayfold.operators import fuse, graph, repair, spatial, transfer
from wayfold.plans.runtime import materialize, once

CUT = "edge_id bigint, m double, vertex_id bigint, x double, y double"


def line_foot(x: Column, y: Column, points: Column) -> Column:
    """Struct(d, m): distance of a point from a line and the measure of its foot, the first of equally near ones."""
    def best(line: Column) -> Column:
        return F.array_min(F.transform(geo.legs(line), lambda g: geo.let(geo.point_leg(x, y, g.a.x, g.a.y, g.b.x, g.b.y), lambda f: F.struct(f.d.alias("d"), (g.a.m + f.t * (g.b.m - g.a.m)).alias("m")))))

    return geo.let(geo.measured(points), best)


def touching(points: DataFrame, segments: DataFrame, metres: float) -> DataFrame:
    """vertex_id, edge_id, d, m, length, from_node_id, to_node_id of points (vertex_id, x, y) and segments within metres that do not end there.

    A point lies in one square of each level, a leg passes squares of one; a strip along the leg
    sifts what meets there in plain arithmetic, the foot on the whole line decides.
    """
    reach = metres + 0.001
    squares = spatial.leg_squares(segments.select("edge_id", "points"), "edge_id", reach)
    levels = spatial.used_levels(squares) or [spatial.MIN_LEVEL]
    spots = materialize(spatial.at_levels(points.select("vertex_id", "x", "y"), "x", "y", levels))  # of few points a small file, which is sent about
    dx, dy, ux, uy = F.col("x") - F.col("xa"), F.col("y") - F.col("ya"), F.col("xb") - F.col("xa"), F.col("yb") - F.col("ya")
    off = dx * uy - dy * ux
    strip = F.col("x").between(F.least("xa", "xb") - reach, F.greatest("xa", "xb") + reach) & F.col("y").between(F.least("ya", "yb") - reach, F.greatest("ya", "yb") + reach)
    strip = strip & (off * off <= reach * reach * (ux * ux + uy * uy))
    near = materialize(spots.join(squares, ["level_", "prefix_"]).where(strip).select("vertex_id", "edge_id", "x", "y").distinct())  # legs that follow each other share a vertex
    j = near.join(segments.select("edge_id", "from_node_id", "to_node_id", "points"), "edge_id").where("vertex_id <> from_node_id and vertex_id <> to_node_id")
    j = once(j, f=line_foot(F.col("x"), F.col("y"), F.col("points"))).where(F.col("f.d") <= metres)
    return j.withColumn("length", geo.line_length(F.col("points"))).select("vertex_id", "edge_id", "x", "y", "f.d", "f.m", "length", "from_node_id", "to_node_id", "points")


def clustered_cuts(cuts: DataFrame, segments: DataFrame, gap: float) -> DataFrame:
    """edge_id, cluster, m, x, y, members: cuts (edge_id, m, vertex_id) of one edge that lie closer than gap in a row become one at their mean."""
    c = fuse.gap_clusters(cuts, ["edge_id"], "m", gap)
    mean = F.avg("m").over(W.partitionBy("edge_id", "cluster_"))
    at = c.withColumn("mean", mean).join(segments.select("edge_id", "points"), "edge_id")
    return at.withColumn("p", geo.interpolate(geo.measured(F.col("points")), F.col("mean"))).select("edge_id", F.col("cluster_").alias("cluster"), F.col("mean").alias("m"), "p.x", "p.y", "vertex_id")


def with_ids(clusters: DataFrame, nodes: DataFrame) -> DataFrame:
    """Clusters with a new vertex_id of their own, after the greatest of nodes, in the order of edge and cluster; members keep theirs as old_id."""
    top = nodes.agg(F.coalesce(F.max("vertex_id"), F.lit(0)).alias("top_"))
    one = fuse.renumber(clusters.select("edge_id", "cluster").distinct(), "n_", "edge_id", "cluster").crossJoin(F.broadcast(top))  # top is one row
    return clusters.withColumnRenamed("vertex_id", "old_id").join(one.select("edge_id", "cluster", (F.col("top_") + F.col("n_")).alias("vertex_id")), ["edge_id", "cluster"])


def reshaped(nodes: DataFrame, segments: DataFrame, final: DataFrame, cuts: DataFrame, connectors: DataFrame | None, top: DataFrame, kind: str) -> DataFrame:
    """Segments after redirects (source, final), cuts and connectors, with their length len_ and whether they stay as they were, same_; new ids follow top (top_), one row."""
    placed = nodes.select("vertex_id", "x", "y").unionByName(cuts.select("vertex_id", "x", "y")).dropDuplicates(["vertex_id"])
    per_edge = cuts.groupBy("edge_id").agg(F.array_sort(F.collect_list(F.struct("m", "vertex_id"))).alias("cuts"))  # cuts of one edge: bounded by its length
    rest = [c for c in segments.columns if c not in ("edge_id", "from_node_id", "to_node_id", "points")]
    whole = segments.join(per_edge.select("edge_id"), "edge_id", "left_anti").withColumn("part", F.lit(0))
    line = segments.join(per_edge, "edge_id").withColumn("line", geo.measured(F.col("points")))
    ms = F.concat(F.array(F.lit(0.0)), F.transform("cuts", lambda c: c.m), F.array(F.element_at("line", -1).m))
    vs = F.concat(F.array("from_node_id"), F.transform("cuts", lambda c: c.vertex_id), F.array("to_node_id"))
    n = F.size("cuts") + 1
    pieces = F.arrays_zip(F.slice(ms, F.lit(1), n).alias("s"), F.slice(ms, F.lit(2), n).alias("e"), F.slice(vs, F.lit(1), n).alias("a"), F.slice(vs, F.lit(2), n).alias("b"))
    parts = line.select("edge_id", *rest, "line", F.posexplode(pieces).alias("part", "p")).where("p.e > p.s")
    parts = parts.select("edge_id", F.col("p.a").alias("from_node_id"), F.col("p.b").alias("to_node_id"), geo.substring(F.col("line"), F.col("p.s"), F.col("p.e")).alias("points"), *rest, "part")
    ids = fuse.renumber(parts.select("edge_id", "part").distinct(), "n_", "edge_id", "part").crossJoin(F.broadcast(top)).select("edge_id", "part", (F.col("top_") + F.col("n_")).alias("id_"))
    fresh = parts.join(ids, ["edge_id", "part"]).withColumn("edge_id", F.col("id_")).drop("id_", "part")
    out = whole.drop("part").select(fresh.columns).withColumn("same_", F.lit(True)).unionByName(fresh.withColumn("same_", F.lit(False)))
    if connectors is not None:
        links = connectors.select(F.col("from_id").alias("from_node_id"), F.col("to_id").alias("to_node_id")).distinct()
        most = out.select("edge_id").unionByName(top.select(F.col("top_").alias("edge_id"))).agg(F.max("edge_id").alias("top_"))
        links = fuse.renumber(links, "n_", "from_node_id", "to_node_id").crossJoin(F.broadcast(most)).select((F.col("top_") + F.col("n_")).alias("edge_id"), "from_node_id", "to_node_id", F.lit(kind).alias("segment_type"), F.lit(False).alias("same_"))
        out = out.unionByName(links, allowMissingColumns=True)
    for end in ("from_node_id", "to_node_id"):
        f = final.select(F.col("source").alias(end), F.col("final").alias("final_"))
        at = placed.select(F.col("vertex_id").alias(end), F.struct("x", "y").alias(f"{end}_at"))
        out = out.join(f, end, "left").withColumn("same_", F.col("same_") & F.col("final_").isNull()).withColumn(end, F.coalesce("final_", end)).drop("final_").join(at, end, "left")
    a, b = F.col("from_node_id_at"), F.col("to_node_id_at")
    inner = F.coalesce(F.slice("points", F.lit(2), F.greatest(F.size("points") - 2, F.lit(0))), F.array().cast("array<struct<x:double,y:double>>"))
    kept = F.coalesce(a == F.get("points", F.lit(0)), F.lit(True)) & F.coalesce(b == F.element_at("points", -1), F.lit(True)) & (F.size("points") >= 2)
    out = out.withColumn("same_", F.coalesce(F.col("same_") & kept, F.lit(False)))
    out = out.withColumn("points", F.concat(F.array(F.coalesce(a, F.get("points", F.lit(0)))), inner, F.array(F.coalesce(b, F.element_at("points", -1))))).drop("from_node_id_at", "to_node_id_at")
    return out.withColumn("len_", geo.line_length(F.col("points")))


def _referenced(nodes: DataFrame, segments: DataFrame) -> DataFrame:
    used = segments.select(F.explode(F.array("from_node_id", "to_node_id")).alias("vertex_id")).distinct()
    return nodes.join(used, "vertex_id", "left_semi")


def rebuild(nodes: DataFrame, segments: DataFrame, redirects: DataFrame, cuts: DataFrame, connectors: DataFrame | None = None, drop_m: float = 0.3, review_m: float = 1.0, referenced_only: bool = True, kind: str = "SIDE_LINE") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, segments and a log (reason, edge_id, length) after redirects (source, target), cuts and connectors (from_id, to_id).

    A cut edge becomes parts with new ids, in order, after the greatest one; ends move to the place
    of their final node. Self loops and edges below drop_m go, edges below review_m are logged; of
    edges with the same ends and type the lowest id stays, so that originals win over parts and
    connectors.
    """
    final = materialize(graph.resolve_redirects(redirects, "source", "target"))
    top = segments.agg(F.coalesce(F.max("edge_id"), F.lit(0)).alias("top_"))
    out = materialize(reshaped(nodes, segments, final, cuts, connectors, top, kind))
    loop, short = F.col("from_node_id") == F.col("to_node_id"), F.col("len_") < drop_m
    log = out.where(loop | (F.col("len_") < review_m)).select(F.when(loop, "SELF_LOOP").when(short, "DROPPED_SHORT").otherwise("REVIEW_SHORT").alias("reason"), "edge_id", F.col("len_").alias("length"))
    kept = out.where(~loop & ~short).withColumn("p_", F.least("from_node_id", "to_node_id")).withColumn("q_", F.greatest("from_node_id", "to_node_id"))
    kept = fuse.first_per_key(kept, ["p_", "q_", "segment_type"], "edge_id").drop("p_", "q_")
    if "length" in segments.columns:
        kept = kept.withColumn("length", F.round("len_", 2))
    kept = materialize(kept.drop("len_", "same_").select(segments.columns))
    all_nodes = nodes.unionByName(cuts.select("vertex_id", "x", "y").distinct(), allowMissingColumns=True)
    return _referenced(all_nodes, kept) if referenced_only else all_nodes, kept, log


def repair_topology(nodes: DataFrame, segments: DataFrame, split_m: float = 1.0, end_m: float = 1.0, merge_m: float = 1.0, cluster_m: float = 1.0, shift_floor_m: float = 2.0, shift_share: float = 0.2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, segments and a log (reason, vertex_id, edge_id) after each node that touches a foreign segment was joined with it.

    A node whose foot lies within end_m of the segment's end is merged with the node there if that
    is within merge_m, the nearest first; others cut the segment, cuts within cluster_m in a row
    becoming one new node. Of several segments to cut the nearest is taken if it is nearer by more
    than 0.5 m, or else more than 1 m further from its ends, or else its ends have more edges;
    otherwise the node is AMBIGUOUS. No node moves further than shift_floor_m or shift_share of the
    shortest of its edges. Two nodes that would each become the other become the lower id.
    """
    used = segments.select(F.explode(F.array("from_node_id", "to_node_id")).alias("vertex_id")).distinct()
    own = nodes.join(used, "vertex_id", "left_semi")
    deg = materialize(graph.degrees(segments))
    at = own.select("vertex_id", "x", "y")
    chord = segments.select("from_node_id", "to_node_id").join(at.select(F.col("vertex_id").alias("from_node_id"), F.col("x").alias("xa"), F.col("y").alias("ya")), "from_node_id").join(at.select(F.col("vertex_id").alias("to_node_id"), F.col("x").alias("xb"), F.col("y").alias("yb")), "to_node_id")
    chord = chord.select(F.hypot(F.col("xa") - F.col("xb"), F.col("ya") - F.col("yb")).alias("chord"), F.explode(F.array("from_node_id", "to_node_id")).alias("vertex_id"))
    allowed = materialize(chord.groupBy("vertex_id").agg(F.greatest(F.lit(shift_floor_m), F.min("chord") * shift_share).alias("allowed")))
    near = touching(at, segments, split_m)
    by_end = lambda e: deg.select(F.col("vertex_id").alias(f"{e}_node_id"), F.col("degree").alias(f"{e}_degree"))
    near = materialize(near.join(by_end("from"), "from_node_id").join(by_end("to"), "to_node_id").join(allowed, "vertex_id"))
    to_end = F.col("length") - F.col("m")
    first = F.col("m") <= to_end
    near = near.withColumn("d3", F.round("d", 3)).withColumn("stable", F.least(F.col("m"), to_end))
    ends = near.where(F.col("stable") <= end_m).withColumn("target", F.when(first, F.col("from_node_id")).otherwise(F.col("to_node_id"))).withColumn("target_degree", F.when(first, F.col("from_degree")).otherwise(F.col("to_degree")))
    spot = F.when(first, F.get("points", F.lit(0))).otherwise(F.element_at("points", -1))
    ends = ends.withColumn("reach", F.round(F.hypot(F.col("x") - spot.x, F.col("y") - spot.y), 3)).join(at.select(F.col("vertex_id").alias("target"), F.col("x").alias("tx"), F.col("y").alias("ty")), "target").where("target <> vertex_id")
    chosen = ends.where(F.col("reach") <= merge_m).groupBy("vertex_id").agg(F.min(F.struct("reach", "d3", (-F.col("target_degree")).alias("less"), "edge_id", "target", "x", "y", "tx", "ty", "allowed")).alias("c")).select("vertex_id", "c.*")
    fits = F.hypot(F.col("tx") - F.col("x"), F.col("ty") - F.col("y")) <= F.col("allowed")
    chosen = materialize(chosen.withColumn("fits", fits))
    merges = chosen.where("fits").select(F.col("vertex_id").alias("source"), "target")
    log = ends.join(chosen.select("vertex_id"), "vertex_id", "left_anti").select(F.lit("MERGE_TOO_FAR").alias("reason"), "vertex_id", "edge_id")
    log = log.unionByName(chosen.where("not fits").select(F.lit("SHIFT_TOO_LARGE").alias("reason"), "vertex_id", "edge_id"))
    inner = near.where(F.col("stable") > end_m).join(merges.select(F.col("source").alias("vertex_id")), "vertex_id", "left_anti").withColumn("edges", F.col("from_degree") + F.col("to_degree"))
    best = F.array_sort(F.collect_list(F.struct("d3", (-F.col("stable")).alias("less_stable"), (-F.col("edges")).alias("fewer"), "edge_id", "m")))  # segments within a metre of one node
    best = inner.groupBy("vertex_id").agg(best.alias("all")).select("vertex_id", F.get("all", F.lit(0)).alias("b"), F.get("all", F.lit(1)).alias("s"))
    clear = F.col("s").isNull() | (F.col("s.d3") - F.col("b.d3") > 0.5) | (F.col("s.less_stable") - F.col("b.less_stable") > 1.0) | (F.col("b.fewer") < F.col("s.fewer"))
    best = materialize(best.withColumn("clear", clear).select("vertex_id", "b.edge_id", "b.m", "clear"))
    log = log.unionByName(best.where("not clear").select(F.lit("AMBIGUOUS").alias("reason"), "vertex_id", "edge_id"))
    groups = clustered_cuts(best.where("clear").select("edge_id", "m", "vertex_id"), segments, cluster_m)
    moved = groups.join(at.select("vertex_id", F.col("x").alias("ox"), F.col("y").alias("oy")), "vertex_id").join(allowed, "vertex_id").withColumn("fits", F.hypot(F.col("x") - F.col("ox"), F.col("y") - F.col("oy")) <= F.col("allowed"))
    moved = materialize(moved)
    log = log.unionByName(moved.where("not fits").select(F.lit("SHIFT_TOO_LARGE").alias("reason"), "vertex_id", "edge_id"))
    named = materialize(with_ids(moved.where("fits").select("edge_id", "cluster", "m", "x", "y", "vertex_id"), nodes))
    redirects = merges.unionByName(named.select(F.col("old_id").alias("source"), F.col("vertex_id").alias("target")))
    n, s, short = rebuild(own, segments, redirects, materialize(named.select("edge_id", "m", "vertex_id", "x", "y").distinct()))
    return n, s, materialize(log.unionByName(short.select("reason", F.lit(None).cast("bigint").alias("vertex_id"), "edge_id")))


# ---- connections between components


class Limits(NamedTuple):
    """Distances in metres and cosines that decide on connections; per_pair: connections of ends kept for each two components."""

    reach_m: float = 20.0
    merge_m: float = 2.0
    same_m: float = 0.75
    split_m: float = 1.0
    end_m: float = 1.0
    connect_m: float = 12.0
    straight_m: float = 3.0
    ahead: float = 0.34
    not_back: float = -0.35
    per_pair: int = 2


def usable(nodes: DataFrame, segments: DataFrame) -> DataFrame:
    """Segments with known, unequal ends and a length."""
    known = nodes.select("vertex_id")
    s = segments.where((F.col("from_node_id") != F.col("to_node_id")) & (geo.line_length(F.col("points")) > 0.01))
    return materialize(s.join(known.withColumnRenamed("vertex_id", "from_node_id"), "from_node_id", "left_semi").join(known.withColumnRenamed("vertex_id", "to_node_id"), "to_node_id", "left_semi").select("edge_id", "from_node_id", "to_node_id", "points"))


def loose_ends(nodes: DataFrame, s: DataFrame, label: DataFrame) -> DataFrame:
    """vertex_id, x, y, component of nodes with one edge."""
    return materialize(nodes.select("vertex_id", "x", "y").join(graph.degrees(s).where("degree = 1").select("vertex_id"), "vertex_id").join(label, "vertex_id"))


def close_nodes(ends: DataFrame, nodes: DataFrame, metres: float) -> DataFrame:
    """vertex_id_a, vertex_id_b, distance_m of an end and another node."""
    return repair.near_pairs(ends, "vertex_id", metres, nodes).where("vertex_id_a <> vertex_id_b")


def close_insides(ends: DataFrame, s: DataFrame, split_m: float, end_m: float) -> DataFrame:
    """vertex_id, edge_id, d, m, from_node_id of an end and the inside of a segment."""
    near = touching(ends, s, split_m)
    gap = lambda p: F.hypot(F.col("x") - p.x, F.col("y") - p.y)
    away = F.least(gap(F.get("points", F.lit(0))), gap(F.element_at("points", -1)))
    foot = geo.interpolate(geo.measured(F.col("points")), F.col("m"))
    near = near.withColumn("p", foot).where(away > end_m)
    off = lambda p: F.hypot(F.col("p.x") - p.x, F.col("p.y") - p.y)
    return near.where(F.least(off(F.get("points", F.lit(0))), off(F.element_at("points", -1))) > end_m).select("vertex_id", "edge_id", "d", "m", "from_node_id")


def possible(ends: DataFrame, label: DataFrame, s: DataFrame, pairs: DataFrame, insides: DataFrame, limits: Limits, low: bool = True) -> DataFrame:
    """Connections without numbers, of close_nodes pairs and close_insides; those of priority LOW only if low."""
    of = lambda end: label.select(F.col("vertex_id").alias(f"vertex_id_{end}"), F.col("component").alias(f"c{end}"))
    # merges
    pairs = pairs.join(of("a"), "vertex_id_a").join(of("b"), "vertex_id_b").where("ca <> cb")
    nearest = materialize(pairs.groupBy("vertex_id_a").agg(F.min(F.struct("distance_m", "vertex_id_b")).alias("m")).select(F.col("vertex_id_a").alias("from_id"), F.col("m.vertex_id_b").alias("to_id"), "m.distance_m"))
    once_ = nearest.groupBy(F.least("from_id", "to_id").alias("p"), F.greatest("from_id", "to_id").alias("q")).agg(F.min(F.struct("from_id", "to_id", "distance_m")).alias("m")).select("m.*")
    none = {"to_edge": F.lit(None).cast("bigint"), "m": F.lit(None).cast("double")}
    merges = once_.select(F.lit("NODE_MERGE").alias("kind"), F.lit("NORMAL").alias("priority"), F.lit("blue").alias("colour"), "from_id", "to_id", *[v.alias(k) for k, v in none.items()], "distance_m")
    # splits
    near = insides.join(label.select(F.col("vertex_id").alias("vertex_id"), F.col("component").alias("mine")), "vertex_id").join(label.select(F.col("vertex_id").alias("from_node_id"), F.col("component").alias("theirs")), "from_node_id").where("mine <> theirs")
    cut = materialize(near.groupBy("vertex_id").agg(F.min(F.struct("d", "edge_id", "m")).alias("b")).select(F.col("vertex_id").alias("from_id"), F.col("b.d").alias("distance_m"), F.col("b.edge_id").alias("to_edge"), "b.m"))
    splits = cut.select(F.lit("SPLIT_AND_CONNECT").alias("kind"), F.lit("NORMAL").alias("priority"), F.lit("yellow").alias("colour"), "from_id", F.lit(None).cast("bigint").alias("to_id"), "to_edge", "m", "distance_m")
    # ends among themselves
    blocked = nearest.select(F.col("from_id").alias("vertex_id")).unionByName(cut.select(F.col("from_id").alias("vertex_id"))).distinct()
    free = materialize(ends.join(blocked, "vertex_id", "left_anti"))
    reach = limits.reach_m if low else min(limits.reach_m, max(limits.connect_m, limits.same_m))  # what lies further is LOW
    side = lambda e: free.select(F.col("vertex_id").alias(f"vertex_id_{e}"), F.col("x").alias(f"x{e}"), F.col("y").alias(f"y{e}"), F.col("component").alias(f"c{e}"))
    met = materialize(repair.near_pairs(free, "vertex_id", reach).join(side("a"), "vertex_id_a").join(side("b"), "vertex_id_b").where("ca <> cb"))
    asked = materialize(met.select(F.explode(F.array("vertex_id_a", "vertex_id_b")).alias("vertex_id")).distinct())
    tip = lambda end, first: s.join(asked.withColumnRenamed("vertex_id", end), end).select(F.col(end).alias("vertex_id"), geo.outward_tangent(F.col("points"), F.lit(first)).alias("t"))
    leaving = materialize(tip("from_node_id", True).unionByName(tip("to_node_id", False)))  # an end has one edge
    for e in "ab":
        met = met.join(leaving.select(F.col("vertex_id").alias(f"vertex_id_{e}"), F.col("t").alias(f"t{e}")), f"vertex_id_{e}", "left")
    ux, uy = (F.col("xb") - F.col("xa")) / F.col("distance_m"), (F.col("yb") - F.col("ya")) / F.col("distance_m")
    fa, fb = F.col("ta.x") * ux + F.col("ta.y") * uy, -(F.col("tb.x") * ux + F.col("tb.y") * uy)
    points_at = F.coalesce((F.greatest(fa, fb) >= limits.ahead) & (F.least(fa, fb) >= limits.not_back) & F.col("ta").isNotNull() & F.col("tb").isNotNull(), F.lit(False))
    far = (F.col("distance_m") > limits.connect_m) | ((F.col("distance_m") > limits.straight_m) & ~points_at)
    met = materialize(met.withColumn("low", far).withColumn("same", F.col("distance_m") <= limits.same_m).withColumn("p0", F.least("ca", "cb")).withColumn("p1", F.greatest("ca", "cb")))
    top = fuse.top_k(met.where("not low and not same"), ["p0", "p1"], limits.per_pair, F.asc("distance_m"), F.asc("vertex_id_a"), F.asc("vertex_id_b"))
    colour = F.when(F.col("distance_m") <= 12.0, "orange").otherwise("red")
    rows = lambda df, kind, priority, c: df.select(F.lit(kind).alias("kind"), F.lit(priority).alias("priority"), c.alias("colour"), F.col("vertex_id_a").alias("from_id"), F.col("vertex_id_b").alias("to_id"), *[v.alias(k) for k, v in none.items()], "distance_m")
    out = merges.unionByName(rows(met.where("same"), "NODE_MERGE", "NORMAL", F.lit("blue"))).unionByName(splits)
    out = out.unionByName(rows(top, "ENDPOINT_TO_ENDPOINT", "NORMAL", colour))
    return out.unionByName(rows(met.where("low and not same"), "ENDPOINT_TO_ENDPOINT", "LOW", colour)) if low else out


def connectivity(nodes: DataFrame, segments: DataFrame, **limits: float) -> DataFrame:
    """candidate_id, kind, priority, colour, from_id, to_id, to_edge, m, distance_m: possible connections of different components, by Limits.

    NODE_MERGE: an end and the nearest node within merge_m, each two nodes once; SPLIT_AND_CONNECT:
    an end and the nearest inside of a segment within split_m; ENDPOINT_TO_ENDPOINT: two ends that
    have none of both, within reach_m, the shortest per_pair of each two components. Ends further
    apart than connect_m, or than straight_m without pointing at each other, are LOW. Segments with
    unknown or equal ends or without length are ignored. Numbers go by distance, kind and ids.
    """
    by = Limits(**limits)
    s = usable(nodes, segments)
    label = materialize(graph.components(s, "from_node_id", "to_node_id"))
    ends = loose_ends(nodes, s, label)
    out = possible(ends, label, s, close_nodes(ends, nodes, by.merge_m), close_insides(ends, s, by.split_m, by.end_m), by)
    out = out.withColumn("distance_m", F.round("distance_m", 3)).withColumn("o_", F.coalesce("to_id", "to_edge")).withColumn("series", F.when(F.col("kind") == "NODE_MERGE", "merge").when(F.col("priority") == "LOW", "low").otherwise("conn"))
    numbered = None
    for name in ("conn", "merge", "low"):
        mine = fuse.renumber(out.where(F.col("series") == name), "n_", "distance_m", "kind", "from_id", "o_")
        mine = mine.withColumn("candidate_id", F.format_string(f"{name}-%05d", "n_"))
        numbered = mine if numbered is None else numbered.unionByName(mine)
    return materialize(numbered.select("candidate_id", "kind", "priority", "colour", "from_id", "to_id", "to_edge", "m", "distance_m"))


def accepted(nodes: DataFrame, segments: DataFrame, candidates: DataFrame, include_low: bool = False, include_merges: bool = True, cluster_m: float = 1.0, merge_m: float = 1.0, end_m: float = 0.01) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Redirects, cuts and connectors of candidates, for rebuild."""
    ok = candidates if include_low else candidates.where("priority <> 'LOW'")
    cut = ok.where("kind = 'SPLIT_AND_CONNECT'")
    struck = materialize(segments.join(cut.select(F.col("to_edge").alias("edge_id")).distinct(), "edge_id", "left_semi").select("edge_id", "points"))
    lengths = struck.select(F.col("edge_id").alias("to_edge"), geo.line_length(F.col("points")).alias("length"))
    cut = cut.join(lengths, "to_edge").where((F.col("m") > end_m) & (F.col("m") < F.col("length") - end_m))
    named = materialize(with_ids(clustered_cuts(cut.select(F.col("to_edge").alias("edge_id"), "m", F.col("from_id").alias("vertex_id")), struck, cluster_m), nodes))
    at = named.join(nodes.select(F.col("vertex_id").alias("old_id"), F.col("x").alias("ox"), F.col("y").alias("oy")), "old_id").withColumn("near", F.hypot(F.col("x") - F.col("ox"), F.col("y") - F.col("oy")) <= merge_m)
    at = materialize(at)
    taken = at.where("near").select(F.col("old_id").alias("source"), F.col("vertex_id").alias("target"))
    redirects = taken
    if include_merges:
        # all nodes that merges link become the lowest of them; a cut's node overrides a merge of the same node
        pairs = ok.where("kind = 'NODE_MERGE'").select("from_id", "to_id")
        label = graph.components(pairs, "from_id", "to_id").where("vertex_id <> component").select(F.col("vertex_id").alias("source"), F.col("component").alias("target"))
        redirects = label.join(taken.select("source"), "source", "left_anti").unionByName(taken)
    links = ok.where("kind = 'ENDPOINT_TO_ENDPOINT'").select("from_id", "to_id").unionByName(at.where("not near").select(F.col("old_id").alias("from_id"), F.col("vertex_id").alias("to_id")))
    return redirects, materialize(named.select("edge_id", "m", "vertex_id", "x", "y").distinct()), links


def apply_candidates(nodes: DataFrame, segments: DataFrame, candidates: DataFrame, **accept: float | bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, segments and a log after accepted candidates: merges, cuts (a node within merge_m of its cut becomes the new node, else gets a connector) and connectors."""
    return rebuild(nodes, segments, *accepted(nodes, segments, candidates, **accept))


def rejoined(nodes: DataFrame, segments: DataFrame, redirects: DataFrame, cuts: DataFrame, connectors: DataFrame, whole: bool, drop_m: float = 0.3, kind: str = "SIDE_LINE") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Nodes and segments as rebuild gives them, the usable ones of these, and edge_id of all that went, came or changed.

    A graph that was rebuilt holds nothing that a second pass would change by itself. So unless whole
    is asked for, segments that are cut or end at a redirected node are taken out, and what becomes of
    them is compared by ends and type with the rest.
    """
    final = materialize(graph.resolve_redirects(redirects, "source", "target"))
    top = segments.agg(F.coalesce(F.max("edge_id"), F.lit(0)).alias("top_"))
    pair = [F.least("from_node_id", "to_node_id").alias("p_"), F.greatest("from_node_id", "to_node_id").alias("q_")]
    touched = segments
    if not whole:
        at = lambda end: segments.select("edge_id", end).join(final.select(F.col("source").alias(end)), end, "left_semi").select("edge_id")
        hit = materialize(at("from_node_id").unionByName(at("to_node_id")).unionByName(cuts.select("edge_id")).distinct())
        touched = materialize(segments.join(hit, "edge_id", "left_semi"))
    out = materialize(reshaped(nodes, touched, final, cuts, connectors, top, kind))
    came = out.where((F.col("from_node_id") != F.col("to_node_id")) & (F.col("len_") >= drop_m)).drop("len_").select("*", *pair)
    came = materialize(fuse.first_per_key(came, ["p_", "q_", "segment_type"], "edge_id"))
    if whole:
        kept = materialize(came.select(segments.columns))
        altered = segments.select("edge_id").join(came.where("same_").select("edge_id"), "edge_id", "left_anti").unionByName(came.where("not same_").select("edge_id"))
    else:
        rest = segments.select("edge_id", "segment_type", *pair).join(hit, "edge_id", "left_anti")
        rival = rest.join(came.select("p_", "q_", F.col("segment_type").alias("type_"), F.col("edge_id").alias("new_")), ["p_", "q_"]).where(F.col("segment_type").eqNullSafe(F.col("type_")))
        rival = materialize(rival.select("edge_id", "new_"))
        came = came.join(rival.where("edge_id < new_").select(F.col("new_").alias("edge_id")), "edge_id", "left_anti")
        went = materialize(hit.unionByName(rival.where("edge_id > new_").select("edge_id")))
        came = materialize(came.select(segments.columns))
        kept = materialize(segments.join(went, "edge_id", "left_anti").select(segments.columns).unionByName(came))
        altered = went.unionByName(came.select("edge_id"))
    nodes = materialize(_referenced(nodes.unionByName(cuts.select("vertex_id", "x", "y").distinct(), allowMissingColumns=True), kept))
    return nodes, kept, _with_known_ends(nodes, kept), materialize(altered.distinct())


def _with_known_ends(nodes: DataFrame, segments: DataFrame) -> DataFrame:
    """Usable segments of a rebuilt graph, which has neither loops nor lines without length."""
    ends = segments.select(F.explode(F.array("from_node_id", "to_node_id")).alias("vertex_id"))
    lost = materialize(ends.where("vertex_id is not null").distinct().join(nodes.select("vertex_id"), "vertex_id", "left_anti"))
    s = segments.where("from_node_id is not null and to_node_id is not null").select("edge_id", "from_node_id", "to_node_id", "points")
    if lost.isEmpty():
        return s
    for end in ("from_node_id", "to_node_id"):
        s = s.join(lost.withColumnRenamed("vertex_id", end), end, "left_anti")
    return materialize(s)


def connect_until_settled(nodes: DataFrame, segments: DataFrame, rounds: int = 20, **limits: float) -> tuple[DataFrame, DataFrame, list[int], bool]:
    """Candidates found and applied again and again: nodes, segments, candidates of each round, and whether the last round found none.

    An end of the greatest component is held against the insides of other components only, any other
    end against all. What lies near an end is looked for once; after a round only for ends that are
    new and near segments and nodes that are.
    """
    by = Limits(**limits)
    counts: list[int] = []
    s = usable(nodes, segments)
    state: tuple | None = None
    for _ in range(rounds):
        label = materialize(graph.components(s, "from_node_id", "to_node_id"))
        ends = loose_ends(nodes, s, label)
        main = label.groupBy("component").agg(F.count("*").alias("n")).agg(F.max_by("component", F.struct("n", "component")).alias("main"))
        inside = F.col("component") == F.lit(main.first()["main"])  # one row
        outer = materialize(ends.where(~inside))
        other = materialize(s.join(label.where(~inside).select(F.col("vertex_id").alias("from_node_id")), "from_node_id", "left_semi"))
        if state is None:
            pairs, insides = close_nodes(ends, nodes, by.merge_m), close_insides(outer, s, by.split_m, by.end_m)
        else:
            ends0, outer0, pairs0, insides0, altered, placed = state
            still = lambda now, before: materialize(now.join(before.select("vertex_id"), "vertex_id", "left_semi").join(placed.select("vertex_id"), "vertex_id", "left_anti"))
            less = lambda now, kept: materialize(now.join(kept.select("vertex_id"), "vertex_id", "left_anti"))
            kept = still(ends, ends0)
            new = less(ends, kept)
            b = nodes.select(F.col("vertex_id").alias("vertex_id_b")).join(placed.select(F.col("vertex_id").alias("vertex_id_b")), "vertex_id_b", "left_anti")
            pairs = pairs0.join(kept.select(F.col("vertex_id").alias("vertex_id_a")), "vertex_id_a", "left_semi").join(b, "vertex_id_b", "left_semi")
            pairs = pairs.unionByName(close_nodes(new, nodes, by.merge_m)).unionByName(close_nodes(kept, placed.join(nodes.select("vertex_id"), "vertex_id", "left_semi"), by.merge_m))
            kept = still(outer, outer0)
            new = less(outer, kept)
            fresh = materialize(s.join(altered, "edge_id", "left_semi"))
            insides = insides0.join(kept.select("vertex_id"), "vertex_id", "left_semi").join(altered, "edge_id", "left_anti")
            for points, lines in ((new, s), (kept, fresh)):
                if not points.isEmpty():
                    insides = insides.unionByName(close_insides(points, lines, by.split_m, by.end_m))
        pairs, insides = materialize(pairs), materialize(insides)
        across = insides.unionByName(close_insides(ends.where(inside), other, by.split_m, by.end_m))
        found = materialize(possible(ends, label, s, pairs, across, by, low=False).where("colour <> 'red'"))
        counts.append(found.count())
        if not counts[-1]:
            return nodes, segments, counts, True
        redirects, cuts, links = accepted(nodes, segments, found)
        nodes, segments, s, altered = rejoined(nodes, segments, redirects, cuts, links, whole=state is None)
        state = ends, outer, pairs, insides, altered, materialize(cuts.select("vertex_id", "x", "y").distinct())
    return nodes, segments, counts, False


def bridge_links(nodes: DataFrame, segments: DataFrame, metres: float = 30.0, auto: float = 3.0, review: float = 12.0) -> DataFrame:
    """component, own_edge, own_m, main_edge, main_m, distance_m, tier: for every component but the main one its shortest link to a main segment.

    Links start at a component's ends; a component without ends, a closed one, is linked from any
    vertex of its lines, or from a vertex of a main line to one of its own. The main component has
    the most edges, then nodes, then the lowest id.
    """
    label = materialize(graph.components(segments, "from_node_id", "to_node_id"))
    main = graph.component_stats(segments, label).agg(F.max_by("component", F.struct("n_edges", "n_nodes", -F.col("component"))).alias("main"))
    s = materialize(segments.select("edge_id", "from_node_id", "to_node_id", "points").join(label.withColumnRenamed("vertex_id", "from_node_id"), "from_node_id").crossJoin(F.broadcast(main)))  # one row
    inside, outside = s.where("component = main"), s.where("component <> main")
    deg = graph.degrees(segments).where("degree = 1")
    tips = outside.select("component", "edge_id", F.explode(F.array(F.struct(F.col("from_node_id").alias("v"), F.lit(True).alias("first")), F.struct(F.col("to_node_id").alias("v"), F.lit(False).alias("first")))).alias("e"), "points")
    tips = materialize(tips.join(deg.select(F.col("vertex_id").alias("v_")), F.col("e.v") == F.col("v_"), "left_semi"))
    spot = F.when(F.col("e.first"), F.get("points", F.lit(0))).otherwise(F.element_at("points", -1))
    starts = tips.select("component", F.col("edge_id").alias("own_edge"), F.when(F.col("e.first"), F.lit(0.0)).otherwise(geo.line_length(F.col("points"))).alias("own_m"), spot.alias("p"))
    vertices = lambda df, edge, m: df.select("component", F.col("edge_id").alias(edge), F.explode(geo.measured(F.col("points"))).alias("v")).select("component", edge, F.col("v.m").alias(m), F.struct("v.x", "v.y").alias("p"))
    closed = outside.join(tips.select("component").distinct(), "component", "left_anti")
    starts = starts.unionByName(vertices(closed, "own_edge", "own_m"))

    def links(points: DataFrame, lines: DataFrame, edge: str, m: str, other_edge: str, other_m: str) -> DataFrame:
        spots = materialize(points.withColumn("spot", F.xxhash64(edge, m)))
        near = transfer.near_lines(spots.select("spot", F.array("p").alias("points")).dropDuplicates(["spot"]), lines.select("edge_id", "points"), "spot", "edge_id", metres).select("spot", "edge_id")
        j = spots.join(near, "spot").join(lines.select("edge_id", F.col("points").alias("line"), F.col("component").alias("theirs")), "edge_id")
        return j.withColumn("f", line_foot(F.col("p.x"), F.col("p.y"), F.col("line"))).select("component", "theirs", edge, m, F.col("edge_id").alias(other_edge), F.col("f.m").alias(other_m), F.col("f.d").alias("distance_m"))

    there = links(starts, inside, "own_edge", "own_m", "main_edge", "main_m").select("component", "own_edge", "own_m", "main_edge", "main_m", "distance_m")
    back = links(vertices(inside, "main_edge", "main_m"), closed, "main_edge", "main_m", "own_edge", "own_m").select(F.col("theirs").alias("component"), "own_edge", "own_m", "main_edge", "main_m", "distance_m")
    best = there.unionByName(back).groupBy("component").agg(F.min(F.struct("distance_m", "own_edge", "main_edge", "own_m", "main_m")).alias("b"))
    tier = F.when(F.col("b.distance_m") <= auto, "AUTO").when(F.col("b.distance_m") <= review, "REVIEW").otherwise("HELD")
    return best.select("component", "b.own_edge", "b.own_m", "b.main_edge", "b.main_m", "b.distance_m", tier.alias("tier"))


def apply_bridges(nodes: DataFrame, segments: DataFrame, links: DataFrame, alias_m: float = 1.0, cluster_m: float = 1.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, segments and a log with the AUTO links built: both sides are cut where needed (a place within alias_m of an end is that end) and connected."""
    auto = materialize(links.where("tier = 'AUTO'").withColumn("link", F.col("component")))
    lines = segments.select("edge_id", "from_node_id", "to_node_id", geo.line_length(F.col("points")).alias("length"))
    sides = auto.select("link", F.lit(0).alias("side"), F.col("own_edge").alias("edge_id"), F.col("own_m").alias("m")).unionByName(auto.select("link", F.lit(1).alias("side"), F.col("main_edge").alias("edge_id"), F.col("main_m").alias("m")))
    sides = materialize(sides.join(lines, "edge_id").withColumn("vertex_id", F.col("link") * 2 + F.col("side")))
    near_end = F.when(F.least(F.col("m"), F.col("length") - F.col("m")) <= alias_m, F.when(F.col("m") <= F.col("length") - F.col("m"), F.col("from_node_id")).otherwise(F.col("to_node_id")))
    sides = sides.withColumn("end_id", near_end)
    named = materialize(with_ids(clustered_cuts(sides.where("end_id is null").select("edge_id", "m", "vertex_id"), segments, cluster_m), nodes))
    ids = sides.where("end_id is not null").select("link", "side", F.col("end_id").alias("id")).unionByName(sides.join(named.select(F.col("old_id").alias("vertex_id"), F.col("vertex_id").alias("id")), "vertex_id").select("link", "side", "id"))
    ends = ids.groupBy("link").agg(F.max(F.when(F.col("side") == 0, F.col("id"))).alias("from_id"), F.max(F.when(F.col("side") == 1, F.col("id"))).alias("to_id"))
    none = nodes.sparkSession.createDataFrame([], "source bigint, target bigint")
    return rebuild(nodes, segments, none, materialize(named.select("edge_id", "m", "vertex_id", "x", "y").distinct()), ends, referenced_only=False)


# ---- validation

#: fixed values: the columns a graph must have
NODE_COLUMNS = ("vertex_id", "source_node_key", "point")
SEGMENT_COLUMNS = ("edge_id", "from_node_id", "to_node_id", "geom", "length_meter", "walk_access", "avg_slope_percent", "width_meter", "braille_block_state", "audio_signal_state", "stairs_state", "slope_state", "width_state", "surface_state", "signal_state", "segment_type")
#: counters that must be zero before a graph is exported
BLOCKERS = ("missing_node_columns", "missing_segment_columns", "bad_node_points", "bad_geometries", "bad_references", "duplicate_node_ids", "duplicate_edge_ids", "self_loops", "endpoint_mismatches", "isolated_nodes")


def validate(nodes: DataFrame, segments: DataFrame, node_point: Column, line: Column, enums: Mapping[str, Sequence[str]], tolerance_m: float = 1.0) -> DataFrame:
    """check_name, n: every counter of a graph in (degree) coordinates; node_point gives struct(lon, lat), line an array of struct(x, y), null where unusable.

    Adds to graph.checks: missing columns, unusable points and lines (or lines of 0.01 m at most),
    line ends further than tolerance_m from their node, distinct node pairs, components, the main
    component's edges by all rows and by distinct pairs.
    """
    spark = nodes.sparkSession
    missing = [("missing_node_columns", len([c for c in NODE_COLUMNS if c not in nodes.columns])), ("missing_segment_columns", len([c for c in SEGMENT_COLUMNS if c not in segments.columns]))]
    base = graph.checks(nodes, segments, enums)
    n = nodes.select("vertex_id", node_point.alias("p"))
    at = materialize(n.where("p is not null").groupBy("vertex_id").agg(F.min("p").alias("p")))
    s = materialize(segments.select("edge_id", "from_node_id", "to_node_id", line.alias("l")).withColumn("metres", geo.line_length_degrees(F.col("l"))))
    good = s.where("l is not null and metres > 0.01")
    gap = lambda p, v: geo.flat_metres(p.lon, p.lat, v.x, v.y)
    ends = good.join(at.select(F.col("vertex_id").alias("from_node_id"), F.col("p").alias("pa")), "from_node_id").join(at.select(F.col("vertex_id").alias("to_node_id"), F.col("p").alias("pb")), "to_node_id")
    off = F.greatest(gap(F.col("pa"), F.get("l", F.lit(0))), gap(F.col("pb"), F.element_at("l", -1)))
    pairs = s.where("from_node_id is not null and to_node_id is not null").select(F.least("from_node_id", "to_node_id").alias("a"), F.greatest("from_node_id", "to_node_id").alias("b"))
    label = materialize(graph.components(pairs, "a", "b"))
    per = lambda df: df.join(label.withColumnRenamed("vertex_id", "a"), "a").groupBy("component").agg(F.count("*").alias("k"))
    one = lambda name, df: df.select(F.lit(name).alias("check_name"), F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))
    parts = [
        one("bad_node_points", n.agg(F.count_if(F.col("p").isNull()).alias("n"))),
        one("bad_geometries", s.agg(F.count_if(F.col("l").isNull() | ~(F.col("metres") > 0.01)).alias("n"))),
        one("endpoint_mismatches", ends.where(off > tolerance_m).agg(F.count("*").alias("n"))),
        one("distinct_node_pairs", pairs.distinct().agg(F.count("*").alias("n"))),
        one("components", label.agg(F.count_distinct("component").alias("n"))),
        one("main_component_rows", per(pairs).agg(F.max("k").alias("n"))),
        one("main_component_pairs", per(pairs.distinct()).agg(F.max("k").alias("n"))),
    ]
    out = base.unionByName(spark.createDataFrame(missing, "check_name string, n bigint"))
    for p in parts:
        out = out.unionByName(p)
    return out


def blockers(checks: DataFrame) -> DataFrame:
    """The counters that forbid an export: blockers and all enum violations above zero."""
    return checks.where((F.col("check_name").isin(*BLOCKERS) | F.col("check_name").startswith("enum_")) & (F.col("n") > 0))


def require_sound(checks: DataFrame) -> None:
    """Raise if any blocker counts; a report of a few rows."""
    bad = {r.check_name: r.n for r in blockers(checks).collect()}
    if bad:
        raise ValueError(f"the graph must not be exported: {bad}")
    if not checks.where("check_name = 'n_segments' and n > 0").count():
        raise ValueError("the graph has no rows")


def intersection_roots(segments: DataFrame, least_m: float = 1.0) -> DataFrame:
    """vertex_id, degree, radius of nodes with three or more edges: half the widest edge, at least least_m. segments: from_node_id, to_node_id, width."""
    ends = segments.select(F.explode(F.array("from_node_id", "to_node_id")).alias("vertex_id"), "width").where("vertex_id is not null")
    return ends.groupBy("vertex_id").agg(F.count("*").alias("degree"), F.greatest(F.coalesce(F.max("width"), F.lit(0.0)) / 2, F.lit(least_m)).alias("radius")).where("degree >= 3")


def sectors(nodes: DataFrame, segments: DataFrame, merge_degrees: float = 18.0) -> DataFrame:
    """vertex_id, sector, low, high: sectors between neighbouring arms of each intersection, by bearing.

    Arms whose bearings follow each other within merge_degrees are one, at their mean; the first and
    the last are one if they meet through 0. An intersection with fewer than two arms has no sector.
    nodes: vertex_id; segments: edge_id, from_node_id, to_node_id, points.
    """
    arm = lambda v, start: F.struct(F.col(v).alias("vertex_id"), geo.outward_tangent(F.col("points"), F.lit(start)).alias("t"))
    arms = segments.select(F.explode(F.array(arm("from_node_id", True), arm("to_node_id", False))).alias("a")).select("a.vertex_id", "a.t").where("t is not null").join(nodes.select("vertex_id"), "vertex_id", "left_semi")
    arms = arms.select("vertex_id", F.pmod(F.degrees(F.atan2(-F.col("t.y"), -F.col("t.x"))), F.lit(360.0)).alias("bearing"))
    w = W.partitionBy("vertex_id").orderBy("bearing")
    runs = fuse.gap_clusters(arms, ["vertex_id"], "bearing", merge_degrees)
    last = F.max("cluster_").over(W.partitionBy("vertex_id"))
    wrap = (F.min("bearing").over(W.partitionBy("vertex_id")) + 360.0 - F.max("bearing").over(W.partitionBy("vertex_id")) <= merge_degrees) & (last > 0)
    runs = runs.withColumn("last", last).withColumn("wrap", wrap)
    turned = F.when(F.col("wrap") & (F.col("cluster_") == F.col("last")), F.col("bearing") - 360.0).otherwise(F.col("bearing"))
    group = F.when(F.col("wrap") & (F.col("cluster_") == F.col("last")), F.lit(0)).otherwise(F.col("cluster_"))
    one = runs.select("vertex_id", group.alias("g"), turned.alias("b")).groupBy("vertex_id", "g").agg(F.avg("b").alias("b")).withColumn("low", F.pmod("b", F.lit(360.0)))
    w = W.partitionBy("vertex_id").orderBy("low")
    n = F.count("*").over(W.partitionBy("vertex_id"))
    first = F.first("low").over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    out = one.withColumn("n", n).withColumn("sector", F.row_number().over(w)).withColumn("high", F.coalesce(F.lead("low").over(w), first))
    return out.where("n >= 2").select("vertex_id", "sector", "low", "high")


def prune_dangling(segments: DataFrame, length: str, most_m: float, rounds: int = 1000) -> tuple[DataFrame, bool]:
    """Segments without chains that hang on one node and are at most most_m long in all; and whether no such chain is left.

    Chains between branchings are measured as a whole, so one round takes each away completely;
    the next looks at what the cut has opened.
    """
    from wayfold.operators import build

    for _ in range(rounds):
        deg = materialize(graph.degrees(segments))
        chain = build.chains(segments).join(segments.select("edge_id", "from_node_id", "to_node_id", length), "edge_id")
        ends = chain.select("chain", F.explode(F.array("from_node_id", "to_node_id")).alias("vertex_id")).join(deg, "vertex_id").where("degree <> 2").groupBy("chain").agg(F.count_if(F.col("degree") == 1).alias("tips"), F.count_if(F.col("degree") > 2).alias("roots"))
        short = chain.groupBy("chain").agg(F.sum(length).alias("whole")).where(F.col("whole") <= most_m).join(ends.where("tips = 1 and roots = 1"), "chain", "left_semi")
        bad = materialize(chain.join(short.select("chain"), "chain", "left_semi").select("edge_id"))
        if bad.isEmpty():
            return segments, True
        segments = materialize(segments.join(bad, "edge_id", "left_anti"))
    return segments, False
