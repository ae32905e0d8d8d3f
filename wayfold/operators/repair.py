"""Finding and applying connections between the components of a road graph, splitting edges, merging nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.functions import geo
from wayfold.operators import fuse, graph, spatial
from wayfold.plans.runtime import materialize


def near_pairs(points: DataFrame, key: str, metres: float, others: DataFrame | None = None) -> DataFrame:
    """key_a, key_b, distance_m of planar points (x, y) within metres; unordered pairs once if there is one set."""
    a = points.select(F.col(key).alias(f"{key}_a"), F.col("x").alias("xa"), F.col("y").alias("ya"))
    b = (points if others is None else others).select(F.col(key).alias(f"{key}_b"), F.col("x").alias("xb"), F.col("y").alias("yb"))
    level = next(v for v in range(spatial.MIN_LEVEL, spatial.MAX_LEVEL + 1, spatial.LEVEL_STEP) if 2 * metres <= float(1 << v))
    # of two sets it is points that are covered: others may be all nodes
    covered = spatial.cover(a, F.col("xa") - metres, F.col("ya") - metres, F.col("xa") + metres, F.col("ya") + metres)
    hits = spatial.at_levels(b, "xb", "yb", [level]).join(covered, ["level_", "prefix_"])
    near = hits.withColumn("distance_m", F.hypot(F.col("xa") - F.col("xb"), F.col("ya") - F.col("yb"))).where(F.col("distance_m") <= metres)
    near = near.where(F.col(f"{key}_a") < F.col(f"{key}_b")) if others is None else near
    return near.select(f"{key}_a", f"{key}_b", "distance_m")


def endpoints(nodes: DataFrame, segments: DataFrame, label: DataFrame) -> DataFrame:
    """vertex_id, x, y, component of nodes with one edge."""
    ends = graph.degrees(segments).where("degree = 1").select("vertex_id")
    return nodes.select("vertex_id", "x", "y").join(ends, "vertex_id").join(label, "vertex_id")


def connection_candidates(ends: DataFrame, merge_m: float = 0.75, connect_m: float = 12.0, per_pair: int = 2) -> DataFrame:
    """vertex_id_a, vertex_id_b, distance_m, kind between ends of different components: the shortest per_pair of each two components."""
    pairs = near_pairs(ends, "vertex_id", connect_m)
    a = ends.select(F.col("vertex_id").alias("vertex_id_a"), F.col("component").alias("ca"))
    b = ends.select(F.col("vertex_id").alias("vertex_id_b"), F.col("component").alias("cb"))
    j = pairs.join(a, "vertex_id_a").join(b, "vertex_id_b").where("ca <> cb").withColumn("c0", F.least("ca", "cb")).withColumn("c1", F.greatest("ca", "cb"))
    best = fuse.top_k(j, ["c0", "c1"], per_pair, F.asc("distance_m"), F.asc("vertex_id_a"), F.asc("vertex_id_b"))
    return best.select("vertex_id_a", "vertex_id_b", "distance_m", F.when(F.col("distance_m") <= merge_m, "NODE_MERGE").otherwise("ENDPOINT_TO_ENDPOINT").alias("kind"))


def bridges(nodes: DataFrame, segments: DataFrame, label: DataFrame, metres: float, auto: float = 3.0, review: float = 12.0) -> DataFrame:
    """For every component but the main one its shortest link to a node of the main one within metres, with a tier."""
    stats = graph.component_stats(segments, label)
    main = stats.agg(F.max_by("component", F.struct("n_edges", "n_nodes", -F.col("component"))).alias("main"))
    placed = nodes.select("vertex_id", "x", "y").join(label, "vertex_id").crossJoin(F.broadcast(main))  # one row
    inside, outside = placed.where("component = main"), placed.where("component <> main")
    pairs = near_pairs(outside, "vertex_id", metres, inside)
    comp = outside.select(F.col("vertex_id").alias("vertex_id_a"), "component")
    best = pairs.join(comp, "vertex_id_a").groupBy("component").agg(F.min(F.struct("distance_m", "vertex_id_a", "vertex_id_b")).alias("m"))
    tier = F.when(F.col("m.distance_m") <= auto, "AUTO").when(F.col("m.distance_m") <= review, "REVIEW").otherwise("HELD")
    return best.select("component", "m.vertex_id_a", "m.vertex_id_b", "m.distance_m", tier.alias("tier"))


def apply_merges(segments: DataFrame, merges: DataFrame, kind: str = "segment_type") -> DataFrame:
    """Segments with merged nodes: all that merges (from_id, to_id) link become the lowest id; self loops go, of equal node pairs and kinds the lowest edge stays."""
    final = materialize(graph.components(merges, "from_id", "to_id").select(F.col("vertex_id").alias("from_id"), F.col("component").alias("final")))
    out = segments
    for end in ("from_node_id", "to_node_id"):
        f = final.select(F.col("from_id").alias(end), F.col("final").alias("final_"))
        out = out.join(f, end, "left").withColumn(end, F.coalesce("final_", end)).drop("final_")
    out = out.where("from_node_id <> to_node_id").withColumn("p0_", F.least("from_node_id", "to_node_id")).withColumn("p1_", F.greatest("from_node_id", "to_node_id"))
    return fuse.first_per_key(out, ["p0_", "p1_", kind], "edge_id").drop("p0_", "p1_")


def split_segments(segments: DataFrame, cuts: DataFrame, cluster_m: float = 1.0, min_gap: float = 0.05) -> DataFrame:
    """edge_id, part_no, points, length: segments (edge_id, points) cut at measures (edge_id, m).

    Cuts closer than cluster_m along an edge become one at their mean. Edges without cuts come whole.
    """
    grouped = fuse.gap_clusters(cuts, ["edge_id"], "m", cluster_m).groupBy("edge_id", "cluster_").agg(F.avg("m").alias("m"))
    per_edge = grouped.groupBy("edge_id").agg(F.collect_list("m").alias("cuts"))  # cuts of one edge, cluster_m apart: bounded by its length
    line = segments.select("edge_id", geo.measured(F.col("points")).alias("line")).where(F.size("line") >= 2).join(per_edge, "edge_id", "left")
    line = line.withColumn("at", graph.split_points(F.element_at("line", -1).m, F.coalesce("cuts", F.array().cast("array<double>")), min_gap))
    n = F.size("at") - 1
    pieces = line.select("edge_id", "line", F.posexplode(F.arrays_zip(F.slice("at", F.lit(1), n).alias("s"), F.slice("at", F.lit(2), n).alias("e"))).alias("part_no", "c"))
    return pieces.select("edge_id", "part_no", geo.substring(F.col("line"), F.col("c.s"), F.col("c.e")).alias("points"), (F.col("c.e") - F.col("c.s")).alias("length"))


def repair(nodes: DataFrame, segments: DataFrame) -> tuple[DataFrame, list[int]]:
    """Merge near ends of different components until no merge is left; segments and the number of merges of each round.

    Every round with a merge leaves fewer components, so it ends.
    """
    done = []
    while True:
        label = materialize(graph.components(segments, "from_node_id", "to_node_id"))
        found = connection_candidates(endpoints(nodes, segments, label)).where("kind = 'NODE_MERGE'")
        merges = materialize(found.select(F.col("vertex_id_b").alias("from_id"), F.col("vertex_id_a").alias("to_id")))
        done.append(merges.count())
        if not done[-1]:
            break
        segments = materialize(apply_merges(segments, merges))
    return segments, done
