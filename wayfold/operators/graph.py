"""Graph operators on (nodes, segments): checks, degrees, components, redirects, splitting, routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfold.functions import arrow
from wayfold.plans.runtime import materialize


def degrees(segments: DataFrame, a: str = "from_node_id", b: str = "to_node_id") -> DataFrame:
    """vertex_id, degree; a self loop counts twice."""
    return segments.select(F.explode(F.array(a, b)).alias("vertex_id")).where("vertex_id is not null").groupBy("vertex_id").agg(F.count("*").alias("degree"))


def node_types(degree: DataFrame) -> DataFrame:
    d = F.col("degree")
    return degree.withColumn("node_type", F.when(d == 1, "DEAD_END").when(d == 2, "CHAIN_JOIN").otherwise("GRAPH_NODE"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """vertex_id, component: least node id of the component, for every node with an edge.

    Ranges of edges by their lower id link what they hold, each by itself; only nodes that stand in
    several ranges are left to link. Then every vertex hooks on its least neighbour, pointers are
    doubled to their roots, and the graph is contracted onto the roots until no edge is left. Edges
    shrink every round; hot nodes are pre-aggregated and their joins split by AQE.
    """
    known = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y"))
    label: DataFrame | None = None
    numbers = known.schema["x"].dataType.simpleString() == "bigint"
    if numbers:
        # written before, as a range exchange reads its input twice
        stars = materialize(materialize(known).repartitionByRange("x").mapInArrow(arrow.local_roots, "v bigint, r bigint"))
        met = materialize(stars.groupBy("v").agg(F.min("r").alias("p"), F.max("r").alias("q")))
        label = met.select("v", "p")
        e = materialize(stars.join(met.where("p <> q").select("v", "p"), "v").where("r <> p").select(F.col("p").alias("x"), F.col("r").alias("y")).distinct())
    else:
        e = materialize(known.distinct())
        vertices = e.select(F.explode(F.array("x", "y")).alias("v")).distinct()
        e = e.where("x <> y")
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("y").alias("x"), F.col("x").alias("y")))
        point = materialize(both.groupBy(F.col("x").alias("v")).agg(F.min("y").alias("m")).select("v", F.least("v", "m").alias("p")))
        while True:
            s, t = point.alias("s"), point.alias("t")
            nxt = materialize(s.join(t, F.col("s.p") == F.col("t.v")).select("s.v", F.col("t.p").alias("p"), (F.col("t.p") != F.col("s.p")).alias("moved")))
            point = nxt.select("v", "p")
            if nxt.where("moved").isEmpty():
                break
        if label is None:
            label = point
        else:
            step = point.select(F.col("v").alias("p"), F.col("p").alias("q"))
            label = materialize(label.join(step, "p", "left").select("v", F.coalesce("q", "p").alias("p")))
        px, py = point.select(F.col("v").alias("x"), F.col("p").alias("px")), point.select(F.col("v").alias("y"), F.col("p").alias("py"))
        e = materialize(e.join(px, "x").join(py, "y").where("px <> py").select(F.least("px", "py").alias("x"), F.greatest("px", "py").alias("y")).distinct())
    if numbers:
        return label.select(F.col("v").alias("vertex_id"), F.col("p").alias("component"))
    if label is None:
        return vertices.select(F.col("v").alias("vertex_id"), F.col("v").alias("component"))
    return vertices.join(label, "v", "left").select(F.col("v").alias("vertex_id"), F.coalesce("p", "v").alias("component"))


def component_stats(segments: DataFrame, label: DataFrame, a: str = "from_node_id") -> DataFrame:
    """component, n_nodes, n_edges."""
    nodes = label.groupBy("component").agg(F.count("*").alias("n_nodes"))
    edges = segments.join(label.select(F.col("vertex_id").alias(a), "component"), a).groupBy("component").agg(F.count("*").alias("n_edges"))
    return nodes.join(edges, "component", "left").fillna(0, ["n_edges"])


#: fixed values: upper bounds of component sizes in reports
SIZE_BINS = ((1, "1"), (5, "2-5"), (10, "6-10"), (50, "11-50"), (100, "51-100"))


def size_bins(stats: DataFrame) -> DataFrame:
    out = F.lit(">100")
    for bound, name in reversed(SIZE_BINS):
        out = F.when(F.col("n_nodes") <= bound, F.lit(name)).otherwise(out)
    return stats.groupBy(out.alias("size_bin")).agg(F.count("*").alias("n_components"), F.sum("n_nodes").alias("n_nodes"))


def checks(nodes: DataFrame, segments: DataFrame, enums: dict[str, Sequence[str]]) -> DataFrame:
    """(check_name, n): duplicate ids, bad references, self loops, repeated node pairs, isolated nodes, values outside enums."""
    pair = (F.least("from_node_id", "to_node_id"), F.greatest("from_node_id", "to_node_id"))
    dup = lambda df, *cols: df.groupBy(*cols).agg(F.count("*").alias("k")).where("k > 1").agg(F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).alias("n"))
    one = lambda name, df: df.select(F.lit(name).alias("check_name"), F.col("n").cast("bigint").alias("n"))
    ends = segments.select(F.explode(F.array("from_node_id", "to_node_id")).alias("vertex_id"))
    ids = nodes.select("vertex_id").distinct()
    flat = segments.agg(F.count("*").alias("n_segments"), F.count_if(F.col("from_node_id") == F.col("to_node_id")).alias("self_loops"), *[F.count_if(~F.coalesce(F.col(c).isin(*v), F.lit(False))).alias(f"enum_{c}") for c, v in enums.items()])
    stacked = flat.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check_name"), F.col(c).cast("bigint").alias("n")) for c in flat.columns])).alias("s")).select("s.*")
    parts = [
        one("n_nodes", nodes.agg(F.count("*").alias("n"))),
        one("duplicate_node_ids", dup(nodes, "vertex_id")),
        one("duplicate_edge_ids", dup(segments, "edge_id")),
        one("duplicate_node_pairs", dup(segments.select(pair[0].alias("x"), pair[1].alias("y")), "x", "y")),
        one("bad_references", ends.join(ids, "vertex_id", "left_anti").agg(F.count("*").alias("n"))),
        one("isolated_nodes", ids.join(ends, "vertex_id", "left_anti").agg(F.count("*").alias("n"))),
    ]
    for p in parts:
        stacked = stacked.unionByName(p)
    return stacked


def resolve_redirects(redirects: DataFrame, source: str, target: str) -> DataFrame:
    """source, final: where a chain of redirects ends. A chain that runs into a cycle ends at the least id of the cycle.

    A source has one target; of several the least counts. To merge all nodes that pairs link, use components.
    """
    r = materialize(redirects.where(F.col(source) != F.col(target)).groupBy(F.col(source).alias("s")).agg(F.min(target).alias("t")))
    state = materialize(r.select("s", "t", F.col("t").alias("low")))
    before = None
    while True:
        a, b = state.alias("a"), state.alias("b")
        j = a.join(b, F.col("a.t") == F.col("b.s"), "left")
        state = materialize(j.select("a.s", F.coalesce("b.t", "a.t").alias("t"), F.least("a.low", F.coalesce("b.low", "a.low")).alias("low"), F.col("b.s").isNotNull().alias("going"), (F.col("b.low") < F.col("a.low")).alias("sank")))
        n = state.where("going").count()
        if n == 0 or (n == before and state.where("going and sank").isEmpty()):
            break
        before = n
    return state.select(F.col("s").alias(source), F.when(F.col("going"), F.col("low")).otherwise(F.col("t")).alias("final"))


def cluster_points(points: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """Centre of each cluster of points linked by pairs (key_a, key_b): cluster, n_points, x, y; single points too."""
    label = components(pairs, f"{key}_a", f"{key}_b").withColumnRenamed("vertex_id", key)
    return points.join(label, key, "left").groupBy(F.coalesce("component", key).alias("cluster")).agg(F.count("*").alias("n_points"), F.avg("x").alias("x"), F.avg("y").alias("y"))


def split_points(segment_length: Column, cuts: Column, min_gap: float = 0.05) -> Column:
    """Sorted measures at which a line of a length is cut, with both ends, at least min_gap apart."""
    inner = F.array_sort(F.filter(cuts, lambda m: (m > min_gap) & (m < segment_length - min_gap)))
    kept = F.aggregate(inner, F.array(F.lit(0.0)), lambda acc, m: F.when(m - F.element_at(acc, -1) >= min_gap, F.concat(acc, F.array(m))).otherwise(acc))
    return F.concat(kept, F.array(segment_length))


def runs(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Run-length groups of equal consecutive values: keys, run_, value, first and last position, n."""
    w = W.partitionBy(*keys).orderBy(order)
    new = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    marked = df.withColumn("new_", new).withColumn("run_", F.sum("new_").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "run_").agg(F.first(value).alias(value), F.min(order).alias("first_at"), F.max(order).alias("last_at"), F.count("*").alias("n"))
