"""Consolidating pairwise matches into groups (connected components).

Each round works on the distinct edges of a simple graph:

1. degrees and the least and greatest neighbour of every vertex come from one aggregation;
2. vertices of degree one and two form trees' tips and chains. List ranking by pointer doubling
   over their arcs finds both ends of each chain in a logarithm of its length. A chain with an end
   in the rest of the graph hangs its vertices on that end and, if both ends lie there, leaves one
   edge between them; a chain without such an end, or a cycle, is a finished group;
3. if no such vertices are left, every vertex points to its least neighbour if that is smaller,
   the pointers are doubled to their roots, and the graph is contracted onto the roots.

Then the removed vertices take over, last round first, the label of the vertex they hang on, and
the least id of a group becomes its label.

Scale: arcs are keyed by the ordered pair of vertices, which is unique, so no join of step 2 has a
hot key even if one hub touches a third of all edges; degrees are pre-aggregated map-side. Joins on
a hub's id occur where labels are handed down; there only one side is skewed and AQE splits it.
Nothing is collected but row counts, and each round is cut off with a reliable checkpoint.

Defined results: null ids are in no group, but the other id of such a pair is; self pairs and
repeated or reversed pairs change nothing; a vertex without links is its own group; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.plans.runtime import materialize


def rank_chains(arcs: DataFrame) -> DataFrame:
    """The far end of every arc of a chain.

    arcs: (v, y, other): at v, of degree one or two, heading to neighbour y, other being the second
    neighbour or null. Result: (v, y, anchor, low): anchor is the first vertex of higher degree met
    by going on, null if the chain ends before one or is a cycle; low is the least id passed, of the
    whole cycle for a cycle.
    """
    a, b = arcs.alias("a"), arcs.alias("b")
    first = a.join(b, (F.col("b.v") == F.col("a.y")) & (F.col("b.y") == F.col("a.v")), "left")
    start = first.select(
        F.col("a.v").alias("v"),
        F.col("a.y").alias("y"),
        F.when(F.col("b.other").isNotNull(), F.col("b.v")).alias("nv"),
        F.col("b.other").alias("ny"),
        F.when(F.col("b.v").isNull(), F.col("a.y")).alias("anchor"),
        F.when(F.col("b.v").isNull(), F.col("a.v")).otherwise(F.least("a.v", "a.y")).alias("low"),
    )
    state = materialize(start)
    done, going = [state.where("ny is null")], state.where("ny is not null")  # only arcs still going are written again
    going_before = -1
    while (n := going.count()) > 0:
        s, t = going.alias("s"), reduce(DataFrame.unionByName, done, going).alias("t")
        doubled = s.join(t, (F.col("s.nv") == F.col("t.v")) & (F.col("s.ny") == F.col("t.y")))
        low = F.least("s.low", "t.low")
        nxt = materialize(doubled.select("s.v", "s.y", "t.nv", "t.ny", "t.anchor", low.alias("low"), (low < F.col("s.low")).alias("sank")))
        # a chain with an end loses arcs in every round; if none was lost, only cycles are left, and
        # they are done once no low sinks: windows of equal low tile the whole cycle
        still = n == going_before and nxt.where("ny is not null and sank").isEmpty()
        going_before = n
        nxt = nxt.drop("sank")
        done.append(nxt if still else nxt.where("ny is null"))
        if still:
            break
        going = nxt.where("ny is not null")
    return reduce(DataFrame.unionByName, done).select("v", "y", "anchor", "low")


def _strip(edges: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """(edges left, removed: v, parent, label) or None if no vertex has degree one or two."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(F.col("a").alias("v")).agg(F.count("*").alias("deg"), F.min("b").alias("n1"), F.max("b").alias("n2")).where("deg <= 2")
    low = materialize(low)
    if low.isEmpty():
        return None
    ends = F.when(F.col("deg") == 1, F.array(F.struct(F.col("n1").alias("y"), F.lit(None).cast("bigint").alias("other")))).otherwise(
        F.array(F.struct(F.col("n1").alias("y"), F.col("n2").alias("other")), F.struct(F.col("n2").alias("y"), F.col("n1").alias("other")))
    )
    arcs = low.select("v", F.explode(ends).alias("e")).select("v", "e.y", "e.other")
    ranked = rank_chains(arcs)
    removed = ranked.groupBy("v").agg(F.min("anchor").alias("parent"), F.max("anchor").alias("far"), F.min("low").alias("low"))
    removed = materialize(removed.select("v", "parent", "far", F.when(F.col("parent").isNull(), F.col("low")).alias("label")))
    touched = arcs.select(F.least("v", "y").alias("a"), F.greatest("v", "y").alias("b"))
    bridges = removed.where("far > parent").select(F.col("parent").alias("a"), F.col("far").alias("b"))
    left = materialize(edges.join(touched, ["a", "b"], "left_anti").unionByName(bridges).distinct())
    return left, removed.select("v", "parent", "label")


def _contract(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hook every vertex on its least neighbour if smaller; (contracted edges, hooked: v, parent, label)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    point = materialize(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("p")))
    while True:
        s, t = point.alias("s"), point.alias("t")
        nxt = materialize(s.join(t, F.col("s.p") == F.col("t.v")).select("s.v", F.col("t.p").alias("p"), (F.col("t.p") != F.col("s.p")).alias("moved")))
        point = nxt.select("v", "p")
        if nxt.where("moved").isEmpty():
            break
    e = edges.join(point.select(F.col("v").alias("a"), F.col("p").alias("pa")), "a").join(point.select(F.col("v").alias("b"), F.col("p").alias("pb")), "b")
    left = materialize(e.where("pa != pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
    return left, point.where("v != p").select("v", F.col("p").alias("parent"), F.lit(None).cast("bigint").alias("label"))


def consolidate(pairs: DataFrame, left: str, right: str, vertex: str = "vertex_id", group: str = "group_id") -> DataFrame:
    """(vertex, group) for every non-null id in either column; group is the least id linked directly or indirectly."""
    ends = materialize(pairs.select(F.col(left).cast("bigint").alias("x"), F.col(right).cast("bigint").alias("y")))
    vertices = ends.select(F.explode(F.array("x", "y")).alias("v")).where("v is not null").distinct()
    edges = materialize(ends.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    log: list[DataFrame] = []
    while not edges.isEmpty():
        stripped = _strip(edges)
        edges, gone = stripped if stripped else _contract(edges)
        log.append(gone)
    # restore: a vertex without parent and label is a root of its own
    levels: list[DataFrame] = []  # each round's rows are written once
    for gone in reversed(log):
        hung = gone.where("parent is not null").select("v", "parent")
        mine = gone.where("parent is null").select("v", F.col("label").alias("root"))
        if levels:
            k = reduce(DataFrame.unionByName, levels).select(F.col("v").alias("parent"), "root")
            handed = hung.join(k, "parent", "left").select("v", F.coalesce("root", "parent").alias("root"))
        else:
            handed = hung.select("v", F.col("parent").alias("root"))
        levels.append(materialize(mine.unionByName(handed)))
    known = reduce(DataFrame.unionByName, levels) if levels else None
    if known is None:
        return vertices.select(F.col("v").alias(vertex), F.col("v").alias(group))
    rooted = vertices.join(known, "v", "left").select("v", F.coalesce("root", "v").alias("root"))
    least = rooted.groupBy("root").agg(F.min("v").alias("least"))
    return rooted.join(least, "root").select(F.col("v").alias(vertex), F.col("least").alias(group))
