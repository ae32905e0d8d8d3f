"""Routes: costs from rule tables, shortest paths block by block, path rows, connected pairs, requests."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfold.functions import geo
from wayfold.operators import rules
from wayfold.plans.runtime import materialize, release

#: fixed values: profile, column, comparison, literal, factor; all that hold multiply, and 0 blocks
PROFILE_RULES = (
    ("pedestrian_fast", "walk_access", "=", "NO", 0.0),
    ("pedestrian_fast", "stairs_state", "=", "YES", 0.75),
    ("pedestrian_fast", "surface_state", "=", "UNPAVED", 0.85),
    ("pedestrian_safe", "walk_access", "=", "NO", 0.0),
    ("pedestrian_safe", "signal_state", "=", "TRAFFIC_SIGNALS", 1.1),
    ("pedestrian_safe", "slope_state", "=", "RISK", 0.6),
    ("pedestrian_safe", "stairs_state", "=", "YES", 0.55),
    ("pedestrian_safe", "surface_state", "=", "UNPAVED", 0.75),
    ("visual_fast", "walk_access", "=", "NO", 0.0),
    ("visual_fast", "stairs_state", "=", "YES", 0.75),
    ("visual_fast", "braille_block_state", "=", "YES", 1.05),
    ("visual_safe", "walk_access", "=", "NO", 0.0),
    ("visual_safe", "signal_state", "=", "TRAFFIC_SIGNALS", 1.1),
    ("visual_safe", "audio_signal_state", "=", "YES", 1.1),
    ("visual_safe", "braille_block_state", "=", "YES", 1.08),
    ("visual_safe", "stairs_state", "=", "YES", 0.45),
    ("visual_safe", "slope_state", "=", "RISK", 0.65),
    ("visual_safe", "surface_state", "=", "UNPAVED", 0.75),
    ("wheelchair_auto_fast", "walk_access", "=", "NO", 0.0),
    ("wheelchair_auto_fast", "stairs_state", "=", "YES", 0.0),
    ("wheelchair_auto_fast", "width_state", "=", "NARROW", 0.35),
    ("wheelchair_auto_fast", "surface_state", "=", "UNPAVED", 0.55),
    ("wheelchair_auto_fast", "slope", ">=", 8.33, 0.45),
    ("wheelchair_auto_safe", "walk_access", "=", "NO", 0.0),
    ("wheelchair_auto_safe", "stairs_state", "=", "YES", 0.0),
    ("wheelchair_auto_safe", "width_state", "=", "NARROW", 0.2),
    ("wheelchair_auto_safe", "width_state", "=", "ADEQUATE_120", 0.75),
    ("wheelchair_auto_safe", "surface_state", "=", "UNPAVED", 0.35),
    ("wheelchair_auto_safe", "slope", ">=", 8.33, 0.2),
    ("wheelchair_auto_safe", "slope", ">=", 5.56, 0.55),
    ("wheelchair_manual_fast", "walk_access", "=", "NO", 0.0),
    ("wheelchair_manual_fast", "stairs_state", "=", "YES", 0.0),
    ("wheelchair_manual_fast", "width_state", "=", "NARROW", 0.25),
    ("wheelchair_manual_fast", "surface_state", "=", "UNPAVED", 0.45),
    ("wheelchair_manual_fast", "slope", ">=", 8.33, 0.25),
    ("wheelchair_manual_safe", "walk_access", "=", "NO", 0.0),
    ("wheelchair_manual_safe", "stairs_state", "=", "YES", 0.0),
    ("wheelchair_manual_safe", "width_state", "=", "NARROW", 0.12),
    ("wheelchair_manual_safe", "width_state", "=", "ADEQUATE_120", 0.65),
    ("wheelchair_manual_safe", "surface_state", "=", "UNPAVED", 0.25),
    ("wheelchair_manual_safe", "slope", ">=", 8.33, 0.1),
    ("wheelchair_manual_safe", "slope", ">=", 5.56, 0.45),
)
#: fixed values: seconds that a kilometre weighs beyond its walking time
DISTANCE_INFLUENCE = {"pedestrian_fast": 35, "pedestrian_safe": 80, "visual_fast": 45, "visual_safe": 95, "wheelchair_auto_fast": 45, "wheelchair_auto_safe": 90, "wheelchair_manual_fast": 55, "wheelchair_manual_safe": 120}

#: fixed values: what each state adds to the cost of a metre, by kind of route
EXTRA = {
    "fast": {"slope": {"FLAT": 0.0, "MODERATE": 0.04, "STEEP": 0.14, "IMPASSABLE": 0.7}, "slope_else": 0.08, "surface": {"PAVED": 0.0, "UNPAVED": 0.12}, "surface_else": 0.05},
    "mobility": {"slope": {"FLAT": 0.0, "MODERATE": 0.35, "STEEP": 1.4, "IMPASSABLE": 8.0}, "slope_else": 0.45, "surface": {"PAVED": 0.0, "UNPAVED": 1.1}, "surface_else": 0.35},
    "visuality": {"slope": {"FLAT": 0.0, "MODERATE": 0.18, "STEEP": 0.65, "IMPASSABLE": 2.0}, "slope_else": 0.28, "surface": {"PAVED": 0.0, "UNPAVED": 0.35}, "surface_else": 0.16},
}


def profile_priorities(segments: DataFrame, table: tuple = PROFILE_RULES, profiles: dict[str, float] = DISTANCE_INFLUENCE, metres_per_second: float = 5 / 3.6) -> DataFrame:
    """edge_id, profile, priority, weight of every edge for every profile; weight is null if the edge is blocked.

    The rule table becomes one expression a profile, so that edges are read once and stay JVM-side.
    segments: edge_id, length and the columns of the rules.
    """
    out = []
    for p, influence in profiles.items():
        holds = [((F.col(c) >= v) if op == ">=" else (F.col(c) == v), f) for q, c, op, v, f in table if q == p]
        out.append(F.struct(F.lit(p).alias("profile"), rules.product(holds).alias("priority"), F.lit(float(influence)).alias("influence")))
    each = segments.select("edge_id", "length", F.explode(F.array(*out)).alias("o")).select("edge_id", "length", "o.*")
    weight = F.when(F.col("priority") > 0, F.col("length") / (metres_per_second * F.col("priority")) + F.col("length") / 1000 * F.col("influence"))
    return each.select("edge_id", "profile", "priority", weight.alias("weight"))


def cost_multiplier(kind: str, profile: str, slope_state: Column, surface: Column, stairs: Column, width: Column, walk_access: Column) -> Column:
    """Cost of a metre: 1 plus what the states add; kind fast or safe, profile mobility or visuality; a safe one is 0.2 at least."""
    e = EXTRA["fast" if kind == "fast" else profile]
    pick = lambda c, t, other: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in t.items() for x in kv]), c), F.lit(other))
    add = lambda cond, v: F.when(cond, F.lit(v)).otherwise(F.lit(0.0))
    base = F.lit(1.0) + pick(slope_state, e["slope"], e["slope_else"]) + pick(surface, e["surface"], e["surface_else"])
    steps, slim = F.coalesce(stairs == "YES", F.lit(False)), F.coalesce(width < 1.2, F.lit(False))
    if kind == "fast":
        return base + add(steps, 0.8 if profile == "visuality" else 3.0) + add(slim, 0.45 if profile == "visuality" else 1.2)
    if profile == "mobility":
        by_width = F.when(width < 1.2, 5.0).when(width < 1.5, 1.2).when(width >= 2.0, -0.08).otherwise(0.0)
        base = base + add(steps, 20.0) + by_width
    else:
        base = base + add(steps, 2.5) + add(slim, 0.75)
    return F.greatest(base - add(F.coalesce(walk_access == "YES", F.lit(False)), 0.05), F.lit(0.2))


def warnings_of(profile: str, slope_state: Column, surface: Column, stairs: Column, width: Column) -> Column:
    """Array of what a walker should know about an edge."""
    return F.array_compact(F.array(F.when(stairs == "YES", F.lit("stairs")), F.when(slope_state.isin("STEEP", "IMPASSABLE"), F.concat(F.lit("slope:"), slope_state)), F.when(surface == "UNPAVED", F.lit("surface:UNPAVED")), F.when(width < (1.5 if profile == "mobility" else 1.2), F.lit("narrow"))))


def route_graph(nodes: DataFrame, segments: DataFrame) -> DataFrame:
    """edge_id, from_node_id, to_node_id, length of edges whose nodes both exist; a missing length is the line's, or else the nodes' distance.

    nodes: vertex_id, lon, lat; segments: edge_id, from_node_id, to_node_id, length, points (degrees) or null.
    """
    n = nodes.select("vertex_id", "lon", "lat").dropDuplicates(["vertex_id"])
    a, b = (n.select(F.col("vertex_id").alias(f"{e}_node_id"), F.col("lon").alias(f"{e}_lon"), F.col("lat").alias(f"{e}_lat")) for e in ("from", "to"))
    j = segments.join(a, "from_node_id").join(b, "to_node_id")
    line = F.when(F.size("points") >= 2, geo.line_length_degrees(F.col("points")))
    chord = geo.haversine(F.col("from_lon"), F.col("from_lat"), F.col("to_lon"), F.col("to_lat"))
    return j.select("edge_id", "from_node_id", "to_node_id", F.coalesce(F.when(F.col("length") > 0, F.col("length")), line, chord).alias("length"))


# ---- shortest paths


def shortest_paths(edges: DataFrame, sources: DataFrame, cost: str, a: str = "from_node_id", b: str = "to_node_id", edge: str | None = None, block_size: int = 2048, blocks: DataFrame | None = None, max_rounds: int = 100_000) -> DataFrame:
    """source_id, vertex_id, cost, previous, edge_id: least cost from every source over undirected edges, and the step that reached it.

    Vertices lie in blocks (blocks: vertex_id, block; else runs of block_size ids). A round hands the
    offers that came in to each block concerned, which settles all its vertices by itself (Dijkstra
    in one Arrow group) and sends offers over its border. So rounds count crossings of blocks, not
    hops, a round touches the blocks with offers only, and what a block has settled is written
    once a visit. Ends when no offer is better than what is known. Edges without cost, or with a negative
    one, are not used; equal costs go to the lower edge id. sources: source_id, vertex_id.
    """
    eid = F.col(edge) if edge else F.lit(None).cast("bigint")
    one = edges.select(F.col(a).cast("bigint").alias("u"), F.col(b).cast("bigint").alias("w"), F.col(cost).cast("double").alias("c"), eid.cast("bigint").alias("e")).where("u <> w and c >= 0")
    both = one.unionByName(one.select(F.col("w").alias("u"), F.col("u").alias("w"), "c", "e"))
    arcs = both.groupBy("u", "w").agg(F.min(F.struct("c", "e")).alias("m")).select("u", "w", "m.c", "m.e")
    if blocks is None:
        at = lambda v: F.floor(F.col(v) / block_size).cast("bigint")
        arcs = arcs.withColumn("block", at("u")).withColumn("to_block", at("w"))
        start = sources.withColumn("block", at("vertex_id"))
    else:
        of = blocks.select(F.col("vertex_id").alias("v_"), F.col("block").cast("bigint").alias("k_"))
        arcs = arcs.join(of, F.col("u") == F.col("v_")).withColumnRenamed("k_", "block").drop("v_").join(of, F.col("w") == F.col("v_")).withColumnRenamed("k_", "to_block").drop("v_")
        start = sources.join(of, F.col("vertex_id") == F.col("v_")).withColumnRenamed("k_", "block").drop("v_")
    arcs = materialize(arcs.repartition("block"))
    offers = start.select(F.col("source_id").cast("bigint").alias("source_id"), F.col("vertex_id").cast("bigint").alias("vertex_id"), F.lit(0.0).alias("cost"), F.lit(None).cast("bigint").alias("previous"), F.lit(None).cast("bigint").alias("e"), "block").distinct()
    shape = "source_id bigint, vertex_id bigint, cost double, previous bigint, e bigint, block bigint, out boolean"
    names = [x.split()[0] for x in shape.split(", ")]

    def settle(own: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        steps: dict[int, list] = {}
        for u, w, c, e, to in zip(own.u.tolist(), own.w.tolist(), own.c.tolist(), own.e.tolist(), own.to_block.tolist()):
            steps.setdefault(u, []).append((w, c, None if e != e or e is None else int(e), to))
        if not len(given):
            return pd.DataFrame(columns=names)
        here, rows = int(given.block.iloc[0]), []
        for source, part in given.groupby("source_id"):
            settled = {int(v): c for v, c, known in zip(part.vertex_id, part.cost, part.known) if known}
            best, heap, out = dict(settled), [], {}
            for v, c, p, e in part.loc[~part.known, ["vertex_id", "cost", "previous", "e"]].itertuples(index=False):
                heap.append((float(c), -1 if e != e or e is None else int(e), int(v), -1 if p != p or p is None else int(p)))
            heapq.heapify(heap)
            done: set[int] = set()
            while heap:
                c, e, v, p = heapq.heappop(heap)
                if v in done or (v in settled and c >= settled[v] - 1e-9):
                    continue
                done.add(v)
                rows.append((source, v, c, None if p < 0 else p, None if e < 0 else e, here, False))
                for w, step, edge_id, to in steps.get(v, ()):
                    n = c + step
                    if to != here:
                        if (w, to) not in out or n < out[w, to][0]:
                            out[w, to] = (n, v, edge_id)
                    elif n < best.get(w, float("inf")) - 1e-9:
                        best[w] = n
                        heapq.heappush(heap, (n, -1 if edge_id is None else edge_id, w, v))
            rows += [(source, w, n, v, edge_id, to, True) for (w, to), (n, v, edge_id) in out.items()]
        f = pd.DataFrame(rows, columns=names)
        return f.astype({"previous": "Int64", "e": "Int64"})

    known: list[DataFrame] = []  # increments; a later one of the same vertex is cheaper
    least = lambda df, *keys: df.groupBy(*keys).agg(F.min(F.struct("cost", "e", "previous")).alias("m")).select(*keys, "m.*")
    keys = ("source_id", "vertex_id", "block")
    state: DataFrame | None = None
    for _ in range(max_rounds):
        fresh = materialize(least(offers, *keys))
        if fresh.isEmpty():
            release(fresh)
            break
        active = fresh.select("block").distinct()
        given = fresh.withColumn("known", F.lit(False))
        if state is not None:
            given = given.unionByName(state.join(active, "block", "left_semi").withColumn("known", F.lit(True)))
        step = materialize(arcs.join(active, "block", "left_semi").groupBy("block").cogroup(given.groupBy("block")).applyInPandas(settle, shape))
        release(fresh)
        found = step.where("not out").select(*keys, "cost", "previous", "e")
        known.append(found)
        if len(known) > 8:  # put together now and then, so that a look-up reads few files
            merged = materialize(least(_together(known), *keys).select(*keys, "cost", "previous", "e"))
            known = [merged]
        state = least(_together(known), *keys).select(*keys, "cost", "previous", "e")
        offers = step.where("out").select(*keys, "cost", "previous", "e")
    else:
        raise RuntimeError(f"costs still fall after {max_rounds} rounds")
    if state is None:
        return offers.select("source_id", "vertex_id", "cost", "previous", F.col("e").alias("edge_id")).limit(0)
    return state.select("source_id", "vertex_id", "cost", "previous", F.col("e").alias("edge_id"))


def _together(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def path_rows(reached: DataFrame, targets: DataFrame) -> DataFrame:
    """source_id, target_id, seq, vertex_id, edge_id: the steps from each source to each target, in order.

    reached: as shortest_paths gives it; targets: source_id, target_id. Predecessors are doubled, so
    a path of n steps takes log n joins; edge_id is that of the step into the vertex, null at the
    source. A target that was not reached has no rows.
    """
    jump = materialize(reached.select("source_id", "vertex_id", F.col("previous").alias("to")))
    jumps = [jump]
    while not (j := jumps[-1]).where("to is not null").isEmpty():
        x, y = j.alias("x"), j.alias("y")
        jumps.append(materialize(x.join(y, (F.col("x.source_id") == F.col("y.source_id")) & (F.col("x.to") == F.col("y.vertex_id"))).select("x.source_id", "x.vertex_id", "y.to").where("to is not null")))
    on = targets.select("source_id", "target_id").distinct().join(reached.select("source_id", F.col("vertex_id").alias("target_id")), ["source_id", "target_id"])
    on = on.select("source_id", "target_id", F.col("target_id").alias("vertex_id"), F.lit(0).cast("bigint").alias("back"))
    for k in reversed(range(len(jumps))):
        farther = on.join(jumps[k], ["source_id", "vertex_id"]).where("to is not null").select("source_id", "target_id", F.col("to").alias("vertex_id"), (F.col("back") + (1 << k)).alias("back"))
        on = materialize(on.unionByName(farther))
    n = W.partitionBy("source_id", "target_id")
    rows = on.withColumn("seq", F.max("back").over(n) - F.col("back"))
    return rows.join(reached.select("source_id", "vertex_id", "edge_id"), ["source_id", "vertex_id"]).select("source_id", "target_id", "seq", "vertex_id", "edge_id")


def path_summary(rows: DataFrame, edges: DataFrame, metres_per_second: float = 1.05) -> DataFrame:
    """source_id, target_id, n_edges, metres, minutes, cost, n_warnings, edge_ids of each path. edges: edge_id, length, cost, warnings."""
    j = rows.join(edges.select("edge_id", "length", "cost", "warnings"), "edge_id", "left")
    ids = F.transform(F.array_sort(F.collect_list(F.when(F.col("edge_id").isNotNull(), F.struct("seq", "edge_id")))), lambda s: s.edge_id)  # edges of one path
    out = j.groupBy("source_id", "target_id").agg(F.count("edge_id").alias("n_edges"), F.coalesce(F.sum("length"), F.lit(0.0)).alias("metres"), F.coalesce(F.sum("cost"), F.lit(0.0)).alias("cost"), F.sum(F.coalesce(F.size("warnings"), F.lit(0))).alias("n_warnings"), ids.alias("edge_ids"))
    return out.withColumn("minutes", F.col("metres") / metres_per_second / 60)


def connected_ends(requests: DataFrame, nodes: DataFrame, label: DataFrame, k: int = 80, metres: float = 5000.0) -> DataFrame:
    """request_id, from_vertex, to_vertex, from_m, to_m, connected: of the k nearest nodes of both ends, the pair of one component with the least sum; else the nearest nodes.

    requests: request_id, from_lon, from_lat, to_lon, to_lat; nodes: vertex_id, lon, lat; label: vertex_id, component.
    """
    from wayfold.operators import fuse, spatial

    labelled = nodes.join(label, "vertex_id").select("vertex_id", "component", "lon", "lat")

    def near(end: str) -> DataFrame:
        p = requests.select("request_id", F.col(f"{end}_lon").alias("lon"), F.col(f"{end}_lat").alias("lat"))
        pairs = spatial.within_distance(labelled, p, metres).select("request_id", "vertex_id", "component", "distance_m")
        top = fuse.top_k(pairs, ["request_id"], k, F.asc("distance_m"), F.asc("vertex_id"))
        return materialize(top.select("request_id", "component", F.col("vertex_id").alias(f"{end}_vertex"), F.col("distance_m").alias(f"{end}_m")))

    a, b = near("from"), near("to")
    first = lambda df, e: df.groupBy("request_id", "component").agg(F.min(F.struct(f"{e}_m", f"{e}_vertex")).alias(e))
    j = first(a, "from").join(first(b, "to"), ["request_id", "component"])
    best = j.groupBy("request_id").agg(F.min(F.struct((F.col("from.from_m") + F.col("to.to_m")).alias("sum_m"), "from", "to")).alias("m")).select("request_id", "m.from", "m.to", F.lit(True).alias("connected"))
    alone = lambda df, e: df.groupBy("request_id").agg(F.min(F.struct(f"{e}_m", f"{e}_vertex")).alias(e))
    rest = alone(a, "from").join(alone(b, "to"), "request_id").join(best.select("request_id"), "request_id", "left_anti").withColumn("connected", F.lit(False))
    return best.unionByName(rest.select(best.columns)).select("request_id", "from.from_vertex", "to.to_vertex", "from.from_m", "to.to_m", "connected")


def checked_requests(requests: DataFrame, options: tuple[str, ...] = ("SAFE", "SHORTEST")) -> DataFrame:
    """A row a request and option with problem: null, or what is wrong with its coordinates; no options means all.

    requests: request_id, from_lon, from_lat, to_lon, to_lat, options (array or null).
    """
    p = F.lit(None).cast("string")
    for end in ("to", "from"):
        lon, lat = F.col(f"{end}_lon"), F.col(f"{end}_lat")
        p = F.when(lon.isNull() | lat.isNull(), F.lit(f"{end.upper()}_MISSING")).when(~lon.between(-180, 180) | ~lat.between(-90, 90), F.lit(f"{end.upper()}_OUT_OF_RANGE")).otherwise(p)
    wanted = F.when(F.size(F.coalesce("options", F.array().cast("array<string>"))) > 0, F.col("options")).otherwise(F.array(*map(F.lit, options)))
    return requests.withColumn("problem", p).withColumn("option", F.explode(F.array_distinct(wanted))).drop("options")


def answers(checked: DataFrame, found: DataFrame) -> DataFrame:
    """Every request and option with its path's summary, or available = false and a reason: its problem, or NO_PATH. found: request_id, option, metres, minutes."""
    j = checked.join(found, ["request_id", "option"], "left")
    reason = F.coalesce("problem", F.when(F.col("metres").isNull(), F.lit("NO_PATH")))
    return j.select("request_id", "option", reason.isNull().alias("available"), reason.alias("reason"), "metres", "minutes")
