"""Queries of routing, attribute transfer, repair and validation over the project's road tables, with SQL where SQL can say them."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfold.functions import geo, states, text
from wayfold.operators import build, fuse, graph, rules, routing, spatial, topology, transfer
from wayfold.plans.core_problems import located_places
from wayfold.plans.reference import _CC, _LAT, _LON, _POINTS, _PT, _TM, HAV, SEG, _lifts, bare_lines, metric_lines, metric_nodes, segments
from wayfold.plans.runtime import materialize, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---- routing


def _rule_sql() -> str:
    parts = []
    for p, influence in routing.DISTANCE_INFLUENCE.items():
        factors = " * ".join(f"case when {c} {op} {repr(v) if isinstance(v, str) else v} then {f} else 1.0 end" for q, c, op, v, f in routing.PROFILE_RULES if q == p)
        parts.append(f"select edge_id, '{p}' as profile, ({factors})::double as priority, length, {influence} as influence from seg")
    return f"with {SEG}, p as ({' union all '.join(parts)}) select edge_id, profile, round(priority, 6) as priority, round(case when priority > 0 then length / (5.0/3.6 * priority) + length / 1000 * influence end, 6) as weight from p"


@query(_rule_sql())
def profile_priorities(spark, sf_dir):
    """Priority and weight of every edge for all eight profiles of the rule table."""
    p = routing.profile_priorities(segments(spark, sf_dir))
    return p.select("edge_id", "profile", F.round("priority", 6).alias("priority"), F.round("weight", 6).alias("weight"))


@query(
    f"""with {SEG}, d as (select *, case when width < 2.0 then 'IMPASSABLE' when slope is null then 'UNKNOWN' when slope <= 3.0 then 'FLAT' when slope <= 5.56 then 'MODERATE' when slope <= 8.33 then 'STEEP' else 'IMPASSABLE' end st from seg)
    select edge_id, st as display_state,
     round(1.0 + case st when 'FLAT' then 0.0 when 'MODERATE' then 0.04 when 'STEEP' then 0.14 when 'IMPASSABLE' then 0.7 else 0.08 end + case surface_state when 'PAVED' then 0.0 when 'UNPAVED' then 0.12 else 0.05 end + case when stairs_state = 'YES' then 3.0 else 0.0 end + case when width < 1.2 then 1.2 else 0.0 end, 6) as fast,
     round(greatest(0.2, 1.0 + case st when 'FLAT' then 0.0 when 'MODERATE' then 0.35 when 'STEEP' then 1.4 when 'IMPASSABLE' then 8.0 else 0.45 end + case surface_state when 'PAVED' then 0.0 when 'UNPAVED' then 1.1 else 0.35 end + case when stairs_state = 'YES' then 20.0 else 0.0 end
       + case when width < 1.2 then 5.0 when width < 1.5 then 1.2 when width >= 2.0 then -0.08 else 0.0 end - case when walk_access = 'YES' then 0.05 else 0.0 end), 6) as safe,
     len(list_filter([case when stairs_state = 'YES' then 'stairs' end, case when st in ('STEEP','IMPASSABLE') then 's' end, case when surface_state = 'UNPAVED' then 'u' end, case when width < 1.5 then 'n' end], lambda x: x is not null))::int as n_warnings from d"""
)
def route_costs(spark, sf_dir):
    """Additive cost of a metre for people with impaired mobility, fast and safe, and the number of warnings."""
    s = segments(spark, sf_dir).withColumn("st", states.display_slope(F.col("slope"), F.col("width")))
    cols = [F.col(c) for c in ("st", "surface_state", "stairs_state", "width", "walk_access")]
    cost = lambda kind: F.round(routing.cost_multiplier(kind, "mobility", *cols), 6)
    return s.select("edge_id", F.col("st").alias("display_state"), cost("fast").alias("fast"), cost("safe").alias("safe"), F.size(routing.warnings_of("mobility", *cols[:4])).alias("n_warnings"))


def _route_edges(spark, sf_dir):
    nodes = metric_nodes(spark, sf_dir).select("vertex_id", "lon", "lat")
    s = segments(spark, sf_dir).withColumn("points", text.parse_linestring(F.col("geom")))
    return materialize(routing.route_graph(nodes, s))


@query(
    f"""with {SEG}, nd as {_POINTS('road_nodes', 'vertex_id')} select edge_id, round(length, 2) as length from seg where length > 0 and from_node_id in (select vertex_id from nd) and to_node_id in (select vertex_id from nd)"""
)
def route_graph(spark, sf_dir):
    """Edges whose nodes both exist, with their length."""
    return _route_edges(spark, sf_dir).select("edge_id", F.round("length", 2).alias("length"))


@query()
def path_summaries(spark, sf_dir):
    """The twenty farthest nodes from the node with the lowest id, a top-k report, with their paths: edges, metres, minutes, warnings."""
    edges = _route_edges(spark, sf_dir)
    source = edges.agg(F.min("from_node_id").alias("vertex_id")).select(F.lit(1).cast("bigint").alias("source_id"), "vertex_id")
    reached = materialize(routing.shortest_paths(edges, source, "length", edge="edge_id"))
    targets = reached.orderBy(F.desc("cost"), "vertex_id").limit(20).select("source_id", F.col("vertex_id").alias("target_id"))
    rows = routing.path_rows(reached, targets)
    s = segments(spark, sf_dir)
    shown = s.select("edge_id", "length", F.col("length").alias("cost"), routing.warnings_of("mobility", states.display_slope(F.col("slope"), F.col("width")), F.col("surface_state"), F.col("stairs_state"), F.col("width")).alias("warnings"))
    out = routing.path_summary(rows, shown)
    return out.select("target_id", "n_edges", F.round("metres", 2).alias("metres"), F.round("minutes", 3).alias("minutes"), "n_warnings")


@query()
def connected_route_ends(spark, sf_dir):
    """For every elevator as origin and the next one by id as destination, the nearest pair of road nodes of one component."""
    lifts = _lifts(spark, sf_dir)
    numbered = fuse.renumber(lifts, "n", "elevator_id").select("n", "elevator_id", "lon", "lat")
    to = numbered.select((F.col("n") - 1).alias("n"), F.col("lon").alias("to_lon"), F.col("lat").alias("to_lat"))
    requests = materialize(numbered.join(to, "n").select(F.col("elevator_id").alias("request_id"), F.col("lon").alias("from_lon"), F.col("lat").alias("from_lat"), "to_lon", "to_lat"))
    nodes = metric_nodes(spark, sf_dir).select("vertex_id", "lon", "lat")
    label = graph.components(segments(spark, sf_dir), "from_node_id", "to_node_id")
    e = routing.connected_ends(requests, nodes, label, k=80, metres=800.0)
    return e.select("request_id", "from_vertex", "to_vertex", F.round("from_m", 3).alias("from_m"), F.round("to_m", 3).alias("to_m"), "connected")


# ---- states


@query(
    f"""with {SEG} select edge_id, case when width is null then 'UNKNOWN' when width < 2 then 'VERY_NARROW' when width < 4 then 'NARROW' when width < 8 then 'MEDIUM' when width < 10 then 'WIDE' else 'VERY_WIDE' end as width_level,
    case when slope is null then 'UNKNOWN' when slope < 3 then 'VERY_GENTLE' when slope < 5 then 'GENTLE' when slope < 8 then 'CAUTION' when slope < 12 then 'SLOPED' when slope < 20 then 'STEEP' when slope < 35 then 'VERY_STEEP' else 'DANGEROUS' end as slope_level,
    case when k >= 6 then 'VERY_HIGH' when k >= 4 then 'HIGH' when k >= 2 then 'MEDIUM' else 'LOW' end as risk from (select *, case when slope >= 20 then 4 when slope >= 12 then 3 when slope >= 8 then 2 when slope >= 5 then 1 else 0 end + case when width < 2 then 2 when width < 4 then 1 else 0 end k from seg)"""
)
def road_levels(spark, sf_dir):
    """Width and slope levels and the risk of every edge."""
    s = segments(spark, sf_dir)
    return s.select("edge_id", states.width_level(F.col("width")).alias("width_level"), states.slope_level(F.col("slope")).alias("slope_level"), states.risk_level(F.col("slope"), F.col("width"), F.col("surface_state")).alias("risk"))


# ---- attribute transfer


def _shapes(spark, sf_dir):
    s = table(spark, sf_dir, "road_segment_filter_polygons").where("edge_id is not null")
    s = fuse.first_per_key(s.select("edge_id", "geom", "road_width_meter", "source_row_number"), ["edge_id"], "source_row_number", "geom")
    return materialize(s.select(F.col("edge_id").alias("shape_id"), "road_width_meter", text.parse_multipolygon(F.col("geom")).alias("parts")))


@query()
def polygon_overlaps(spark, sf_dir):
    """How much of each edge lies in each filter polygon it enters."""
    o = spatial.lines_in_regions(metric_lines(spark, sf_dir).select("edge_id", "points"), _shapes(spark, sf_dir), "edge_id", "shape_id")
    return o.select("edge_id", "shape_id", F.round("overlap_m", 3).alias("overlap_m"), F.round("length_m", 3).alias("length_m"))


@query()
def polygon_widths(spark, sf_dir):
    """Mean road width of the polygons whose best edge it is, for edges of which at least 0.3 lies inside."""
    m = transfer.polygon_means(metric_lines(spark, sf_dir).select("edge_id", "points"), _shapes(spark, sf_dir), "edge_id", "shape_id", ["road_width_meter"])
    return m.select("edge_id", "n_sources", F.round("road_width_meter", 3).alias("road_width_meter"))




@query(
    f"""with {SEG}, vx as (select edge_id, j, x, y from {_TM.format(src="(select edge_id, i j, v[2*i-1] lon, v[2*i] lat from (select edge_id, v, unnest(generate_series(1, (len(v)//2)::bigint)) i from (select edge_id, list_transform(regexp_extract_all(regexp_extract(geom, '(?i)LINESTRING[ ]*[(](.*)[)]', 1), '(-?[0-9]+([.][0-9]+)?)', 1), lambda x: x::double) v from seg where geom is not null and segment_type = 'SIDE_WALK') where len(v) >= 4))")}),
    legs as (select a.edge_id, a.x ax, a.y ay, b.x bx, b.y "by" from vx a join vx b on a.edge_id = b.edge_id and b.j = a.j + 1), pts as (select elevator_id, x px, y py from {_TM.format(src=_POINTS('subway_station_elevators_erd_ready', 'elevator_id'))}),
    d as (select elevator_id, edge_id, sqrt(pow(px-ax-t*(bx-ax),2)+pow(py-ay-t*("by"-ay),2)) d from (select *, greatest(0.0, least(1.0, case when (bx-ax)*(bx-ax)+("by"-ay)*("by"-ay) = 0 then 0.0 else ((px-ax)*(bx-ax)+(py-ay)*("by"-ay))/((bx-ax)*(bx-ax)+("by"-ay)*("by"-ay)) end)) t
      from pts join legs on px between least(ax,bx)-60 and greatest(ax,bx)+60 and py between least(ay,"by")-60 and greatest(ay,"by")+60))
    select elevator_id, round(min(d), 2) as distance_m from d where d <= 60 group by 1"""
)
def nearest_side_walk(spark, sf_dir):
    """The nearest edge of type SIDE_WALK to every elevator within 60 m."""
    pts = _lifts(spark, sf_dir).select("elevator_id", F.array(geo.to_metres(F.col("lon"), F.col("lat"))).alias("points"))
    n = transfer.nearest_line(pts, metric_lines(spark, sf_dir).select("edge_id", "segment_type", "points"), "elevator_id", "edge_id", 60.0, only=F.col("segment_type") == "SIDE_WALK")
    return n.select("elevator_id", F.round("distance_m", 2).alias("distance_m"))


@query()
def elevator_mapping_counts(spark, sf_dir):
    """Elevators, those without a usable point, mapped and unmapped ones, and edges reached."""
    e = table(spark, sf_dir, "subway_station_elevators_erd_ready").select("elevator_id", text.point_lon_lat(F.col("point")).alias("p")).distinct()
    pts = e.where("p is not null").select("elevator_id", F.array(geo.to_metres(F.col("p.lon"), F.col("p.lat"))).alias("points"))
    n = transfer.nearest_line(pts, metric_lines(spark, sf_dir).select("edge_id", "points"), "elevator_id", "edge_id", 15.0)
    return transfer.mapping_counts(e, n, "elevator_id", "edge_id", F.col("p").isNotNull())


@query(
    f"""with {SEG}, e as (select edge_id, width, unnest(list_distinct([from_node_id, to_node_id])) node from seg), p as (select distinct a.edge_id, b.edge_id other, b.width w from e a join e b on a.node = b.node where a.width is null and b.width is not null),
    f as (select edge_id, round(median(w), 4) w from p group by edge_id)
    select seg.edge_id, coalesce(seg.width, f.w) as width, case when not (width_state is null or upper(trim(width_state)) in ('', 'UNKNOWN', 'NULL', 'NONE', 'NAN')) or coalesce(seg.width, f.w) is null then width_state
      when coalesce(seg.width, f.w) <= 0 then 'UNKNOWN' when coalesce(seg.width, f.w) >= 1.5 then 'ADEQUATE_150' when coalesce(seg.width, f.w) >= 1.2 then 'ADEQUATE_120' else 'NARROW' end as width_state from seg left join f on f.edge_id = seg.edge_id"""
)
def filled_widths(spark, sf_dir):
    """Unknown widths filled from neighbours, then unknown width states from widths."""
    s = materialize(segments(spark, sf_dir).select("edge_id", "from_node_id", "to_node_id", "width", "width_state"))
    near = fuse.neighbour_median(s, "edge_id", ["from_node_id", "to_node_id"], "width").withColumnRenamed("filled", "width")
    filled = transfer.fill_from(s, near, "edge_id", ["width"])
    return transfer.backfill_states(filled, {"width_state": ("width", states.width_state)}).select("edge_id", "width", "width_state")


# ---- topology


def _graph(spark, sf_dir):
    nodes = fuse.first_per_key(metric_nodes(spark, sf_dir), ["vertex_id"], "x", "y").select("vertex_id", "x", "y")
    s = metric_lines(spark, sf_dir).select("edge_id", "from_node_id", "to_node_id", "segment_type", "points")
    return materialize(nodes), materialize(s)


@query()
def topology_repair(spark, sf_dir):
    """Segments after every node that touches a foreign segment was joined with it."""
    _n, s, _log = topology.repair_topology(*_graph(spark, sf_dir))
    return s.select("edge_id", "from_node_id", "to_node_id", "segment_type", F.size("points").alias("n_points"), F.round(geo.line_length(F.col("points")), 2).alias("length"))


@query()
def topology_review(spark, sf_dir):
    """What the repair left for a person: ambiguous nodes, nodes that would move too far, short edges."""
    return topology.repair_topology(*_graph(spark, sf_dir))[2]


@query()
def connection_candidates(spark, sf_dir):
    """Possible connections of different components within 600 m, numbered, with kind, priority and colour."""
    return topology.connectivity(*_graph(spark, sf_dir), reach_m=600.0, connect_m=400.0)


@query()
def connected_graph(spark, sf_dir):
    """Segments after candidates were found and applied until none is left."""
    _n, s, _counts, _settled = topology.connect_until_settled(*_graph(spark, sf_dir))
    return s.select("edge_id", "from_node_id", "to_node_id", "segment_type", F.round(geo.line_length(F.col("points")), 2).alias("length"))


@query()
def bridged_graph(spark, sf_dir):
    """Segments after each other component's shortest link to the main one, of 30 m at most here, was built."""
    nodes, s = _graph(spark, sf_dir)
    links = topology.bridge_links(nodes, s, 30.0, auto=30.0)
    _n, out, _log = topology.apply_bridges(nodes, s, links)
    return out.select("edge_id", "from_node_id", "to_node_id", "segment_type", F.round(geo.line_length(F.col("points")), 2).alias("length"))


_ENUMS = {"walk_access": ("YES", "NO", "UNKNOWN"), "segment_type": ("SIDE_LINE", "SIDE_WALK")}
_LINE = r"list_transform(regexp_extract_all(regexp_extract(geom, '(?i)LINESTRING\s*\((.*)\)', 1), '(-?[0-9]+(\.[0-9]+)?)', 1), lambda x: x::double)"


@query(
    _CC
    + f""", np as (select least(from_node_id,to_node_id) x, greatest(from_node_id,to_node_id) y, count(*) k from road_segments group by 1,2), nn as (select from_node_id v from road_segments union all select to_node_id from road_segments),
    nd as (select vertex_id, case when {_PT} and {_LON} between 124 and 132 and {_LAT} between 33 and 39 then {_LON} end lon, {_LAT} lat from road_nodes), na as (select vertex_id, min(lon) lon, arg_min(lat, lon) lat from nd where lon is not null group by 1),
    ln as (select from_node_id, to_node_id, v, list_sum(list_transform(generate_series(1, (len(v) // 2 - 1)::bigint), lambda i: sqrt(pow((v[2*i+1]-v[2*i-1])*111320.0*cos(radians((v[2*i]+v[2*i+2])/2)),2)+pow((v[2*i+2]-v[2*i])*110540.0,2)))) m from (select from_node_id, to_node_id, case when len({_LINE}) >= 4 then {_LINE} end v from road_segments)),
    gp as (select greatest(sqrt(pow((a.lon-v[1])*111320.0*cos(radians((a.lat+v[2])/2)),2)+pow((a.lat-v[2])*110540.0,2)), sqrt(pow((b.lon-v[len(v)-1])*111320.0*cos(radians((b.lat+v[len(v)])/2)),2)+pow((b.lat-v[len(v)])*110540.0,2))) g from ln join na a on a.vertex_id = from_node_id join na b on b.vertex_id = to_node_id where v is not null and m > 0.01)
    select 'n_nodes' as check_name, count(*) n from road_nodes union all select 'n_segments', count(*) from road_segments union all select 'self_loops', count(*) from road_segments where from_node_id = to_node_id
    union all select 'duplicate_node_ids', (count(*) - count(distinct vertex_id)) from road_nodes union all select 'duplicate_edge_ids', (count(*) - count(distinct edge_id)) from road_segments
    union all select 'duplicate_node_pairs', coalesce(sum(k-1), 0)::bigint from np where k > 1
    union all select 'bad_references', count(*) from nn where v is null or v not in (select vertex_id from road_nodes) union all select 'isolated_nodes', count(*) from (select distinct vertex_id v from road_nodes) where v not in (select v from nn where v is not null)
    union all select 'enum_walk_access', count(*) from road_segments where not coalesce(walk_access in ('YES','NO','UNKNOWN'), false) union all select 'enum_segment_type', count(*) from road_segments where not coalesce(segment_type in ('SIDE_LINE','SIDE_WALK'), false)
    union all select 'missing_node_columns', 0 union all select 'missing_segment_columns', 0 union all select 'bad_node_points', count(*) from nd where lon is null union all select 'bad_geometries', count(*) from ln where v is null or not (m > 0.01)
    union all select 'endpoint_mismatches', count(*) from gp where g > 1.0 union all select 'distinct_node_pairs', count(*) from np where x is not null and y is not null union all select 'components', count(distinct g) from cc
    union all select 'main_component_rows', max(k)::bigint from (select sum(np.k) k from np join cc on cc.v = np.x where np.x is not null and np.y is not null group by cc.g) union all select 'main_component_pairs', max(k) from (select count(*) k from np join cc on cc.v = np.x where np.x is not null and np.y is not null group by cc.g)"""
)
def graph_validation(spark, sf_dir):
    """All counters of the graph validator."""
    nodes, s = table(spark, sf_dir, "road_nodes"), table(spark, sf_dir, "road_segments")
    return topology.validate(nodes, s, text.point_lon_lat(F.col("point")), text.parse_linestring(F.col("geom")), _ENUMS)


@query(f"with {SEG}, e as (select from_node_id v, width from seg union all select to_node_id, width from seg) select v as vertex_id, count(*) as degree, greatest(coalesce(max(width), 0.0) / 2, 1.0) as radius from e where v is not null group by v having count(*) >= 3")
def intersection_roots(spark, sf_dir):
    return topology.intersection_roots(segments(spark, sf_dir))


@query()
def intersection_sectors(spark, sf_dir):
    """Sectors between the arms of every intersection."""
    s = materialize(metric_lines(spark, sf_dir).select("edge_id", "from_node_id", "to_node_id", "points", "width"))
    out = topology.sectors(topology.intersection_roots(s), s)
    return out.select("vertex_id", "sector", F.round("low", 4).alias("low"), F.round("high", 4).alias("high"))


@query()
def pruned_graph(spark, sf_dir):
    """Segments without dangling chains of 25 m at most."""
    s = materialize(segments(spark, sf_dir).select("edge_id", "from_node_id", "to_node_id", "length").where("from_node_id is not null and to_node_id is not null"))
    return topology.prune_dangling(s, "length", 25.0)[0]


@query()
def near_crossings(spark, sf_dir):
    """Lines that pass each other within 2.5 m at an angle without meeting."""
    n = build.near_crosses(metric_lines(spark, sf_dir).select("edge_id", "points"))
    return n.select("edge_id_a", "edge_id_b", F.round("distance_m", 3).alias("distance_m"), F.round("turn", 2).alias("turn"))


@query()
def parallel_stretches(spark, sf_dir):
    """Stretches on which two lines run side by side."""
    n = build.near_overlaps(bare_lines(spark, sf_dir))
    return n.select("edge_id_a", "edge_id_b", F.round("length", 3).alias("length"))


@query()
def clipped_side_lines(spark, sf_dir):
    """Stretches of every side line that lie outside the discs of the two intersections it runs to."""
    s = materialize(metric_lines(spark, sf_dir).select("edge_id", "from_node_id", "to_node_id", "points", "width"))
    at = metric_nodes(spark, sf_dir).groupBy("vertex_id").agg(F.min(F.struct("x", "y")).alias("p"))
    disc = topology.intersection_roots(s).join(at, "vertex_id").select("vertex_id", F.struct("p.x", "p.y", F.col("radius").alias("r")).alias("disc"))
    j = s.join(disc.select(F.col("vertex_id").alias("from_node_id"), F.col("disc").alias("da")), "from_node_id", "left").join(disc.select(F.col("vertex_id").alias("to_node_id"), F.col("disc").alias("db")), "to_node_id", "left")
    lines = build.side_lines(s).join(j.select("edge_id", F.array_compact(F.array("da", "db")).alias("discs")), "edge_id")
    cut = lines.withColumn("line", geo.measured(F.col("points"))).select("edge_id", "side", F.posexplode(geo.outside_discs(F.col("line"), F.col("discs"))).alias("part", "k"))
    return cut.select("edge_id", "side", "part", F.round(F.col("k.e") - F.col("k.s"), 3).alias("length")).where("length > 0")
