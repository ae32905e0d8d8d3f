"""Queries of the reference's own operators over the project's tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.functions import geo, states, text
from wayfold.operators import build, fuse, graph, nearest, quality_profile, repair, routing, rules
from wayfold.plans.core_problems import located_places
from wayfold.plans.runtime import materialize, once, table
from wayfold.sources import files
from wayfold.streaming import flow

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest load of every edge, numbers typed, unusable numbers null."""
    s = table(spark, sf_dir, "road_segments")
    s = fuse.first_per_key(s, ["edge_id"], -F.col("load_id"), F.col("loaded_at"), F.col("geom"))
    num = lambda c, hi: F.when(F.col(c).rlike(r"\A[0-9]+(\.[0-9]{1,2})?\z") & (F.col(c).try_cast("double") <= hi), F.col(c).try_cast("double"))
    return s.withColumn("width", num("width_meter", 30)).withColumn("slope", num("avg_slope_percent", 100)).withColumn("length", F.col("length_meter").cast("double"))


SEG = """seg as (select *, case when regexp_full_match(width_meter, '[0-9]+(\\.[0-9]{1,2})?') and try_cast(width_meter as double) <= 30 then try_cast(width_meter as double) end width,
  case when regexp_full_match(avg_slope_percent, '[0-9]+(\\.[0-9]{1,2})?') and try_cast(avg_slope_percent as double) <= 100 then try_cast(avg_slope_percent as double) end slope, length_meter::double length
  from (select *, row_number() over (partition by edge_id order by load_id desc, loaded_at, geom) rn from road_segments) where rn = 1)"""
_PT = r"regexp_full_match(point, '(?i)\s*(srid\s*=\s*4326\s*;)?\s*point\s*\(\s*[+-]?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?\s+[+-]?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?\s*\)\s*')"
_LON, _LAT = r"try_cast(regexp_extract(point, '\(\s*([^\s]+)\s', 1) as double)", r"try_cast(regexp_extract(point, '\s([^\s()]+)\s*\)', 1) as double)"
_NUMBER_PAIR = (_LON, _LAT, f"{_PT} and {_LON} between 124 and 132 and {_LAT} between 33 and 39")
_POINTS = lambda t, k: f"(select distinct {k}, {_LON} lon, {_LAT} lat from {t} where {_PT} and {_LON} between 124 and 132 and {_LAT} between 33 and 39)"
_HAV = "2*6371008.8*asin(least(1.0, sqrt(pow(sin(radians({b}.lat-{a}.lat)/2),2)+cos(radians({a}.lat))*cos(radians({b}.lat))*pow(sin(radians({b}.lon-{a}.lon)/2),2))))"
HAV = _HAV.format(a="a", b="b")


# ---- parsing, states, text


@query(
    r"""select distinct edge_id, load_id, len(v) // 2 as n_points, round(v[1], 8) as first_lon, round(v[len(v)], 8) as last_lat,
    round(list_sum(list_transform(generate_series(1, (len(v) // 2 - 1)::bigint), lambda i: sqrt(pow((v[2*i+1]-v[2*i-1])*111320.0*cos(radians((v[2*i]+v[2*i+2])/2)),2)+pow((v[2*i+2]-v[2*i])*110540.0,2)))), 3) as metres
    from (select edge_id, load_id, list_transform(regexp_extract_all(regexp_extract(geom, '(?i)LINESTRING\s*\((.*)\)', 1), '(-?[0-9]+(\.[0-9]+)?)', 1), lambda x: x::double) v from road_segments where geom is not null) where len(v) >= 4"""
)
def parse_linestrings(spark, sf_dir):
    s = table(spark, sf_dir, "road_segments").where("geom is not null").select("edge_id", "load_id", text.parse_linestring(F.col("geom")).alias("p")).where("p is not null")
    n = F.size("p")
    return s.select("edge_id", "load_id", n.cast("bigint").alias("n_points"), F.round(F.col("p")[0].x, 8).alias("first_lon"), F.round(F.element_at("p", -1).y, 8).alias("last_lat"), F.round(geo.line_length_degrees(F.col("p")), 3).alias("metres")).distinct()


@query(
    f"""with {SEG} select edge_id, case when width is null or width <= 0 then 'UNKNOWN' when width >= 1.5 then 'ADEQUATE_150' when width >= 1.2 then 'ADEQUATE_120' else 'NARROW' end as width_state,
    case when slope is null then 'UNKNOWN' when slope < 3 then 'FLAT' when slope < 5.56 then 'MODERATE' when slope < 8.33 then 'STEEP' else 'RISK' end as slope_state,
    least(511, floor(coalesce(slope, 0)/0.25+0.5)::int)*0.25::double as slope_stored from seg"""
)
def derived_states(spark, sf_dir):
    return segments(spark, sf_dir).select("edge_id", states.width_state(F.col("width")).alias("width_state"), states.slope_state(F.col("slope")).alias("slope_state"), states.quantize(F.col("slope"), 0.25, 9).cast("double").alias("slope_stored"))


@query(
    r"""select distinct place_id, regexp_replace(regexp_replace(lower(name), '\([^)]*\)', '', 'g'), '[^0-9a-z가-힣]', '', 'g') as plain_name,
    array_to_string(list_filter(string_split_regex(address, '[\s\p{Z}\x{1c}-\x{1f}\x{85}\x{0b}]+'), lambda w: w <> '')[1:2], ' ') as address_prefix from places"""
)
def normalized_places(spark, sf_dir):
    """Every place, null for null."""
    p = table(spark, sf_dir, "places")
    return p.select("place_id", text.normalize_plain(F.col("name")).alias("plain_name"), text.address_prefix(F.col("address")).alias("address_prefix")).distinct()


@query(
    r"""select distinct removed_id, case when len(u) = 0 then 0.0 else round(len(list_intersect(x, y))::double / len(u), 6) end as jaccard from
    (select removed_id, x, y, list_distinct(list_concat(x, y)) u from (select removed_id, list_distinct(list_filter(string_split(coalesce(name, ''), ''), lambda c: c <> '')) x, list_distinct(list_filter(string_split(coalesce(public_facility_name, ''), ''), lambda c: c <> '')) y from facility_priority_manual_removed_applied))"""
)
def name_set_overlap(spark, sf_dir):
    r = table(spark, sf_dir, "facility_priority_manual_removed_applied")
    return r.select("removed_id", F.round(text.char_jaccard(F.col("name"), F.col("public_facility_name")), 6).alias("jaccard")).distinct()


@query(
    """select distinct removed_id, len(f)::int as n_flags, array_to_string(list_concat(f, case when list_contains(f, 'generic_name') then [] else ['generic_name'] end), '|') as with_generic, array_to_string(list_filter(f, lambda x: x <> 'accessible_toilet'), '|') as without_toilet
    from (select removed_id, list_distinct_ordered as f from (select removed_id, list_filter(string_split(coalesce(review_flags, ''), '|'), lambda x: x <> '') list_distinct_ordered from facility_priority_manual_removed_applied))"""
)
def flag_lists(spark, sf_dir):
    r = table(spark, sf_dir, "facility_priority_manual_removed_applied")
    f = F.filter(F.split(F.coalesce("review_flags", F.lit("")), r"\|"), lambda x: x != "")
    return r.select("removed_id", F.size(f).alias("n_flags"), text.list_add(F.col("review_flags"), "generic_name").alias("with_generic"), text.list_drop(F.col("review_flags"), "accessible_toilet").alias("without_toilet")).distinct()


# the projection again, by another series than the engine's: Helmert's meridian arc and Snyder's powers of the longitude
_ARC = "6378137.0/(1+n)*((1+n*n/4+pow(n,4)/64)*{p} - 1.5*(n-pow(n,3)/8)*sin(2*{p}) + 15.0/16*(n*n-pow(n,4)/4)*sin(4*{p}) - 35.0/48*pow(n,3)*sin(6*{p}) + 315.0/512*pow(n,4)*sin(8*{p}))"
_TM = f"""(select *, 1000000 + 0.9996*v*(a + (1-t+c)*pow(a,3)/6 + (5-18*t+t*t+72*c-58*e1)*pow(a,5)/120) x,
 2000000 + 0.9996*({_ARC.format(p="phi")} - {_ARC.format(p="radians(38)")} + v*tan(phi)*(a*a/2 + (5-t+9*c+4*c*c)*pow(a,4)/24 + (61-58*t+t*t+600*c-330*e1)*pow(a,6)/720)) y
 from (select *, 6378137.0/sqrt(1-e2*pow(sin(phi),2)) v, pow(tan(phi),2) t, e1*pow(cos(phi),2) c, (radians(lon)-radians(127.5))*cos(phi) a
 from (select *, radians(lat) phi, e2/(1-e2) e1 from (select *, f*(2-f) e2, f/(2-f) n from (select *, 1/298.257222101 f from {{src}})))))"""


@query(f"select place_id, round(x, 3) as x, round(y, 3) as y from {_TM.format(src=_POINTS('places', 'place_id'))}")
def projected_places(spark, sf_dir):
    p = located_places(spark, sf_dir).withColumn("m", geo.to_metres(F.col("lon"), F.col("lat")))
    return p.select("place_id", F.round("m.x", 3).alias("x"), F.round("m.y", 3).alias("y"))


@query()
def polygon_measures(spark, sf_dir):
    """Area and centroid of the outer rings of filter polygons, summed over parts."""
    s = table(spark, sf_dir, "road_segment_filter_polygons").select("edge_id", "geom").distinct()
    s = s.select("edge_id", F.explode(text.parse_multipolygon(F.col("geom"))).alias("part")).select("edge_id", F.col("part")[0].alias("ring"))
    s = s.select("edge_id", F.abs(geo.ring_area(F.col("ring"))).alias("area"), geo.ring_centroid(F.transform("ring", lambda p: F.struct((p.x - F.col("ring")[0].x).alias("x"), (p.y - F.col("ring")[0].y).alias("y")))).alias("c"), F.col("ring")[0].alias("o"))
    return s.groupBy("edge_id").agg(F.round(F.sum("area"), 3).alias("area"), F.round(F.sum(F.col("area") * (F.col("c.x") + F.col("o.x"))) / F.sum("area"), 4).alias("x"), F.round(F.sum(F.col("area") * (F.col("c.y") + F.col("o.y"))) / F.sum("area"), 4).alias("y"))


# ---- joins


def _lifts(spark, sf_dir):
    e = table(spark, sf_dir, "subway_station_elevators_erd_ready").select("elevator_id", text.point_lon_lat(F.col("point")).alias("p")).where("p is not null")
    return e.select("elevator_id", "p.lon", "p.lat").distinct()


_NEAR = f"(select a.place_id, b.elevator_id, {HAV} d from {_POINTS('places', 'place_id')} a, {_POINTS('subway_station_elevators_erd_ready', 'elevator_id')} b)"


@query(
    f"""select p.place_id, n.elevator_id, round(n.d, 3) as distance_m, case when n.d <= 15 then 'MATCHED' when n.d <= 100 then 'REVIEW' else 'UNMATCHED' end as tier
    from {_POINTS('places', 'place_id')} p left join (select place_id, elevator_id, d from (select *, row_number() over (partition by place_id order by d, elevator_id) k from {_NEAR} where d <= 100) where k = 1) n using (place_id)"""
)
def nearest_elevator_tiered(spark, sf_dir):
    t = nearest.tiered_nearest(located_places(spark, sf_dir), _lifts(spark, sf_dir), "place_id", "elevator_id", 15.0, 100.0)
    return t.select("place_id", "elevator_id", F.round("distance_m", 3).alias("distance_m"), "tier")


@query(f"select place_id from {_POINTS('places', 'place_id')} where place_id not in (select place_id from {_NEAR} where d <= 300)")
def places_without_elevator(spark, sf_dir):
    return nearest.without_near(located_places(spark, sf_dir), _lifts(spark, sf_dir), "place_id", "elevator_id", 300.0).select("place_id")


@query(
    f"""with p as (select a.elevator_id ka, b.elevator_id kb, {HAV} d from {_POINTS('subway_station_elevators_erd_ready', 'elevator_id')} a, {_POINTS('subway_station_elevators_erd_ready', 'elevator_id')} b where a.elevator_id <> b.elevator_id),
    n as (select ka, kb, d from (select *, row_number() over (partition by ka order by d, kb) k from p where d <= 200) where k = 1)
    select x.ka as elevator_id_a, x.kb as elevator_id_b, round(x.d, 3) as distance_m from n x join n y on x.ka = y.kb and x.kb = y.ka where x.ka < x.kb"""
)
def mutual_nearest_elevators(spark, sf_dir):
    m = nearest.mutual_nearest(_lifts(spark, sf_dir), "elevator_id", 200.0)
    return m.withColumn("distance_m", F.round("distance_m", 3))


@query(
    f"""select place_id, elevator_id, round(d, 3) as distance_m, case when d <= 50 then 50.0 when d <= 200 then 200.0 else 800.0 end as rung_m
    from (select *, row_number() over (partition by place_id order by d, elevator_id) k from {_NEAR} where d <= 800) where k = 1"""
)
def elevator_radius_ladder(spark, sf_dir):
    r = nearest.radius_ladder(located_places(spark, sf_dir), _lifts(spark, sf_dir), "place_id", "elevator_id", [50.0, 200.0, 800.0])
    return r.withColumn("distance_m", F.round("distance_m", 3))


_LEGS = r"""legs as (select edge_id, v[2*i-1]*111320.0*cos(radians(34.68)) ax, v[2*i]*110540.0 ay, v[2*i+1]*111320.0*cos(radians(34.68)) bx, v[2*i+2]*110540.0 as "by" from
 (select edge_id, v, unnest(generate_series(1, (len(v)//2-1)::bigint)) i from (select edge_id, list_transform(regexp_extract_all(regexp_extract(geom, '(?i)LINESTRING\s*\((.*)\)', 1), '(-?[0-9]+(\.[0-9]+)?)', 1), lambda x: x::double) v from seg where geom is not null) where len(v) >= 4))"""


@query(
    f"""with {SEG}, {_LEGS}, pts as (select elevator_id, lon*111320.0*cos(radians(34.68)) px, lat*110540.0 py from {_POINTS('subway_station_elevators_erd_ready', 'elevator_id')}),
    d as (select elevator_id, edge_id, sqrt(pow(px-ax-t*(bx-ax),2)+pow(py-ay-t*("by"-ay),2)) d from (select *, greatest(0.0, least(1.0, case when (bx-ax)*(bx-ax)+("by"-ay)*("by"-ay) = 0 then 0.0 else ((px-ax)*(bx-ax)+(py-ay)*("by"-ay))/((bx-ax)*(bx-ax)+("by"-ay)*("by"-ay)) end)) t
      from pts join legs on px between least(ax,bx)-40 and greatest(ax,bx)+40 and py between least(ay,"by")-40 and greatest(ay,"by")+40)),
    e as (select elevator_id, edge_id, min(d) d from d where d <= 40 group by 1, 2)
    select elevator_id, round(d, 3) as distance_m from (select *, row_number() over (partition by elevator_id order by d, edge_id) k from e) where k = 1"""
)
def nearest_segment_of_elevators(spark, sf_dir):
    pts = _lifts(spark, sf_dir).withColumn("p", nearest.local_xy(F.col("lon"), F.col("lat"), 34.68)).select("elevator_id", "p.x", "p.y")
    lines = segments(spark, sf_dir).select("edge_id", F.transform(text.parse_linestring(F.col("geom")), lambda p: nearest.local_xy(p.x, p.y, 34.68)).alias("points")).where("points is not null")
    return nearest.nearest_leg(pts, lines, "elevator_id", "edge_id", 40.0).select("elevator_id", F.round("distance_m", 3).alias("distance_m"))


@query("select distinct s.edge_id, s.from_node_id from road_segments s where s.from_node_id is not null and not exists (select 1 from road_nodes n where n.vertex_id = s.from_node_id)")
def orphan_segments(spark, sf_dir):
    """Edges whose start the node table lacks: none in these tables; orders_without_lines is the case with rows."""
    nodes = table(spark, sf_dir, "road_nodes").select(F.col("vertex_id").alias("from_node_id")).distinct()
    return table(spark, sf_dir, "road_segments").where("from_node_id is not null").select("edge_id", "from_node_id").distinct().join(nodes, "from_node_id", "left_anti").select("edge_id", "from_node_id")


@query("select distinct vertex_id, source_node_key from road_nodes where vertex_id in (select from_node_id from road_segments union select to_node_id from road_segments)")
def referenced_nodes(spark, sf_dir):
    ends = table(spark, sf_dir, "road_segments").select(F.explode(F.array("from_node_id", "to_node_id")).alias("vertex_id")).distinct()
    return table(spark, sf_dir, "road_nodes").select("vertex_id", "source_node_key").distinct().join(ends, "vertex_id", "left_semi")


# ---- aggregations, windows, fills


@query(
    """select case when g = 2 then 'surface_state' when g = 1 then 'segment_type*surface_state' else 'segment_type' end as grouping, case when g = 2 then s when g = 1 then t || ' / ' || s else t end as name, n from (
    select 2 g, coalesce(surface_state, '(none)') s, null t, count(*) n from road_segments group by 2 union all
    select 0, null, coalesce(segment_type, '(none)'), count(*) from road_segments group by 3 union all
    select 1, coalesce(surface_state, '(none)'), coalesce(segment_type, '(none)'), count(*) from road_segments group by 2, 3)"""
)
def counts_by_groupings(spark, sf_dir):
    return fuse.count_groupings(table(spark, sf_dir, "road_segments"), [["surface_state"], ["segment_type"], ["segment_type", "surface_state"]])


@query(
    f"""with {SEG} select load_id, count(*) as n, count(*) filter (where width > 0) as n_width, round(avg(slope) filter (where slope > 0), 6) as avg_slope, round(median(width), 2) as median_width, max(slope) as max_slope from seg group by load_id"""
)
def conditional_aggregates(spark, sf_dir):
    s = segments(spark, sf_dir)
    return s.groupBy("load_id").agg(F.count("*").alias("n"), F.count_if(F.col("width") > 0).alias("n_width"), F.round(F.avg(F.when(F.col("slope") > 0, F.col("slope"))), 6).alias("avg_slope"), F.round(F.median("width"), 2).alias("median_width"), F.max("slope").alias("max_slope"))


@query(
    """with c as (select from_node_id, surface_state, count(*) n, min(edge_id) f from road_segments where surface_state is not null and upper(trim(surface_state)) not in ('', 'UNKNOWN', 'NULL', 'NONE', 'NAN') group by 1, 2)
    select from_node_id, surface_state, n as votes from (select *, row_number() over (partition by from_node_id order by n desc, f, surface_state) k from c) where k = 1"""
)
def majority_surface(spark, sf_dir):
    return fuse.majority(table(spark, sf_dir, "road_segments"), ["from_node_id"], "surface_state", "edge_id")


@query(
    """with u as (select *, upper(trim(coalesce(width_meter,''))) w, upper(trim(coalesce(avg_slope_percent,''))) a, upper(trim(coalesce(slope_state,''))) s, upper(trim(coalesce(surface_state,''))) f from road_segments)
    select attribute, n_rows, n_unknown, round((n_rows-n_unknown)/n_rows, 6) as filled_rate from (
     select 'width' as attribute, count(*) n_rows, count(*) filter (where w in ('','UNKNOWN','NULL','NONE','NAN')) n_unknown from u union all
     select 'slope', count(*), count(*) filter (where a in ('','UNKNOWN','NULL','NONE','NAN') or s in ('','UNKNOWN','NULL','NONE','NAN')) from u union all
     select 'surface', count(*), count(*) filter (where f in ('','UNKNOWN','NULL','NONE','NAN')) from u)"""
)
def attribute_coverage(spark, sf_dir):
    return fuse.coverage(table(spark, sf_dir, "road_segments"), {"width": ["width_meter"], "slope": ["avg_slope_percent", "slope_state"], "surface": ["surface_state"]})


@query(
    f"""with {SEG}, e as (select edge_id, width, unnest(list_distinct([from_node_id, to_node_id])) node from seg), p as (select distinct a.edge_id, b.edge_id other, b.width w from e a join e b on a.node = b.node where a.width is null and b.width is not null)
    select edge_id, round(median(w), 4) as filled from p group by edge_id"""
)
def neighbour_width(spark, sf_dir):
    return fuse.neighbour_median(segments(spark, sf_dir).select("edge_id", "from_node_id", "to_node_id", "width"), "edge_id", ["from_node_id", "to_node_id"], "width")


@query("select station_id, coalesce(array_to_string(list_sort(list_distinct(list(entrance_no) filter (where entrance_no is not null))), ' / '), '') as entrances, count(distinct elevator_id) as n_elevators from subway_station_elevators_erd_ready group by station_id")
def station_entrances(spark, sf_dir):
    e = table(spark, sf_dir, "subway_station_elevators_erd_ready")
    return e.groupBy("station_id").agg(F.array_join(F.sort_array(F.collect_set("entrance_no")), " / ").alias("entrances"), F.count_distinct("elevator_id").alias("n_elevators"))


@query("select place_id, name, ingested_at from (select *, row_number() over (partition by place_id order by ingested_at, name nulls first) k from places) where k = 1")
def first_place_rows(spark, sf_dir):
    return fuse.first_per_key(table(spark, sf_dir, "places").select("place_id", "name", "ingested_at"), ["place_id"], "ingested_at", "name")


@query("select user_id, count(*) as n_events, max(c) + 1 as n_sessions from (select *, sum(s) over (partition by user_id order by ts, event_id rows unbounded preceding) c from (select *, case when epoch(ts) - lag(epoch(ts)) over (partition by user_id order by ts, event_id) > 86400 then 1 else 0 end s from events)) group by user_id")
def event_sessions(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("second", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    c = fuse.gap_clusters(e, ["user_id"], "second", 86400.0)
    return c.groupBy("user_id").agg(F.count("*").alias("n_events"), (F.max("cluster_") + 1).alias("n_sessions"))


@query(f"with {SEG} select from_node_id, edge_id, length from (select *, row_number() over (partition by from_node_id order by length desc, edge_id) k from seg) where k <= 2")
def longest_two_per_node(spark, sf_dir):
    return fuse.top_k(segments(spark, sf_dir), ["from_node_id"], 2, F.desc("length"), F.asc("edge_id")).select("from_node_id", "edge_id", "length")


@query("select row_number() over (order by source_node_key) as new_id, vertex_id from (select distinct vertex_id, source_node_key from road_nodes)")
def renumbered_nodes(spark, sf_dir):
    return fuse.renumber(table(spark, sf_dir, "road_nodes").select("vertex_id", "source_node_key").distinct(), "new_id", "source_node_key").select("new_id", "vertex_id")


@query("""select district_gu, count(*) filter (where review_priority = 'F1') as "F1", count(*) filter (where review_priority = 'F2') as "F2", count(*) filter (where review_priority = 'F3') as "F3" from facility_priority_manual_removed_applied group by district_gu""")
def priority_pivot(spark, sf_dir):
    return table(spark, sf_dir, "facility_priority_manual_removed_applied").groupBy("district_gu").pivot("review_priority", ["F1", "F2", "F3"]).count().fillna(0, ["F1", "F2", "F3"])


@query("select e.event_id, f.value as last_value from events e asof left join (select user_id, ts, max(value) as value from events where event_type = 'purchase' group by 1, 2) f on e.user_id = f.user_id and e.ts >= f.ts where e.event_type = 'click'")
def as_of_purchase(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    buys = e.where("event_type = 'purchase'").groupBy("user_id", F.col("ts").alias("bought_at")).agg(F.max("value").alias("last_value"))
    return fuse.as_of(e.where("event_type = 'click'").select("user_id", "event_id", "ts"), buys, ["user_id"], "ts", "bought_at").select("event_id", "last_value")


@query("select category, name, n from (select category, name, count(distinct place_id) n from places where name is not null group by 1, 2) where n > 1")
def repeated_places(spark, sf_dir):
    """Names that several places of a category have."""
    p = table(spark, sf_dir, "places").where("name is not null")
    return p.groupBy("category", "name").agg(F.count_distinct("place_id").alias("n")).where("n > 1")


@query("select o_orderpriority, o_orderstatus, n, grouping_level from (select o_orderpriority, o_orderstatus, count(*) n, grouping(o_orderpriority) * 2 + grouping(o_orderstatus) as grouping_level from orders group by cube (o_orderpriority, o_orderstatus))")
def order_cube(spark, sf_dir):
    o = table(spark, sf_dir, "orders").cube("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"), F.grouping_id().alias("grouping_level"))
    return o.select("o_orderpriority", "o_orderstatus", "n", "grouping_level")


# ---- graph


@query(
    f"""with {SEG}, d as (select degree, count(*) n_nodes from (select v, count(*) degree from (select from_node_id v from seg where from_node_id is not null union all select to_node_id from seg where to_node_id is not null) group by v) group by degree) select degree, n_nodes from d"""
)
def degree_distribution(spark, sf_dir):
    return graph.degrees(segments(spark, sf_dir)).groupBy("degree").agg(F.count("*").alias("n_nodes"))


_CHECK_ENUMS = {"walk_access": ("YES", "NO", "UNKNOWN"), "segment_type": ("SIDE_LINE", "SIDE_WALK")}


@query(
    """with p as (select least(from_node_id,to_node_id) x, greatest(from_node_id,to_node_id) y, count(*) k from road_segments group by 1,2), e as (select from_node_id v from road_segments union all select to_node_id from road_segments)
    select 'n_nodes' as check_name, count(*) n from road_nodes union all select 'n_segments', count(*) from road_segments union all select 'self_loops', count(*) from road_segments where from_node_id = to_node_id
    union all select 'duplicate_node_ids', (count(*) - count(distinct vertex_id)) from road_nodes union all select 'duplicate_edge_ids', (count(*) - count(distinct edge_id)) from road_segments
    union all select 'duplicate_node_pairs', coalesce(sum(k-1), 0)::bigint from p where k > 1
    union all select 'bad_references', count(*) from e where v is null or v not in (select vertex_id from road_nodes) union all select 'isolated_nodes', count(*) from (select distinct vertex_id v from road_nodes) where v not in (select v from e where v is not null)
    union all select 'enum_walk_access', count(*) from road_segments where not coalesce(walk_access in ('YES','NO','UNKNOWN'), false) union all select 'enum_segment_type', count(*) from road_segments where not coalesce(segment_type in ('SIDE_LINE','SIDE_WALK'), false)"""
)
def graph_checks(spark, sf_dir):
    return graph.checks(table(spark, sf_dir, "road_nodes"), table(spark, sf_dir, "road_segments"), _CHECK_ENUMS)


_CC = """with recursive e as (select distinct from_node_id x, to_node_id y from road_segments where from_node_id is not null and to_node_id is not null union select to_node_id, from_node_id from road_segments where from_node_id is not null and to_node_id is not null),
 cc(v, g) using key (v) as (select distinct x, x from e union (select e.y, min(cc.g) from cc join e on e.x = cc.v join recurring.cc r on r.v = e.y where cc.g < r.g group by e.y))"""


@query(_CC + " select v as vertex_id, g as component from cc")
def road_components(spark, sf_dir):
    return graph.components(table(spark, sf_dir, "road_segments"), "from_node_id", "to_node_id")


@query(_CC + " select size_bin, count(*) n_components, sum(n)::bigint n_nodes from (select count(*) n, case when count(*) <= 1 then '1' when count(*) <= 5 then '2-5' when count(*) <= 10 then '6-10' when count(*) <= 50 then '11-50' when count(*) <= 100 then '51-100' else '>100' end as size_bin from cc group by g) group by size_bin")
def component_bins(spark, sf_dir):
    s = table(spark, sf_dir, "road_segments")
    return graph.size_bins(graph.component_stats(s, graph.components(s, "from_node_id", "to_node_id")))


@query(
    """with recursive r as (select s, min(t) t from (select greatest(from_node_id, canonical_node_id) s, least(from_node_id, canonical_node_id) t from node_match_pairs where from_node_id <> canonical_node_id) group by s),
    c(s, t) as (select s, t from r union select c.s, r.t from c join r on r.s = c.t) select s as node_id, min(t) as final from c group by s"""
)
def resolved_redirects(spark, sf_dir):
    p = table(spark, sf_dir, "node_match_pairs").where("from_node_id <> canonical_node_id").select(F.greatest("from_node_id", "canonical_node_id").alias("node_id"), F.least("from_node_id", "canonical_node_id").alias("to_id"))
    return graph.resolve_redirects(p, "node_id", "to_id")


_COST = """with recursive e as (select u, w, min(c) c from (select from_node_id u, to_node_id w, length_meter::double c from road_segments union all select to_node_id, from_node_id, length_meter::double from road_segments) where u <> w and c >= 0 group by 1, 2),
 src as (select min(vertex_id) v from road_nodes),
 sp(v, d) using key (v) as (select v, 0.0::double from src union (select e.w, min(sp.d + e.c) from sp join e on e.u = sp.v left join recurring.sp r on r.v = e.w where r.v is null or sp.d + e.c < r.d - 1e-9 group by e.w))"""


@query(_COST + " select v as vertex_id, round(d, 2) as metres from sp")
def shortest_paths(spark, sf_dir):
    s = table(spark, sf_dir, "road_segments").select("from_node_id", "to_node_id", F.col("length_meter").cast("double").alias("metres"))
    source = table(spark, sf_dir, "road_nodes").agg(F.min("vertex_id").alias("vertex_id")).select(F.lit(1).alias("source_id"), "vertex_id")
    return routing.shortest_paths(s, source, "metres").select("vertex_id", F.round("cost", 2).alias("metres"))


_SAFE = """case when stairs_state = 'YES' then 0.0 else 1.0 end * case when slope >= 8.33 then 0.1 else 1.0 end * case when slope >= 5.56 then 0.5 else 1.0 end * case when width < 1.2 and width > 0 then 0.4 else 1.0 end * case when surface_state = 'UNPAVED' then 0.6 else 1.0 end"""


@query(f"with {SEG} select edge_id, round({_SAFE}, 6) as priority from seg")
def profile_priority(spark, sf_dir):
    """All matching factors multiply; 0 blocks the edge."""
    s = segments(spark, sf_dir)
    f = [(F.col("stairs_state") == "YES", 0.0), (F.col("slope") >= 8.33, 0.1), (F.col("slope") >= 5.56, 0.5), ((F.col("width") < 1.2) & (F.col("width") > 0), 0.4), (F.col("surface_state") == "UNPAVED", 0.6)]
    return s.select("edge_id", F.round(rules.product(f), 6).alias("priority"))


@query(
    f"""with {SEG}, m as (select *, case when lag(k) over w is distinct from surface_state or row_number() over w = 1 then 1 else 0 end nw from (select *, surface_state k from seg) window w as (partition by from_node_id order by edge_id)),
    r as (select *, sum(nw) over (partition by from_node_id order by edge_id rows unbounded preceding) run_ from m)
    select from_node_id, run_::bigint as run_, any_value(surface_state) as surface_state, min(edge_id) as first_at, max(edge_id) as last_at, count(*) as n from r group by 1, 2"""
)
def surface_runs(spark, sf_dir):
    return graph.runs(segments(spark, sf_dir), ["from_node_id"], "edge_id", "surface_state")


@query(
    f"""with {SEG} select edge_id, case when stairs_state = 'YES' then 'EXCLUDE' when slope >= 8.33 then 'REVIEW' when width is null then 'CHECK' else 'KEEP' end as decision, case when stairs_state = 'YES' then 'stairs' when slope >= 8.33 then 'steep' when width is null then 'no width' else '' end as reason from seg"""
)
def ordered_rules(spark, sf_dir):
    s = segments(spark, sf_dir)
    d = rules.decide([(F.col("stairs_state") == "YES", "EXCLUDE", "stairs"), (F.col("slope") >= 8.33, "REVIEW", "steep"), (F.col("width").isNull(), "CHECK", "no width")], ("KEEP", ""))
    return s.select("edge_id", d.alias("d")).select("edge_id", "d.decision", "d.reason")


@query()
def quality_profile_all(spark, sf_dir):
    """Profile of every road state column over all loads; columns without a domain have no violations."""
    return quality_profile.profile(table(spark, sf_dir, "road_segments"), quality_profile.ROAD_STATES, "load_id")


# ---- connections between components, export


def metric_nodes(spark, sf_dir):
    """vertex_id, lon, lat, x, y of road nodes."""
    n = table(spark, sf_dir, "road_nodes").select("vertex_id", text.point_lon_lat(F.col("point")).alias("p")).where("p is not null").distinct()
    return n.select("vertex_id", "p.lon", "p.lat", geo.to_metres(F.col("p.lon"), F.col("p.lat")).alias("m")).select("vertex_id", "lon", "lat", "m.x", "m.y")


_ENDS = (
    _CC.replace("with recursive", "with recursive " + SEG + ",").replace("from road_segments where", "from seg where")
    + f""", nd as (select vertex_id, x, y from {_TM.format(src=_POINTS('road_nodes', 'vertex_id'))}),
 dg as (select v, count(*) k from (select from_node_id v from seg union all select to_node_id from seg) where v is not null group by v),
 ends as (select nd.vertex_id, x, y, g from nd join dg on dg.v = nd.vertex_id and k = 1 join cc on cc.v = nd.vertex_id)"""
)


@query(
    _ENDS
    + """, p as (select a.vertex_id a, b.vertex_id b, sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2)) d, least(a.g,b.g) g0, greatest(a.g,b.g) g1 from ends a join ends b on a.vertex_id < b.vertex_id and a.g <> b.g and abs(a.x-b.x) <= 600 and abs(a.y-b.y) <= 600)
 select a as vertex_id_a, b as vertex_id_b, round(d, 3) as distance_m, case when d <= 0.75 then 'NODE_MERGE' else 'ENDPOINT_TO_ENDPOINT' end as kind from (select *, row_number() over (partition by g0, g1 order by d, a, b) k from p where d <= 600) where k <= 2"""
)
def connectivity_candidates(spark, sf_dir):
    s = materialize(segments(spark, sf_dir).select("edge_id", "from_node_id", "to_node_id"))
    ends = materialize(repair.endpoints(metric_nodes(spark, sf_dir), s, graph.components(s, "from_node_id", "to_node_id")))
    return repair.connection_candidates(ends, connect_m=600.0).withColumn("distance_m", F.round("distance_m", 3))


@query(
    _ENDS
    + """, st as (select g, count(*) n from cc group by g), se as (select cc.g, count(*) e from seg join cc on cc.v = seg.from_node_id group by cc.g), mn as (select st.g from st left join se using (g) order by coalesce(e,0) desc, n desc, g limit 1),
 al as (select nd.vertex_id, x, y, cc.g, cc.g = (select g from mn) is_main from nd join cc on cc.v = nd.vertex_id),
 p as (select a.g, a.vertex_id a, b.vertex_id b, sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2)) d from al a join al b on not a.is_main and b.is_main and abs(a.x-b.x) <= 30 and abs(a.y-b.y) <= 30)
 select g as component, round(d, 3) as distance_m, case when d <= 3 then 'AUTO' when d <= 12 then 'REVIEW' else 'HELD' end as tier from (select *, row_number() over (partition by g order by d, a, b) k from p where d <= 30) where k = 1"""
)
def component_bridges(spark, sf_dir):
    s = materialize(segments(spark, sf_dir).select("edge_id", "from_node_id", "to_node_id"))
    label = materialize(graph.components(s, "from_node_id", "to_node_id"))
    b = repair.bridges(metric_nodes(spark, sf_dir), s, label, 30.0)
    return b.select("component", F.round("distance_m", 3).alias("distance_m"), "tier")


@query()
def repaired_graph(spark, sf_dir):
    """Segments after merging near ends to a fixed point."""
    s = materialize(segments(spark, sf_dir).select("edge_id", "from_node_id", "to_node_id", "segment_type"))
    return repair.repair(metric_nodes(spark, sf_dir), s)[0]


@query()
def split_at_elevators(spark, sf_dir):
    """Road edges cut where the nearest elevators project onto them."""
    lines = segments(spark, sf_dir).select("edge_id", F.transform(text.parse_linestring(F.col("geom")), lambda p: nearest.local_xy(p.x, p.y, 34.68)).alias("points")).where("points is not null")
    lines = materialize(lines)
    pts = _lifts(spark, sf_dir).withColumn("p", nearest.local_xy(F.col("lon"), F.col("lat"), 34.68)).select("elevator_id", "p.x", "p.y")
    near = nearest.nearest_leg(pts, lines, "elevator_id", "edge_id", 40.0).join(pts, "elevator_id").join(lines, "edge_id")
    line = near.withColumn("line", geo.measured(F.col("points")))
    foot = F.array_min(F.zip_with(F.slice("line", F.lit(1), F.size("line") - 1), F.slice("line", F.lit(2), F.size("line") - 1), lambda a, b: F.struct(geo.point_leg(F.col("x"), F.col("y"), a.x, a.y, b.x, b.y).d.alias("d"), (a.m + geo.point_leg(F.col("x"), F.col("y"), a.x, a.y, b.x, b.y).t * (b.m - a.m)).alias("m"))))
    cuts = line.select("edge_id", foot.m.alias("m"))
    return repair.split_segments(lines, cuts).select("edge_id", "part_no", F.size("points").alias("n_points"), F.round("length", 3).alias("length"))


@query()
def osm_elements(spark, sf_dir):
    """Lines of the OSM XML export."""
    s = segments(spark, sf_dir).withColumn("points", text.parse_linestring(F.col("geom"))).where("points is not null")
    nodes = materialize(files.osm_nodes(metric_nodes(spark, sf_dir), s))
    have = nodes.where("osm_id >= 0").select("osm_id").distinct()
    for end in ("from_node_id", "to_node_id"):  # edges whose node has no usable point are left to graph_validation
        s = s.join(have.withColumnRenamed("osm_id", end), end, "left_semi")
    ways = files.osm_ways(s, nodes, {"walk_access": "walk_access", "surface": "surface_state", "signal": "signal_state", "stairs": "stairs_state"})
    return files.osm_lines(nodes, ways)


def metric_lines(spark, sf_dir):
    """Segments with points in EPSG:5179 metres."""
    return _in_metres(segments(spark, sf_dir))


def _in_metres(s: DataFrame) -> DataFrame:
    s = once(s, points=text.parse_linestring(F.col("geom"))).where("points is not null")
    return s.withColumn("points", F.transform("points", lambda p: geo.to_metres(p.x, p.y)))


def bare_lines(spark, sf_dir):
    """edge_id and points of metric_lines; of a segment only what picks the latest load is sent about, its text once."""
    s = table(spark, sf_dir, "road_segments")
    first = F.min(F.struct((-F.col("load_id")).alias("newest"), "loaded_at", "geom"))
    return _in_metres(s.groupBy("edge_id").agg(first["geom"].alias("geom"))).select("edge_id", "points")


_planar = metric_lines


@query()
def edge_chains(spark, sf_dir):
    """Edges, length and number of edges of maximal paths through nodes of degree two."""
    s = materialize(segments(spark, sf_dir).select("edge_id", "from_node_id", "to_node_id", "length"))
    return build.chains(s).join(s.select("edge_id", "length"), "edge_id").groupBy("chain").agg(F.count("*").alias("n_edges"), F.round(F.sum("length"), 2).alias("metres"))


@query()
def corner_split(spark, sf_dir):
    lines = materialize(_planar(spark, sf_dir).select("edge_id", "points"))
    return repair.split_segments(lines, build.corner_cuts(lines, 45.0)).select("edge_id", "part_no", F.round("length", 3).alias("length"))


@query()
def side_lines(spark, sf_dir):
    """Left and right lines of every edge with their number of vertices."""
    return build.side_lines(_planar(spark, sf_dir)).select("edge_id", "side", F.size("points").alias("n_points"))


@query()
def line_crossings(spark, sf_dir):
    return build.crossings(_planar(spark, sf_dir).select("edge_id", "points")).select("edge_id_a", "edge_id_b", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@query()
def self_scanned_graph(spark, sf_dir):
    """Segments after removal of micro loops and dangling and dense tails; the table's two kinds of segments count as sides."""
    s = materialize(metric_lines(spark, sf_dir).select("edge_id", "from_node_id", "to_node_id", "segment_type", "points"))
    return build.self_scan(s, sides=("SIDE_LINE", "SIDE_WALK"))[0].select("edge_id", "from_node_id", "to_node_id", "segment_type")


# ---- streams


@query("""select time_bucket(interval '1 day', ts) as "start", event_type, count(*) as n from events group by 1, 2""")
def stream_daily_counts(spark, sf_dir):
    s = flow.read_table(spark, f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    out = flow.drain_complete(flow.window_counts(s, "ts", "400 days", "1 day", None, "event_type"))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("select count(distinct event_id) as n_events from events")
def stream_deduplicated(spark, sf_dir):
    s = flow.read_table(spark, f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return flow.drain(flow.deduplicated(s.select("event_id", "ts"), "event_id", "ts", "400 days")).agg(F.count("*").alias("n_events"))


# ---- general analytics on the star schema


@query(
    """select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, round(sum(l_extendedprice), 2) as sum_base, round(sum(l_extendedprice*(1-l_discount)), 2) as sum_disc, count(*) as n from lineitem where l_shipdate <= timestamp '1998-09-02' group by 1, 2"""
)
def pricing_summary(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").where("l_shipdate <= timestamp '1998-09-02'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc"), F.count("*").alias("n"))


@query(
    """select n_name, o_orderstatus, count(distinct o_orderkey) as n_orders, round(sum(l_extendedprice*(1-l_discount)), 2) as revenue from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2"""
)
def revenue_by_nation(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    j = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name", "o_orderstatus").agg(F.count_distinct("o_orderkey").alias("n_orders"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))
