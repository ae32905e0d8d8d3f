"""Queries that bring places, facilities, elevators and documents together, and check loads; with SQL where SQL can say them."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfold.functions import geo, text
from wayfold.operators import fuse, places, transfer
from wayfold.plans.core_problems import located_places
from wayfold.plans.graph_queries import _shapes
from wayfold.plans.reference import _NEAR, _NUMBER_PAIR, _POINTS, _TM, HAV, SEG, _lifts
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


# p4_found again, by ray crossing over all vertices
ORACLES["p4_found"] = rf"""
with pl as (select distinct place_id, x, y from {_TM.format(src=_POINTS('places', 'place_id'))}),
 sh as (select edge_id, regexp_extract(g, '(?i)^MULTIPOLYGON\(\(\((.*)\)\)\)$', 1) body from (select edge_id, regexp_replace(regexp_replace(geom, '\s+', ' ', 'g'), ' ?([(),]) ?', '\1', 'g') g from (select distinct edge_id, geom from road_segment_filter_polygons where geom is not null and edge_id is not null))),
 pt as (select edge_id, body, generate_subscripts(p, 1) part, unnest(p) t from (select edge_id, body, string_split(body, ')),((') p from sh where body <> '')),
 rg as (select edge_id, body, part, generate_subscripts(r, 1) ring, unnest(r) t from (select edge_id, body, part, string_split(t, '),(') r from pt)),
 vx as (select edge_id, body, part, ring, generate_subscripts(v, 1) i, unnest(v) t from (select edge_id, body, part, ring, string_split(t, ',') v from rg)),
 xy as (select *, string_split(t, ' ')[1]::double x, string_split(t, ' ')[2]::double y from vx),
 s2 as (select a.edge_id, a.body, a.part, a.ring, a.x, a.y, coalesce(b.x, f.x) x2, coalesce(b.y, f.y) y2 from xy a left join xy b on b.edge_id = a.edge_id and b.body = a.body and b.part = a.part and b.ring = a.ring and b.i = a.i + 1 join xy f on f.edge_id = a.edge_id and f.body = a.body and f.part = a.part and f.ring = a.ring and f.i = 1),
 bx as (select edge_id, body, part, min(x) x0, max(x) x1, min(y) y0, max(y) y1 from xy where ring = 1 group by 1, 2, 3),
 cd as (select place_id, bx.edge_id, bx.body, bx.part, pl.x px, pl.y py from pl join bx on pl.x between x0 and x1 and pl.y between y0 and y1),
 cr as (select place_id, c.edge_id, c.body, c.part, ring, count(*) filter (where (y > py) <> (y2 > py) and px < (x2 - x) * (py - y) / nullif(y2 - y, 0) + x) % 2 odd from cd c join s2 on s2.edge_id = c.edge_id and s2.body = c.body and s2.part = c.part group by 1, 2, 3, 4, 5)
select 'ELEVATOR' as relation, place_id, elevator_id as other_id from {_NEAR} where d <= 50
union all select distinct 'POLYGON', place_id, edge_id from (select place_id, edge_id, body, part from cr group by 1, 2, 3, 4 having bool_or(ring = 1 and odd = 1) and not bool_or(ring > 1 and odd = 1))"""
ORACLES["polygon_measures"] = (
    ORACLES["p4_found"].split(" bx as (")[0].rstrip().rstrip(",")
    + """, ar as (select edge_id, body, part, sum(x * y2 - x2 * y) / 2 a, sum((x + x2 - 2 * ox) * ((x - ox) * (y2 - oy) - (x2 - ox) * (y - oy))) cx, sum((y + y2 - 2 * oy) * ((x - ox) * (y2 - oy) - (x2 - ox) * (y - oy))) cy, sum((x - ox) * (y2 - oy) - (x2 - ox) * (y - oy)) / 2 a0, any_value(ox) ox, any_value(oy) oy
     from (select s2.*, f.x ox, f.y oy from s2 join xy f on f.edge_id = s2.edge_id and f.body = s2.body and f.part = s2.part and f.ring = 1 and f.i = 1 where s2.ring = 1) group by 1, 2, 3)
    select edge_id, round(sum(abs(a0)), 3) as area, round(sum(abs(a0) * (cx / (6 * a0) + ox)) / sum(abs(a0)), 4) as x, round(sum(abs(a0) * (cy / (6 * a0) + oy)) / sum(abs(a0)), 4) as y from ar group by 1"""
)

# edge_chains: edges that share a node of degree two, joined until nothing changes
ORACLES["edge_chains"] = f"""
with recursive {SEG}, dg as (select v from (select from_node_id v from seg where from_node_id is not null union all select to_node_id from seg where to_node_id is not null) group by v having count(*) = 2),
 en as (select edge_id, unnest([from_node_id, to_node_id]) v from seg where from_node_id <> to_node_id), lk as (select min(edge_id) a, max(edge_id) b from en join dg using (v) group by v having min(edge_id) <> max(edge_id)),
 nb as (select a x, b y from lk union select b, a from lk), cc(v, g) using key (v) as (select distinct x, x from nb union (select nb.y, min(cc.g) from cc join nb on nb.x = cc.v join recurring.cc r on r.v = nb.y where cc.g < r.g group by nb.y))
select coalesce(g, edge_id) as chain, count(*) as n_edges, round(sum(length), 2) as metres from seg left join cc on cc.v = seg.edge_id group by 1"""

FACILITIES = "facility_priority_manual_removed_applied"


def _first_places(spark, sf_dir):
    p = fuse.first_per_key(table(spark, sf_dir, "places").where("place_id is not null"), ["place_id"], "ingested_at", "name")
    return p.withColumn("p", text.point_lon_lat(F.col("point"))).select("place_id", "name", "category", "address", "p.lon", "p.lat")


def _first_facilities(spark, sf_dir):
    r = fuse.first_per_key(table(spark, sf_dir, FACILITIES).where("removed_id is not null"), ["removed_id"], "ingested_at", "name")
    ok = text.valid_lat_lng(F.col("lat"), F.col("lng"))
    number = lambda c: F.when(ok, text.valid_number(F.col(c)))
    return r.select(F.col("removed_id").alias("source_id"), "name", "address", F.col("db_category").alias("category"), number("lng").alias("lon"), number("lat").alias("lat"))


_P = f"""pl as (select place_id, name, category, address, case when ok then {_NUMBER_PAIR[0]} end lon, case when ok then {_NUMBER_PAIR[1]} end lat from (select *, coalesce(point in (select point from places where {_NUMBER_PAIR[2]}), false) ok from (select *, row_number() over (partition by place_id order by ingested_at, name nulls first) k from places where place_id is not null) where k = 1)),
 nums as (select *, coalesce(regexp_full_match(lat, '\\s*[+-]?[0-9]+(\\.[0-9]+)?([eE][+-]?[0-9]+)?\\s*') and regexp_full_match(lng, '\\s*[+-]?[0-9]+(\\.[0-9]+)?([eE][+-]?[0-9]+)?\\s*') and try_cast(trim(lat) as double) between 33 and 39 and try_cast(trim(lng) as double) between 124 and 132, false) ok
   from (select *, row_number() over (partition by removed_id order by ingested_at, name nulls first) k from {FACILITIES} where removed_id is not null) where k = 1),
 src as (select removed_id source_id, name, address, db_category category, case when ok then try_cast(trim(lng) as double) end lon, case when ok then try_cast(trim(lat) as double) end lat from nums),
 ft as (select distinct place_id from pl where category in ('TOILET', 'WELFARE')),
 b as (select a.source_id, b.place_id, case when a.name = b.name then 1 else 2 end tier, b.place_id in (select place_id from ft) has, case when a.lon is not null and b.lon is not null then {HAV} end d from src a join pl b on a.address = b.address),
 t as (select * from b qualify tier = min(tier) over (partition by source_id)),
 n as (select a.source_id, b.place_id, 3 tier, b.place_id in (select place_id from ft) has, {HAV} d from src a join pl b on a.lon is not null and b.lon is not null and abs(a.lat - b.lat) < 0.001 and abs(a.lon - b.lon) < 0.001
   and array_to_string(string_split_regex(trim(regexp_replace(a.address, '[\\s\\x{{3000}}\\x{{00A0}}]+', ' ', 'g')), ' ')[1:2], ' ') = array_to_string(string_split_regex(trim(regexp_replace(b.address, '[\\s\\x{{3000}}\\x{{00A0}}]+', ' ', 'g')), ' ')[1:2], ' ') where a.source_id not in (select source_id from b)),
 u as (select * from t union all select * from n where d <= 20),
 one as (select *, count(*) over (partition by source_id) c, row_number() over (partition by source_id order by has desc, d is null, d, place_id) k from u)"""


@query(
    f"""with {_P} select src.source_id as removed_id, one.place_id, coalesce(case tier when 1 then 'exact_name_address' || case when c > 1 then '_multi' else '' end when 2 then 'exact_address' || case when c > 1 then '_multi' else '' end when 3 then 'nearest' end, 'unmatched') as status, coalesce(has, false) as has_features, round(d, 3) as distance_m
    from src left join one on one.source_id = src.source_id and k = 1"""
)
def place_matches(spark, sf_dir):
    """Every removed facility with one place by tiers of name, address and distance; toilets and welfare places count as having features."""
    p = materialize(_first_places(spark, sf_dir))
    m = places.match_places(_first_facilities(spark, sf_dir), p, p.where("category in ('TOILET', 'WELFARE')").select("place_id"))
    return m.select(F.col("source_id").alias("removed_id"), "place_id", "status", "has_features", F.round("distance_m", 3).alias("distance_m"))


_DEFAULTS = {"TOILET": ("accessibleEntrance", "accessibleToilet"), "RESTAURANT": ("accessibleEntrance", "stepFree"), "ACCOMMODATION": ("accessibleEntrance", "accessibleParking", "elevator"), "HEALTHCARE": ("accessibleEntrance", "elevator", "ramp")}
_ORDER = ("accessibleEntrance", "ramp", "stepFree", "accessibleParking", "accessibleToilet", "elevator")


@query(
    f"""with {_P}, m as (select one.place_id, src.category from src join one on one.source_id = src.source_id and k = 1), own as (select place_id, 'accessibleToilet' f from pl where category = 'TOILET' union all select place_id, 'ramp' from pl where category = 'WELFARE'),
    dv as (select * from (values ('TOILET', ['accessibleEntrance','accessibleToilet']), ('RESTAURANT', ['accessibleEntrance','stepFree']), ('ACCOMMODATION', ['accessibleEntrance','accessibleParking','elevator']), ('HEALTHCARE', ['accessibleEntrance','elevator','ramp'])) v(category, fs)),
    r as (select distinct place_id, f from own where place_id in (select place_id from m) union select distinct m.place_id, unnest(fs) from m join dv using (category) where m.place_id not in (select place_id from own))
    select row_number() over (order by place_id, list_position(['accessibleEntrance','ramp','stepFree','accessibleParking','accessibleToilet','elevator'], f), f) as id, place_id, f as feature from r"""
)
def accessibility_rows(spark, sf_dir):
    """Feature rows of matched places: a place's own features, else the defaults of its facilities' categories."""
    p = materialize(_first_places(spark, sf_dir))
    own = p.where("category = 'TOILET'").select("place_id", F.lit("accessibleToilet").alias("feature")).unionByName(p.where("category = 'WELFARE'").select("place_id", F.lit("ramp").alias("feature")))
    s = materialize(_first_facilities(spark, sf_dir))
    m = places.match_places(s, p, own.select("place_id")).join(s.select("source_id", "category"), "source_id")
    return places.feature_rows(m, own, _DEFAULTS, _ORDER)


@query()
def scored_places(spark, sf_dir):
    """The best place within 300 m of every removed facility by points for distance, name, address and category."""
    f = _first_facilities(spark, sf_dir).withColumnRenamed("source_id", "facility_id")
    p = _first_places(spark, sf_dir).withColumnRenamed("place_id", "poi_id")
    same = F.when(F.col("category_f") == F.col("category_p"), 15).otherwise(0)
    out = places.scored_candidates(f, p, same, F.col("name_f").isin("공중화장실", "개방화장실", "일반음식점", "휴게음식점", "충전소"))
    return out.select("facility_id", "poi_id", "score", F.round("distance_m", 3).alias("distance_m"), F.round("name_similarity", 4).alias("name_similarity"), "status")


@query()
def places_of_one_spot(spark, sf_dir):
    """Facilities and places with equal coordinates to three digits (a hundred metres), the most alike place of each."""
    f = _first_facilities(spark, sf_dir).select(F.col("source_id").alias("id"), "name", "address", "lon", "lat").where("lon is not null")
    p = _first_places(spark, sf_dir).select(F.col("place_id").alias("id"), "name", "address", "lon", "lat").where("lon is not null")
    return places.same_spot(f, p, digits=3).select("left_id", "right_id", F.round("score", 4).alias("score"))


_LOAD_TABLES = ("places", "road_nodes", "road_segments", "road_loads", "subway_station_elevators_erd_ready", "documents")


@query(
    " union all ".join(f"select 'rows:{t}' as check_name, count(*) as n from {t}" for t in _LOAD_TABLES)
    + "".join(f" union all select 'repeated:{t}.{k}', (select coalesce(sum(c - 1), 0)::bigint from (select count(*) c from {t} where {k} is not null group by {k})) union all select 'null:{t}.{k}', count(*) from {t} where {k} is null" for t, k in (("places", "place_id"), ("road_nodes", "vertex_id"), ("road_loads", "load_id"), ("documents", "doc_id")))
    + "".join(f" union all select 'orphan:{t}.{c}', count(*) from {t} where {c} is not null and {c} not in (select {k} from {o} where {k} is not null)" for t, c, o, k in (("road_segments", "from_node_id", "road_nodes", "vertex_id"), ("road_segments", "load_id", "road_loads", "load_id"), ("documents", "subject_place_id", "places", "place_id"), ("road_loads", "prior_load_id", "road_loads", "load_id")))
)
def load_report(spark, sf_dir):
    """Rows, repeated and null keys and orphans of the loaded tables."""
    return places.load_checks(
        {t: table(spark, sf_dir, t) for t in _LOAD_TABLES},
        {"places": "place_id", "road_nodes": "vertex_id", "road_loads": "load_id", "documents": "doc_id"},
        [("road_segments", "from_node_id", "road_nodes", "vertex_id"), ("road_segments", "load_id", "road_loads", "load_id"), ("documents", "subject_place_id", "places", "place_id"), ("road_loads", "prior_load_id", "road_loads", "load_id")],
    )


@query(
    f"""with recursive e as (select elevator_id, station_id, lon, lat from (select elevator_id, min(station_id) station_id, min(lon) lon, arg_min(lat, lon) lat from (select p.*, s.station_id from {_POINTS('subway_station_elevators_erd_ready', 'elevator_id')} p join subway_station_elevators_erd_ready s using (elevator_id)) group by 1)),
    l as (select a.elevator_id x, b.elevator_id y from e a join e b on a.station_id = b.station_id and a.elevator_id <> b.elevator_id and {HAV} <= 60),
    r(x, g) as (select elevator_id, elevator_id from e union select l.y, r.g from r join l on l.x = r.x where r.g < l.y), c as (select x, min(g) g from r group by x), n as (select g, row_number() over (order by g) k, count(*) s from c group by g)
    select x as elevator_id, 'ELV-' || lpad(k::varchar, 4, '0') as cluster_id, s as cluster_size from c join n using (g)"""
)
def elevator_clusters(spark, sf_dir):
    """Elevators of one station that lie within 60 m of each other in a row."""
    e = table(spark, sf_dir, "subway_station_elevators_erd_ready").select("elevator_id", "station_id", text.point_lon_lat(F.col("point")).alias("p")).where("p is not null")
    e = e.groupBy("elevator_id").agg(F.min("station_id").alias("station_id"), F.min("p").alias("p")).withColumn("m", geo.to_metres(F.col("p.lon"), F.col("p.lat"))).select("elevator_id", "station_id", "m.x", "m.y")
    return places.clusters_within(materialize(e), "elevator_id", "station_id", 60.0, "ELV")


@query(
    f"""select p.place_id, n.elevator_id as lift_id, round(n.d, 3) as lift_m, n.elevator_id is not null as has_lift from {_POINTS('places', 'place_id')} p left join (select place_id, elevator_id, d from (select *, row_number() over (partition by place_id order by d, elevator_id) k from {_NEAR} where d <= 50) where k = 1) n using (place_id)"""
)
def place_proximity(spark, sf_dir):
    """Every place with its nearest elevator within 50 m and a flag."""
    out = places.proximity(located_places(spark, sf_dir), {"lift": (_lifts(spark, sf_dir), "elevator_id", 50.0)}, "place_id")
    return out.select("place_id", "lift_id", F.round("lift_m", 3).alias("lift_m"), "has_lift")


@query()
def places_by_road_area(spark, sf_dir):
    """The filter polygon that contains each place, or else the one with a vertex within 30 m."""
    return places.assigned_region(located_places(spark, sf_dir), _shapes(spark, sf_dir), "place_id", "shape_id", 30.0)


@query("select l_suppkey, bool_or(l_returnflag = 'R') as any_flag, count(*) as n_vehicles, count(*) filter (where l_returnflag = 'R') as n_flag from lineitem group by 1")
def supplier_flags(spark, sf_dir):
    """Whether a supplier has any returned line, and how many."""
    return transfer.route_flags(table(spark, sf_dir, "lineitem"), "l_suppkey", F.col("l_returnflag") == "R")


@query(
    """with v as (select l_orderkey k, case when l_returnflag = 'R' then 'CONFIRMED' when l_linestatus = 'O' then 'UNCLEAR' else 'NO_VIEW' end v, case when l_quantity > 25 then 'HIGH' else 'LOW' end c from lineitem),
    f as (select k, case when bool_or(v = 'CONFIRMED') then 'CONFIRMED' when bool_or(v = 'UNCLEAR') then 'UNCLEAR' when bool_and(v = 'NO_VIEW') then 'NO_VIEW' else 'NONE' end w from v group by k)
    select k as l_orderkey, w as verdict, case when bool_or(v.v = w and c = 'HIGH') then 'HIGH' else 'LOW' end as confidence from v join f using (k) group by 1, 2"""
)
def order_verdicts(spark, sf_dir):
    """One verdict an order from the votes of its lines."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_returnflag") == "R", "CONFIRMED").when(F.col("l_linestatus") == "O", "UNCLEAR").otherwise("NO_VIEW").alias("verdict"), F.when(F.col("l_quantity") > 25, "HIGH").otherwise("LOW").alias("confidence"))
    return transfer.folded_verdict(li, "l_orderkey", "verdict", "confidence")


@query("select removed_id, i as ordinal, f[i] as flag from (select removed_id, f, unnest(generate_series(1, len(f))) i from (select removed_id, any_value(list_filter(string_split(coalesce(review_flags, ''), '|'), lambda x: x <> '')) f from facility_priority_manual_removed_applied group by 1))")
def flag_rows(spark, sf_dir):
    """One row a flag of each removed facility, with its place in the list."""
    r = table(spark, sf_dir, FACILITIES).select("removed_id", "review_flags").distinct()
    return transfer.child_rows(r, "removed_id", F.filter(F.split(F.coalesce("review_flags", F.lit("")), r"\|"), lambda x: x != ""), "flag")


@query("select removed_id, review_priority, name from (select removed_id, any_value(review_priority) review_priority, any_value(name) as name from facility_priority_manual_removed_applied group by 1) order by coalesce(list_position(['F1', 'F2', 'F3'], review_priority), 4), removed_id limit 25")
def review_queue_head(spark, sf_dir):
    """The first 25 facilities to review, a top-k report, by priority and id."""
    r = table(spark, sf_dir, FACILITIES).select("removed_id", "review_priority", "name").distinct()
    return transfer.ranked_head(r, 25, {"review_priority": ("F1", "F2", "F3")}, F.asc("removed_id"))


@query("select o_orderkey, o_orderstatus from orders where o_orderkey not in (select l_orderkey from lineitem where l_orderkey is not null)")
def orders_without_lines(spark, sf_dir):
    """A left anti join with rows on both sides of it."""
    o = table(spark, sf_dir, "orders")
    return o.join(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct(), "o_orderkey", "left_anti").select("o_orderkey", "o_orderstatus")
