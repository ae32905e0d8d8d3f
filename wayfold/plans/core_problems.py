"""Queries of the problems that the core solves: 2 (quality profile), 4 (points near), 6 (rows that fail to parse)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.functions import text
from wayfold.operators import quality_profile, spatial
from wayfold.plans.runtime import materialize, table
from wayfold.sources.reject_csv import RAW_FORMATS, split_lines


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_profile.findings(table(spark, sf_dir, "road_segments"), table(spark, sf_dir, "road_loads"))


def p2_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile itself: null rates, distinct counts, ranges, masks and violations of each load and column."""
    return quality_profile.profile(table(spark, sf_dir, "road_segments"), quality_profile.ROAD_DOMAINS, "load_id")


def p2_rare_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell whose mask is rare in its load and column, with the mask's share."""
    return quality_profile.rare_masks(table(spark, sf_dir, "road_segments"), quality_profile.ROAD_DOMAINS, "edge_id", "load_id")


def p2_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every load against its prior load, by column: mask and value distances, blank shares, medians, flags."""
    return quality_profile.divergence(table(spark, sf_dir, "road_segments"), table(spark, sf_dir, "road_loads"), quality_profile.ROAD_DOMAINS, "load_id")


def located_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """place_id, lon, lat of places with a valid point; repeated rows once."""
    p = table(spark, sf_dir, "places").where("place_id is not null").select("place_id", text.point_lon_lat(F.col("point")).alias("p"))
    return p.where("p is not null").select("place_id", "p.lon", "p.lat").distinct()


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = materialize(located_places(spark, sf_dir))  # both joins read it
    lifts = table(spark, sf_dir, "subway_station_elevators_erd_ready").where("elevator_id is not null").select("elevator_id", text.point_lon_lat(F.col("point")).alias("p"))
    lifts = lifts.where("p is not null").select("elevator_id", "p.lon", "p.lat").distinct()
    near = spatial.within_distance(places, lifts, 50.0).select(F.lit("ELEVATOR").alias("relation"), "place_id", F.col("elevator_id").alias("other_id"))
    shapes = table(spark, sf_dir, "road_segment_filter_polygons").where("edge_id is not null").select("edge_id", "geom").distinct()
    shapes = shapes.select("edge_id", text.parse_multipolygon(F.col("geom")).alias("parts"))
    inside = spatial.in_regions(places, shapes).select(F.lit("POLYGON").alias("relation"), "place_id", F.col("edge_id").alias("other_id"))
    return near.unionByName(inside).distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    def bad(name: str, key: str, ok) -> DataFrame:
        rows = table(spark, sf_dir, name).where(F.col(key).isNotNull() & ~ok)
        return rows.select(F.lit(name).alias("record_source"), F.col(key).alias("record_id"), F.lit("INVALID_VALUE").alias("reason"))

    places = bad("places", "place_id", text.point_lon_lat(F.col("point")).isNotNull())
    removed = bad("facility_priority_manual_removed_applied", "removed_id", text.valid_lat_lng(F.col("lat"), F.col("lng")))
    lines = split_lines(table(spark, sf_dir, "raw_csv_lines").where("line_id is not null"), RAW_FORMATS).where("reason is not null")
    lines = lines.select(F.lit("raw_csv_lines").alias("record_source"), F.col("line_id").alias("record_id"), "reason")
    return places.unionByName(removed).unionByName(lines).distinct()


def p6_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the three sources that p6_found does not set apart, typed; columns that a target lacks are null.

    Only raw_csv_lines go through DuckDB's reader; places and removed facilities are tables already.
    place_id is decimal, as a line's id may be of any length; removed_at is null where its text is no
    time, and removed_at_text keeps the text.
    """
    def lines(target: str) -> DataFrame:
        ok = read.where((F.col("target_table") == target) & F.col("reason").isNull())
        at = {c: F.col("fields")[i] for i, c in enumerate(RAW_FORMATS[target].header)}
        return ok.select(F.lit("raw_csv_lines").alias("record_source"), F.col("line_id").alias("record_id"), "target_table", *[v.alias(c) for c, v in at.items()])

    def point(df: DataFrame) -> DataFrame:
        return df.withColumn("p_", text.point_lon_lat(F.col("point"))).withColumn("lon", F.col("p_.lon")).withColumn("lat", F.col("p_.lat")).drop("p_", "point")

    def degrees(df: DataFrame) -> DataFrame:
        return df.withColumn("lon", text.valid_number(F.col("lng"))).withColumn("lat", text.valid_number(F.col("lat"))).drop("lng").withColumn("removed_at", F.col("removed_at_text").try_cast("timestamp"))

    facilities = "facility_priority_manual_removed_applied"
    read = materialize(split_lines(table(spark, sf_dir, "raw_csv_lines").where("line_id is not null"), RAW_FORMATS))
    names = {"placeId": "place_id", "providerPlaceId": "provider_place_id", "sourceKey": "source_key", "dbCategory": "db_category", "publicFacilityName": "public_facility_name", "publicFacilityAddress": "public_facility_address", "districtGu": "district_gu", "removedAt": "removed_at_text"}
    place_lines = point(lines("places").withColumnsRenamed(names)).withColumn("place_id", F.trim("place_id").try_cast("decimal(38,0)"))
    facility_lines = degrees(lines(facilities).withColumnsRenamed(names))
    p = table(spark, sf_dir, "places").where(F.col("place_id").isNotNull() & text.point_lon_lat(F.col("point")).isNotNull())
    places = point(p.select(F.lit("places").alias("record_source"), F.col("place_id").alias("record_id"), F.lit("places").alias("target_table"), F.col("place_id").cast("decimal(38,0)").alias("place_id"), "name", "category", "address", "point", "provider_place_id"))
    r = table(spark, sf_dir, facilities).where(F.col("removed_id").isNotNull() & text.valid_lat_lng(F.col("lat"), F.col("lng")))
    removed = degrees(r.select(F.lit(facilities).alias("record_source"), F.col("removed_id").alias("record_id"), F.lit(facilities).alias("target_table"), "source_key", "name", "db_category", "public_facility_name", "public_facility_address", "district_gu", "address", "lat", "lng", F.col("removed_at").cast("string").alias("removed_at_text")))
    out = place_lines
    for df in (facility_lines, places, removed):
        out = out.unionByName(df, allowMissingColumns=True)
    return out.distinct()


QUERIES = {"p2_found": p2_found, "p2_profile": p2_profile, "p2_rare_masks": p2_rare_masks, "p2_divergence": p2_divergence, "p4_found": p4_found, "p6_found": p6_found, "p6_loaded": p6_loaded}

_NUM = r"[+-]?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?"
_DOM = {
    "slope_state": "slope_state in ('FLAT','MODERATE','STEEP','RISK','UNKNOWN')",
    "surface_state": "surface_state in ('PAVED','UNPAVED','UNKNOWN')",
    "avg_slope_percent": r"regexp_full_match(avg_slope_percent, '[0-9]+(\.[0-9]{1,2})?') and try_cast(avg_slope_percent as decimal(18,2)) between 0 and 100",
    "width_meter": r"regexp_full_match(width_meter, '[0-9]+(\.[0-9]{1,2})?') and try_cast(width_meter as decimal(18,2)) between 0 and 30",
}


def _p2_sql() -> str:
    cells = " union all ".join(f"select edge_id, load_id, '{c}' as column_name, {c} as v, (case when {c} is null or {c} = '' then false else {t} end) as ok from road_segments" for c, t in _DOM.items())
    return f"""
    with c as ({cells}),
    agg as (select load_id, column_name, count(*) n, count(*) filter (where v is null or v = '') b, count(*) filter (where ok) d,
              median(case when ok and column_name in ('avg_slope_percent','width_meter') then v::double end) md from c group by 1, 2),
    tops as (select load_id, column_name, max(k) top from (select load_id, column_name, v::decimal(18,2) num, count(*) k from c where ok and column_name in ('avg_slope_percent','width_meter') group by 1,2,3) group by 1,2),
    sv as (select load_id, column_name, v, count(*) k from c where ok and column_name in ('slope_state','surface_state') group by 1,2,3),
    pr as (select load_id, prior_load_id from road_loads where prior_load_id is not null),
    tv as (select x.load_id, x.column_name, sum(abs(coalesce(s1.k,0)::double/a.d - coalesce(s0.k,0)::double/b.d))/2 dist
           from (select distinct pr.load_id, pr.prior_load_id, sv.column_name, sv.v from pr join sv on sv.load_id in (pr.load_id, pr.prior_load_id)) x
           join agg a on a.load_id=x.load_id and a.column_name=x.column_name and a.d>0 join agg b on b.load_id=x.prior_load_id and b.column_name=x.column_name and b.d>0
           left join sv s1 on s1.load_id=x.load_id and s1.column_name=x.column_name and s1.v=x.v
           left join sv s0 on s0.load_id=x.prior_load_id and s0.column_name=x.column_name and s0.v=x.v group by 1,2)
    select distinct 'VALUE' as finding_kind, column_name, edge_id as record_id from c where v is not null and v <> '' and not ok
    union all
    select distinct 'LOAD', a.column_name, a.load_id from pr join agg a on a.load_id=pr.load_id join agg b on b.load_id=pr.prior_load_id and b.column_name=a.column_name
      left join tops t1 on t1.load_id=a.load_id and t1.column_name=a.column_name left join tops t0 on t0.load_id=b.load_id and t0.column_name=b.column_name
      left join tv on tv.load_id=a.load_id and tv.column_name=a.column_name
    where abs(a.b::double/a.n - b.b::double/b.n) >= 0.1 or tv.dist >= 0.2
       or (greatest(a.md,b.md) > least(a.md,b.md) and greatest(a.md,b.md) >= 1.5*least(a.md,b.md)) or abs(t1.top::double/a.d - t0.top::double/b.d) >= 0.2
    """


ORACLES = {
    "p2_found": _p2_sql(),
    "p6_found": rf"""
    select distinct 'places' as record_source, place_id as record_id, 'INVALID_VALUE' as reason from places
    where not coalesce(regexp_full_match(point, '(?i)\s*(srid\s*=\s*4326\s*;)?\s*point\s*\(\s*{_NUM}\s+{_NUM}\s*\)\s*')
      and try_cast(regexp_extract(point, '(?i)\(\s*({_NUM})\s', 1) as double) between 124 and 132 and try_cast(regexp_extract(point, '(?i)\s({_NUM})\s*\)', 1) as double) between 33 and 39, false)
    union all
    select distinct 'facility_priority_manual_removed_applied', removed_id, 'INVALID_VALUE' from facility_priority_manual_removed_applied
    where not coalesce(regexp_full_match(lat, '\s*{_NUM}\s*') and regexp_full_match(lng, '\s*{_NUM}\s*') and try_cast(trim(lat) as double) between 33 and 39 and try_cast(trim(lng) as double) between 124 and 132, false)
    union all
    select distinct 'raw_csv_lines', line_id, reason from (
      select line_id, case when not regexp_full_match(t, '("([^"]|"")*"|[^",][^",]*|)(,("([^"]|"")*"|[^",][^",]*|))*') then 'QUOTING'
        when len(f) <> case when target_table = 'places' then 6 else 11 end then 'COLUMN_COUNT'
        when target_table = 'places' and not (regexp_full_match(f[1], '\s*[+]?[0-9]+\s*') and regexp_matches(f[1], '[1-9]')
             and regexp_full_match(f[5], '(?i)\s*(srid\s*=\s*4326\s*;)?\s*point\s*\(\s*{_NUM}\s+{_NUM}\s*\)\s*')
             and try_cast(regexp_extract(f[5], '\(\s*({_NUM})\s', 1) as double) between 124 and 132 and try_cast(regexp_extract(f[5], '\s({_NUM})\s*\)', 1) as double) between 33 and 39) then 'INVALID_VALUE'
        when target_table <> 'places' and not coalesce(regexp_full_match(f[8], '\s*{_NUM}\s*') and regexp_full_match(f[9], '\s*{_NUM}\s*')
             and try_cast(trim(f[8]) as double) between 33 and 39 and try_cast(trim(f[9]) as double) between 124 and 132, false) then 'INVALID_VALUE' end as reason
      from (select line_id, target_table, t, list_transform(string_split(regexp_replace(regexp_replace(t, '("([^"]|"")*")|,', chr(1) || '\1', 'g'), chr(1) || '"', '"', 'g'), chr(1)), lambda x: trim(x, '"')) f
            from (select line_id, target_table, regexp_replace(coalesce(line_text, ''), '\r$', '') t from raw_csv_lines))) where reason is not null
    """,
}
