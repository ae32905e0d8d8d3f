"""Bringing place records of several sources together: tiered matches, scored candidates, feature rows, load checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.functions import arrow, geo, text
from wayfold.operators import fuse, graph, repair, spatial
from wayfold.plans.runtime import materialize, once


def match_places(sources: DataFrame, places: DataFrame, featured: DataFrame, metres: float = 20.0) -> DataFrame:
    """source_id, place_id, status, has_features, distance_m: each source with one place, or none.

    Tiers, the first that has a place: same name and address, same address, same first two words of
    the address within metres. Within a tier places with features (featured: place_id) come first,
    then near ones, then those without a distance, then the lower id. Null names and addresses match
    nothing.
    sources and places: id, name, address, lon, lat (null if unknown).
    """
    s = sources.select("source_id", "name", "address", F.col("lon").alias("slon"), F.col("lat").alias("slat"))
    p = places.select("place_id", F.col("name").alias("pname"), F.col("address").alias("paddress"), F.col("lon").alias("plon"), F.col("lat").alias("plat"))
    p = p.join(featured.select("place_id").distinct().withColumn("has", F.lit(True)), "place_id", "left").withColumn("has", F.coalesce("has", F.lit(False)))
    p = materialize(p)
    far = geo.haversine(F.col("slon"), F.col("slat"), F.col("plon"), F.col("plat"))
    both = s.join(p, F.col("address") == F.col("paddress"))
    tiers = both.select("source_id", "place_id", "has", far.alias("distance_m"), F.when(F.col("name") == F.col("pname"), 1).otherwise(2).alias("tier"))
    # the third tier only for those that the first two left
    left = s.join(tiers.select("source_id").distinct(), "source_id", "left_anti").where("slon is not null and slat is not null")
    near = spatial.within_distance(p.select("place_id", "has", "paddress", F.col("plon").alias("lon"), F.col("plat").alias("lat")), left.select("source_id", "address", F.col("slon").alias("lon"), F.col("slat").alias("lat")), metres)
    near = near.where(text.address_prefix(F.col("address")) == text.address_prefix(F.col("paddress"))).select("source_id", "place_id", "has", "distance_m", F.lit(3).alias("tier"))
    # a name match stands in the address tier too, unless the name decides
    counted = tiers.groupBy("source_id").agg(F.min("tier").alias("tier"))
    mine = tiers.join(counted, ["source_id", "tier"]).unionByName(near)
    one = mine.groupBy("source_id", "tier").agg(F.count("*").alias("n"), F.min(F.struct((~F.col("has")).alias("bare"), F.col("distance_m").isNull().alias("nowhere"), "distance_m", "place_id")).alias("m"))
    many = F.when(F.col("n") > 1, "_multi").otherwise("")
    status = F.when(F.col("tier") == 1, F.concat(F.lit("exact_name_address"), many)).when(F.col("tier") == 2, F.concat(F.lit("exact_address"), many)).otherwise(F.lit("nearest"))
    found = one.select("source_id", "m.place_id", status.alias("status"), (~F.col("m.bare")).alias("has_features"), "m.distance_m")
    out = sources.select("source_id").join(found, "source_id", "left")
    return out.withColumn("status", F.coalesce("status", F.lit("unmatched"))).withColumn("has_features", F.coalesce("has_features", F.lit(False)))


def feature_rows(matched: DataFrame, features: DataFrame, defaults: Mapping[str, Sequence[str]], order: Sequence[str]) -> DataFrame:
    """id, place_id, feature: of each matched place its own features, or else the defaults of its sources' categories; ids follow place and the order of features.

    matched: source_id, place_id, category; features: place_id, feature. Features outside the order come last, by name.
    """
    places = matched.where("place_id is not null").select("place_id", "category").distinct()
    own = features.select("place_id", "feature").distinct().join(places.select("place_id").distinct(), "place_id", "left_semi")
    rest = places.join(own.select("place_id").distinct(), "place_id", "left_anti")
    table = F.create_map(*[x for k, v in defaults.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    given = rest.select("place_id", F.explode(F.try_element_at(table, F.col("category"))).alias("feature")).distinct()
    at = F.array_position(F.array(*map(F.lit, order)), F.col("feature"))
    rows = own.unionByName(given).withColumn("at_", F.when(at > 0, at).otherwise(len(order) + 1))
    return fuse.renumber(rows, "id", "place_id", "at_", "feature").select("id", "place_id", "feature")


def match_report(matched: DataFrame) -> DataFrame:
    """status, n, n_places, n_with_features."""
    return matched.groupBy("status").agg(F.count("*").alias("n"), F.count_distinct("place_id").alias("n_places"), F.count_if("has_features").alias("n_with_features"))


#: fixed values: points by distance in metres, for a shared address token, and for one address within the other
DISTANCE_POINTS = ((30.0, 45), (50.0, 38), (100.0, 28), (200.0, 15), (300.0, 5))
TOKEN_POINTS, CONTAINED_POINTS, NAME_POINTS = 25, 18, 35
#: pairs within so many metres give each facility's first score to beat; discs are covered by squares as wide as this part of them
FIRST_M, DISC_SPLIT = 50.0, 4


def scored_candidates(facilities: DataFrame, pois: DataFrame, category_points: Column | None = None, generic: Column | None = None, metres: float = 300.0) -> DataFrame:
    """facility_id, poi_id, score, distance_m, name_similarity, status: the best candidate of each facility, by score, distance, likeness and id.

    Both sides: id, name, address, lon, lat; category_points may use their columns, ending in _f and
    _p. The score adds points for distance, likeness of normalised names (none if generic),
    addresses and category. Near pairs first give each facility a score that it has at least; names
    are compared only of pairs that could still reach it by the letters that they share.
    """
    def side(df: DataFrame, key: str, mark: str) -> DataFrame:
        own = df.select([F.col(c).alias(f"{c}_{mark}") if c not in (key, "lon", "lat") else F.col(c) for c in df.columns])
        name, address = F.col(f"name_{mark}"), F.col(f"address_{mark}")
        own = own.withColumns({f"n{mark}": text.normalize_name(name), f"plain_{mark}_": text.normalize_plain(address), f"tokens_{mark}_": text.address_tokens(address)})
        own = once(own, **{f"called_{mark}_": F.col(f"n{mark}")})
        return materialize(own.withColumns({f"length_{mark}_": F.length(f"called_{mark}_"), f"mask_{mark}_": text.letter_mask(F.col(f"called_{mark}_"))}).drop(f"called_{mark}_"))

    f, p = side(facilities, "facility_id", "f"), side(pois, "poi_id", "p")
    named = ~F.coalesce(generic if generic is not None else F.lit(False), F.lit(False))
    by_distance = F.lit(0)
    for bound, v in reversed(DISTANCE_POINTS):
        by_distance = F.when(F.col("distance_m") <= bound, v).otherwise(by_distance)
    a, b = F.col("plain_f_"), F.col("plain_p_")
    token = F.arrays_overlap(F.col("tokens_f_"), F.col("tokens_p_"))
    inside = (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))
    address = F.when(token, TOKEN_POINTS).when(inside, CONTAINED_POINTS).otherwise(0)
    of_kind = category_points if category_points is not None else F.lit(0)
    name_points = lambda ratio: F.floor(ratio * NAME_POINTS).cast("int")

    first = spatial.within_distance(p, f, min(FIRST_M, metres), DISC_SPLIT)
    sure = by_distance + address + of_kind + F.when(named & (F.col("nf") == F.col("np")), NAME_POINTS).otherwise(0)
    f = materialize(f.join(first.groupBy("facility_id").agg(F.max(sure).alias("least_")), "facility_id", "left"))

    most = F.when(named, F.coalesce(name_points(text.blocks_ratio_bound(F.col("length_f_"), F.col("mask_f_"), F.col("length_p_"), F.col("mask_p_"))), F.lit(0))).otherwise(0)
    could = lambda points: F.col("least_").isNull() | (by_distance + points + of_kind + most >= F.col("least_"))
    # a null of the caller's points makes a null score, which comes first
    some = spatial.within_distance(p, f, metres, DISC_SPLIT).where(of_kind.isNull() | (could(F.lit(max(TOKEN_POINTS, CONTAINED_POINTS))) & could(address)))
    j = some.select("facility_id", "poi_id", "distance_m", address.alias("address_points"), (by_distance + of_kind).alias("sum_"), named.alias("named_"), "nf", "np")
    j = j.withColumn("ratio_", arrow.longest_blocks_ratio("nf", "np")).withColumn("name_similarity", F.when(F.col("named_"), F.coalesce("ratio_", F.lit(0.0))).otherwise(0.0))
    j = j.withColumn("score", F.col("sum_") + name_points(F.col("name_similarity")) + F.col("address_points"))
    best = j.groupBy("facility_id").agg(F.min(F.struct((-F.col("score")).alias("less"), "distance_m", (-F.col("name_similarity")).alias("unlike"), "poi_id", "address_points")).alias("m"))
    out = best.select("facility_id", "m.poi_id", (-F.col("m.less")).alias("score"), "m.distance_m", (-F.col("m.unlike")).alias("name_similarity"), "m.address_points")
    status = F.when((F.col("score") >= 75) & (F.col("distance_m") <= 80), "STRONG").when((F.col("score") >= 55) & (F.col("distance_m") <= 150), "MEDIUM").when(F.col("score") >= 38, "WEAK").when((F.col("address_points") > 0) | (F.col("name_similarity") >= 0.55), "REVIEW").otherwise("NEARBY")
    return out.withColumn("status", status).drop("address_points")


def same_spot(left: DataFrame, right: DataFrame, digits: int = 7, name_weight: float = 0.55) -> DataFrame:
    """left_id, right_id, score: of the right rows with equal rounded coordinates the one most alike in name and address; ties to the lower id. Both: id, name, address, lon, lat."""
    key = lambda: text.coordinate_key(F.col("lon"), F.col("lat"), digits)
    a = left.select(F.col("id").alias("left_id"), F.col("name").alias("na"), F.col("address").alias("aa"), key().alias("key"))
    b = right.select(F.col("id").alias("right_id"), F.col("name").alias("nb"), F.col("address").alias("ab"), key().alias("key"))
    j = a.where("key is not null").join(b, "key")
    score = name_weight * F.coalesce(arrow.longest_blocks_ratio("na", "nb"), F.lit(0.0)) + (1 - name_weight) * F.coalesce(arrow.longest_blocks_ratio("aa", "ab"), F.lit(0.0))
    best = j.withColumn("score", score).groupBy("left_id").agg(F.min(F.struct((-F.col("score")).alias("less"), "right_id")).alias("m"))
    return best.select("left_id", "m.right_id", (-F.col("m.less")).alias("score"))


def first_good_answers(answers: DataFrame, key: str, ordinal: str, score: str, distance: str, enough: float = 80.0, near: float = 80.0) -> DataFrame:
    """The best answer of each key among its queries up to the first, by ordinal, that has a good one; queries after it count as not asked."""
    good = answers.where((F.col(score) >= enough) & (F.col(distance) <= near)).groupBy(key).agg(F.min(ordinal).alias("stop_"))
    asked = answers.join(good, key, "left").where(F.col("stop_").isNull() | (F.col(ordinal) <= F.col("stop_"))).drop("stop_")
    return fuse.first_per_key(asked, [key], -F.col(score), F.col(distance), F.col(ordinal))


def clusters_within(points: DataFrame, key: str, group: str, metres: float, prefix: str) -> DataFrame:
    """key, cluster_id, cluster_size: points (x, y) of one group linked within metres; numbered by their least key. Points without group are clusters of their own."""
    pairs = repair.near_pairs(points, key, metres)
    of = lambda e: points.select(F.col(key).alias(f"{key}_{e}"), F.col(group).alias(f"g{e}"))
    inside = pairs.join(of("a"), f"{key}_a").join(of("b"), f"{key}_b").where("ga = gb")
    label = graph.components(inside, f"{key}_a", f"{key}_b").withColumnRenamed("vertex_id", key)
    each = materialize(points.select(key).join(label, key, "left").select(key, F.coalesce("component", key).alias("lead")))
    sizes = each.groupBy("lead").agg(F.count("*").alias("cluster_size"))
    numbers = fuse.renumber(sizes, "n_", "lead").select("lead", "cluster_size", F.format_string(f"{prefix}-%04d", "n_").alias("cluster_id"))
    return each.join(numbers, "lead").select(key, "cluster_id", "cluster_size")


def proximity(points: DataFrame, layers: Mapping[str, tuple[DataFrame, str, float]], key: str) -> DataFrame:
    """key and, for each layer (points of lon, lat; id column; metres), the nearest one's id, its distance and whether there is one."""
    out = points.select(key).distinct()
    for name, (layer, id_col, metres) in layers.items():
        pairs = spatial.within_distance(points.select(key, "lon", "lat"), layer.select(F.col(id_col).alias("other_"), "lon", "lat"), metres)
        best = pairs.groupBy(key).agg(F.min(F.struct("distance_m", "other_")).alias("m")).select(key, F.col("m.other_").alias(f"{name}_id"), F.col("m.distance_m").alias(f"{name}_m"))
        out = out.join(best, key, "left").withColumn(f"has_{name}", F.col(f"{name}_id").isNotNull())
    return out


def assigned_region(points: DataFrame, regions: DataFrame, key: str, region: str, metres: float) -> DataFrame:
    """key, region of the region that contains a point, the lowest of several; else of the nearest region with a vertex within metres; else null. regions: region, parts (EPSG:5179)."""
    inside = spatial.in_regions(points.select(key, "lon", "lat"), regions.select(region, "parts")).groupBy(key).agg(F.min(region).alias("inside_"))
    rest = points.join(inside.select(key), key, "left_anti").withColumn("m", geo.to_metres(F.col("lon"), F.col("lat"))).select(key, "m.x", "m.y")
    corners = regions.select(region, F.explode(F.flatten(F.flatten("parts"))).alias("v")).select(region, "v.x", "v.y").distinct()
    spots = rest.select(F.col(key).alias("spot"), "x", "y")
    near = repair.near_pairs(spots, "spot", metres, corners.withColumn("spot", F.col(region))).groupBy(F.col("spot_a").alias(key)).agg(F.min(F.struct("distance_m", "spot_b")).alias("m")).select(key, F.col("m.spot_b").alias("near_"))
    return points.select(key).distinct().join(inside, key, "left").join(near, key, "left").select(key, F.coalesce("inside_", "near_").alias(region))


def load_checks(tables: Mapping[str, DataFrame], unique: Mapping[str, str], references: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """check_name, n: rows of each table, repeated and null keys (unique: table to key), values without a partner (table, column, other table, its column)."""
    one = lambda name, df: df.select(F.lit(name).alias("check_name"), F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))
    parts = [one(f"rows:{t}", df.agg(F.count("*").alias("n"))) for t, df in tables.items()]
    for t, k in unique.items():
        parts.append(one(f"repeated:{t}.{k}", tables[t].where(F.col(k).isNotNull()).groupBy(k).agg(F.count("*").alias("c")).agg(F.sum(F.col("c") - 1).alias("n"))))
        parts.append(one(f"null:{t}.{k}", tables[t].agg(F.count_if(F.col(k).isNull()).alias("n"))))
    for t, c, other, oc in references:
        have = tables[other].select(F.col(oc).alias(c)).distinct()
        parts.append(one(f"orphan:{t}.{c}", tables[t].where(F.col(c).isNotNull()).select(c).join(have, c, "left_anti").agg(F.count("*").alias("n"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def require_loaded(checks: DataFrame, allowed: Mapping[str, int] | None = None) -> None:
    """Raise if a table is empty, or if another check counts more than it is allowed; a report of a few rows."""
    limit = dict(allowed or {})
    bad = {r.check_name: r.n for r in checks.collect() if (r.n == 0 if r.check_name.startswith("rows:") else r.n > limit.get(r.check_name, 0))}
    if bad:
        raise ValueError(f"the load is not sound: {bad}")
