"""Nearest, tiered, mutual and gap joins on points and polylines, over the cell-code joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.functions import geo
from wayfold.operators import spatial
from wayfold.plans.runtime import materialize


def local_xy(lon: Column, lat: Column, lat0: float) -> Column:
    """Struct(x, y): planar metres with 111320 a degree of longitude at lat0 and 110540 a degree of latitude."""
    return F.struct((lon * F.lit(111320.0) * F.cos(F.radians(F.lit(lat0)))).alias("x"), (lat * F.lit(110540.0)).alias("y"))


def nearest_point(left: DataFrame, right: DataFrame, left_id: str, right_id: str, metres: float) -> DataFrame:
    """left_id, right_id, distance_m of the nearest right point within metres; of equally near ones the least id."""
    pairs = spatial.within_distance(left.select(left_id, "lon", "lat"), right.select(right_id, "lon", "lat"), metres)
    return pairs.groupBy(left_id).agg(F.min(F.struct("distance_m", right_id)).alias("m")).select(left_id, f"m.{right_id}", "m.distance_m")


def tier(distance: Column, auto: float, review: float) -> Column:
    return F.when(distance <= auto, "MATCHED").when(distance <= review, "REVIEW").otherwise("UNMATCHED")


def tiered_nearest(left: DataFrame, right: DataFrame, left_id: str, right_id: str, auto: float, review: float) -> DataFrame:
    """Every left row with the nearest right point and its tier; unmatched rows too."""
    near = nearest_point(left, right, left_id, right_id, review)
    return left.select(left_id).join(near, left_id, "left").withColumn("tier", tier(F.col("distance_m"), auto, review))


def mutual_nearest(points: DataFrame, key: str, metres: float) -> DataFrame:
    """key_a < key_b of points that are each other's nearest within metres."""
    a = points.select(F.col(key).alias("ka"), "lon", "lat")
    b = points.select(F.col(key).alias("kb"), "lon", "lat")
    pairs = spatial.within_distance(a, b, metres).where("ka <> kb")
    best = pairs.groupBy("ka").agg(F.min(F.struct("distance_m", "kb")).alias("m")).select("ka", F.col("m.kb").alias("kb"), F.col("m.distance_m").alias("distance_m"))
    back = best.select(F.col("ka").alias("kb"), F.col("kb").alias("ka"))
    return best.join(back, ["ka", "kb"]).where("ka < kb").select(F.col("ka").alias(f"{key}_a"), F.col("kb").alias(f"{key}_b"), "distance_m")


def radius_ladder(left: DataFrame, right: DataFrame, left_id: str, right_id: str, radii: list[float]) -> DataFrame:
    """Nearest right point by growing radii; only rows still without one go on to the next."""
    rest, out = left, None
    for r in radii:
        found = nearest_point(rest, right, left_id, right_id, r).withColumn("rung_m", F.lit(float(r)))
        out = found if out is None else out.unionByName(found)
        rest = rest.join(found.select(left_id), left_id, "left_anti")
    return out


def without_near(left: DataFrame, right: DataFrame, left_id: str, right_id: str, metres: float) -> DataFrame:
    """Left rows with no right point within metres."""
    pairs = spatial.within_distance(left.select(left_id, "lon", "lat"), right.select(right_id, "lon", "lat"), metres)
    return left.join(pairs.select(left_id).distinct(), left_id, "left_anti")


def nearest_leg(points: DataFrame, lines: DataFrame, point_id: str, line_id: str, metres: float) -> DataFrame:
    """point_id, line_id, distance_m: nearest polyline by exact distance to its legs.

    points: x, y; lines: points array<struct(x, y)>; both planar metres. Legs are covered with cells
    of their bounding box grown by metres, points are expanded to the levels that occur.
    """
    legs = lines.select(line_id, F.explode(geo.legs(F.col("points"))).alias("g")).select(line_id, "g.a", "g.b")
    lo = lambda c: F.least(F.col(f"a.{c}"), F.col(f"b.{c}")) - metres
    hi = lambda c: F.greatest(F.col(f"a.{c}"), F.col(f"b.{c}")) + metres
    legs = materialize(legs)  # the levels are taken from it, too
    covered = spatial.cover(legs, lo("x"), lo("y"), hi("x"), hi("y"))
    extent = F.greatest(hi("x") - lo("x"), hi("y") - lo("y"))
    levels = spatial.used_levels(legs.select(spatial.level_of(extent).alias("level_"))) or [spatial.MIN_LEVEL]
    hits = spatial.at_levels(points.select(point_id, "x", "y"), "x", "y", levels).join(covered, ["level_", "prefix_"])
    far = geo.point_leg(F.col("x"), F.col("y"), F.col("a.x"), F.col("a.y"), F.col("b.x"), F.col("b.y")).d
    near = hits.withColumn("distance_m", far).where(F.col("distance_m") <= metres)
    return near.groupBy(point_id).agg(F.min(F.struct("distance_m", line_id)).alias("m")).select(point_id, f"m.{line_id}", "m.distance_m")
