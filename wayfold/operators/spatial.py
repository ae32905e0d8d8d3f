"""Points near points and points in regions by sorted space-filling-curve codes.

A point in metres gets a Z-order code on a one-metre grid. A disc or polygon is covered by aligned
squares: at a level l of side 2**l metres at least as wide as its bounding box, four squares or
fewer. An aligned square is one range of codes, [p << 2l, (p + 1) << 2l), so "code in range" is
"code >> 2l = p": the range join becomes a sort-merge join on the sorted prefixes, with the
regions' few levels as part of the key. Each hit is then refined exactly in the JVM.

Nothing is broadcast and no cell is collected: a cell that holds a third of all points is a skewed
join partition, which AQE splits, since every point row meets only the regions of its own cell.
Regions are spread over levels two apart, from MIN_LEVEL on, and points are expanded to the levels
that occur, which the data of the regions decide (metres of one city: one to three).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.functions import arrow, geo
from wayfold.plans.runtime import materialize, once

MIN_LEVEL, LEVEL_STEP, MAX_LEVEL = 6, 2, 30
#: metres added so that grid numbers stay positive
SHIFT = 1 << 28
#: a region that meets lines is covered by squares as wide as this part of its box, as lines are many and their legs short
REGION_SPLIT = 4


def grid(v: Column) -> Column:
    return (F.floor(v) + F.lit(SHIFT)).cast("bigint")


def z_code(x: Column, y: Column) -> Column:
    return geo.morton(grid(x), grid(y))


def level_of(extent: Column) -> Column:
    """Lowest used level whose squares are at least as wide as the extent."""
    out = F.lit(MAX_LEVEL)
    for level in range(MAX_LEVEL - LEVEL_STEP, MIN_LEVEL - 1, -LEVEL_STEP):
        out = F.when(extent <= float(1 << level), F.lit(level)).otherwise(out)
    return out


def cover(df: DataFrame, x0: Column, y0: Column, x1: Column, y1: Column, split: int = 1) -> DataFrame:
    """A row for each aligned square (level_, prefix_) that the bounding box meets; squares at least as wide as its split-th part."""
    df = df.withColumn("level_", level_of(F.greatest(x1 - x0, y1 - y0) / split))
    side = F.pow(F.lit(2.0), F.col("level_"))
    lo = lambda v: F.floor(grid(v) / side).cast("bigint")
    squares = F.flatten(F.transform(F.sequence(lo(x0), lo(x1)), lambda i: F.transform(F.sequence(lo(y0), lo(y1)), lambda j: geo.morton(i, j))))
    return df.withColumn("prefix_", F.explode(squares))


def at_levels(points: DataFrame, x: str, y: str, levels: list[int]) -> DataFrame:
    """Each point with its code's prefix at each level."""
    code = F.col("code_")
    prefixes = F.array(*[F.struct(F.lit(level).alias("level_"), F.shiftright(code, 2 * level).alias("prefix_")) for level in levels])
    return points.withColumn("code_", z_code(F.col(x), F.col(y))).withColumn("at_", F.explode(prefixes)).select(*points.columns, "at_.level_", "at_.prefix_")


def used_levels(regions: DataFrame) -> list[int]:
    """The levels that occur: at most (MAX_LEVEL - MIN_LEVEL) / LEVEL_STEP + 1 rows."""
    return sorted(r[0] for r in regions.select("level_").distinct().collect())


def line_legs(lines: DataFrame, key: str) -> DataFrame:
    """key, leg, a, b: the legs of polylines (planar points), numbered from 0. A line of one vertex is a leg without length."""
    own = F.coalesce(geo.legs(F.col("points")), F.when(F.size("points") == 1, F.transform("points", lambda p: F.struct(p.alias("a"), p.alias("b")))))
    return lines.select(key, F.posexplode(own).alias("leg", "g")).select(key, "leg", "g.a", "g.b")


def cell_of(v: Column) -> Column:
    """Number of the row or column of squares of level MIN_LEVEL that holds a coordinate."""
    return F.floor(grid(v) / float(1 << MIN_LEVEL)).cast("bigint")


def leg_cells(lines: DataFrame, key: str, margin: float = 0.001) -> DataFrame:
    """key, leg, a, b, cell: the legs of polylines (planar points) with each aligned square of level MIN_LEVEL that they pass, grown by a margin.

    Each column of squares holds a stretch of the leg, whose ends say which squares of the column it
    passes: a long leg costs squares in proportion to its length, not to its bounding box. Lines
    should be a written table: the optimiser copies their expression for every use of points.
    """
    ax, ay, bx, by = (F.col(c) for c in ("a.x", "a.y", "b.x", "b.y"))
    side = float(1 << MIN_LEVEL)
    columns = F.sequence(cell_of(F.least(ax, bx) - margin), cell_of(F.greatest(ax, bx) + margin))
    leg = line_legs(lines, key).withColumn("cx_", F.explode(columns))
    # a leg nearly along the column has no stable place where it enters: it counts whole
    x0 = (F.col("cx_") - F.lit(SHIFT >> MIN_LEVEL)) * side - margin
    at = lambda x: F.when(F.abs(bx - ax) < 1.0, F.lit(None)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - ax) / (bx - ax))))
    p, q = ay + F.coalesce(at(x0), F.lit(0.0)) * (by - ay), ay + F.coalesce(at(x0 + side + 2 * margin), F.lit(1.0)) * (by - ay)
    leg = leg.withColumn("cy_", F.explode(F.sequence(cell_of(F.least(p, q) - margin), cell_of(F.greatest(p, q) + margin))))
    return leg.select(key, "leg", "a", "b", geo.morton(F.col("cx_"), F.col("cy_")).alias("cell"))


#: a leg longer than this many of the smallest squares is covered by wider ones, so that about as many hold it
LEG_SPLIT = 8


def leg_squares(lines: DataFrame, key: str, margin: float) -> DataFrame:
    """key, xa, ya, xb, yb, level_, prefix_: the legs of polylines with each aligned square that they pass, grown by a margin.

    As leg_cells, but of a level by the leg's extent: a leg costs some twenty rows at most, however
    long. Points meet it at_levels that occur; far fewer points than legs keep that cheap.
    """
    corner = [F.col(f"{e}.{c}").alias(f"{c}{e}") for e in "ab" for c in "xy"]
    ax, ay, bx, by = (F.col(c) for c in ("xa", "ya", "xb", "yb"))
    extent = F.greatest(F.abs(bx - ax), F.abs(by - ay)) / LEG_SPLIT
    leg = once(line_legs(lines, key).select(key, *corner), level_=level_of(extent))
    side = F.pow(F.lit(2.0), F.col("level_"))
    of = lambda v: F.floor(grid(v) / side).cast("bigint")
    leg = leg.withColumn("cx_", F.explode(F.sequence(of(F.least(ax, bx) - margin), of(F.greatest(ax, bx) + margin))))
    # a leg nearly along the column has no stable place where it enters: it counts whole
    x0 = F.col("cx_") * side - F.lit(SHIFT) - margin
    at = lambda x: F.when(F.abs(bx - ax) < 1.0, F.lit(None)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - ax) / (bx - ax))))
    p, q = ay + F.coalesce(at(x0), F.lit(0.0)) * (by - ay), ay + F.coalesce(at(x0 + side + 2 * margin), F.lit(1.0)) * (by - ay)
    leg = leg.withColumn("cy_", F.explode(F.sequence(of(F.least(p, q) - margin), of(F.greatest(p, q) + margin))))
    return leg.select(key, "xa", "ya", "xb", "yb", "level_", geo.morton(F.col("cx_"), F.col("cy_")).alias("prefix_"))


class Spot(NamedTuple):
    """A point in two columns of their own, for the functions of geo."""

    x: Column
    y: Column


def leg_ends() -> list[Spot]:
    """The ends a1, b1 and a2, b2 of two legs, in columns of their own."""
    return [Spot(F.col(f"x{k}"), F.col(f"y{k}")) for k in ("a1", "b1", "a2", "b2")]


def legs_near(a: Column, b: Column, c: Column, d: Column, gap: float) -> Column:
    """Whether the bounding boxes of legs a-b and c-d come within gap of each other: the cheap test before an exact one."""
    meet = lambda a, b, c, d: (F.least(a, b) - gap <= F.greatest(c, d)) & (F.least(c, d) - gap <= F.greatest(a, b))
    return meet(a.x, b.x, c.x, d.x) & meet(a.y, b.y, c.y, d.y)


def within_distance(left: DataFrame, right: DataFrame, metres: float, split: int = 1) -> DataFrame:
    """Pairs within a great-circle distance.

    Both sides have lon and lat; their other columns must differ in name. Rows with null
    coordinates are in no pair. The disc is covered with a margin for the grid's scale error, and
    the haversine distance decides. Where points are dense, split covers the disc by squares as wide
    as this part of it; then planar distance sifts the pairs, and haversine is worked out once each.
    """
    def metric(df: DataFrame, mark: str) -> DataFrame:
        df = df.where(F.col("lon").isNotNull() & F.col("lat").isNotNull())
        m = geo.to_metres(F.col("lon"), F.col("lat"))
        return (once(df, m_=m) if split > 1 else df.withColumn("m_", m)).withColumnsRenamed({"lon": f"lon_{mark}", "lat": f"lat_{mark}"})

    a, b = metric(left, "a"), metric(right, "b")
    reach = metres * 1.002 + 1.0
    a = a.withColumn("x_", F.col("m_.x")).withColumn("y_", F.col("m_.y")).drop("m_")
    if split > 1:
        b = b.withColumn("u_", F.col("m_.x")).withColumn("v_", F.col("m_.y"))
    b = cover(b, F.col("m_.x") - reach, F.col("m_.y") - reach, F.col("m_.x") + reach, F.col("m_.y") + reach, split).drop("m_")
    level = next(v for v in range(MIN_LEVEL, MAX_LEVEL + 1, LEVEL_STEP) if 2 * reach / split <= float(1 << v))
    hits = at_levels(a, "x_", "y_", [level])
    far = geo.haversine(F.col("lon_a"), F.col("lat_a"), F.col("lon_b"), F.col("lat_b"))
    if split > 1:
        dx, dy = F.col("x_") - F.col("u_"), F.col("y_") - F.col("v_")
        near = hits.join(b, ["level_", "prefix_"]).where(dx * dx + dy * dy <= (metres * 1.01 + 1.0) ** 2).drop("x_", "y_", "u_", "v_")
        return once(near, distance_m=far).where(F.col("distance_m") <= metres).drop("level_", "prefix_")
    hits = hits.drop("x_", "y_").join(b, ["level_", "prefix_"])
    return hits.withColumn("distance_m", far).where(F.col("distance_m") <= metres).drop("level_", "prefix_")


def in_regions(points: DataFrame, regions: DataFrame, parts: str = "parts") -> DataFrame:
    """Pairs of a point (lon, lat) and a region in EPSG:5179 metres that contains it.

    regions has the column parts as parse_multipolygon gives it; null or empty parts contain
    nothing. Column names of both sides must differ.
    """
    outer = F.flatten(F.transform(F.col(parts), lambda part: F.get(part, F.lit(0))))
    # written before anything filters on the shapes: a filter would be pushed down and parse them again
    boxed = materialize(regions.withColumn("box_", geo.bbox(outer))).where("box_.x0 is not null and box_.y0 is not null")
    covered = cover(boxed, F.col("box_.x0"), F.col("box_.y0"), F.col("box_.x1"), F.col("box_.y1"))
    pts = points.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).withColumn("m_", geo.to_metres(F.col("lon"), F.col("lat")))
    pts = pts.withColumn("x_", F.col("m_.x")).withColumn("y_", F.col("m_.y")).drop("m_")
    extent = F.greatest(F.col("box_.x1") - F.col("box_.x0"), F.col("box_.y1") - F.col("box_.y0"))
    levels = used_levels(boxed.select(level_of(extent).alias("level_"))) or [MIN_LEVEL]
    hits = at_levels(pts, "x_", "y_", levels).join(covered, ["level_", "prefix_"])
    inside = F.col("x_").between(F.col("box_.x0"), F.col("box_.x1")) & F.col("y_").between(F.col("box_.y0"), F.col("box_.y1"))
    return hits.where(inside).where(geo.in_multipolygon(F.col("x_"), F.col("y_"), F.col(parts))).drop("level_", "prefix_", "box_", "x_", "y_", parts)


def lines_in_regions(lines: DataFrame, regions: DataFrame, line: str, region: str, parts: str = "parts") -> DataFrame:
    """line, region, overlap_m, length_m: how much of each polyline (planar points) lies in each region (EPSG:5179 metres) it enters.

    A region is covered by a few aligned squares of its level, a leg by the small squares it passes;
    a square of a lower level is a prefix of its code at a higher one, so this too is an equi-join.
    A leg meets a region in one square only, that where it enters the region's box; legs that miss
    the box are left out before the exact cut.
    """
    outer = F.flatten(F.transform(F.col(parts), lambda part: F.get(part, F.lit(0))))
    boxed = materialize(regions.select(region, parts, geo.bbox(outer).alias("box_"))).where("box_.x0 is not null and box_.y0 is not null")
    lines = materialize(lines.select(line, "points", geo.line_length(F.col("points")).alias("length_m")))
    extent = F.greatest(F.col("box_.x1") - F.col("box_.x0"), F.col("box_.y1") - F.col("box_.y0"))
    levels = used_levels(boxed.select(level_of(extent / REGION_SPLIT).alias("level_"))) or [MIN_LEVEL]
    box = [F.col(f"box_.{c}") for c in ("x0", "y0", "x1", "y1")]
    covered = cover(boxed, *box, REGION_SPLIT).select(F.col(region).alias("region_"), *[c.alias(f"{n}_") for c, n in zip(box, ("x0", "y0", "x1", "y1"))], "level_", "prefix_")
    at = F.explode(F.array(*[F.struct(F.lit(v).alias("level_"), F.shiftright("cell", 2 * (v - MIN_LEVEL)).alias("prefix_")) for v in levels])).alias("at_")
    passed = leg_cells(lines, line).select(F.col(line).alias("line_"), *[F.col(f"{e}.{c}").alias(f"{e}{c}") for e in "ab" for c in "xy"], "cell", at).select("*", "at_.*").drop("at_")
    meet = lambda c: (F.least(f"a{c}", f"b{c}") <= F.col(f"{c}1_")) & (F.greatest(f"a{c}", f"b{c}") >= F.col(f"{c}0_"))
    met = passed.join(covered, ["level_", "prefix_"]).where(meet("x") & meet("y"))
    share = lambda c, e: (F.col(f"{c}{e}_") - F.col(f"a{c}")) / F.nullif(F.col(f"b{c}") - F.col(f"a{c}"), F.lit(0.0))
    met = once(met, tx0=share("x", 0), tx1=share("x", 1), ty0=share("y", 0), ty1=share("y", 1))
    # least and greatest pass over null, the share of a leg along an axis
    first = F.greatest(F.lit(0.0), F.least("tx0", "tx1"), F.least("ty0", "ty1"))
    met = once(met, t=first).where(F.col("t") <= F.least(F.lit(1.0), F.greatest("tx0", "tx1"), F.greatest("ty0", "ty1")) + 1e-9)
    entry = lambda c: F.greatest(F.col(f"{c}0_"), F.least(F.col(f"{c}1_"), F.col(f"a{c}") + F.col("t") * (F.col(f"b{c}") - F.col(f"a{c}"))))
    met = once(met, own=geo.morton(cell_of(entry("x")), cell_of(entry("y")))).where("own = cell")
    kinds = f"line_ {lines.schema[line].dataType.simpleString()}, region_ {regions.schema[region].dataType.simpleString()}, overlap_m double"
    # a region's shape stands once before its legs; in each leg's row it would be written over and over
    empty = lambda *named: [F.lit(None).cast(kind).alias(c) for c, kind in named]
    shapes = boxed.select(F.col(region).alias("region_"), *empty(("line_", lines.schema[line].dataType), *((c, "double") for c in ("ax", "ay", "bx", "by"))), F.col(parts).alias("parts"))
    legs = met.select("region_", "line_", "ax", "ay", "bx", "by", *empty(("parts", shapes.schema["parts"].dataType)))
    stood = shapes.unionByName(legs).repartition("region_").sortWithinPartitions("region_", F.col("parts").isNull())
    inside = stood.mapInArrow(arrow.legs_inside, kinds).groupBy("line_", "region_").agg(F.sum("overlap_m").alias("overlap_m"))
    return inside.join(lines.select(F.col(line).alias("line_"), "length_m"), "line_").select(F.col("line_").alias(line), F.col("region_").alias(region), "overlap_m", "length_m")
