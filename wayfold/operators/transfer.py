"""Bringing attributes of points, lines and polygons onto the edges of a road graph."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.functions import geo
from wayfold.functions.text import is_unknown
from wayfold.operators import spatial
from wayfold.plans.runtime import materialize, once


def near_lines(sources: DataFrame, lines: DataFrame, source: str, line: str, metres: float, radius: str | None = None) -> DataFrame:
    """source, line, distance_m, overlap_m of every source and line within metres, or within the source's own radius if a column names it.

    sources and lines have planar points; a source of one vertex is a point. metres bounds the radius
    column: a greater radius counts as metres. Legs meet by the squares they pass, grown by metres on
    one side; the overlap is the length on which both lie on one line.
    """
    limit = F.least(F.coalesce(F.col(radius), F.lit(metres)), F.lit(metres)) if radius else F.lit(metres)
    corners = lambda k: [F.col(e)[c].alias(f"{c}{e}{k}") for e in "ab" for c in "xy"]
    a = spatial.leg_cells(materialize(sources.select(source, "points")), source, metres).select(source, F.col("leg").alias("leg_a"), *corners(1), "cell")
    b = spatial.leg_cells(materialize(lines.select(line, "points")), line).select(line, F.col("leg").alias("leg_b"), *corners(2), "cell")
    ends = spatial.leg_ends()
    # boxes first; distances are worked out for legs whose boxes are near, not in the join
    met = once(a.join(b, "cell").where(spatial.legs_near(*ends, metres)), d_=geo.leg_distance(*ends)).where(F.col("d_") <= metres)
    met = once(met, o_=geo.leg_overlap(*ends))
    each = met.groupBy(source, line, "leg_a", "leg_b").agg(F.min("d_").alias("d_"), F.max("o_").alias("o_"))  # two legs may share several squares
    pairs = each.groupBy(source, line).agg(F.min("d_").alias("distance_m"), F.sum("o_").alias("overlap_m"))
    if radius:
        pairs = pairs.join(sources.select(source, limit.alias("limit_")), source).where("distance_m <= limit_").drop("limit_")
    return pairs


def nearest_line(sources: DataFrame, lines: DataFrame, source: str, line: str, metres: float, radius: str | None = None, only: Column | None = None) -> DataFrame:
    """source, line, distance_m, overlap_m: the nearest line of those that only allows; of equally near ones the one with more overlap, then the lower id."""
    pairs = near_lines(sources, lines if only is None else lines.where(only), source, line, metres, radius)
    return pairs.groupBy(source).agg(F.min(F.struct("distance_m", (-F.col("overlap_m")).alias("less"), line)).alias("m")).select(source, f"m.{line}", "m.distance_m", (-F.col("m.less")).alias("overlap_m"))


def best_overlap(pairs: DataFrame, source: str, line: str, whole: Column, least_share: float = 0.3) -> DataFrame:
    """The best line of each source: the longest overlap, then the nearest, then the lower id; kept if the overlap is at least least_share of whole (a length)."""
    ranked = pairs.withColumn("share", F.col("overlap_m") / F.nullif(whole, F.lit(0.0)))
    rest = [c for c in ranked.columns if c not in (source, line, "overlap_m", "distance_m")]
    far = F.col("distance_m") if "distance_m" in pairs.columns else F.lit(0.0)
    best = ranked.groupBy(source).agg(F.min(F.struct((-F.col("overlap_m")).alias("less"), far.alias("distance_m"), line, *rest)).alias("m"))
    return best.select(source, f"m.{line}", (-F.col("m.less")).alias("overlap_m"), "m.distance_m", *[f"m.{c}" for c in rest]).where(F.col("share") >= least_share)


def best_source(pairs: DataFrame, source: str, line: str) -> DataFrame:
    """The best source of each line, by the same order."""
    far = F.col("distance_m") if "distance_m" in pairs.columns else F.lit(0.0)
    best = pairs.groupBy(line).agg(F.min(F.struct((-F.col("overlap_m")).alias("less"), far.alias("distance_m"), source)).alias("m"))
    return best.select(line, f"m.{source}", (-F.col("m.less")).alias("overlap_m"), "m.distance_m")


def polygon_means(lines: DataFrame, regions: DataFrame, line: str, region: str, values: Sequence[str], least_share: float = 0.3) -> DataFrame:
    """line and the mean of each value over the regions whose best line it is, by overlap as a share of the line's length.

    regions: region, parts, values; values that are null or not positive are left out of a mean.
    """
    pairs = spatial.lines_in_regions(lines, regions, line, region)
    best = best_overlap(pairs, region, line, F.col("length_m"), least_share).join(regions.select(region, *values), region)
    return best.groupBy(line).agg(F.count("*").alias("n_sources"), *[F.avg(F.when(F.col(v) > 0, F.col(v))).alias(v) for v in values])


def mapping_counts(sources: DataFrame, mapped: DataFrame, source: str, line: str, valid: Column) -> DataFrame:
    """One row: sources, invalid ones, mapped and unmapped ones, and edges that got a value."""
    j = sources.select(source, F.coalesce(valid, F.lit(False)).alias("ok_")).join(mapped.select(source, line), source, "left")
    return j.agg(
        F.count_distinct(source).alias("n_sources"),
        F.count_distinct(F.when(~F.col("ok_"), F.col(source))).alias("n_invalid"),
        F.count_distinct(F.when(F.col(line).isNotNull(), F.col(source))).alias("n_mapped"),
        F.count_distinct(F.when(F.col("ok_") & F.col(line).isNull(), F.col(source))).alias("n_unmapped"),
        F.count_distinct(line).alias("n_edges"),
    )


def load_stats(rows: DataFrame, outcome: str, kinds: Sequence[str] = ("LOADED", "MATCHED", "REVIEW", "UNMATCHED", "CONFLICT", "SKIPPED", "DUPLICATE")) -> DataFrame:
    """One row: source rows and how many had each outcome."""
    return rows.agg(F.count("*").alias("n_source"), *[F.count_if(F.col(outcome) == k).alias(f"n_{k.lower()}") for k in kinds])


def guarded_tier(distance: Column, edge_length: Column, source_length: Column, auto: float, review: float, low: float = 0.2, high: float = 5.0) -> Column:
    """CONFLICT if the lengths are too unlike, before the tier of the distance is asked for."""
    ratio = edge_length / F.nullif(source_length, F.lit(0.0))
    return F.when(distance.isNull(), "UNMATCHED").when(~ratio.between(low, high), "CONFLICT").when(distance <= auto, "MATCHED").when(distance <= review, "REVIEW").otherwise("UNMATCHED")


def mean_with_fallback(mapped: DataFrame, line: str, value: str, primary: Column) -> DataFrame:
    """line, value: the mean over primary sources, or else over the others."""
    means = mapped.groupBy(line).agg(F.avg(F.when(primary, F.col(value))).alias("p_"), F.avg(F.when(~primary, F.col(value))).alias("f_"))
    return means.select(line, F.coalesce("p_", "f_").alias(value)).where(F.col(value).isNotNull())


def fill_from(edges: DataFrame, updates: DataFrame, key: str, columns: Sequence[str], overwrite: bool = False) -> DataFrame:
    """Edges with columns taken from updates: known values into unknown cells only, or over all cells that the update knows."""
    u = updates.select(key, *[F.col(c).alias(f"{c}_new_") for c in columns])
    j = edges.join(u, key, "left")
    known = lambda c: F.col(c).isNotNull() & ~is_unknown(F.col(c).cast("string"))
    for c in columns:
        take = known(f"{c}_new_") if overwrite else known(f"{c}_new_") & ~known(c)
        j = j.withColumn(c, F.when(take, F.col(f"{c}_new_")).otherwise(F.col(c)))
    return j.select(*edges.columns)


def fill_in_order(edges: DataFrame, updates: Sequence[DataFrame], key: str, columns: Sequence[str]) -> DataFrame:
    """Cells filled by the first update that knows them; what one has filled, the next does not touch."""
    for u in updates:
        edges = fill_from(edges, u, key, columns)
    return edges


def backfill_states(edges: DataFrame, rules: Mapping[str, tuple[str, object]]) -> DataFrame:
    """State columns that are unknown take the state of their number. rules: state column to (number column, function of a Column)."""
    for state, (number, derive) in rules.items():
        edges = edges.withColumn(state, F.when(is_unknown(F.col(state)) & F.col(number).isNotNull(), derive(F.col(number))).otherwise(F.col(state)))
    return edges


def route_flags(vehicles: DataFrame, route: str, flag: Column) -> DataFrame:
    """route, any_flag, n_vehicles, n_flag."""
    f = F.coalesce(flag, F.lit(False))
    return vehicles.where(F.col(route).isNotNull()).groupBy(route).agg(F.bool_or(f).alias("any_flag"), F.count("*").alias("n_vehicles"), F.count_if(f).alias("n_flag"))


def folded_verdict(votes: DataFrame, key: str, verdict: str, confidence: str, order: Sequence[str] = ("CONFIRMED", "PRIVATE", "UNCLEAR"), all_only: str = "NO_VIEW", otherwise: str = "NONE") -> DataFrame:
    """key, verdict, confidence: the first verdict of the order that any vote gives; all_only if all votes are that; HIGH if any vote of the verdict is."""
    flags = [F.bool_or(F.col(verdict) == v).alias(f"f{i}_") for i, v in enumerate(order)]
    g = votes.groupBy(key).agg(*flags, F.bool_and(F.col(verdict) == all_only).alias("all_"))
    out = F.when(F.col("all_"), F.lit(all_only)).otherwise(F.lit(otherwise))
    for i, v in reversed(list(enumerate(order))):
        out = F.when(F.col(f"f{i}_"), F.lit(v)).otherwise(out)
    g = g.select(key, out.alias("v_"))
    high = votes.join(g, key).groupBy(key, "v_").agg(F.bool_or((F.col(verdict) == F.col("v_")) & (F.col(confidence) == "HIGH")).alias("h_"))
    return high.select(key, F.col("v_").alias(verdict), F.when(F.col("h_"), "HIGH").otherwise("LOW").alias(confidence))


def ranked_head(df: DataFrame, k: int, order: Mapping[str, Sequence[str]], *then: Column) -> DataFrame:
    """The first k rows by columns whose values rank as listed (others last), then by more columns; one TakeOrdered."""
    ranks = [F.coalesce(F.array_position(F.array(*map(F.lit, vs)), F.col(c)).cast("int"), F.lit(0)) for c, vs in order.items()]
    ranks = [F.when(r > 0, r).otherwise(len(vs) + 1) for r, vs in zip(ranks, order.values())]
    return df.orderBy(*ranks, *then).limit(k)


def child_rows(df: DataFrame, key: str, items: Column, name: str, first: int = 1) -> DataFrame:
    """key, ordinal, name: one row an element of a list column."""
    return df.select(key, F.posexplode(items).alias("i_", name)).select(key, (F.col("i_") + first).alias("ordinal"), name)


