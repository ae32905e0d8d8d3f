"""Column-level data quality profile by character-class masks.

A value is generalised to its mask: letters become A or a, Hangul syllables K, digits 9, other
characters stand for themselves. Cells are first counted by (load, column, value), map-side, so
all later steps work on distinct values rather than rows; a load or value that holds a third of
all rows is one counter. From these counts come

* the profile: rows, blanks, distinct values, range, masks, dominant masks of each column and load;
* rare masks: cells whose mask has a share below min_mask_share in its load and column;
* violations: masks that no value of the domain has condemn all their values, unseen; the values of
  the other masks are checked exactly. Both are judged once a distinct value, and the cells with a
  bad value are joined back;
* divergence: mask distribution, blank share, value shares and medians of a load against its prior.
  If the masks of a load's domain values already lie as far from its prior's as values may, the load
  differs, as values lie at least as far apart as their masks; else the values' shares decide.

Defined results: null and empty string are blank; other white space is a value. An empty table
gives empty results. A load without rows, or without domain values, has no share and is not
compared. Repeated rows count as often as they occur; a violating edge is reported once a column.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfold.plans.runtime import materialize


@dataclass(frozen=True)
class StateDomain:
    """The allowed values, compared exactly."""

    column: str
    values: tuple[str, ...]

    def allows(self, v: Column) -> Column:
        return v.isin(*self.values)

    def mask_allows(self, m: Column) -> Column:
        return m.isin(*sorted({plain_mask(v) for v in self.values}))

    number = False


@dataclass(frozen=True)
class NumberDomain:
    """Digits, optionally a point and one or two digits, within [low, high]."""

    column: str
    low: int
    high: int
    number = True

    def allows(self, v: Column) -> Column:
        return v.rlike(r"\A[0-9]+(\.[0-9]{1,2})?\z") & F.coalesce(v.try_cast("decimal(38,2)").between(self.low, self.high), F.lit(False))

    def mask_allows(self, m: Column) -> Column:
        return m.rlike(r"\A9+(\.9{1,2})?\z")


def plain_mask(v: str) -> str:
    """The mask of a constant, as value_mask gives it."""
    return "".join("A" if "A" <= c <= "Z" else "a" if "a" <= c <= "z" else "9" if "0" <= c <= "9" else "K" if "가" <= c <= "힣" else c for c in v)


def value_mask(v: Column) -> Column:
    upper, lower, digits = string.ascii_uppercase, string.ascii_lowercase, string.digits
    v = F.translate(v, upper + lower + digits, "A" * len(upper) + "a" * len(lower) + "9" * len(digits))
    return F.when(v.rlike("[가-힣]"), F.regexp_replace(v, "[가-힣]", "K")).otherwise(v)


def cells(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """One row a cell: the kept columns, column_name, value."""
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])).alias("cell")
    return df.select(*keep, stacked).select(*keep, "cell.column_name", "cell.value")


def value_counts(df: DataFrame, domains: Sequence, load: str) -> DataFrame:
    """load, column_name, value, n, blank, mask, in_mask, in_domain."""
    counted = cells(df, [d.column for d in domains], load).groupBy(F.col(load).alias("load_id"), "column_name", "value").agg(F.count("*").alias("n"))
    return _judged(counted, domains)


def _judged(df: DataFrame, domains: Sequence) -> DataFrame:
    df = df.withColumn("blank", F.col("value").isNull() | (F.col("value") == "")).withColumn("mask", F.when(~F.col("blank"), value_mask(F.col("value"))))
    by_mask, by_value = F.lit(None).cast("boolean"), F.lit(None).cast("boolean")
    for d in domains:
        here = F.col("column_name") == d.column
        by_mask = F.when(here, d.mask_allows(F.col("mask"))).otherwise(by_mask)
        by_value = F.when(here, d.allows(F.col("value"))).otherwise(by_value)
    return df.withColumn("in_mask", F.coalesce(by_mask, F.lit(False))).withColumn("in_domain", F.coalesce(by_value, F.lit(False)) & ~F.col("blank"))


def profile(df: DataFrame, domains: Sequence, load: str, min_mask_share: float = 0.01) -> DataFrame:
    """One row a load and column."""
    counts = value_counts(df, domains, load)
    masks = counts.where(~F.col("blank")).groupBy("load_id", "column_name", "mask").agg(F.sum("n").alias("m"))
    share = F.col("m") / F.sum("m").over(W.partitionBy("load_id", "column_name"))
    mined = masks.withColumn("share", share).groupBy("load_id", "column_name").agg(
        F.count("*").alias("n_masks"), F.max_by("mask", F.struct("m", "mask")).alias("dominant_mask"), F.sum(F.when(F.col("share") < min_mask_share, F.col("m")).otherwise(0)).alias("rare_mask_cells")
    )
    number = F.when(F.col("in_domain"), F.col("value").try_cast("decimal(12,2)"))
    flat = counts.groupBy("load_id", "column_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("n_blank"),
        F.count(F.when(~F.col("blank"), 1)).alias("n_distinct"),
        F.min(F.when(~F.col("blank"), F.col("value"))).alias("least_text"),
        F.max(F.when(~F.col("blank"), F.col("value"))).alias("greatest_text"),
        F.min(number).alias("least_number"),
        F.max(number).alias("greatest_number"),
        F.sum(F.when(~F.col("blank") & ~F.col("in_domain"), F.col("n")).otherwise(0)).alias("n_violations"),
    )
    return flat.join(mined, ["load_id", "column_name"], "left")


def bad_values(counts: DataFrame, domains: Sequence) -> DataFrame:
    """column_name, value, mask, reason of distinct values: MASK if no domain value looks like it, VALUE if one does and the value is refused.

    counts: as value_counts gives it; its judgements are not read: masks are judged first, and only
    the values of masks that pass are checked.
    """
    distinct = counts.where(~F.col("blank")).select("column_name", "value", "mask").distinct()
    masks = distinct.select("column_name", "mask").distinct()
    fits = F.lit(False)
    for d in domains:
        fits = F.when(F.col("column_name") == d.column, F.coalesce(d.mask_allows(F.col("mask")), F.lit(False))).otherwise(fits)
    alien = masks.where(~fits)
    by_mask = distinct.join(alien, ["column_name", "mask"]).select("column_name", "value", "mask", F.lit("MASK").alias("reason"))
    allowed = F.lit(False)
    for d in domains:
        allowed = F.when(F.col("column_name") == d.column, F.coalesce(d.allows(F.col("value")), F.lit(False))).otherwise(allowed)
    rest = distinct.join(alien, ["column_name", "mask"], "left_anti")
    return by_mask.unionByName(rest.where(~allowed).select("column_name", "value", "mask", F.lit("VALUE").alias("reason")))


def violations(df: DataFrame, domains: Sequence, key: str, counts: DataFrame) -> DataFrame:
    """key, column_name, value, mask, reason of every cell with a bad value; counts: value_counts of the same rows."""
    bad = materialize(bad_values(counts, domains))
    return cells(df, [d.column for d in domains], key).join(bad, ["column_name", "value"]).select(key, "column_name", "value", "mask", "reason")


def rare_masks(df: DataFrame, domains: Sequence, key: str, load: str, min_mask_share: float = 0.01) -> DataFrame:
    """key, load_id, column_name, value, mask, mask_share of the cells that profile() counts as rare_mask_cells."""
    masks = value_counts(df, domains, load).where(~F.col("blank")).groupBy("load_id", "column_name", "mask").agg(F.sum("n").alias("m"))
    share = F.col("m") / F.sum("m").over(W.partitionBy("load_id", "column_name"))
    rare = masks.withColumn("mask_share", share).where(F.col("mask_share") < min_mask_share)
    rare = materialize(rare.select(F.col("load_id").alias("l_"), F.col("column_name").alias("c_"), F.col("mask").alias("m_"), "mask_share"))
    each = cells(df, [d.column for d in domains], key, load).where(F.col("value").isNotNull() & (F.col("value") != "")).withColumn("mask", value_mask(F.col("value")))
    hit = F.col(load).eqNullSafe(F.col("l_")) & (F.col("column_name") == F.col("c_")) & (F.col("mask") == F.col("m_"))
    return each.join(rare, hit).select(key, F.col(load).alias("load_id"), "column_name", "value", "mask", "mask_share")


def _median_and_top(counts: DataFrame) -> DataFrame:
    """Exact median (mean of the middle two, doubled to stay whole) and the count of the most frequent number, from value counts."""
    by_number = counts.withColumn("v", F.col("value").try_cast("decimal(12,2)")).groupBy("load_id", "column_name", "v").agg(F.sum("n").alias("n"))
    w = W.partitionBy("load_id", "column_name")
    ranked = by_number.withColumn("upto", F.sum("n").over(w.orderBy("v").rowsBetween(W.unboundedPreceding, 0))).withColumn("total", F.sum("n").over(w))
    low, high = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
    at = lambda pos: F.min(F.when(F.col("upto") >= pos, F.col("v")))
    return ranked.groupBy("load_id", "column_name").agg((at(low) + at(high)).alias("median2"), F.max("n").alias("top_n"), F.max("total").alias("num_n"))


def divergence(df: DataFrame, loads: DataFrame, domains: Sequence, load: str, counts: DataFrame | None = None) -> DataFrame:
    """One row a load with a prior load and column: blank shares, mask and value distances, medians, shares of the top number.

    Shares are kept as pairs of whole numbers, and the flags compare products of whole numbers, so
    no rounding decides a case on a limit.
    """
    counts = materialize(value_counts(df, domains, load)) if counts is None else counts  # one row a load, column and distinct value
    states = [d.column for d in domains if not d.number]
    is_state = F.col("column_name").isin(*states) if states else F.lit(False)
    flat = counts.groupBy("load_id", "column_name").agg(F.sum("n").alias("rows_n"), F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank_n"), F.sum(F.when(F.col("in_domain"), F.col("n")).otherwise(0)).alias("dom_n"))
    numbers = _median_and_top(counts.where(F.col("in_domain") & ~is_state))
    per_load = flat.join(numbers, ["load_id", "column_name"], "left")
    chain = loads.select("load_id", "prior_load_id").where(F.col("prior_load_id").isNotNull()).distinct()
    now = per_load.alias("now")
    prior = per_load.select(F.col("load_id").alias("prior_load_id"), "column_name", *[F.col(c).alias(f"p_{c}") for c in per_load.columns[2:]])
    both = chain.join(now, "load_id").join(prior, ["prior_load_id", "column_name"])

    # distances of distributions: domain values of state columns, masks of all cells
    def distance(keyed: DataFrame, name: str) -> DataFrame:
        shares = keyed.withColumn("total", F.sum("n").over(W.partitionBy("load_id", "column_name")))
        a = chain.join(shares, "load_id").select("load_id", "column_name", "item", F.col("n").alias("a_n"), F.col("total").alias("a_t"))
        b = chain.join(shares.withColumnRenamed("load_id", "prior_load_id"), "prior_load_id").select("load_id", "column_name", "item", F.col("n").alias("b_n"), F.col("total").alias("b_t"))
        w = W.partitionBy("load_id", "column_name")
        j = a.join(b, ["load_id", "column_name", "item"], "full").withColumn("a_t", F.max("a_t").over(w)).withColumn("b_t", F.max("b_t").over(w)).where(F.col("a_t").isNotNull() & F.col("b_t").isNotNull())
        d = lambda c: c.cast("decimal(18,0)")
        cross = F.abs(d(F.coalesce("a_n", F.lit(0))) * d(F.col("b_t")) - d(F.coalesce("b_n", F.lit(0))) * d(F.col("a_t")))
        return j.groupBy("load_id", "column_name").agg(F.sum(cross).alias(f"{name}_num"), F.max(d(F.col("a_t")) * d(F.col("b_t"))).alias(f"{name}_den"))

    values = distance(counts.where(F.col("in_domain") & is_state).select("load_id", "column_name", F.col("value").alias("item"), "n"), "value")
    masks = distance(counts.where(~F.col("blank")).groupBy("load_id", "column_name", F.col("mask").alias("item")).agg(F.sum("n").alias("n")), "mask")
    shapes = distance(counts.where(F.col("in_domain") & is_state).groupBy("load_id", "column_name", F.col("mask").alias("item")).agg(F.sum("n").alias("n")), "shape")
    for far in (values, masks, shapes):
        both = both.join(far, ["load_id", "column_name"], "left")
    d = lambda c: F.col(c).cast("decimal(18,0)")
    apart = lambda x, xt, y, yt: F.abs(d(x) * d(yt) - d(y) * d(xt))
    blank_flag = (F.col("rows_n") > 0) & (F.col("p_rows_n") > 0) & (apart("blank_n", "rows_n", "p_blank_n", "p_rows_n") * 10 >= d("rows_n") * d("p_rows_n"))
    beyond = lambda name: F.col(f"{name}_num") * 5 >= F.col(f"{name}_den") * 2
    value_flag = is_state & F.when(beyond("shape"), F.lit(True)).otherwise(beyond("value"))
    lo, hi = F.least("median2", "p_median2"), F.greatest("median2", "p_median2")
    median_flag = ~is_state & (hi > lo) & (hi * 2 >= lo * 3)
    top_flag = ~is_state & (apart("top_n", "num_n", "p_top_n", "p_num_n") * 5 >= d("num_n") * d("p_num_n"))
    return both.select(
        "load_id",
        "prior_load_id",
        "column_name",
        (F.col("blank_n") / F.nullif(F.col("rows_n"), F.lit(0))).alias("blank_share"),
        (F.col("p_blank_n") / F.nullif(F.col("p_rows_n"), F.lit(0))).alias("prior_blank_share"),
        (F.col("mask_num") / F.col("mask_den") / 2).cast("double").alias("mask_distance"),
        (F.col("value_num") / F.col("value_den") / 2).cast("double").alias("value_distance"),
        (F.col("median2") / 2).cast("double").alias("median"),
        (F.col("p_median2") / 2).cast("double").alias("prior_median"),
        F.coalesce(blank_flag, F.lit(False)).alias("blank_differs"),
        F.coalesce(value_flag, F.lit(False)).alias("values_differ"),
        F.coalesce(median_flag, F.lit(False)).alias("median_differs"),
        F.coalesce(top_flag, F.lit(False)).alias("top_differs"),
    )


@dataclass(frozen=True)
class AnyValue:
    """A column without a domain: profiled, never violated."""

    column: str
    number = False

    def allows(self, v: Column) -> Column:
        return v.isNotNull()

    def mask_allows(self, m: Column) -> Column:
        return m.isNotNull()


#: fixed values: the domains of the road segment columns
ROAD_DOMAINS = (
    StateDomain("slope_state", ("FLAT", "MODERATE", "STEEP", "RISK", "UNKNOWN")),
    NumberDomain("width_meter", 0, 30),
    NumberDomain("avg_slope_percent", 0, 100),
    StateDomain("surface_state", ("PAVED", "UNPAVED", "UNKNOWN")),
)

ROAD_STATES = (*ROAD_DOMAINS, *map(AnyValue, ("walk_access", "braille_block_state", "audio_signal_state", "stairs_state", "width_state", "signal_state", "segment_type")))


def findings(segments: DataFrame, loads: DataFrame, domains: Sequence = ROAD_DOMAINS) -> DataFrame:
    """finding_kind (VALUE or LOAD), column_name, record_id."""
    counts = materialize(value_counts(segments, domains, "load_id"))
    values = violations(segments, domains, "edge_id", counts).where("edge_id is not null").select(F.lit("VALUE").alias("finding_kind"), "column_name", F.col("edge_id").alias("record_id")).distinct()
    flagged = divergence(segments, loads, domains, "load_id", counts).where("blank_differs or values_differ or median_differs or top_differs")
    return values.unionByName(flagged.select(F.lit("LOAD").alias("finding_kind"), "column_name", F.col("load_id").alias("record_id")))
