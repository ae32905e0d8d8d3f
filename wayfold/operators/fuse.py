"""Aggregations and fills that bring attributes of several sources onto one record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfold.functions.text import is_unknown
from wayfold.plans.runtime import materialize


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """One row a key, the first in the given order, by a map-side combinable minimum."""
    rest = [c for c in df.columns if c not in keys]
    names = [f"o{i}_" for i in range(len(order))]
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    packed = F.min(F.struct(*[c.alias(n) for c, n in zip(cols, names)], F.struct(*rest).alias("row_"))).alias("m_")
    return df.groupBy(*keys).agg(packed).select(*keys, "m_.row_.*")


def top_k(df: DataFrame, keys: Sequence[str], k: int, *order: Column) -> DataFrame:
    """At most k rows a key; Spark limits each partition before the shuffle."""
    return df.withColumn("rank_", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank_") <= k).drop("rank_")


def majority(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """Most frequent known value a key; of equally frequent ones the one seen first by order."""
    counted = df.where(~is_unknown(F.col(value))).groupBy(*keys, value).agg(F.count("*").alias("n_"), F.min(order).alias("first_"))
    return counted.groupBy(*keys).agg(F.min(F.struct(-F.col("n_"), "first_", value))[value].alias(value), F.max("n_").alias("votes"))


def medians(df: DataFrame, keys: Sequence[str], value: str, digits: int = 2) -> DataFrame:
    return df.groupBy(*keys).agg(F.round(F.median(value), digits).alias(value))


def fill_unknown(target: Column, *sources: Column) -> Column:
    """The target, or else the first known source in the given order."""
    out = F.coalesce(*[F.when(~is_unknown(s), s) for s in sources], target)
    return F.when(is_unknown(target), out).otherwise(target)


def coverage(df: DataFrame, groups: dict[str, Sequence[str]]) -> DataFrame:
    """attribute, n_rows, n_unknown, filled_rate; a group is unknown if any of its columns is."""
    flags = {g: F.count_if(F.exists(F.array(*[is_unknown(F.col(c).cast("string")) for c in cs]), lambda x: x)).alias(g) for g, cs in groups.items()}
    one = df.agg(F.count("*").alias("n_rows"), *flags.values())
    items = F.explode(F.array(*[F.struct(F.lit(g).alias("attribute"), F.col(g).alias("n_unknown")) for g in groups])).alias("i")
    return one.select("n_rows", items).select("i.attribute", "n_rows", "i.n_unknown", F.round((F.col("n_rows") - F.col("i.n_unknown")) / F.col("n_rows"), 6).alias("filled_rate"))


def count_groupings(df: DataFrame, groupings: Sequence[Sequence[str]]) -> DataFrame:
    """(grouping, name, n): several groupings counted in one pass with grouping sets."""
    columns = list(dict.fromkeys(c for g in groupings for c in g))
    marked = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("(none)")).alias(c) for c in columns])
    sets = [[F.col(c) for c in g] for g in groupings]
    agg = marked.groupingSets(sets, *columns).agg(F.count("*").alias("n"), F.grouping_id(*columns).alias("gid"))
    name, label = F.lit(None).cast("string"), F.lit(None).cast("string")
    for g in groupings:
        gid = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in g)
        label = F.when(F.col("gid") == gid, F.lit("*".join(g))).otherwise(label)
        name = F.when(F.col("gid") == gid, F.concat_ws(" / ", *g)).otherwise(name)
    return agg.select(label.alias("grouping"), name.alias("name"), "n")


def gap_clusters(df: DataFrame, keys: Sequence[str], position: str, gap: float) -> DataFrame:
    """cluster_ number of each row: a new cluster starts where the position rises by more than gap."""
    w = W.partitionBy(*keys).orderBy(position)
    new = F.when(F.col(position) - F.lag(position).over(w) > gap, 1).otherwise(0)
    return df.withColumn("new_", new).withColumn("cluster_", F.sum("new_").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("new_")


def scope_replace(base: DataFrame, replacement: DataFrame, inside: Column) -> DataFrame:
    """Base rows outside the scope with replacement rows inside it."""
    return base.where(~F.coalesce(inside, F.lit(False))).unionByName(replacement.where(inside))


def renumber(df: DataFrame, new_id: str, *order: str) -> DataFrame:
    """Dense numbers from 1 in the given total order, without one global window.

    Rows are range-partitioned and written with the number of their partition, ranked within it, and
    shifted by the counts of the partitions before; the counts are one row a partition. They are
    written because a range exchange that is planned twice may draw other bounds the second time.
    """
    parts = materialize(df.repartitionByRange(*order).withColumn("part_", F.spark_partition_id()))
    sizes = parts.groupBy("part_").agg(F.count("*").alias("size_"))
    offsets = sizes.withColumn("from_", F.sum("size_").over(W.orderBy("part_").rowsBetween(W.unboundedPreceding, -1))).select("part_", F.coalesce("from_", F.lit(0)).alias("from_"))
    ranked = parts.withColumn("in_part_", F.row_number().over(W.partitionBy("part_").orderBy(*order)))
    return ranked.join(F.broadcast(offsets), "part_").withColumn(new_id, F.col("from_") + F.col("in_part_")).drop("part_", "in_part_", "from_")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows over old ones with the same key."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)


def positional_diff(a: DataFrame, b: DataFrame, order: str) -> DataFrame:
    """order and both rows as JSON wherever they differ."""
    js = lambda df, n: df.select(order, F.to_json(F.struct(*[c for c in df.columns if c != order])).alias(n))
    return js(a, "left_row").join(js(b, "right_row"), order, "full").where(~F.col("left_row").eqNullSafe(F.col("right_row")))


def neighbour_median(edges: DataFrame, edge: str, ends: Sequence[str], value: str, digits: int = 4) -> DataFrame:
    """edge, filled: for edges without value the median of the measured edges that share an end, each counted once.

    Measured values are put together by node first, as counts of distinct values. An edge without
    value takes the counts of both its ends, less those of measured edges that have the same two
    ends, which both ends counted. So a hot node costs its distinct values, not its edges, for each
    edge that lacks a value.
    """
    a, b = ends
    ok = edges.select(F.col(edge).alias("edge_"), F.least(a, b).alias("p_"), F.greatest(a, b).alias("q_"), F.col(value).alias("v_"), F.array_distinct(F.array(a, b)).alias("nodes_"))
    ok = ok.withColumn("both_", F.col("p_").isNotNull() & (F.size(F.filter("nodes_", lambda n: n.isNotNull())) == 2))
    known, blank = ok.where(F.col("v_").isNotNull()), ok.where(F.col("v_").isNull())
    at_node = known.select(F.explode("nodes_").alias("n_"), "v_").groupBy("n_", "v_").agg(F.count("*").alias("k_"))
    twice = known.where("both_").groupBy("p_", "q_", "v_").agg(F.count("*").alias("k_"))
    near = blank.select("edge_", F.explode("nodes_").alias("n_")).join(at_node, "n_").select("edge_", "v_", "k_")
    less = blank.where("both_").select("edge_", "p_", "q_").join(twice, ["p_", "q_"]).select("edge_", "v_", (-F.col("k_")).alias("k_"))
    counts = near.unionByName(less).groupBy("edge_", "v_").agg(F.sum("k_").alias("k_")).where("k_ > 0")
    return counts.groupBy(F.col("edge_").alias(edge)).agg(F.round(F.expr("percentile(v_, 0.5D, k_)"), digits).alias("filled"))


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, forward: bool = False, chunk_rows: int = 1_000_000) -> DataFrame:
    """Each left row with the latest right row not after it (or the earliest not before it).

    Both sides are one sequence ordered by key, time and side, cut into ranges of rows that are
    written with their number; each range is filled within itself, and what its start lacks comes from the
    last right row of the ranges before, one row a range. So a key with a third of all rows is
    spread over as many tasks as its rows need. Column names of both sides must differ but for the keys.
    """
    rest = [c for c in right.columns if c not in keys]
    lc = [c for c in left.columns if c not in keys]
    r_type, l_type = right.select(F.struct(*rest).alias("r")).schema["r"].dataType, left.select(F.struct(*lc).alias("l")).schema["l"].dataType
    first_side = 1 if not forward else 0
    a = left.select(*keys, F.col(left_time).alias("t_"), F.lit(first_side).alias("side_"), F.struct(*lc).alias("l_"), F.lit(None).cast(r_type).alias("r_"))
    b = right.select(*keys, F.col(right_time).alias("t_"), F.lit(1 - first_side).alias("side_"), F.lit(None).cast(l_type).alias("l_"), F.struct(*rest).alias("r_"))
    both = a.unionByName(b)
    shuffles = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(shuffles, -(-both.count() // chunk_rows))
    # the hash breaks ties of one key and time, so that many equal rows can be cut apart, too
    rows = materialize(both.withColumn("tie_", F.xxhash64("l_", "r_")).repartitionByRange(n, *keys, "t_", "side_", "tie_").withColumn("part_", F.spark_partition_id()))
    w = W.partitionBy("part_", *keys).orderBy("t_", "side_", "tie_")
    if not forward:
        own, edge, before = F.last("r_", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)), F.max, W.unboundedPreceding
    else:
        own, edge, before = F.first("r_", ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing)), F.min, W.unboundedFollowing
    # the last (first) right row of each key and range, carried to the ranges after (before): at most a row a key and range
    carried = rows.where("r_ is not null").groupBy(*keys, "part_").agg(edge(F.struct("t_", "side_", "tie_", "r_")).r_.alias("end_"))
    spots = rows.select(*keys, "part_").distinct().join(carried, [*keys, "part_"], "left")
    across = W.partitionBy(*keys).orderBy("part_")
    got = F.last("end_", ignorenulls=True).over(across.rowsBetween(before, -1)) if not forward else F.first("end_", ignorenulls=True).over(across.rowsBetween(1, before))
    spots = spots.withColumn("from_", got).select(*keys, "part_", "from_")
    return rows.withColumn("own_", own).where("l_ is not null").join(spots, [*keys, "part_"]).withColumn("p_", F.coalesce("own_", "from_")).select(*keys, "l_.*", "p_.*")
