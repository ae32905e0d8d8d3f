"""Filling containers of fixed capacity with items of whole-number sizes.

Linear grouping. Items above small_share of the capacity are large. Sorted by size they are cut
into groups of equal cardinality, and each is rounded up to the largest of its group. The few-size
problem that is left is solved by column generation: the linear programme's patterns are priced by
a knapsack over the capacity, used a whole number of times, and what rounding leaves over is packed
greedily. Real items then take the slots of their group, and the small items are put, by best fit,
into the room that is left, new containers being opened only if none has room.

Only the histogram of large sizes comes to the driver: at most as many rows as the capacity has
units, whatever the number of items. Ranks within a group are taken in salted parts with offsets,
so a size that a third of all items share is ranked by many tasks. Best fit runs in shards of
shard_items items and containers at most; each shard can waste room in its last container only.

Defined results: an item above the capacity is cut into full containers and a rest, and only such
an item is cut; items of size 0 are spread over the containers (container 0 if there is none); a
null size counts as 0; repeated ids are separate items; an empty table gives an empty table.
"""

from __future__ import annotations

import warnings

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfold.plans.runtime import materialize, salts_for

GROUPS = 24
SMALL_SHARE = 0.125
SHARD_ITEMS = 100_000
SCHEMA = "container_id bigint, item_id bigint, part_no bigint, size bigint"


def linear_groups(sizes: np.ndarray, counts: np.ndarray, k: int, capacity: int) -> list[tuple[int, int, int, int]]:
    """(group, low, high, n): sizes low..high, all of a size in one group, about equal numbers of items, largest first.

    A group ends where rounding up would cost a place: at a half, a third and so on of the capacity;
    and a size that fills a group by itself gets its own.
    """
    order = np.argsort(-sizes)
    sizes, counts = sizes[order], counts[order]
    quota, out, start, have = max(1.0, counts.sum() / k), [], 0, 0

    def close(end: int) -> None:
        nonlocal start, have
        if have:
            out.append((len(out), int(sizes[end]), int(sizes[start]), have))
        start, have = end + 1, 0

    for i in range(len(sizes)):
        if have and (counts[i] >= quota or capacity // int(sizes[start]) != capacity // int(sizes[i])):
            close(i - 1)
        have += int(counts[i])
        if have >= quota or i == len(sizes) - 1:
            close(i)
    return out


def knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best unbounded knapsack: value and how often each size is used."""
    order = np.argsort(sizes)
    s, v = sizes[order], values[order]
    best = np.zeros(capacity + 1)
    used = np.full(capacity + 1, -1)
    upto = np.searchsorted(s, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        n = upto[c]
        best[c] = best[c - 1]
        if n:
            cand = best[c - s[:n]] + v[:n]
            i = int(cand.argmax())
            if cand[i] > best[c] + 1e-12:
                best[c], used[c] = cand[i], i
    pattern, c = np.zeros(len(s), dtype=np.int64), capacity
    while c > 0:
        if used[c] < 0:
            c -= 1
        else:
            pattern[order[used[c]]] += 1
            c -= s[used[c]]
    return float(best[capacity]), pattern


def few_size_patterns(sizes: np.ndarray, need: np.ndarray, capacity: int, rounds: int = 2000) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used, covering need: column generation, then rounding down and greedy repair."""
    k = len(sizes)
    basis = np.zeros((k, k))
    for i in range(k):
        basis[i, i] = capacity // sizes[i]
    x = need / np.diag(basis)
    for _ in range(rounds):
        inverse = np.linalg.pinv(basis) if np.linalg.matrix_rank(basis) < k else np.linalg.inv(basis)
        value, pattern = knapsack(sizes, np.maximum(inverse.sum(axis=0), 0), capacity)
        if value <= 1 + 1e-7:
            break
        direction = inverse @ pattern
        x = inverse @ need
        ratio = np.where(direction > 1e-9, np.maximum(x, 0) / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = pattern
    else:
        warnings.warn(f"patterns still improve after {rounds} rounds; more containers than needed may be used", stacklevel=2)
    x = np.linalg.lstsq(basis, need.astype(float), rcond=None)[0]
    left, plan = need.copy(), []
    for j in range(k):
        pattern = basis[:, j].astype(np.int64)
        times = int(np.floor(max(x[j], 0) + 1e-6))
        times = min([times, *(int(left[i] // pattern[i]) for i in range(k) if pattern[i])])
        if times > 0 and pattern.any():
            plan.append((pattern, times))
            left = left - pattern * times
    order = np.argsort(-sizes)
    while left.any():  # first fit decreasing by whole patterns: each pass empties a group or fills a container
        pattern, room = np.zeros(k, dtype=np.int64), capacity
        for i in order:
            n = min(int(left[i]), room // int(sizes[i]))
            pattern[i], room = n, room - n * int(sizes[i])
        times = min(int(left[i] // pattern[i]) for i in range(k) if pattern[i])
        plan.append((pattern, times))
        left = left - pattern * times
    return plan


class Rooms:
    """Containers by free room, with the smallest sufficient room found as the lowest set bit of the rooms in use."""

    def __init__(self):
        self.by_room: dict[int, list[int]] = {}
        self.summary = 0

    def put(self, room: int, container: int) -> None:
        if room > 0:
            if not self.by_room.setdefault(room, []):
                self.summary |= 1 << room
            self.by_room[room].append(container)

    def take(self, size: int) -> tuple[int, int] | None:
        above = self.summary >> size
        if not above:
            return None
        room = size + (above & -above).bit_length() - 1
        container = self.by_room[room].pop()
        if not self.by_room[room]:
            self.summary &= ~(1 << room)
        return room, container


def best_fit(ids: np.ndarray, rooms: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Container of each item, sizes taken in falling order; new containers are numbered from -1 down. Also their number."""
    r = Rooms()
    for c, room in zip(ids.tolist(), rooms.tolist()):
        r.put(room, c)
    out, opened = np.empty(len(sizes), dtype=np.int64), 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = r.take(size)
        if found is None:
            opened += 1
            found = capacity, -opened
        out[i] = found[1]
        r.put(found[0] - size, found[1])
    return out, opened


def _ranked(items: DataFrame, key: str, per_task: int = 200_000) -> DataFrame:
    """rank_ of each row within its key, from 0, taken in salted parts so that no task ranks a whole hot key."""
    total = items.count()
    salts = salts_for(total, per_task)
    items = items.withColumn("salt_", F.pmod(F.xxhash64("item_id", "part_no"), F.lit(salts)))
    sizes = items.groupBy(key, "salt_").agg(F.count("*").alias("n_"))
    offsets = sizes.withColumn("from_", F.sum("n_").over(W.partitionBy(key).orderBy("salt_").rowsBetween(W.unboundedPreceding, 0)) - F.col("n_")).drop("n_")
    mine = F.row_number().over(W.partitionBy(key, "salt_").orderBy(F.desc("size"), "item_id", "part_no")) - 1
    return items.withColumn("r_", mine).join(offsets, [key, "salt_"]).withColumn("rank_", F.col("from_") + F.col("r_")).drop("salt_", "r_", "from_")


def pack(items: DataFrame, capacity: int, id_col: str = "doc_id", size_col: str = "n_tokens", groups: int = GROUPS, small_share: float = SMALL_SHARE, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """container_id, item_id, part_no, size: every item, or every part of an item above the capacity, in one container."""
    spark = items.sparkSession
    sized = items.select(F.col(id_col).cast("bigint").alias("item_id"), F.coalesce(F.col(size_col).cast("bigint"), F.lit(0)).alias("size"))
    count = F.ceil(F.col("size") / capacity).cast("bigint")
    parts = sized.select("item_id", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(count - 1, F.lit(0)))).alias("part_no"))
    parts = materialize(parts.select("item_id", "part_no", F.least(F.col("size") - F.col("part_no") * capacity, F.lit(capacity)).cast("bigint").alias("size")))
    full = parts.where(F.col("size") == capacity)
    open_ = parts.where((F.col("size") > 0) & (F.col("size") < capacity))
    limit = int(capacity * small_share)
    # full containers
    n_full = full.count()
    done = _ranked(full.withColumn("one_", F.lit(0)), "one_").select(F.col("rank_").cast("bigint").alias("container_id"), "item_id", "part_no", "size") if n_full else spark.createDataFrame([], SCHEMA)
    base = n_full
    # large items
    hist = open_.where(F.col("size") > limit).groupBy("size").count().collect()  # at most capacity rows
    if hist:
        grouped = linear_groups(np.array([r[0] for r in hist]), np.array([r[1] for r in hist]), groups, capacity)
        rounded, need = np.array([g[2] for g in grouped]), np.array([g[3] for g in grouped])
        plan = few_size_patterns(rounded, need, capacity)
        slots: dict[int, list] = {g[0]: [] for g in grouped}
        upto = [0] * len(grouped)
        for pattern, times in plan:
            for i in np.flatnonzero(pattern).tolist():
                slots[i].append((upto[i], upto[i] + int(pattern[i]) * times, int(pattern[i]), base))
                upto[i] += int(pattern[i]) * times
            base += times
        slot_rows = [(g, *row) for g, rows in slots.items() for row in rows]  # groups x patterns, both bounded by the parameter
        slot_df = spark.createDataFrame(slot_rows, "group_ int, lo_ bigint, hi_ bigint, each_ bigint, base_ bigint")
        group_of = F.lit(None).cast("int")
        for g, low, high, _ in grouped:
            group_of = F.when(F.col("size").between(low, high), F.lit(g)).otherwise(group_of)
        large = _ranked(open_.where(F.col("size") > limit).withColumn("group_", group_of), "group_")
        placed = large.join(F.broadcast(slot_df), "group_").where("rank_ >= lo_ and rank_ < hi_")
        placed = placed.select((F.col("base_") + F.floor((F.col("rank_") - F.col("lo_")) / F.col("each_"))).cast("bigint").alias("container_id"), "item_id", "part_no", "size")
    else:
        placed = spark.createDataFrame([], SCHEMA)
    placed = materialize(placed)
    # small items: best fit in shards
    small = open_.where(F.col("size") <= limit)
    room = placed.groupBy("container_id").agg((F.lit(capacity) - F.sum("size")).alias("room")).where("room > 0")
    shards = salts_for(small.count() + room.count(), shard_items)
    events = small.select(F.lit(False).alias("is_room"), F.col("item_id"), "part_no", "size").unionByName(room.select(F.lit(True).alias("is_room"), F.col("container_id").alias("item_id"), F.lit(0).cast("bigint").alias("part_no"), F.col("room").alias("size")))
    events = events.withColumn("shard", F.pmod(F.xxhash64("is_room", "item_id", "part_no"), F.lit(shards)).cast("int"))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        rooms, mine = pdf[pdf.is_room], pdf[~pdf.is_room].sort_values(["size", "item_id", "part_no"], ascending=[False, True, True])
        rooms = rooms.sort_values("item_id", ascending=False)
        at, _ = best_fit(rooms.item_id.to_numpy(), rooms["size"].to_numpy(), mine["size"].to_numpy(), capacity)
        shard = int(pdf.shard.iloc[0])
        at = np.where(at < 0, base + (-at - 1) * shards + shard, at)  # new numbers of different shards never meet
        return pd.DataFrame({"container_id": at, "item_id": mine.item_id.to_numpy(), "part_no": mine.part_no.to_numpy(), "size": mine["size"].to_numpy()})

    fitted = events.groupBy("shard").applyInPandas(fill, SCHEMA)
    packed = materialize(done.unionByName(placed).unionByName(fitted))
    zero = parts.where("size = 0")
    if zero.isEmpty():
        return packed
    have = packed.agg(F.min("container_id"), F.max("container_id")).first()  # every number from 0 to base - 1 is in use
    spread = F.pmod(F.xxhash64("item_id"), F.lit(base)) if base else F.lit(have[0] or 0)
    return packed.unionByName(zero.select(spread.cast("bigint").alias("container_id"), "item_id", "part_no", "size"))


def summary(packed: DataFrame, capacity: int) -> DataFrame:
    """containers, parts, tokens, the least number of containers that the volume allows, and the share of unused space."""
    per = packed.groupBy("container_id").agg(F.sum("size").alias("used"), F.count("*").alias("n"))
    total = per.agg(F.count("*").alias("containers"), F.sum("n").alias("parts"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"))
    return total.withColumn("least_containers", F.ceil(F.col("tokens") / capacity)).withColumn("unused_share", 1 - F.col("tokens") / (F.col("containers") * capacity))
