"""Matching records of two tables that share no key, by loopy belief propagation.

Candidate pairs come from blocks: the same building, and names alike. Every pair is compared on
names, branch, building, district, distance and category, each with a level for missing;
expectation-maximisation over the patterns of levels gives the log-odds of each pair. The pairs
then exchange messages with factors on both sides until no message moves by more than a tolerance.
A record of the right side has at most one partner: its factor makes a pair the less likely the more
its rivals claim the record. A record of the left side may have several: its factor halves the
weight of every partner beyond the first (MORE). Messages run through aggregations and joins on
the records; each pair's marginal probability is its confidence.

Blocks. A piece (two letters in a row) weighs the logarithm of how rare it is among all distinct
names. Two names are alike if the pieces they share weigh at least ALIKE of the heavier one. Alike
names share a key of the weighted prefix: of a name's pieces, rarest first, those from which on at
least ALIKE of its weight is left. So "public toilet" meets other plain "public toilet"s only, and a
name that merely ends in it is blocked on what sets it apart. Distinct names are joined, not records.

* same building, whatever the names;
* alike names, if at least one of the two has no building (other buildings contradict a match).

Every pair of a block is compared, far ones and those without a distance too: what is left out would
be missing from EM's patterns and among the rivals of other pairs. A key that many rows of both sides
share costs the product of their numbers; AQE splits its join.

EM sees only the table of patterns, whose size is the product of the levels. Messages are sums per
record, pre-aggregated map-side.

Defined results: records with neither name nor address are in no pair; repeated rows count once;
null components give the missing level; equal probabilities are decided by the lower ids; an empty
table on either side gives an empty table; other columns are not read. Propagation that does not
settle raises an error rather than giving unsettled figures.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfold.llm.address import em_weights, posterior
from wayfold.plans.runtime import materialize, release

ALIKE, MORE, STRENGTH = 0.5, 0.5, 100.0
#: fixed values: marks and notes that are not part of a name
NOTES = re.compile(r"\[[^\]]*\]|\([^)]*\)|㈜|주식회사|^구\)|(?:정문|후문|주차장 ?입구|입구)$")
BRANCH = re.compile(r"([가-힣]{1,4}?(?:역|본)?점)$")
PARTS = "record_id bigint, names array<string>, pieces array<string>, branch string"


#: fixed values: English words for kinds of places
KINDS = {"museum": "박물관", "observatory": "전망대", "park": "공원", "hotel": "호텔", "pharmacy": "약국", "cafe": "카페", "market": "시장", "toilet": "화장실", "restroom": "화장실", "hospital": "병원", "clinic": "의원", "library": "도서관", "center": "센터", "restaurant": "식당", "bakery": "제과", "bank": "은행", "motel": "모텔", "resort": "리조트", "arboretum": "수목원", "school": "학교", "dental": "치과", "office": "사무소"}
LATIN_WORD = re.compile(r"[a-z]{3,}")


def compact(name: str | None) -> str:
    """Letters and digits of a name without notes and marks."""
    if not name:
        return ""
    s = unicodedata.normalize("NFKC", name).lower().strip()
    for _ in range(3):
        s = NOTES.sub(" ", s).strip(" .·")
    s = LATIN_WORD.sub(lambda m: KINDS.get(m[0], m[0]), s)
    return re.sub(r"[^0-9a-z가-힣]", "", s)


def branch_of(name: str | None) -> str | None:
    """The branch that ends a name of several words or a long one."""
    if not name:
        return None
    words = unicodedata.normalize("NFKC", name)
    for _ in range(3):
        words = NOTES.sub(" ", words).strip(" .·")
    for w in words.split():
        if len(w) >= 3 and w.endswith("점") and BRANCH.fullmatch(w) and not w.endswith(("음식점", "반점", "주점")):
            return w
    m = re.search(r"([가-힣]{2}(?:역|본)?점)$", words)
    return m[1] if m and not words.endswith(("음식점", "반점", "주점")) and len(words) > 5 else None


def pieces(s: str) -> set[str]:
    return {s[i : i + 2] for i in range(len(s) - 1)} if len(s) > 1 else ({s} if s else set())


@lru_cache(maxsize=1 << 16)  # generic names come again in many pairs
def similarity(a: str, b: str) -> float:
    """0 to 1: best of the longest-blocks ratio and the overlap of pieces, which does not mind the words' order."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    short, long = sorted((a, b), key=len)
    if len(short) <= 5 and len(long) >= len(short) + 2 and (long.endswith(short) or long.startswith(short)):
        return 0.45  # a bare kind of place is not the name of one
    x, y = pieces(a), pieces(b)
    dice = 2 * len(x & y) / (len(x) + len(y))
    ca, cb = sorted(a), sorted(b)
    bag = SequenceMatcher(None, ca, cb, autojunk=False).ratio() if dice > 0.3 else 0.0
    return max(dice, SequenceMatcher(None, a, b, autojunk=False).ratio(), 0.95 * bag if dice >= 0.6 else 0.0)


def described(df: DataFrame, id_col: str, name_cols: list[str]) -> DataFrame:
    """record_id, names (compact, distinct), pieces of all of them, branch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                raw = row[1:]
                names = list(dict.fromkeys(c for c in map(compact, raw) if c))
                branch = next((x for x in map(branch_of, raw) if x), None)
                out.append((row[0], names, sorted(set().union(*map(pieces, names))) if names else [], branch))
            yield pd.DataFrame(out, columns=["record_id", "names", "pieces", "branch"])

    cols = [F.col(id_col).cast("bigint").alias("record_id"), *[F.col(c).alias(f"n{i}_") for i, c in enumerate(name_cols)]]
    return df.select(*cols).mapInPandas(run, PARTS)


def name_pieces(df: DataFrame, name: str = "name") -> DataFrame:
    """Rows of df with each distinct piece of the name; a name of one letter is its own piece."""
    n = F.length(name)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(F.col(name), i, F.lit(2)))
    return df.where(n > 0).withColumn("piece", F.explode(F.array_distinct(cut)))


def prefix_keys(names: DataFrame, alike: float = ALIKE) -> DataFrame:
    """name, piece, weight, total: the pieces of each distinct name by which alike names are found, and all names' weights."""
    each = name_pieces(names.select("name").distinct())
    df = each.groupBy("piece").agg(F.count("*").alias("df"))
    n = names.select("name").distinct().agg(F.count("*").alias("n_names"))
    weighed = each.join(df.crossJoin(F.broadcast(n)).select("piece", F.log1p(F.col("n_names") / F.col("df")).alias("weight")), "piece")  # n_names is one row
    by_name = W.partitionBy("name")
    rest = F.sum("weight").over(by_name.orderBy(F.desc("weight"), "piece").rowsBetween(W.currentRow, W.unboundedFollowing))
    return weighed.withColumn("rest", rest).withColumn("total", F.sum("weight").over(by_name)).withColumn("is_key", F.col("rest") >= alike * F.col("total") - 1e-9)


def alike_names(left: DataFrame, right: DataFrame, weighed: DataFrame, alike: float = ALIKE) -> DataFrame:
    """(name_l, name_r) of the names of both sides (column name) whose shared pieces weigh enough."""
    def keys(side: DataFrame, mark: str, only: bool) -> DataFrame:
        w = weighed.where("is_key") if only else weighed
        return side.select("name").distinct().join(w, "name").select(F.col("name").alias(f"name_{mark}"), "piece", "weight", F.col("total").alias(f"total_{mark}"))

    met = keys(left, "l", True).join(keys(right, "r", True).drop("weight"), "piece").select("name_l", "name_r", "total_l", "total_r").distinct()
    both = met.join(keys(left, "l", False).drop("total_l"), "name_l").join(keys(right, "r", False).select("name_r", "piece"), ["name_r", "piece"])
    shared = both.groupBy("name_l", "name_r", "total_l", "total_r").agg(F.sum("weight").alias("shared"))
    return shared.where(F.col("shared") >= alike * F.greatest("total_l", "total_r") - 1e-9).select("name_l", "name_r")


def keyed_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left_id, right_id) of all rows with equal key. Both sides: key, record_id."""
    mine = lambda df, side: df.select("key", F.col("record_id").alias(side)).distinct()
    return mine(left, "left_id").join(mine(right, "right_id"), "key").select("left_id", "right_id").distinct()


def candidate_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left_id, right_id) from all blocks. Both sides: record_id, names, buildings."""

    def forms(df: DataFrame) -> DataFrame:
        rows = df.select("record_id", "buildings", F.explode("names").alias("name"))
        return materialize(rows.distinct())

    fl, fr = forms(left), forms(right)
    weighed = materialize(prefix_keys(fl.select("name").unionByName(fr.select("name"))))
    out = []
    unplaced, any_ = F.size("buildings") == 0, F.lit(True)
    for which_l, which_r in ((any_, unplaced), (unplaced, ~unplaced)):
        a, b = fl.where(which_l), fr.where(which_r)
        met = alike_names(a, b, weighed)
        rows = b.join(met, F.col("name") == F.col("name_r")).select(F.col("name_l").alias("key"), "record_id")
        out.append(materialize(keyed_pairs(a.select(F.col("name").alias("key"), "record_id"), rows)))
    housed = lambda df: df.withColumn("b", F.explode("buildings"))
    # the same building whatever the names holds the pairs of one building and alike names
    out.append(materialize(keyed_pairs(housed(left).withColumnRenamed("b", "key"), housed(right).withColumnRenamed("b", "key"))))
    return reduce(DataFrame.unionByName, out).distinct()


# Levels of the components, with first guesses of their probabilities among matches and others.
# Pairs of one building and pairs of which a record has no building are estimated apart: among
# others, tenants of one building have unlike names, while the names of the second kind are alike,
# as they are blocked on them. So neither estimate depends on how many pairs the other kind has.
#: name: 0.97, 0.85, 0.7, 0.5, less, missing
NAME_MATCH = [0.56, 0.26, 0.13, 0.035, 0.001, 0.014]
NAME_OTHER = {True: [0.01, 0.01, 0.03, 0.08, 0.8, 0.07], False: [0.05, 0.05, 0.2, 0.5, 0.15, 0.05]}
#: branch: agree, one or none given, differ; district: agree, missing, differ; distance: within 1.5 m, 12 m, missing, more; category: agree, missing, differ
MATCH = [NAME_MATCH, [0.28, 0.7, 0.02], [0.88, 0.11, 0.01], [0.66, 0.08, 0.25, 0.01], [0.88, 0.04, 0.08]]
OTHER = {k: [v, [0.05, 0.75, 0.2], [0.5, 0.15, 0.35], [0.03, 0.2, 0.22, 0.55], [0.25, 0.05, 0.7]] for k, v in NAME_OTHER.items()}


def compare_pairs(pairs: DataFrame) -> DataFrame:
    """left_id, right_id, same_building, the levels of the five components; pairs has both sides' columns with _l and _r."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for p in b.itertuples(index=False):
                s = max((similarity(x, y) for x in p.names_l for y in p.names_r), default=-1.0)
                name = 5 if s < 0 else 0 if s >= 0.97 else 1 if s >= 0.85 else 2 if s >= 0.7 else 3 if s >= 0.5 else 4
                if p.branch_l and p.branch_r:
                    branch = 0 if similarity(p.branch_l, p.branch_r) >= 0.6 or p.branch_l in p.branch_r or p.branch_r in p.branch_l else 2
                else:
                    branch = 1
                same = not set(p.buildings_l).isdisjoint(p.buildings_r)
                district = 1 if not p.district_l or not p.district_r else 0 if p.district_l == p.district_r else 2
                gap = abs(p.metres_l - p.metres_r) if p.metres_l == p.metres_l and p.metres_r == p.metres_r and p.metres_l is not None and p.metres_r is not None else None
                distance = 2 if gap is None else 0 if gap <= 1.5 else 1 if gap <= 12 else 3
                category = 1 if not p.category_l or not p.category_r else 0 if p.category_l == p.category_r else 2
                rows.append((p.left_id, p.right_id, s, same, name, branch, district, distance, category))
            yield pd.DataFrame(rows, columns=["left_id", "right_id", "name_similarity", "same_building", "l0", "l1", "l2", "l3", "l4"])

    return pairs.mapInPandas(run, "left_id bigint, right_id bigint, name_similarity double, same_building boolean, l0 int, l1 int, l2 int, l3 int, l4 int")


@dataclass(frozen=True)
class Settled:
    """How propagation ended: rounds, and the largest change of a message in the last one."""

    rounds: int
    largest_change: float


def propagate(pairs: DataFrame, left_more: float = MORE, tolerance: float = 1e-3, rounds: int = 200) -> tuple[DataFrame, Settled]:
    """Marginals of pairs (left_id, right_id, log_odds) under a factor on every record of either side.

    The right factor allows one partner: it tells a pair -log(1 + sum of exp of its rivals'
    messages). The left factor weighs n partners left_more ** (n - 1), so that with odds o of the
    rivals, d being the product of 1 - p over that of 1 - (1 - left_more) p, it tells a pair
    log(left_more) - log(1 - (1 - left_more) d). A pair tells a factor its own log-odds and what its
    other factor said. Messages are damped from round 20 on, by half, later by more. It ends when no
    message moves by more than the tolerance; if it has not within so many rounds it raises.
    """
    state = materialize(pairs.select("left_id", "right_id", "log_odds", F.lit(0.0).alias("from_left"), F.lit(0.0).alias("from_right")))
    for done in range(1, rounds + 1):
        keep = 0.0 if done < 20 else 0.5 if done < 60 else 0.8
        to_right = F.exp(F.least(F.col("log_odds") + F.col("from_left"), F.lit(60.0)))
        to_left = F.exp(F.least(F.col("log_odds") + F.col("from_right"), F.lit(60.0)))
        none_, few = -F.log1p(to_left), F.log1p(left_more * to_left) - F.log1p(to_left)
        right = state.groupBy("right_id").agg(F.sum(to_right).alias("claims"))
        left = state.groupBy("left_id").agg(F.sum(none_).alias("none"), F.sum(few).alias("few"))
        new = state.join(right, "right_id").join(left, "left_id")
        d = F.exp(F.least(F.col("none") - none_ - F.col("few") + few, F.lit(0.0)))
        heard_left = F.lit(math.log(left_more)) - F.log(1 - (1 - left_more) * d)
        heard_right = -F.log1p(F.greatest(F.col("claims") - to_right, F.lit(0.0)))
        new = new.select("left_id", "right_id", "log_odds", (keep * F.col("from_left") + (1 - keep) * heard_left).alias("new_left"), (keep * F.col("from_right") + (1 - keep) * heard_right).alias("new_right"), F.greatest(F.abs(heard_left - F.col("from_left")), F.abs(heard_right - F.col("from_right"))).alias("moved"))
        before, state = state, materialize(new.select("left_id", "right_id", "log_odds", F.col("new_left").alias("from_left"), F.col("new_right").alias("from_right"), "moved"))
        release(before)
        change = state.agg(F.max("moved")).first()[0] or 0.0
        if change <= tolerance:
            total = F.col("log_odds") + F.col("from_left") + F.col("from_right")
            return state.withColumn("probability", 1 / (1 + F.exp(-total))).drop("moved"), Settled(done, float(change))
    raise RuntimeError(f"messages still move by {change} after {rounds} rounds")


def match(left: DataFrame, right: DataFrame) -> tuple[DataFrame, Settled]:
    """left_id, right_id, probability of every candidate pair, and how propagation ended.

    Both sides have one row a record: record_id, names, branch, buildings array, road, district,
    metres, category.
    """
    left, right = materialize(left), materialize(right)
    pairs = candidate_pairs(left, right)
    mark = lambda df, s: df.select(*[F.col(c).alias(f"{c}_{s}" if c != "record_id" else ("left_id" if s == "l" else "right_id")) for c in df.columns])
    compared = materialize(compare_pairs(pairs.join(mark(left, "l"), "left_id").join(mark(right, "r"), "right_id")))
    levels = [f"l{i}" for i in range(len(MATCH))]
    rows = compared.groupBy("same_building", *levels).count().collect()  # at most twice the product of the levels: 1296
    if not rows:
        empty = left.sparkSession.createDataFrame([], "left_id bigint, right_id bigint, probability double, log_odds double, name_similarity double, same_building boolean, " + ", ".join(f"{x} int" for x in levels))
        return empty, Settled(0, 0.0)
    table = []
    for kind in (True, False):
        own = [r for r in rows if r[0] == kind]
        if own:
            patterns, counts = np.array([r[1:-1] for r in own]), np.array([r[-1] for r in own], float)
            prior, m, u = em_weights(patterns, counts, MATCH, OTHER[kind], strength=STRENGTH, anchored=(0,))
            odds = np.log(prior) - np.log1p(-prior) + sum(np.log(m[j][patterns[:, j]]) - np.log(u[j][patterns[:, j]]) for j in range(len(m)))
            table += [(kind, *map(int, p), float(o)) for p, o in zip(patterns, odds)]
    weights = left.sparkSession.createDataFrame(table, "same_building boolean, " + ", ".join(f"{x} int" for x in levels) + ", log_odds double")
    told, settled = propagate(compared.join(F.broadcast(weights), ["same_building", *levels]))
    return told.join(compared, ["left_id", "right_id"]).select("left_id", "right_id", "probability", "log_odds", "name_similarity", "same_building", *levels), settled


def decide(marginals: DataFrame, left_once: bool = False, right_once: bool = True, accept: float = 0.5) -> DataFrame:
    """Pairs with a marginal of at least accept; on a side with one partner the best, ties to the lower id."""
    out = marginals.where(F.col("probability") >= accept)
    for side, other, once in (("left_id", "right_id", left_once), ("right_id", "left_id", right_once)):
        if once:
            best = out.groupBy(side).agg(F.max_by(other, F.struct("probability", "name_similarity", -F.col(other))).alias(other))
            out = out.join(best, [side, other])
    return out
