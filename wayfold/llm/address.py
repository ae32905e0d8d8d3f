"""Postal addresses of the same building written differently.

An address is taken apart into road, side street, building number and sub-number, district and
postcode, whatever its order, separators, digits' width, spelling of the side street, or script.

Spellings. Distinct road spellings are blocked on street-sound keys (any two of a name's syllables
with their sounds coarsened), compared on components (letters that differ, support, district,
postcodes, each with a level for missing), and weighed by expectation-maximisation over the patterns
of agreement levels. A spelling goes to the better supported one that it most probably stands for.

Records. Records are blocked on the canonical building and compared on district, postcode and the
spelling of the road, each with a level for missing; EM over the patterns of all pairs, counted by
groups of records that are alike in them, gives each pair the probability that both are in one
building. So roads of one name in two districts that postcodes keep apart are two buildings.

Scale: parsing is one Arrow pass; spellings, not records, are compared with each other, counted
map-side; EM sees only tables of patterns, whose size is the product of the components' levels.
Record pairs are an equi-join on the building, whose hot keys AQE splits; their number is the
result's own.

Defined results: null, blank or garbled addresses and addresses without a building number are in
no pair; repeated rows count once; a very long address is parsed whole; of several numbers the one
after the road counts; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm.mojibake import SUSPECT, repair
from wayfold.operators import graph
from wayfold.plans.runtime import materialize

#: fixed values: romanised initials, vowels and finals of Hangul in code point order
INITIALS = "g kk n d tt r m b pp s ss  j jj ch k t p h".split(" ")
VOWELS = "a ae ya yae eo e yeo ye o wa wae oe yo u wo we wi yu eu ui i".split(" ")
FINALS = " k k k n n n t l k m l l l p l m p p t t ng t t k t p t".split(" ")

DIGITS = str.maketrans(dict(zip("０１２３４５６７８９", "0123456789")) | dict.fromkeys("－–—‐‑−~～", "-") | {"＃": "#"} | dict.fromkeys("　\xa0_·ㆍ•,/", " "))
KOREAN = re.compile(r"([가-힣]+)\s*로\s*(?:(\d+)\s*번?\s*길)?\s*(?:#|no\.?)?\s*(\d+)(?!\d)(?:\s*(?:-|의)\s*(\d+))?(?!\s*번?\s*길(?![가-힣]))", re.I)
KOREAN_BACK = re.compile(r"(\d+)(?:\s*(?:-|의)\s*(\d+))?(?:\s*번지?)?\s+([가-힣]+)\s*로\s*(?:(\d+)\s*번?\s*길)?")
GLUED = re.compile(r"[가-힣]{2}[구군](?:[가-힣]{2}동)?([가-힣]{2,4})$")
LATIN = re.compile(r"(?:#|no\.?)?\s*(\d+)(?:\s*-\s*(\d+))?\s+([a-z]+)-?\s*ro\b(?:\s*(\d+)\s*(?:beon)?-?\s*gil)?")
LATIN_FRONT = re.compile(r"([a-z]+)-?\s*ro\b(?:\s*(\d+)\s*(?:beon)?-?\s*gil)?\s+(?:#|no\.?)?\s*(\d+)(?:\s*-\s*(\d+))?")
DISTRICT = re.compile(r"(?:^|[\s)\]])([가-힣]{2,4}[구군])(?=[\s(\[]|$)")
LATIN_DISTRICT = re.compile(r"([a-z]+)-(gu|gun)\b")
POSTCODE = re.compile(r"(?:^|[\s(])(?:우\)?\s*)?(\d{5})(?=[\s)]|$)")
SCHEMA = "record_id bigint, road string, spelled string, side int, number bigint, sub bigint, district string, postcode string"


def romanize(s: str) -> str:
    """Letter by letter, without sound changes between syllables."""
    out = []
    for c in s:
        k = ord(c) - 0xAC00
        out.append(INITIALS[k // 588] + VOWELS[k // 28 % 21] + FINALS[k % 28] if 0 <= k < 11172 else c)
    return "".join(out)


def letters(s: str) -> str:
    """Conjoining letters of Hangul text."""
    return unicodedata.normalize("NFD", s)


def _whole(s: str | None) -> int:
    return int(s[:18]) if s else 0


def parse(text: str | None) -> tuple | None:
    """(road in Latin letters, road as spelled in Hangul or None, side, number, sub, district in Latin letters, postcode) or None."""
    if not text or text.isspace():
        return None
    if re.search(SUSPECT, text) and repair(text)[0]:
        return None
    s = re.sub(r"\s+", " ", unicodedata.normalize("NFC", text).translate(DIGITS)).strip().lower()
    code = POSTCODE.search(s)
    postcode = code[1] if code else None
    m = KOREAN.search(s)
    if m:
        spelled, side, number, sub = m[1], m[2], m[3], m[4]
    else:
        m = LATIN.search(s)
        if m:
            number, sub, road, side = m[1], m[2], m[3], m[4]
        elif m := LATIN_FRONT.search(s):
            road, side, number, sub = m[1], m[2], m[3], m[4]
        elif m := KOREAN_BACK.search(s):
            number, sub, spelled, side = m[1], m[2], m[3], m[4]
            if len(number) == 5 and not sub:
                return None
        else:
            return None
        if m.re is not KOREAN_BACK:
            d = LATIN_DISTRICT.search(s)
            return road, None, _whole(side), _whole(number), _whole(sub), d[1] + d[2] if d else None, postcode
    glued = GLUED.search(spelled) if len(spelled) > 4 else None
    if glued:
        spelled = glued[1]
    d = next((m[1] for m in DISTRICT.finditer(s) if m[1] != spelled), None)  # a road may be named like a district
    return romanize(spelled), spelled, _whole(side), _whole(number), _whole(sub), romanize(d) if d else None, postcode


def parsed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The parts of every address that has a road and a building number; repeated rows once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, *p) for i, t in zip(b.record_id, b.text) if (p := parse(t)) is not None]
            yield pd.DataFrame(rows, columns=["record_id", "road", "spelled", "side", "number", "sub", "district", "postcode"]).astype({"road": object, "spelled": object, "district": object, "postcode": object})

    rows = df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("record_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, SCHEMA).distinct()


# ---- expectation-maximisation over agreement patterns


def em_weights(patterns: np.ndarray, counts: np.ndarray, match: list[list[float]], other: list[list[float]], prior: float = 0.1, strength: float = 10.0, anchored: tuple[int, ...] = (), known_other: bool = False, rounds: int = 20_000) -> tuple[float, list[np.ndarray], list[np.ndarray]]:
    """Share of matches and, for each component, the levels' probabilities among matches and among others.

    patterns: rows of level numbers with their counts; match, other: first guesses of the levels'
    probabilities, which also count as so many observations (strength), so that a few patterns
    cannot turn the classes round and levels that never occur stay possible. Components in anchored
    keep the first guess among matches: they define what a match is. With known_other the levels'
    probabilities among others are given, not guessed, and stay.
    """
    k = len(match)
    m0, u0 = ([np.array(x, float) / sum(x) for x in start] for start in (match, other))
    m, u = m0, u0
    for _ in range(rounds):
        g = posterior(patterns, prior, m, u)
        new = float(np.clip(((g * counts).sum() + strength * 0.1) / (counts.sum() + strength), 1e-5, 0.999))
        m = [np.bincount(patterns[:, j], weights=g * counts, minlength=len(m0[j])) + strength * m0[j] for j in range(k)]
        u = [np.bincount(patterns[:, j], weights=(1 - g) * counts, minlength=len(u0[j])) + strength * u0[j] for j in range(k)]
        m, u = [m0[j] if j in anchored else x / x.sum() for j, x in enumerate(m)], u0 if known_other else [x / x.sum() for x in u]
        if abs(new - prior) < 1e-9:
            return new, m, u
        prior = new
    warnings.warn(f"the estimate still moves after {rounds} rounds", stacklevel=2)
    return prior, m, u


def posterior(patterns: np.ndarray, prior: float, m: list[np.ndarray], u: list[np.ndarray]) -> np.ndarray:
    a = np.log(prior) + sum(np.log(m[j][patterns[:, j]]) for j in range(len(m)))
    b = np.log1p(-prior) + sum(np.log(u[j][patterns[:, j]]) for j in range(len(u)))
    return 1 / (1 + np.exp(np.clip(b - a, -500, 500)))


# ---- road spellings

#: coarse sounds: tense and aspirated initials like plain ones; vowels and finals are dropped
COARSE = {c: g for g, cs in (("g", ("g", "kk", "k")), ("d", ("d", "tt", "t")), ("b", ("b", "pp", "p", "m")), ("s", ("s", "ss")), ("j", ("j", "jj", "ch")), ("n", ("n", "r")), ("h", ("h", ""))) for c in cs}


def sound_keys(spelled: str) -> list[str]:
    """Any two syllables of a name, as written, and the coarse initials of the whole name."""
    syllables = list(spelled)
    pairs = [f"{i}{syllables[i]}{j}{syllables[j]}" for i in range(len(syllables)) for j in range(i + 1, len(syllables)) if j - i <= 2]
    initials = "".join(COARSE.get(INITIALS[(ord(c) - 0xAC00) // 588], "") for c in syllables if 0 <= ord(c) - 0xAC00 < 11172)
    return sorted({*pairs, "~" + initials})


def edit_distance(a: str, b: str, most: int = 4) -> int:
    """Edits between two short texts, counting a swap of neighbours as one; most if there are as many or more."""
    if abs(len(a) - len(b)) >= most:
        return most
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            v = min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y))
            if before and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            new.append(v)
        before, row = row, new
    return min(row[-1], most)


def letter_distance(a: str, b: str) -> int:
    """Letters that differ; a letter and its tense or aspirated sister count as different letters."""
    return edit_distance(letters(a), letters(b))


#: letters that differ: 1, 2, 3, more; support ratio: below 3, 10, 30, 100, above; district and postcodes: agree, missing, differ
MATCH = [[0.85, 0.13, 0.015, 0.005], [0.03, 0.07, 0.2, 0.35, 0.35], [0.8, 0.18, 0.02], [0.3, 0.65, 0.05]]
OTHER = [[0.01, 0.02, 0.1, 0.87], [0.5, 0.2, 0.1, 0.1, 0.1], [0.08, 0.3, 0.62], [0.05, 0.65, 0.3]]


def canonical_roads(records: DataFrame, accept: float = 0.5) -> DataFrame:
    """road, canonical (both in Latin letters): the better supported spelling that each stands for.

    Only spellings that stand for another one are listed. Of equally supported spellings the one
    first in the alphabet counts as better supported.
    """
    s = records.where("spelled is not null")
    per_district = s.where("district is not null").groupBy("spelled", "district").agg(F.count("*").alias("n"))
    main = per_district.groupBy("spelled").agg(F.max_by("district", F.struct("n", "district")).alias("district"))
    codes = materialize(s.where("postcode is not null").select("spelled", "postcode").distinct())
    table = s.groupBy("spelled").agg(F.count("*").alias("support"), F.first("road").alias("road")).join(main, "spelled", "left").join(codes.select("spelled", F.lit(True).alias("coded")).distinct(), "spelled", "left")
    table = materialize(table)
    schema = ", ".join(["spelled string", "support bigint", "road string", "district string", "coded boolean", "block string"])

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.assign(block=[sound_keys(x) for x in b.spelled])
            yield b.explode("block", ignore_index=True)

    blocks = table.mapInPandas(keyed, schema)
    a = blocks.select([F.col(c).alias(f"{c}_a") if c != "block" else F.col(c) for c in blocks.columns])
    b = blocks.select([F.col(c).alias(f"{c}_b") if c != "block" else F.col(c) for c in blocks.columns])
    # a may stand for b: b has the greater support
    better = (F.col("support_a") < F.col("support_b")) | ((F.col("support_a") == F.col("support_b")) & (F.col("spelled_a") > F.col("spelled_b")))
    pairs = materialize(a.join(b, "block").where(better).drop("block").dropDuplicates(["spelled_a", "spelled_b"]))
    code = lambda mark: codes.select(F.col("spelled").alias(f"spelled_{mark}"), "postcode")
    shared = pairs.select("spelled_a", "spelled_b").join(code("a"), "spelled_a").join(code("b"), ["spelled_b", "postcode"]).select("spelled_a", "spelled_b", F.lit(True).alias("shared")).distinct()
    pairs = pairs.join(shared, ["spelled_a", "spelled_b"], "left")
    pairs = pairs.withColumn("l3", F.when(F.col("shared"), 0).when(F.col("coded_a") & F.col("coded_b"), 2).otherwise(1))
    pairs = pairs.withColumn("l2", F.when(F.col("district_a").isNull() | F.col("district_b").isNull(), 1).when(F.col("district_a") == F.col("district_b"), 0).otherwise(2))
    ratio = F.col("support_b") / F.col("support_a")
    pairs = pairs.withColumn("l1", F.when(ratio < 3, 0).when(ratio < 10, 1).when(ratio < 30, 2).when(ratio < 100, 3).otherwise(4))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            far = np.array([letter_distance(x, y) for x, y in zip(p.spelled_a, p.spelled_b)], dtype=np.int64)
            yield pd.DataFrame({"road_a": p.road_a, "road_b": p.road_b, "support_b": p.support_b, "l0": np.clip(far, 1, 4) - 1, "l1": p.l1, "l2": p.l2, "l3": p.l3})

    named = pairs.select("spelled_a", "spelled_b", "road_a", "road_b", "support_b", "l1", "l2", "l3")
    compared = materialize(named.mapInPandas(compare, "road_a string, road_b string, support_b bigint, l0 int, l1 int, l2 int, l3 int"))
    rows = compared.groupBy("l0", "l1", "l2", "l3").count().collect()  # at most 180 patterns
    spark = records.sparkSession
    if not rows:
        return spark.createDataFrame([], "road string, canonical string")
    patterns, counts = np.array([r[:4] for r in rows]), np.array([r[4] for r in rows], float)
    prior, m, u = em_weights(patterns, counts, MATCH, OTHER)
    scored = [(*map(int, p), float(g)) for p, g in zip(patterns, posterior(patterns, prior, m, u))]
    weights = spark.createDataFrame(scored, "l0 int, l1 int, l2 int, l3 int, posterior double")
    likely = compared.join(F.broadcast(weights), ["l0", "l1", "l2", "l3"]).where((F.col("posterior") >= accept) & (F.col("road_a") != F.col("road_b")))
    best = likely.groupBy("road_a").agg(F.max_by("road_b", F.struct("posterior", -F.col("l0"), "support_b", "road_b")).alias("road_b"))
    # a spelling may stand for one that itself stands for another, and so on up to the one that stands for none
    ends = graph.resolve_redirects(best.select(F.xxhash64("road_a").alias("s"), F.xxhash64("road_b").alias("t")), "s", "t")
    names = best.select(F.xxhash64("road_b").alias("final"), F.col("road_b").alias("canonical")).distinct()
    return best.select(F.col("road_a").alias("road"), F.xxhash64("road_a").alias("s")).join(ends, "s").join(names, "final").select("road", "canonical").where("road != canonical")


def buildings(records: DataFrame) -> DataFrame:
    """record_id, building (road, side, number, sub as one text), road, district, postcode, linked (whether the road was spelled otherwise)."""
    fixed = canonical_roads(records)
    r = records.join(fixed, "road", "left").withColumn("linked", F.col("canonical").isNotNull()).withColumn("road", F.coalesce("canonical", "road"))
    return r.select("record_id", F.concat_ws(":", "road", "side", "number", "sub").alias("building"), "road", "district", "postcode", "linked")


#: levels of two records of one building: district and postcode: agree, missing, differ; road as spelled: none, one, both linked
RECORD_MATCH = [[0.8, 0.17, 0.03], [0.3, 0.65, 0.05], [0.9, 0.09, 0.01]]


def chance_levels(records: DataFrame) -> list[list[float]]:
    """How often any two records have each level: shares of districts and postcodes squared and summed, one row in all."""
    n = records.agg(F.count("*").alias("n"), F.count_if("linked").alias("linked")).first()
    out = []
    for c in ("district", "postcode"):
        r = records.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").cast("double").alias("k")).agg(F.sum("k").alias("known"), F.sum(F.col("k") * F.col("k")).alias("squares")).first()
        both, agree = ((r.known or 0.0) / max(n.n, 1)) ** 2, (r.squares or 0.0) / max(n.n, 1) ** 2
        out.append([agree, 1 - both, both - agree])
    p = n.linked / max(n.n, 1)
    out.append([(1 - p) ** 2, 2 * p * (1 - p), p * p])
    return [[max(x, 1e-6) for x in levels] for levels in out]


def _pair_levels() -> list:
    agree = lambda c: F.when(F.col(f"{c}_a").isNull() | F.col(f"{c}_b").isNull(), 1).when(F.col(f"{c}_a") == F.col(f"{c}_b"), 0).otherwise(2)
    return [agree("district").alias("l0"), agree("postcode").alias("l1"), (F.col("linked_a").cast("int") + F.col("linked_b").cast("int")).alias("l2")]


def building_pairs(records: DataFrame) -> DataFrame:
    """record_id_a < record_id_b, probability of every two records with the same canonical building.

    Pairs are counted for EM by groups of records that are alike in all components, so that no pair is
    listed for it; how the levels fall among others is what any two records show.
    """
    b = materialize(buildings(records).select("record_id", "building", "district", "postcode", "linked").distinct())
    of = lambda df, mark: df.select(*[F.col(c).alias(f"{c}_{mark}") if c != "building" else F.col(c) for c in df.columns])
    groups = materialize(b.groupBy("building", "district", "postcode", "linked").agg(F.count("*").alias("n")).withColumn("g", F.xxhash64("district", "postcode", "linked")))
    met = of(groups, "a").join(of(groups, "b"), "building").where("g_a <= g_b")
    many = F.when(F.col("g_a") == F.col("g_b"), F.col("n_a") * (F.col("n_a") - 1) / 2).otherwise(F.col("n_a") * F.col("n_b"))
    rows = met.select(*_pair_levels(), many.alias("n")).groupBy("l0", "l1", "l2").agg(F.sum("n").alias("n")).where("n > 0").collect()  # at most 27 patterns
    spark = records.sparkSession
    schema = "l0 int, l1 int, l2 int, probability double"
    if rows:
        patterns, counts = np.array([tuple(r)[:3] for r in rows], int), np.array([r.n for r in rows], float)
        prior, m, u = em_weights(patterns, counts, RECORD_MATCH, chance_levels(b), prior=0.9, known_other=True)
        weights = spark.createDataFrame([(*map(int, p), float(g)) for p, g in zip(patterns, posterior(patterns, prior, m, u))], schema)
    else:
        weights = spark.createDataFrame([], schema)
    pairs = of(b, "a").join(of(b, "b"), "building").where("record_id_a < record_id_b").select("record_id_a", "record_id_b", *_pair_levels())
    told = pairs.join(F.broadcast(weights), ["l0", "l1", "l2"])
    return told.groupBy("record_id_a", "record_id_b").agg(F.max("probability").alias("probability"))  # a record may have two addresses


def same_building(records: DataFrame, accept: float = 0.5) -> DataFrame:
    """record_id_a, record_id_b of every two records that are probably at the same building."""
    return building_pairs(records).where(F.col("probability") >= accept).select("record_id_a", "record_id_b")
