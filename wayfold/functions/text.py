"""Column to Column: parsing and normalising of dirty text. All JVM-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfold.functions.geo import let

NUMBER = r"[+-]?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"
POINT_TEXT = rf"(?i)^\s*(?:SRID\s*=\s*4326\s*;)?\s*POINT\s*\(\s*({NUMBER})\s+({NUMBER})\s*\)\s*$"


def strip_srid(c: Column) -> Column:
    """WKT without the SRID=n; prefix of EWKT."""
    return F.regexp_replace(F.trim(c), r"(?i)^SRID=[^;]*;", "")


def to_double(c: Column) -> Column:
    """Finite double, or null for blank and unusable text."""
    d = F.nullif(F.trim(c), F.lit("")).try_cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(None)).otherwise(d)


def to_int(c: Column) -> Column:
    """Whole number by truncating a decimal text; null if unusable."""
    return to_double(c).try_cast("int")


def to_positive_int(c: Column) -> Column:
    v = F.trim(c).try_cast("bigint")
    return F.when(v > 0, v)


def number_or_far(c: Column, far: float = 999999.0) -> Column:
    return F.coalesce(to_double(c), F.lit(far))


def to_bool(c: Column, yes: Sequence[str] = ("true", "1", "yes", "y", "예", "가능")) -> Column:
    return F.coalesce(F.lower(F.trim(c)).isin(*yes), F.lit(False))


def valid_number(c: Column) -> Column:
    """Double if the text is a plain number with blanks allowed around it, else null."""
    return F.when(c.rlike(rf"^\s*{NUMBER}\s*$"), F.trim(F.regexp_replace(c, r"\s", "")).try_cast("double"))


def _within(lon: Column, lat: Column) -> Column:
    return lon.between(124.0, 132.0) & lat.between(33.0, 39.0)


def point_lon_lat(c: Column) -> Column:
    """Struct(lon, lat) of a WKT or EWKT point in Korean bounds; null for anything else."""
    two = F.split(F.regexp_replace(F.when(c.rlike(POINT_TEXT), c), POINT_TEXT, "$1 $2"), " ")
    xy = let(two, lambda t: F.struct(F.get(t, F.lit(0)).try_cast("double").alias("lon"), F.get(t, F.lit(1)).try_cast("double").alias("lat")))
    return let(xy, lambda p: F.when(_within(p.lon, p.lat), p))


def valid_lat_lng(lat: Column, lng: Column) -> Column:
    """True if both texts are numbers in bounds; never null."""
    return F.coalesce(_within(valid_number(lng), valid_number(lat)), F.lit(False))


def parse_linestring(c: Column) -> Column:
    """Array of struct(x, y) of a LINESTRING with two or more proper vertices, else null."""
    inner = F.regexp_extract(strip_srid(c), r"(?i)^LINESTRING\s*\((.*)\)$", 1)

    def vertices(xs: Column) -> Column:
        pts = F.transform(xs, lambda p: F.struct(F.get(p, F.lit(0)).try_cast("double").alias("x"), F.get(p, F.lit(1)).try_cast("double").alias("y")))
        proper = (F.size(xs) >= 2) & F.forall(xs, lambda p: F.size(p) == 2)
        return let(pts, lambda v: F.when(proper & F.forall(v, lambda p: p.x.isNotNull() & p.y.isNotNull()), v))

    return let(F.transform(F.split(inner, ","), lambda p: F.split(F.trim(p), r"\s+")), vertices)


def number_scan(c: Column) -> Column:
    """Vertices from every pair of numbers in any WKT."""
    nums = F.transform(F.regexp_extract_all(strip_srid(c), F.lit(r"(-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)"), F.lit(1)), lambda v: v.try_cast("double"))
    n = F.floor(F.size(nums) / 2).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(nums, i * 2).alias("x"), F.get(nums, i * 2 + 1).alias("y"))))


def parse_multipolygon(c: Column) -> Column:
    """array<part: array<ring: array<struct(x, y)>>> of POLYGON or MULTIPOLYGON text; null if empty or broken."""
    s = F.regexp_replace(strip_srid(c), r"\s+", " ")
    s = F.regexp_replace(s, r" ?([(),]) ?", "$1")
    multi = F.regexp_extract(s, r"(?i)^MULTIPOLYGON\(\(\((.*)\)\)\)$", 1)
    single = F.regexp_extract(s, r"(?i)^POLYGON\(\((.*)\)\)$", 1)
    body = F.nullif(F.when(multi != "", multi).otherwise(single), F.lit(""))
    def vertex(p):
        xy = F.split(p, " ")
        return F.struct(F.get(xy, F.lit(0)).try_cast("double").alias("x"), F.get(xy, F.lit(1)).try_cast("double").alias("y"))
    return F.transform(F.split(body, r"\)\),\(\("), lambda part: F.transform(F.split(part, r"\),\("), lambda ring: F.transform(F.split(ring, ","), vertex)))


def closed_multipolygon(parts: Column) -> Column:
    """Parts with every ring closed; rings of fewer than three distinct vertices and parts without an outer ring go."""
    from wayfold.functions.geo import closed_ring

    whole = F.transform(parts, lambda part: F.transform(part, closed_ring))
    solid = lambda r: F.size(F.array_distinct(r)) >= 3
    kept = F.filter(whole, lambda part: F.coalesce(solid(F.get(part, F.lit(0))), F.lit(False)))
    return F.transform(kept, lambda part: F.filter(part, lambda r, i: (i == 0) | solid(r)))


def wkt_multipolygon(parts: Column, digits: int = 3) -> Column:
    """MULTIPOLYGON text with closed rings."""
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(r, lambda p: F.format_string(f"%.{digits}f %.{digits}f", p.x, p.y)), ","), F.lit(")"))
    part = lambda p: F.concat(F.lit("("), F.array_join(F.transform(p, ring), ","), F.lit(")"))
    return F.concat(F.lit("MULTIPOLYGON("), F.array_join(F.transform(closed_multipolygon(parts), part), ","), F.lit(")"))


def parse_multilinestring(c: Column) -> Column:
    """array of lines, each array<struct(x, y)>, of LINESTRING or MULTILINESTRING text; lines of fewer than two proper vertices go."""
    s = F.regexp_replace(F.regexp_replace(strip_srid(c), r"\s+", " "), r" ?([(),]) ?", "$1")
    multi = F.regexp_extract(s, r"(?i)^MULTILINESTRING ?\(\((.*)\)\)$", 1)
    single = F.regexp_extract(s, r"(?i)^LINESTRING ?\(([^()]*)\)$", 1)
    body = F.nullif(F.when(multi != "", multi).otherwise(single), F.lit(""))
    lines = F.transform(F.split(body, r"\),\("), lambda line: parse_linestring(F.concat(F.lit("LINESTRING("), line, F.lit(")"))))
    return F.filter(lines, lambda x: x.isNotNull())


def wkt_point(lon: Column, lat: Column, digits: int = 8) -> Column:
    return F.format_string(f"POINT(%.{digits}f %.{digits}f)", lon, lat)


def ewkt_linestring(points: Column, digits: int = 8) -> Column:
    body = F.array_join(F.transform(points, lambda p: F.format_string(f"%.{digits}f %.{digits}f", p.x, p.y)), ", ")
    return F.concat(F.lit("SRID=4326;LINESTRING("), body, F.lit(")"))


def coordinate_key(lon: Column, lat: Column, digits: int = 8) -> Column:
    return F.format_string(f"%.{digits}f:%.{digits}f", lon, lat)


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def is_unknown(c: Column) -> Column:
    return F.upper(F.trim(F.coalesce(c, F.lit("")))).isin("", "UNKNOWN", "NULL", "NONE", "NAN")


def one_of(c: Column, allowed: Sequence[str], other: str = "UNKNOWN") -> Column:
    """Upper-cased value if allowed, else the fallback."""
    u = F.upper(F.trim(c))
    return F.when(u.isin(*allowed), u).otherwise(F.lit(other))


def signal_state(c: Column) -> Column:
    u = F.upper(F.trim(c))
    return F.when(u == "YES", F.lit("TRAFFIC_SIGNALS")).otherwise(one_of(c, ("TRAFFIC_SIGNALS", "NO")))


def lookup(c: Column, mapping: Mapping[str, str], default: str | None = None, strict: bool = False) -> Column:
    """Value of a small fixed mapping; strict raises for a value without an entry."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    found = F.try_element_at(m, c)
    if strict:
        return F.when(c.isNull() | found.isNotNull(), found).otherwise(F.raise_error(F.concat(F.lit("no entry for "), c)))
    return F.coalesce(found, F.lit(default))


def normalize_name(c: Column) -> Column:
    """Lower case, no bracketed notes, no company marks, no punctuation or blanks."""
    s = F.regexp_replace(F.lower(c), r"\([^)]*\)", "")
    s = F.regexp_replace(s, r"주식회사|㈜|\(주\)", "")
    return F.regexp_replace(s, r"[^\p{L}\p{N}]", "")


def letter_mask(c: Column) -> Column:
    """64 bits, of which each letter of a text sets one."""
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(x), F.lit(64)).cast("int"))
    letters = F.filter(F.split(c, ""), lambda x: x != "")  # empty text splits into itself
    return F.aggregate(letters, F.lit(0).cast("bigint"), lambda mask, x: mask.bitwiseOR(bit(x)))


def blocks_ratio_bound(len_a: Column, mask_a: Column, len_b: Column, mask_b: Column) -> Column:
    """What arrow.longest_blocks_ratio of two texts can be at most, by their lengths and letter_mask: each bit of one text only is a letter without a partner."""
    shared = F.least(len_a - F.bit_count(mask_a.bitwiseAND(F.bitwise_not(mask_b))), len_b - F.bit_count(mask_b.bitwiseAND(F.bitwise_not(mask_a))))
    return F.when(len_a + len_b == 0, F.lit(1.0)).otherwise(2.0 * shared / (len_a + len_b))


def normalize_plain(c: Column) -> Column:
    """Digits, ASCII letters and Hangul syllables only, after dropping bracketed notes."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"\([^)]*\)", ""), r"[^0-9a-z가-힣]", "")


#: a named road, path, ward or village, a side street's number if there is one, the number and sub-number on it
PLACE_ON_ROAD = r"([가-힣]+[0-9]*(?:로|길|동|리))(?:\s*([0-9]+)\s*번?\s*길)?\s*([0-9]+)(?:\s*-\s*([0-9]+))?(?![0-9])"


def address_places(c: Column) -> Column:
    """array<struct(on, side, number, sub)> of every place that a text names by a number on a road or in a village; side and sub are empty if not given."""
    found = [F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(PLACE_ON_ROAD), F.lit(i)) for i in (1, 2, 3, 4)]
    return F.arrays_zip(found[0].alias("on"), found[1].alias("side"), found[2].alias("number"), found[3].alias("sub"))


def address_tokens(c: Column) -> Column:
    """Distinct places of a text in one spelling each."""
    spelled = lambda p: F.concat(p["on"], F.when(p["side"] != "", F.concat(p["side"], F.lit("번길"))).otherwise(""), p["number"], F.when(p["sub"] != "", F.concat(F.lit("-"), p["sub"])).otherwise(""))
    return F.array_distinct(F.transform(address_places(c), spelled))


def address_prefix(c: Column, words: int = 2) -> Column:
    """First words between any Unicode white space (ideographic and no-break blanks too); null for null."""
    parts = F.filter(F.split(c, r"[\s\p{Z}\x1c-\x1f\x85]+"), lambda w: w != "")
    return F.array_join(F.slice(parts, 1, words), " ")


def first_of(c: Column, terms: Sequence[str]) -> Column:
    """First term of the list that occurs in the text; longest first is the caller's order."""
    out = F.lit(None).cast("string")
    for t in reversed(list(terms)):
        out = F.when(F.contains(c, F.lit(t)), F.lit(t)).otherwise(out)
    return out


def district_of(c: Column, names: Sequence[str]) -> Column:
    return first_of(c, sorted(names, key=lambda n: (-len(n), n)))


def terms_in(c: Column, terms: Sequence[str]) -> Column:
    return F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(c, t))


def char_jaccard(a: Column, b: Column) -> Column:
    """Overlap of the two texts' character sets; 0 if either is blank."""
    x = F.array_distinct(F.filter(F.split(F.coalesce(a, F.lit("")), ""), lambda ch: ch != ""))
    y = F.array_distinct(F.filter(F.split(F.coalesce(b, F.lit("")), ""), lambda ch: ch != ""))
    u = F.size(F.array_union(x, y))
    return F.when(u == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / u)


def common_prefix_length(a: Column, b: Column) -> Column:
    n = F.least(F.length(a), F.length(b))
    same = F.transform(F.sequence(F.lit(0), n), lambda i: F.substr(a, F.lit(1), i) == F.substr(b, F.lit(1), i))
    return F.size(F.filter(same, lambda x: x)) - 1


def list_add(c: Column, *items: str) -> Column:
    """Pipe-joined list with items appended once."""
    have = F.filter(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: x != "")
    return F.array_join(F.array_union(have, F.array(*[F.lit(i) for i in items])), "|")


def list_drop(c: Column, *items: str) -> Column:
    have = F.filter(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: x != "")
    return F.array_join(F.array_except(have, F.array(*[F.lit(i) for i in items])), "|")
