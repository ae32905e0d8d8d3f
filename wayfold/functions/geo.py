"""Column to Column: geometry in metres and degrees. All JVM-side, no geometry library."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS_M = 6_371_008.8
#: fixed values of the Korean unified grid (EPSG:5179) on GRS80
A, INV_F, LAT0, LON0, K0, FE, FN = 6378137.0, 298.257222101, 38.0, 127.5, 0.9996, 1_000_000.0, 2_000_000.0

_f = 1 / INV_F
_n = _f / (2 - _f)
_e2 = _f * (2 - _f)
_e = math.sqrt(_e2)
_rect = A / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
_alpha = (
    _n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16 + 41 * _n**4 / 180,
    13 * _n**2 / 48 - 3 * _n**3 / 5 + 557 * _n**4 / 1440,
    61 * _n**3 / 240 - 103 * _n**4 / 140,
    49561 * _n**4 / 161280,
)
_beta = (
    _n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96 - _n**4 / 360,
    _n**2 / 48 + _n**3 / 15 - 437 * _n**4 / 1440,
    17 * _n**3 / 480 - 37 * _n**4 / 840,
    4397 * _n**4 / 161280,
)
_delta = (
    2 * _n - 2 * _n**2 / 3 - 2 * _n**3 + 116 * _n**4 / 45,
    7 * _n**2 / 3 - 8 * _n**3 / 5 - 227 * _n**4 / 45,
    56 * _n**3 / 15 - 136 * _n**4 / 35,
    4279 * _n**4 / 630,
)


def _xi0() -> float:
    """Rectifying latitude of the origin."""
    phi = math.radians(LAT0)
    chi = math.atan(math.sinh(math.atanh(math.sin(phi)) - _e * math.atanh(_e * math.sin(phi))))
    return chi + sum(a * math.sin(2 * (j + 1) * chi) for j, a in enumerate(_alpha))


_M0 = K0 * _rect * _xi0()


def let(value: Column, body) -> Column:
    """body(value) with value worked out once: a one-element transform binds it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def to_metres(lon: Column, lat: Column) -> Column:
    """Struct(x, y) in EPSG:5179 of WGS84 degrees: Krueger's series to the fourth order (sub-millimetre)."""
    def angles(p: Column) -> Column:
        s = F.sin(p.phi)
        return F.struct(F.sinh(F.atanh(s) - F.lit(_e) * F.atanh(F.lit(_e) * s)).alias("t"), F.sin(p.lam).alias("s"), F.cos(p.lam).alias("c"))

    def series(q: Column) -> Column:
        x, y = q.eta, q.xi
        for j, a in enumerate(_alpha, 1):
            x = x + F.lit(a) * F.cos(2 * j * q.xi) * F.sinh(2 * j * q.eta)
            y = y + F.lit(a) * F.sin(2 * j * q.xi) * F.cosh(2 * j * q.eta)
        return F.struct((F.lit(FE) + F.lit(K0 * _rect) * x).alias("x"), (F.lit(FN) + F.lit(K0 * _rect) * y - F.lit(_M0)).alias("y"))

    start = F.struct(F.radians(lat).alias("phi"), (F.radians(lon) - F.lit(math.radians(LON0))).alias("lam"))
    turned = lambda q: F.struct(F.atan2(q.t, q.c).alias("xi"), F.asinh(q.s / F.sqrt(q.t * q.t + q.c * q.c)).alias("eta"))
    return let(let(let(start, angles), turned), series)


def to_degrees(x: Column, y: Column) -> Column:
    """Struct(lon, lat) in WGS84 of EPSG:5179 metres."""
    def back(q: Column) -> Column:
        xp, ep = q.xi, q.eta
        for j, b in enumerate(_beta, 1):
            xp = xp - F.lit(b) * F.sin(2 * j * q.xi) * F.cosh(2 * j * q.eta)
            ep = ep - F.lit(b) * F.cos(2 * j * q.xi) * F.sinh(2 * j * q.eta)
        return F.struct(xp.alias("xp"), ep.alias("ep"))

    def series(q: Column) -> Column:
        phi = q.chi
        for j, d in enumerate(_delta, 1):
            phi = phi + F.lit(d) * F.sin(2 * j * q.chi)
        return F.struct(F.degrees(F.lit(math.radians(LON0)) + q.lam).alias("lon"), F.degrees(phi).alias("lat"))

    start = F.struct(((y - F.lit(FN) + F.lit(_M0)) / F.lit(K0 * _rect)).alias("xi"), ((x - F.lit(FE)) / F.lit(K0 * _rect)).alias("eta"))
    turned = lambda q: F.struct(F.asin(F.sin(q.xp) / F.cosh(q.ep)).alias("chi"), F.atan2(F.sinh(q.ep), F.cos(q.xp)).alias("lam"))
    return let(let(let(start, back), turned), series)


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float = RADIUS_M) -> Column:
    dp, dl = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    h = F.sin(dp / 2) * F.sin(dp / 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dl / 2) * F.sin(dl / 2)
    root = F.sqrt(h)
    return F.lit(2 * radius) * F.asin(F.when(root > 1.0, F.lit(1.0)).otherwise(root))  # null for null, which least would pass over


def flat_metres(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Equirectangular distance with 111320 and 110540 metres a degree."""
    dx = (lon2 - lon1) * 111320.0 * F.cos(F.radians((lat1 + lat2) / 2))
    return F.hypot(dx, (lat2 - lat1) * 110540.0)


def legs(points: Column) -> Column:
    """Consecutive vertex pairs as array<struct(a, b)>."""
    n = F.size(points)
    return F.when(n >= 2, F.zip_with(F.slice(points, F.lit(1), n - 1), F.slice(points, F.lit(2), n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"))))


def line_length(points: Column) -> Column:
    """Planar length of a polyline."""
    return F.aggregate(legs(points), F.lit(0.0), lambda acc, g: acc + F.hypot(g.b.x - g.a.x, g.b.y - g.a.y))


def line_length_degrees(points: Column) -> Column:
    return F.aggregate(legs(points), F.lit(0.0), lambda acc, g: acc + flat_metres(g.a.x, g.a.y, g.b.x, g.b.y))


def point_leg(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Struct(d, t): distance of a point from a leg and the share of the leg at the foot, clamped to 0..1."""
    dx, dy = bx - ax, by - ay
    q = dx * dx + dy * dy
    t = F.when(q == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / q)))
    return F.struct(F.hypot(px - ax - t * dx, py - ay - t * dy).alias("d"), t.alias("t"))


def point_line_distance(px: Column, py: Column, points: Column) -> Column:
    return F.array_min(F.transform(legs(points), lambda g: point_leg(px, py, g.a.x, g.a.y, g.b.x, g.b.y).d))


def in_ring(px: Column, py: Column, ring: Column) -> Column:
    """Parity of crossings of a ray to the right; the ring may be open or closed."""
    n = F.size(ring)
    closed = F.concat(ring, F.slice(ring, F.lit(1), F.lit(1)))
    crossings = F.aggregate(
        F.zip_with(F.slice(closed, F.lit(1), n), F.slice(closed, F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
        F.lit(0),
        lambda acc, g: acc + F.when(((g.a.y > py) != (g.b.y > py)) & (px < (g.b.x - g.a.x) * (py - g.a.y) / (g.b.y - g.a.y) + g.a.x), F.lit(1)).otherwise(F.lit(0)),
    )
    return F.coalesce(crossings % 2 == 1, F.lit(False))


def in_multipolygon(px: Column, py: Column, parts: Column) -> Column:
    """Inside the outer ring of a part and in none of that part's holes."""
    return F.coalesce(
        F.exists(parts, lambda part: in_ring(px, py, F.get(part, F.lit(0))) & ~F.exists(F.slice(part, F.lit(2), F.greatest(F.size(part), F.lit(1))), lambda hole: in_ring(px, py, hole))),
        F.lit(False),
    )


def ring_area(ring: Column) -> Column:
    """Signed shoelace area, from the first vertex on, so that large coordinates do not cancel."""
    n = F.size(ring)
    closed = F.concat(ring, F.slice(ring, F.lit(1), F.lit(1)))
    o = F.get(ring, F.lit(0))
    cross = lambda a, b: (a.x - o.x) * (b.y - o.y) - (b.x - o.x) * (a.y - o.y)
    return F.aggregate(F.zip_with(F.slice(closed, F.lit(1), n), F.slice(closed, F.lit(2), n), cross), F.lit(0.0), lambda acc, v: acc + v) / 2


def ring_centroid(ring: Column) -> Column:
    n = F.size(ring)
    closed = F.concat(ring, F.slice(ring, F.lit(1), F.lit(1)))
    pairs = F.zip_with(F.slice(closed, F.lit(1), n), F.slice(closed, F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    area6 = ring_area(ring) * 6
    cx = F.aggregate(pairs, F.lit(0.0), lambda acc, g: acc + (g.a.x + g.b.x) * (g.a.x * g.b.y - g.b.x * g.a.y)) / area6
    cy = F.aggregate(pairs, F.lit(0.0), lambda acc, g: acc + (g.a.y + g.b.y) * (g.a.x * g.b.y - g.b.x * g.a.y)) / area6
    return F.struct(cx.alias("x"), cy.alias("y"))


def bbox(points: Column) -> Column:
    xs, ys = F.transform(points, lambda p: p.x), F.transform(points, lambda p: p.y)
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def turn_angle(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    """Degrees of turning at b on the way from a to c: 0 is straight on; null if a leg has no length."""
    ux, uy, vx, vy = bx - ax, by - ay, cx - bx, cy - by
    cosine = (ux * vx + uy * vy) / F.nullif(F.hypot(ux, uy) * F.hypot(vx, vy), F.lit(0.0))
    return F.when(cosine.isNotNull(), F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))))


def heading(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Degrees from the x axis, 0 up to 360."""
    return F.pmod(F.degrees(F.atan2(by - ay, bx - ax)), F.lit(360.0))


def morton(x: Column, y: Column) -> Column:
    """Interleaved bits of two whole numbers below 2**31: the Z-order code."""
    def spread(v: Column) -> Column:
        v = v.cast("bigint").bitwiseAND(F.lit(0x7FFFFFFF))
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v
    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1))


def measured(points: Column) -> Column:
    """Vertices with their distance along the line: array<struct(x, y, m)>."""
    n = F.size(points)
    steps = F.concat(F.array(F.lit(0.0)), F.coalesce(F.transform(legs(points), lambda g: F.hypot(g.b.x - g.a.x, g.b.y - g.a.y)), F.array().cast("array<double>")))
    # running sums by doubling: each pass adds what lies 2**k places before, so a line costs n log n
    sums = F.aggregate(
        F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(n, F.lit(2)))).cast("int")), lambda k: F.pow(F.lit(2.0), k).cast("int")),
        steps,
        lambda acc, back: F.transform(acc, lambda v, i: v + F.when(i >= back, F.get(acc, i - back)).otherwise(F.lit(0.0))),
    )
    return F.when(n >= 1, F.zip_with(points, sums, lambda p, m: F.struct(p.x.alias("x"), p.y.alias("y"), m.alias("m"))))


def interpolate(line: Column, m: Column) -> Column:
    """Struct(x, y) at measure m of a measured line; ends are clamped."""
    before = F.coalesce(F.element_at(F.filter(line, lambda p: p.m <= m), -1), line[0])
    after = F.coalesce(F.get(F.filter(line, lambda p: p.m > m), F.lit(0)), F.element_at(line, -1))

    def at(q: Column) -> Column:
        t = F.when(q.b.m > q.a.m, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (q.m - q.a.m) / (q.b.m - q.a.m)))).otherwise(F.lit(0.0))
        return F.struct((q.a.x + t * (q.b.x - q.a.x)).alias("x"), (q.a.y + t * (q.b.y - q.a.y)).alias("y"))

    return let(F.struct(before.alias("a"), after.alias("b"), m.alias("m")), at)


def substring(line: Column, start: Column, end: Column) -> Column:
    """Part of a measured line between two measures, as array<struct(x, y)>."""
    inner = F.transform(F.filter(line, lambda p: (p.m > start) & (p.m < end)), lambda p: F.struct(p.x.alias("x"), p.y.alias("y")))
    return F.concat(F.array(interpolate(line, start)), inner, F.array(interpolate(line, end)))


def without_repeats(points: Column) -> Column:
    """Consecutive equal vertices once."""
    return F.filter(points, lambda p, i: (i == 0) | ~p.eqNullSafe(F.get(points, i - 1)))


def axis_angle(ux: Column, uy: Column, vx: Column, vy: Column) -> Column:
    """Degrees between two undirected lines, 0 to 90; null if one has no length."""
    return let(F.abs(ux * vx + uy * vy) / F.nullif(F.hypot(ux, uy) * F.hypot(vx, vy), F.lit(0.0)), lambda c: F.degrees(F.acos(F.when(c > 1.0, F.lit(1.0)).otherwise(c))))


def leg_crossing(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Struct(x, y) where leg a-b crosses leg c-d; null if they are parallel or do not meet."""
    den = (b.x - a.x) * (d.y - c.y) - (b.y - a.y) * (d.x - c.x)
    t = ((c.x - a.x) * (d.y - c.y) - (c.y - a.y) * (d.x - c.x)) / F.nullif(den, F.lit(0.0))
    u = ((c.x - a.x) * (b.y - a.y) - (c.y - a.y) * (b.x - a.x)) / F.nullif(den, F.lit(0.0))
    return F.when(t.between(0.0, 1.0) & u.between(0.0, 1.0), F.struct((a.x + t * (b.x - a.x)).alias("x"), (a.y + t * (b.y - a.y)).alias("y")))


def leg_distance(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Least distance of leg a-b from leg c-d; 0 if they cross."""
    far = lambda p, q, r: point_leg(p.x, p.y, q.x, q.y, r.x, r.y).d
    return F.when(leg_crossing(a, b, c, d).isNotNull(), F.lit(0.0)).otherwise(F.least(far(a, c, d), far(b, c, d), far(c, a, b), far(d, a, b)))


def leg_overlap(a: Column, b: Column, c: Column, d: Column, tolerance: float = 0.01) -> Column:
    """Length that leg c-d shares with leg a-b where both lie on one line, within a tolerance."""
    n = F.nullif(F.hypot(b.x - a.x, b.y - a.y), F.lit(0.0))
    off = lambda p: F.abs((p.x - a.x) * (b.y - a.y) - (p.y - a.y) * (b.x - a.x)) / n
    along = lambda p: ((p.x - a.x) * (b.x - a.x) + (p.y - a.y) * (b.y - a.y)) / n
    shared = F.least(n, F.greatest(along(c), along(d))) - F.greatest(F.lit(0.0), F.least(along(c), along(d)))
    return F.when((n > 0) & (off(c) <= tolerance) & (off(d) <= tolerance) & (shared > 0), shared).otherwise(F.lit(0.0))


def length_inside(points: Column, parts: Column) -> Column:
    """Length of a polyline inside a multipolygon: legs are cut where they cross a ring, and each piece counts by its middle."""
    rings = F.flatten(parts)
    sides = F.flatten(F.transform(rings, lambda r: legs(F.concat(r, F.slice(r, F.lit(1), F.lit(1))))))

    def share(g: Column, c: Column, d: Column) -> Column:
        """Where along the leg g the side c-d crosses it; null if nowhere."""
        den = (g.b.x - g.a.x) * (d.y - c.y) - (g.b.y - g.a.y) * (d.x - c.x)
        t = ((c.x - g.a.x) * (d.y - c.y) - (c.y - g.a.y) * (d.x - c.x)) / F.nullif(den, F.lit(0.0))
        u = ((c.x - g.a.x) * (g.b.y - g.a.y) - (c.y - g.a.y) * (g.b.x - g.a.x)) / F.nullif(den, F.lit(0.0))
        return F.when(t.between(0.0, 1.0) & u.between(0.0, 1.0), t)

    def of_leg(g: Column) -> Column:
        cuts = F.array_sort(F.concat(F.array(F.lit(0.0), F.lit(1.0)), F.array_compact(F.transform(sides, lambda s: share(g, s.a, s.b)))))

        def pieces(ts: Column) -> Column:
            pair = F.zip_with(F.slice(ts, F.lit(1), F.size(ts) - 1), F.slice(ts, F.lit(2), F.size(ts) - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
            mid = lambda k, c: g.a[c] + (k.p + k.q) / 2 * (g.b[c] - g.a[c])
            return F.aggregate(pair, F.lit(0.0), lambda acc, k: acc + F.when((k.q > k.p) & in_multipolygon(mid(k, "x"), mid(k, "y"), parts), k.q - k.p).otherwise(F.lit(0.0)))

        return let(cuts, pieces) * F.hypot(g.b.x - g.a.x, g.b.y - g.a.y)

    return F.coalesce(F.aggregate(F.transform(legs(points), of_leg), F.lit(0.0), lambda acc, v: acc + v), F.lit(0.0))


def outward_tangent(points: Column, at_start: Column) -> Column:
    """Unit vector struct(x, y) that leaves a line over its first or last vertex; null if the leg there has no length."""
    n = F.size(points)
    p, q = F.when(at_start, F.get(points, F.lit(0))).otherwise(F.element_at(points, -1)), F.when(at_start, F.get(points, F.lit(1))).otherwise(F.get(points, n - 2))
    d = F.nullif(F.hypot(p.x - q.x, p.y - q.y), F.lit(0.0))
    return F.when(d.isNotNull(), F.struct(((p.x - q.x) / d).alias("x"), ((p.y - q.y) / d).alias("y")))


def detour_ratio(points: Column) -> Column:
    """Length of a line over the distance of its ends; null for a closed one."""
    return line_length(points) / F.nullif(F.hypot(F.element_at(points, -1).x - points[0].x, F.element_at(points, -1).y - points[0].y), F.lit(0.0))


def max_turn(points: Column) -> Column:
    """Greatest turn in degrees at an inner vertex; 0 if there is none."""
    n = F.size(points)
    turns = F.when(n >= 3, F.zip_with(legs(F.slice(points, F.lit(1), n - 1)), legs(F.slice(points, F.lit(2), n - 1)), lambda g, h: turn_angle(g.a.x, g.a.y, g.b.x, g.b.y, h.b.x, h.b.y)))
    return F.coalesce(F.array_max(turns), F.lit(0.0))


def bisector(low: Column, high: Column) -> Column:
    """Middle bearing of the sector that goes from low up to high, through 360 if high is the lower one."""
    return F.pmod(low + F.pmod(high - low, F.lit(360.0)) / 2, F.lit(360.0))


def in_sector(bearing: Column, low: Column, high: Column) -> Column:
    """Whether a bearing lies in the sector from low up to high; equal limits mean the whole circle."""
    width = F.pmod(high - low, F.lit(360.0))
    return F.when(width == 0, F.lit(True)).otherwise(F.pmod(bearing - low, F.lit(360.0)) <= width)


def boxes_meet(a: Column, b: Column, gap: float = 0.0) -> Column:
    """Whether two boxes (x0, y0, x1, y1) come within gap of each other."""
    return (a.x0 <= b.x1 + gap) & (b.x0 <= a.x1 + gap) & (a.y0 <= b.y1 + gap) & (b.y0 <= a.y1 + gap)


def valid_line(points: Column) -> Column:
    """Two or more distinct finite vertices; never null."""
    finite = F.forall(points, lambda p: p.x.isNotNull() & p.y.isNotNull() & ~F.isnan(p.x) & ~F.isnan(p.y) & (F.abs(p.x) < float("inf")) & (F.abs(p.y) < float("inf")))
    return F.coalesce(finite & (F.size(F.array_distinct(points)) >= 2), F.lit(False))


def closed_ring(ring: Column) -> Column:
    """The ring with its first vertex repeated at the end, if it is not."""
    open_ = ~F.element_at(ring, 1).eqNullSafe(F.element_at(ring, -1))
    return F.when(open_, F.concat(ring, F.slice(ring, F.lit(1), F.lit(1)))).otherwise(ring)


def valid_ring(ring: Column) -> Column:
    """At least three distinct finite vertices, closed, and an area."""
    return F.coalesce(valid_line(ring) & (F.size(F.array_distinct(ring)) >= 3) & F.element_at(ring, 1).eqNullSafe(F.element_at(ring, -1)) & (F.abs(ring_area(ring)) > 0), F.lit(False))


def capped(points: Column, most: int) -> Column:
    """A line resampled to at most so many vertices at even positions, both ends kept."""
    n = F.size(points)
    at = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.get(points, F.round(i * (n - 1) / (most - 1)).cast("int")))
    return F.when(n > most, at).otherwise(points)


def outside_discs(line: Column, discs: Column) -> Column:
    """Measures [s, e] of the stretches of a measured line that lie outside all discs array<struct(x, y, r)>."""
    def cuts(g: Column) -> Column:
        dx, dy, n = g.b.x - g.a.x, g.b.y - g.a.y, F.hypot(g.b.x - g.a.x, g.b.y - g.a.y)

        def of(d: Column) -> Column:
            """Where the leg enters and leaves a disc: the roots of a quadratic equation."""
            fx, fy = g.a.x - d.x, g.a.y - d.y
            qa, qb, qc = dx * dx + dy * dy, 2 * (fx * dx + fy * dy), fx * fx + fy * fy - d.r * d.r
            root = F.sqrt(F.greatest(qb * qb - 4 * qa * qc, F.lit(0.0)))
            both = F.array((-qb - root) / F.nullif(2 * qa, F.lit(0.0)), (-qb + root) / F.nullif(2 * qa, F.lit(0.0)))
            return F.filter(both, lambda t: t.isNotNull() & (t > 0) & (t < 1))

        return F.transform(F.flatten(F.transform(discs, of)), lambda t: g.a.m + t * n)

    ms = F.array_distinct(F.array_sort(F.concat(F.transform(line, lambda p: p.m), F.flatten(F.transform(legs(line), cuts)))))

    def kept(m: Column) -> Column:
        pair = F.zip_with(F.slice(m, F.lit(1), F.size(m) - 1), F.slice(m, F.lit(2), F.size(m) - 1), lambda s, e: F.struct(s.alias("s"), e.alias("e")))
        out = F.filter(pair, lambda k: let(interpolate(line, (k.s + k.e) / 2), lambda p: ~F.exists(discs, lambda d: F.hypot(p.x - d.x, p.y - d.y) < d.r)))
        # neighbouring stretches are put together
        first = F.filter(out, lambda k: ~F.exists(out, lambda o: o.e == k.s))
        last = F.filter(out, lambda k: ~F.exists(out, lambda o: o.s == k.e))
        return F.zip_with(first, last, lambda f, z: F.struct(f.s.alias("s"), z.e.alias("e")))

    return F.when(F.size(line) >= 2, let(ms, kept))
