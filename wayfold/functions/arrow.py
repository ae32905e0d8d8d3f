"""The few functions without a native expression, as Arrow-batched pandas UDFs."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

LINE = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))


@pandas_udf(T.DoubleType())
def longest_blocks_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff and Obershelp's similarity of two texts; null if either is null."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def _xy(points) -> np.ndarray:
    return np.array([(p["x"], p["y"]) for p in points], dtype=float).reshape(-1, 2)


def _back(xy: np.ndarray) -> list[dict]:
    return [{"x": float(x), "y": float(y)} for x, y in xy]


def simplify_line(xy: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas and Peucker's simplification, with a stack instead of recursion."""
    keep, stack = np.zeros(len(xy), bool), [(0, len(xy) - 1)]
    keep[[0, -1]] = True
    while stack:
        i, j = stack.pop()
        if j - i < 2:
            continue
        d = xy[j] - xy[i]
        v = xy[i + 1 : j] - xy[i]
        q = float(d @ d)
        t = np.clip(v @ d / q, 0, 1) if q else np.zeros(len(v))
        far = np.hypot(*(v - t[:, None] * d).T)
        k = int(far.argmax())
        if far[k] > tolerance:
            keep[i + 1 + k] = True
            stack += [(i, i + 1 + k), (i + 1 + k, j)]
    return xy[keep]


def offset_line(xy: np.ndarray, distance: float, mitre: float = 3.0) -> np.ndarray:
    """Parallel line to the left (positive) or right, with mitred corners limited to mitre times the distance."""
    d = np.diff(xy, axis=0)
    n = np.hypot(*d.T)
    d = d[n > 0] / n[n > 0][:, None]
    if not len(d):
        return xy
    xy = np.vstack([xy[:1], xy[1:][n > 0]])
    normal = np.column_stack([-d[:, 1], d[:, 0]])
    at = np.vstack([normal[:1], normal[:-1] + normal[1:], normal[-1:]])
    scale = np.ones(len(at))
    inner = (at[1:-1] ** 2).sum(1)
    scale[1:-1] = np.minimum(2 / np.maximum(inner, 1e-9), mitre)
    return xy + at * scale[:, None] * distance


@pandas_udf(LINE)
def simplified(points: pd.Series, tolerance: pd.Series) -> pd.Series:
    return pd.Series([None if p is None else _back(simplify_line(_xy(p), t)) if len(p) > 2 else list(p) for p, t in zip(points, tolerance)])


@pandas_udf(LINE)
def offset(points: pd.Series, distance: pd.Series) -> pd.Series:
    return pd.Series([None if p is None else _back(offset_line(_xy(p), d)) if len(p) > 1 else list(p) for p, d in zip(points, distance)])


def inside_share(ax: np.ndarray, ay: np.ndarray, bx: np.ndarray, by: np.ndarray, part_at: np.ndarray, ring_at: np.ndarray, vertex_at: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Share of each leg a-b inside its own multipolygon: cut where it crosses a ring, each piece counts by its middle.

    part_at, ring_at, vertex_at: where each leg's parts, each part's rings and each ring's vertices begin, and the end.
    """
    n = len(ax)
    rings = np.arange(len(vertex_at) - 1)
    part = np.repeat(np.arange(len(ring_at) - 1), np.diff(ring_at))
    leg_of_ring = np.repeat(np.arange(n), np.diff(part_at))[part]
    outer = rings == ring_at[:-1][part]
    ring = np.repeat(rings, np.diff(vertex_at))
    after = np.arange(1, len(x) + 1)
    filled = np.diff(vertex_at) > 0
    after[vertex_at[1:][filled] - 1] = vertex_at[:-1][filled]
    cx, cy, dx, dy, leg = x, y, x[after], y[after], leg_of_ring[ring]
    gx, gy = ax[leg], ay[leg]
    ux, uy = bx[leg] - gx, by[leg] - gy
    with np.errstate(divide="ignore", invalid="ignore"):
        den = ux * (dy - cy) - uy * (dx - cx)
        t = ((cx - gx) * (dy - cy) - (cy - gy) * (dx - cx)) / den
        u = ((cx - gx) * uy - (cy - gy) * ux) / den
        hit = (den != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
    legs, cuts = np.concatenate([np.arange(n), np.arange(n), leg[hit]]), np.concatenate([np.zeros(n), np.ones(n), t[hit]])
    order = np.lexsort((cuts, legs))
    legs, cuts = legs[order], cuts[order]
    real = (legs[1:] == legs[:-1]) & (cuts[1:] > cuts[:-1])
    of, p, q = legs[:-1][real], cuts[:-1][real], cuts[1:][real]
    mx, my = ax[of] + (p + q) / 2 * (bx[of] - ax[of]), ay[of] + (p + q) / 2 * (by[of] - ay[of])
    # each piece with all sides of its leg's rings, which stand in a row
    sides = np.bincount(leg, minlength=n)
    begin = np.cumsum(sides) - sides
    many = sides[of]
    piece = np.repeat(np.arange(len(of)), many)
    s = np.arange(len(piece)) - np.repeat(np.cumsum(many) - many, many) + begin[of][piece]
    inside = np.zeros(len(of), bool)
    if len(s):
        px, py = mx[piece], my[piece]
        with np.errstate(divide="ignore", invalid="ignore"):
            crossed = ((cy[s] > py) != (dy[s] > py)) & (px < (dx[s] - cx[s]) * (py - cy[s]) / (dy[s] - cy[s]) + cx[s])
        new = np.flatnonzero(np.concatenate([[True], (piece[1:] != piece[:-1]) | (ring[s][1:] != ring[s][:-1])]))
        odd, at_ring, at_piece = np.add.reduceat(crossed.astype(int), new) % 2, ring[s][new], piece[new]
        held = np.where(outer[at_ring], odd, -2 * odd)  # a part holds a point in its outer ring and in none of its holes
        first = np.flatnonzero(np.concatenate([[True], (at_piece[1:] != at_piece[:-1]) | (part[at_ring][1:] != part[at_ring][:-1])]))
        inside[at_piece[first][np.add.reduceat(held, first) == 1]] = True
    return np.bincount(of, weights=(q - p) * inside, minlength=n)


def legs_inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """line_, region_, overlap_m of rows region_, line_, ax, ay, bx, by, parts: the length of leg a-b inside the multipolygon, where it is more than 0.

    A row with parts is a region; the rows without that follow it, over batches too, are its legs.
    """
    held = None
    for b in batches:
        shape = b.column("parts").is_valid().to_numpy(zero_copy_only=False)
        shapes = b.column("parts").drop_null()
        of = np.cumsum(shape) - (held is None)
        if held is not None:
            shapes = pa.concat_arrays([held, shapes])
        if not len(shapes):
            continue
        held = shapes.slice(len(shapes) - 1)
        if shape.all():
            continue
        level = shapes.take(pa.array(of[~shape]))
        b = b.drop_columns(["parts"]).filter(pa.array(~shape))
        ax, ay, bx, by = (b.column(c).to_numpy(zero_copy_only=False) for c in ("ax", "ay", "bx", "by"))
        starts = []
        for _ in range(3):
            at = level.offsets.to_numpy()
            starts.append(at - at[0])
            level = level.values.slice(at[0], at[-1] - at[0])
        x, y = (v.to_numpy(zero_copy_only=False) for v in level.flatten())
        length = inside_share(ax, ay, bx, by, *starts, x, y) * np.hypot(bx - ax, by - ay)
        some = pa.array(length > 0)
        yield pa.RecordBatch.from_arrays([b.column("line_").filter(some), b.column("region_").filter(some), pa.array(length).filter(some)], ["line_", "region_", "overlap_m"])


def least_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least of all numbers below n that edges a-b link with each number."""
    root = np.arange(n)
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        if not apart.any():
            return root
        a, b = low[apart], high[apart]
        np.minimum.at(root, b, a)
        while (further := root[root]).tobytes() != root.tobytes():
            root = further


#: edges that are linked at once
LINKED = 1 << 18


def local_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (x, y) to rows (v, r): every node of each LINKED edges or so, with the least node that these link it with."""
    held, rows = [], 0

    def linked(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = np.concatenate([c.column(i).to_numpy() for i in (0, 1) for c in held])
        ids, at = np.unique(ends, return_inverse=True)
        root = least_roots(at[: len(at) // 2], at[len(at) // 2 :], len(ids))
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[root])], names=["v", "r"])

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= LINKED:
            yield linked(held)
            held, rows = [], 0
    if rows:
        yield linked(held)
