"""Expressions over 2-D integer vectors and a small inlined centroid set.

With column names (the usual case) the centroid expressions are written
as one SQL expression string and parsed once by Spark - the same Catalyst
expression as building it column by column, without hundreds of
driver-to-JVM calls per k-means iteration.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import as_col

Point = tuple[int, int]

# Up to this many centroids are written out one by one, which compiles into
# the scan; more are literal lists by cell of a grid, of which each row folds over one.
WRITTEN_CENTERS = 256
# Centroids per cell of that grid, its most cells, and how many centroids of a cell
# the others are held against.
GRID_CENTERS = 2
GRID_CELLS = 2048
RIVALS = 64
# Distances are doubles: a list keeps what is within rounding of the bound.
_SLACK = 1e-13
_LISTED = "struct<x: bigint, y: bigint, i: int>"


def point_distance(x: str | Column, y: str | Column, cx, cy) -> Column:
    """Squared Euclidean distance, as a double (no square root)."""
    dx = as_col(x) - (cx if isinstance(cx, Column) else F.lit(cx))
    dy = as_col(y) - (cy if isinstance(cy, Column) else F.lit(cy))
    return dx.cast("double") * dx + dy.cast("double") * dy


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _distance_sql(x: str, y: str, cx: int, cy: int) -> str:
    dx, dy = f"({_ident(x)} - {int(cx)})", f"({_ident(y)} - {int(cy)})"
    return f"(CAST({dx} AS DOUBLE) * {dx} + CAST({dy} AS DOUBLE) * {dy})"


def _grid_lines(values: np.ndarray, n: int) -> list[int]:
    """Edges of up to ``n`` intervals about the values: lines halfway between neighbours, and an extent on both sides."""
    distinct = np.unique(values)
    lo, hi = int(distinct[0]), int(distinct[-1])
    extent = max(hi - lo, 1)
    halfway = [(int(a) + int(b)) // 2 for a, b in zip(distinct, distinct[1:])]
    picked = np.linspace(0, len(halfway), min(n, len(distinct)) + 1).astype(int)[1:-1]
    return [lo - extent, *sorted({halfway[i] for i in picked}), hi + extent]


def _candidates(box: tuple[float, float, float, float], centers: np.ndarray) -> np.ndarray:
    """Places in ``centers`` among which is the nearest to any point of the box.

    One falls out if its least distance to the box is above another's greatest, or
    if another is nearer at every corner, and so everywhere in the box.
    """
    low, high = np.array(box[::2]), np.array(box[1::2])
    most = (np.maximum(np.abs(centers - low), np.abs(high - centers)) ** 2).sum(1)
    least = (np.maximum(np.maximum(low - centers, centers - high), 0) ** 2).sum(1)
    places = np.flatnonzero(least <= most.min() * (1 + _SLACK))
    middle = (low + high) / 2
    near, half = centers[places] - middle, (high - low) / 2
    rivals = near[np.argsort(most[places], kind="stable")[:RIVALS]]
    # |p - rival|^2 - |p - near|^2 is linear in p: its greatest value over the box, from the middle
    over = 2 * (np.abs(near[:, None] - rivals[None]) * half).sum(2) + (rivals**2).sum(1)[None] - (near**2).sum(1)[:, None]
    return places[~(over < -_SLACK * most[places][:, None]).any(1)]


def _grid(centers: Sequence[Point]) -> tuple[list[int], list[int], list[list[tuple[int, int, int]]]]:
    """A grid about the centroids: lines across x and y, and per cell the centroids that can be nearest in it."""
    first: dict[Point, int] = {}
    for i, (cx, cy) in enumerate(centers):
        first.setdefault((int(cx), int(cy)), i)  # of centroids at one place, ties go to the first
    points = list(first)
    at = np.array(points, float)
    cells = min(max(len(points) // GRID_CENTERS, 1), GRID_CELLS)
    wide, high = (max(e, 1) for e in np.ptp(at, axis=0))
    across = min(len(set(at[:, 0])), cells, max(math.isqrt(int(cells * wide / high)), 1))  # cells as wide as high
    xs, ys = _grid_lines(at[:, 0], across), _grid_lines(at[:, 1], max(cells // across, 1))
    lists = []
    for x0, x1 in zip(xs, xs[1:]):
        for y0, y1 in zip(ys, ys[1:]):
            lists.append([(*points[k], first[points[k]]) for k in _candidates((x0, x1, y0, y1), at)])
    return xs, ys, lists


def _literal(value: object, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def _interval(value: Column, lines: Sequence[int]) -> Column:
    """Number of the interval that a value between the lines lies in, found by halving steps."""
    starts = _literal(lines[:-1], "array<bigint>")
    steps = [1 << k for k in reversed(range((len(lines) - 2).bit_length()))]
    if not steps:
        return F.lit(0)
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda at, step: F.when(F.get(starts, at + step) <= value, at + step).otherwise(at),
    )


def _nearest_of_many(centers: Sequence[Point], x: Column, y: Column) -> Column:
    """The smallest (distance, index) of many centroids.

    A row folds over the list of its cell; one outside the grid (or with a null
    coordinate) over all centroids.  The lists are literals, made on the driver.
    """

    def entries(listed: Sequence[tuple[int, int, int]]) -> list[dict]:
        return [{"x": cx, "y": cy, "i": i} for cx, cy, i in listed]

    xs, ys, lists = _grid(centers)
    inside = reduce(Column.__and__, [c.between(lines[0], lines[-1]) for c, lines in ((x, xs), (y, ys))])
    cell = F.when(inside, _interval(x, xs) * (len(ys) - 1) + _interval(y, ys))
    near = F.coalesce(
        F.get(_literal([entries(each) for each in lists], f"array<array<{_LISTED}>>"), cell),
        _literal(entries([(int(cx), int(cy), i) for i, (cx, cy) in enumerate(centers)]), f"array<{_LISTED}>"),
    )
    return F.array_min(F.transform(near, lambda c: F.struct(point_distance(x, y, c.x, c.y).alias("d"), c.i.alias("i"))))


def nearest_center(centers: Sequence[Point], x: str | Column = "x", y: str | Column = "y") -> Column:
    """Index of the closest centroid; ties go to the lowest index.

    The centroids are literals, so this is a minimum over (distance,
    index) structs: no join, constant size per row.  A few are written out
    (whole-stage codegen); of many, a row folds over those that can be nearest
    in its cell of a literal grid.
    """
    if not centers:
        raise ValueError("no centroids")
    if len(centers) == 1:
        return F.lit(0)
    if len(centers) > WRITTEN_CENTERS:
        return _nearest_of_many(centers, as_col(x), as_col(y)).getField("i")
    if isinstance(x, str) and isinstance(y, str):
        cands = ", ".join(
            f"named_struct('d', {_distance_sql(x, y, cx, cy)}, 'i', {i})"
            for i, (cx, cy) in enumerate(centers)
        )
        return F.expr(f"least({cands}).i")
    structs = [
        F.struct(point_distance(x, y, cx, cy).alias("d"), F.lit(i).alias("i"))
        for i, (cx, cy) in enumerate(centers)
    ]
    return F.least(*structs).getField("i")


def nearest_distance(centers: Sequence[Point], x: str | Column = "x", y: str | Column = "y") -> Column:
    """Squared distance to the closest centroid."""
    if not centers:
        raise ValueError("no centroids")
    if len(centers) > WRITTEN_CENTERS:
        return _nearest_of_many(centers, as_col(x), as_col(y)).getField("d")
    if isinstance(x, str) and isinstance(y, str):
        parts = [_distance_sql(x, y, cx, cy) for cx, cy in centers]
        return F.expr(parts[0] if len(parts) == 1 else f"least({', '.join(parts)})")
    dists = [point_distance(x, y, cx, cy) for cx, cy in centers]
    return dists[0] if len(dists) == 1 else F.least(*dists)


def distances(centers: Sequence[Point]) -> Column:
    """Array of the squared distances of ``x, y`` to each centroid, for a projection of its own.

    One element reads ``x`` through a lambda, which keeps Spark from fusing the
    projection with its neighbours into one method; that would be too long to be
    compiled to machine code from some twenty centroids on.
    """
    unfused = F.get(F.transform(F.array("x"), lambda x: x), F.lit(0))
    first = point_distance(unfused, "y", *centers[0])
    return F.array(first, *(F.expr(_distance_sql("x", "y", cx, cy)) for cx, cy in centers[1:]))


def place_of_least(values: Column) -> Column:
    """Index of the smallest element of an array; ties go to the lowest."""
    return (F.array_position(values, F.array_min(values)) - 1).cast("int")
