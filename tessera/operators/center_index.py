"""Nearest centroids among many: cells of a grid, each with the few centroids that can be nearest in it.

The grid's lines are quantiles of the centroids' coordinates.  One aggregate
gives the box of the points in each occupied cell.  A centroid can only be
nearest to a point of a box if its least distance to the box is not above the
smallest of the centroids' greatest distances to it; those centroids are found
on the driver, which holds the boxes (fewer than centroids) and the centroids.
Rows meet their cell's list by a join on the cell and fold over that list alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.vectors import Point, point_distance

# Centroids per cell the grid aims at, and cells compared with all centroids at a time.
CELL_CENTERS = 8
BLOCK = 256
# Most entries in all lists together; the longest lists beyond are left out, and
# rows of those cells fold over all centroids.
LIST_ENTRIES = 4_000_000
# Distances are doubles: a list keeps what is within rounding of the bound.
SLACK = 1 + 1e-9

CANDIDATES = "array<struct<cx: long, cy: long, i: int>>"


def _lines(values: Sequence[int], n: int) -> list[float]:
    """Up to ``n`` distinct quantiles of the values, between infinities."""
    distinct = np.unique(np.asarray(values, float))
    picked = distinct[np.linspace(0, len(distinct) - 1, min(n, len(distinct))).astype(int)]
    middle = sorted(set(picked.tolist()))
    return [-math.inf, *middle, math.inf]


class CenterCells:
    """The grid over ``vectors`` (``x, y``, integers), made from some centroids and good for any others."""

    def __init__(self, vectors: DataFrame, centers: Sequence[Point]):
        cells = max(len(centers) // CELL_CENTERS, 1)
        xs, ys = zip(*centers)
        across = min(len(set(xs)), max(math.isqrt(cells), 1))
        lines = [_lines(xs, across), _lines(ys, max(cells // across, 1))]
        at = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_{c}") for c in ("x", "y")]
        buckets = Bucketizer(splitsArray=lines, inputCols=["_x", "_y"], outputCols=["_i", "_j"])
        placed = buckets.transform(vectors.select("*", *at))
        cell = (F.col("_i") * len(lines[1]) + F.col("_j")).cast("int")
        self.vectors = placed.withColumn("_cell", cell).drop("_x", "_y", "_i", "_j")
        known = self.vectors.where(F.col("x").isNotNull() & F.col("y").isNotNull())
        boxes = known.groupBy("_cell").agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).collect()
        self.cells = [r[0] for r in boxes]
        self.boxes = np.array([r[1:] for r in boxes], float).reshape(len(boxes), 4)

    def lists(self, centers: Sequence[Point], keep: int = 1) -> list[np.ndarray]:
        """Per cell the indexes of the centroids among which are the ``keep`` nearest to any point in its box.

        Of centroids at one place only the first ``keep`` count.
        """
        order = sorted(range(len(centers)), key=lambda i: (centers[i], i))
        first = [i for at, i in enumerate(order) if at < keep or centers[order[at - keep]] != centers[i]]
        index = np.array(sorted(first))
        c = np.asarray(centers, float)[index]
        found = []
        for at in range(0, len(self.boxes), BLOCK):
            x0, x1, y0, y1 = (self.boxes[at : at + BLOCK, k, None] for k in range(4))
            cx, cy = c[None, :, 0], c[None, :, 1]
            dx, dy = (np.maximum(np.maximum(lo - p, p - hi), 0) for lo, hi, p in ((x0, x1, cx), (y0, y1, cy)))
            least = dx * dx + dy * dy
            fx, fy = (np.maximum(np.abs(p - lo), np.abs(hi - p)) for lo, hi, p in ((x0, x1, cx), (y0, y1, cy)))
            most = fx * fx + fy * fy
            bound = np.partition(most, keep - 1, axis=1)[:, keep - 1 : keep] if keep <= len(c) else np.inf
            near = least <= bound * SLACK
            found += [index[np.nonzero(row)[0]] for row in near]
        return found

    def _table(self, centers: Sequence[Point], keep: int) -> DataFrame:
        lists, held, rows = self.lists(centers, keep), 0, []
        for k in sorted(range(len(lists)), key=lambda k: len(lists[k])):
            held += len(lists[k])
            if held > LIST_ENTRIES:
                break
            rows.append((self.cells[k], [(*centers[i], int(i)) for i in lists[k].tolist()]))
        return self.vectors.sparkSession.createDataFrame(rows, f"_cell int, _near {CANDIDATES}")

    def _sorted(self, centers: Sequence[Point], keep: int) -> tuple[DataFrame, Column]:
        """The vectors joined with their lists, and the (distance, index) structs of a row's list."""
        centers = [(int(x), int(y)) for x, y in centers]
        joined = self.vectors.join(F.broadcast(self._table(centers, keep)), "_cell", "left")
        everything = F.from_json(
            F.lit("[" + ",".join(f'{{"cx":{x},"cy":{y},"i":{i}}}' for i, (x, y) in enumerate(centers)) + "]"), CANDIDATES
        )
        near = F.coalesce(F.col("_near"), everything)
        return joined, F.transform(near, lambda c: F.struct(point_distance("x", "y", c.cx, c.cy).alias("d"), c.i.alias("i")))

    def assign(self, centers: Sequence[Point]) -> DataFrame:
        """The vectors with ``cluster``, the index of the nearest centroid; ties go to the lowest index.

        A vector with a null coordinate gets the first, as everywhere.
        """
        joined, each = self._sorted(centers, 1)
        somewhere = F.col("x").isNotNull() & F.col("y").isNotNull()
        return joined.withColumn("cluster", F.when(somewhere, F.array_min(each).i).otherwise(0)).drop("_cell", "_near")

    def two_nearest(self, centers: Sequence[Point]) -> DataFrame:
        """:meth:`assign` with ``d1`` and ``d2``, the squared distances of the nearest and the second nearest."""
        joined, each = self._sorted(centers, 2)
        ranked = joined.withColumn("_two", F.slice(F.array_sort(each), 1, 2))
        two = F.col("_two")
        return ranked.withColumns(
            {"cluster": two[0].i, "d1": two[0].d, "d2": F.get(two, F.lit(1)).d}
        ).drop("_cell", "_near", "_two")
