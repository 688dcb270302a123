"""Exact integer k-means on 2-D vectors ``x, y``.

One step: assign every vector to its nearest centroid (ties to the lowest
index), replace each centroid by the component means of its members with
integer division truncating toward zero; a centroid without members keeps
its place.  Iterate until the summed squared movement of all centroids is
below ``eta`` or ``max_iterations`` steps ran; the last step's centroids are
the result either way.

At scale, the input is first collapsed to distinct ``(x, y, n)`` rows:
sums of integers are exact, so weighted means equal the raw ones while
every iteration reads a table bounded by the number of distinct points.
Each iteration is one job whose shuffle carries at most K partial sums
per task and whose result is at most K rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.vectors import (
    WRITTEN_CENTERS,
    Point,
    distances,
    nearest_center,
    place_of_least,
    point_distance,
)
from tessera.operators.center_index import CenterCells
from tessera.session import check_state, input_fingerprint, materialize, release

# Fixed default parameters: convergence threshold and iteration cap.
DEFAULT_ETA = 20.0
DEFAULT_MAX_ITERATIONS = 120
# Up to this many centroids the nearest is one expression within its stage.
FUSED_CENTERS = 16


def weighted_vectors(vectors: DataFrame) -> DataFrame:
    """Distinct points with their multiplicity: ``x, y, n``."""
    return vectors.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))


def _weight(vectors: DataFrame) -> Column:
    return F.col("n") if "n" in vectors.columns else F.lit(1).cast("long")


def assign(vectors: DataFrame, centers: list[Point], cells: CenterCells | None = None) -> DataFrame:
    """Adds ``cluster`` (index of the nearest centroid).

    More centroids than are written out are looked up by cell: ``cells``, made
    before over the same vectors, or made here (one aggregate over the vectors).
    """
    if len(centers) <= FUSED_CENTERS:
        return vectors.withColumn("cluster", nearest_center(centers).cast("int"))
    if len(centers) <= WRITTEN_CENTERS:
        all_d = vectors.withColumn("_d", distances(centers))
        # no distance to a null coordinate: the first, as where they are written out
        return all_d.withColumn("cluster", F.coalesce(place_of_least(F.col("_d")), F.lit(0))).drop("_d")
    return (cells or CenterCells(vectors, centers)).assign(centers)


def _member_sums(assigned: DataFrame, w: Column) -> DataFrame:
    return assigned.groupBy("cluster").agg(
        F.sum(F.col("x") * w).alias("sx"),
        F.sum(F.col("y") * w).alias("sy"),
        F.sum(w).alias("n"),
    )


def _means(sums: DataFrame) -> DataFrame:
    return sums.select(
        "cluster",
        F.expr("sx div n").alias("x"),
        F.expr("sy div n").alias("y"),
        "n",
    )


def average_vectors(vectors: DataFrame, centers: list[Point], cells: CenterCells | None = None) -> DataFrame:
    """Member means of every non-empty cluster: ``cluster, x, y, n``.

    Long sums, integer division truncating toward zero.  Accepts raw
    vectors or weighted ``(x, y, n)`` rows.
    """
    return _means(_member_sums(assign(vectors, centers, cells), _weight(vectors)))


def centroid_frame(spark: SparkSession, centers: list[Point]) -> DataFrame:
    return spark.createDataFrame(
        [(i, int(x), int(y)) for i, (x, y) in enumerate(centers)], "cluster int, x long, y long"
    )


def kmeans_step(vectors: DataFrame, centers: list[Point]) -> DataFrame:
    """New centroids ``cluster, x, y`` (all K; empty clusters unchanged)."""
    means = average_vectors(vectors, centers).select(
        "cluster", F.col("x").alias("nx"), F.col("y").alias("ny")
    )
    old = centroid_frame(vectors.sparkSession, centers)
    # `means` has at most K rows
    return old.join(F.broadcast(means), "cluster", "left").select(
        "cluster",
        F.coalesce("nx", "x").alias("x"),
        F.coalesce("ny", "y").alias("y"),
    )


def _sq(a: Point, b: Point) -> float:
    dx, dy = a[0] - b[0], a[1] - b[1]
    return float(dx) * dx + float(dy) * dy


def centroid_shift(old: list[Point], new: list[Point]) -> float:
    """Sum of squared movements of all centroids (same count required)."""
    if len(old) != len(new):
        raise ValueError("centroid sets differ in size")
    return sum(_sq(a, b) for a, b in zip(old, new))


def centroid_shift_frame(old: DataFrame, new: DataFrame) -> DataFrame:
    """:func:`centroid_shift` over two ``cluster, x, y`` frames (K rows each)."""
    n = new.select("cluster", F.col("x").alias("nx"), F.col("y").alias("ny"))
    return old.join(n, "cluster").agg(
        F.sum(point_distance("x", "y", F.col("nx"), F.col("ny"))).alias("shift")
    )


def converged(distance: float, eta: float = DEFAULT_ETA) -> bool:
    return distance < eta


@dataclass
class KMeansResult:
    centers: list[Point]
    iterations: int
    shift: float
    trace: list[tuple] = field(default_factory=list)
    inputs: object = None
    converged: bool = False  # False: stopped by the iteration limit
    compared: list[float] = field(default_factory=list)  # per step of this run: share of the vectors compared

    TRACE_SCHEMA = (
        "iteration int, cluster int, old_x long, old_y long, x long, y long, moved double, "
        "shift double"
    )

    def trace_frame(self, spark: SparkSession) -> DataFrame:
        """Per iteration and centroid: old -> new position, its squared move,
        and the iteration's total shift (compared against ``eta``)."""
        return spark.createDataFrame(self.trace, self.TRACE_SCHEMA)

    def centers_frame(self, spark: SparkSession) -> DataFrame:
        return centroid_frame(spark, self.centers)


def _save_iteration(spark: SparkSession, state_path: str, rows: list[tuple]) -> None:
    """Record one finished iteration under ``state_path/iteration=N``.

    Each iteration is its own committed partition, so a crash while
    writing never damages earlier ones (uncommitted output stays in the
    writer's temporary folder, which readers skip).
    """
    it = rows[0][0]
    spark.createDataFrame(rows, KMeansResult.TRACE_SCHEMA).drop("iteration").write.mode(
        "overwrite"
    ).parquet(f"{state_path.rstrip('/')}/iteration={it}")


def _load_state(spark: SparkSession, state_path: str) -> list[tuple] | None:
    """Trace rows of every committed iteration, or None if there are none."""
    try:
        df = spark.read.parquet(state_path)
    except AnalysisException:  # nothing recorded yet
        return None
    cols = [c.split()[0] for c in KMeansResult.TRACE_SCHEMA.split(", ")]
    rows = [tuple(r[c] for c in cols) for r in df.orderBy("iteration", "cluster").collect()]
    if not rows:
        return None
    # keep the contiguous prefix 1..N of complete iterations
    k = max(r[1] for r in rows) + 1
    done = []
    for it in range(1, max(r[0] for r in rows) + 1):
        chunk = [r for r in rows if r[0] == it]
        if len(chunk) != k:
            break
        done.extend(chunk)
    return done or None


def _moved(means: DataFrame, centers: list[Point]) -> list[Point]:
    new = list(centers)
    for r in means.collect():  # <= K rows
        new[r["cluster"]] = (int(r["x"]), int(r["y"]))
    return new


class _Plain:
    """Every vector is compared with the centroids in every step."""

    def __init__(self, data: DataFrame, centers: list[Point]):
        self.data = data
        self.cells = CenterCells(data, centers) if len(centers) > WRITTEN_CENTERS else None
        self.compared: list[float] = []

    def step(self, centers: list[Point]) -> list[Point]:
        self.compared.append(1.0)
        return _moved(average_vectors(self.data, centers, self.cells), centers)

    def close(self) -> None:
        pass


def two_nearest(vectors: DataFrame, centers: list[Point], cells: CenterCells | None = None) -> DataFrame:
    """:func:`assign` with ``d1`` and ``d2``, the squared distances of the nearest and the second nearest centroid
    (null if there is none)."""
    if len(centers) > WRITTEN_CENTERS:
        return (cells or CenterCells(vectors, centers)).two_nearest(centers)
    all_d = vectors.withColumn("_d", distances(centers))
    ranked = all_d.withColumn("_s", F.sort_array("_d"))
    return ranked.withColumns(
        {
            "cluster": F.coalesce(place_of_least(F.col("_d")), F.lit(0)),
            "d1": F.get("_s", F.lit(0)),
            "d2": F.get("_s", F.lit(1)),
        }
    ).drop("_d", "_s")


# Margins are kept as powers of 2 ** (1 / MARGIN_BINS).  Bounds are used while at
# most so large a share of the vectors must be compared, and renewed where
# the last step's movement would leave at most the second share.
MARGIN_BINS = 4
COMPARED_SHARE = 0.5
RENEWED_SHARE = 0.25


class _Bounded:
    """Vectors whose centroid cannot have changed are not compared, nor read.

    A base pass stores for each vector its centroid and its margin: by how much
    the second nearest is farther than the nearest.  As long as the two centroids
    that moved most since then moved less than that together, the triangle
    inequality says the vector keeps its centroid.  Each file is sorted by margin,
    so the others are read by a pushed filter; the sums of those that stay are
    kept per centroid and margin.  The base is renewed when too many must be
    compared and the centroids move little enough for that to pay.
    """

    def __init__(self, data: DataFrame, centers: list[Point]):
        self.data = data
        self.cells = CenterCells(data, centers) if len(centers) > WRITTEN_CENTERS else None
        self.compared: list[float] = []
        self.base: list[Point] | None = None
        self.last: list[Point] = centers
        self.table = self.sums = None
        self.histogram: list[tuple[int, int]] = []

    def _renew(self, centers: list[Point]) -> None:
        self.close()
        near, far = F.sqrt("d1"), F.sqrt(F.coalesce("d2", F.lit(float("inf"))))
        margin = far - near - F.least(near + far, F.lit(1e300)) * 1e-9  # less what rounding may have added
        least = -MARGIN_BINS * 64
        bin_ = F.when(margin > 0, F.greatest(F.floor(F.log2(margin) * MARGIN_BINS), F.lit(least))).otherwise(least)
        found = two_nearest(self.data, centers, self.cells).select(
            "x", "y", _weight(self.data).alias("n"), "cluster", F.least(bin_, F.lit(1 << 20)).cast("int").alias("bin")
        )
        self.table = materialize(found.sortWithinPartitions("bin"), "kmeans-bounds")
        w = F.col("n")
        sums = self.table.groupBy("cluster", "bin").agg(
            F.sum(F.col("x") * w).alias("sx"), F.sum(F.col("y") * w).alias("sy"), F.sum(w).alias("n"), F.count("*").alias("rows")
        )
        self.sums = materialize(sums, "kmeans-sums")
        self.base = centers
        self.histogram = [(r[0], r[1]) for r in self.sums.groupBy("bin").agg(F.sum("rows")).collect()]  # one row per margin

    def _open_bin(self, moved: list[Point], since: list[Point]) -> int:
        """Vectors below this margin may have another centroid now."""
        both = sum(sorted((math.sqrt(_sq(a, b)) for a, b in zip(since, moved)), reverse=True)[:2])
        return math.floor(math.log2(both * (1 + 1e-9)) * MARGIN_BINS) + 2 if both else -MARGIN_BINS * 64 + 1

    def _share(self, open_bin: int) -> float:
        rows = sum(n for _, n in self.histogram)
        return sum(n for b, n in self.histogram if b < open_bin) / rows if rows else 0.0

    def _worth_renewing(self, centers: list[Point]) -> bool:
        """Would the movement of the last step leave few vectors to compare?

        Before there is a base, margins are taken to be spread up to the usual
        distance between neighbouring centroids.
        """
        if self.base:
            return self._share(self._open_bin(centers, self.last)) <= RENEWED_SHARE
        some = [c for c, _ in zip(centers, range(500))]
        apart = sorted(min((_sq(a, b) for b in some if b != a), default=0.0) for a in some)
        both = sum(sorted((math.sqrt(_sq(a, b)) for a, b in zip(self.last, centers)), reverse=True)[:2])
        return self.compared != [] and both <= RENEWED_SHARE * math.sqrt(apart[len(apart) // 2])

    def step(self, centers: list[Point]) -> list[Point]:
        open_bin = self._open_bin(centers, self.base) if self.base else None
        if open_bin is not None and self._share(open_bin) <= COMPARED_SHARE:
            self.compared.append(self._share(open_bin))
        elif self._worth_renewing(centers):
            self._renew(centers)
            self.compared.append(1.0)
            open_bin = -MARGIN_BINS * 64 - 1
        else:
            self.compared.append(1.0)
            self.last = centers
            return _moved(average_vectors(self.data, centers, self.cells), centers)
        self.last = centers
        stay = self.sums.where(F.col("bin") >= open_bin).select("cluster", "sx", "sy", "n")
        may_move = self.table.where(F.col("bin") < open_bin).drop("cluster", "bin")
        both = _member_sums(assign(may_move, centers), F.col("n")).unionByName(stay)
        sums = both.groupBy("cluster").agg(F.sum("sx").alias("sx"), F.sum("sy").alias("sy"), F.sum("n").alias("n"))
        return _moved(_means(sums), centers)

    def close(self) -> None:
        for table in (self.table, self.sums):
            if table is not None:
                release(table)
        self.table = self.sums = None


def kmeans(
    vectors: DataFrame,
    centers: list[Point],
    eta: float = DEFAULT_ETA,
    max_iterations: int = DEFAULT_MAX_ITERATIONS,
    weighted: bool = True,
    state_path: str | None = None,
    bounds: bool = False,
) -> KMeansResult:
    """Iterate :func:`kmeans_step` until converged or ``max_iterations``.

    The (weighted) input is materialised once - written to the cluster's
    shared checkpoint folder when one is configured, persisted otherwise -
    and released when done.  Input that already carries a weight column
    ``n`` is taken as weighted and materialised by the caller.  Centroids
    travel inside each plan as literals, so lineage does not grow across
    iterations.

    ``state_path`` (a folder on shared storage) records every finished
    iteration; a run given the same folder - e.g. after the driver was
    lost - resumes after the last recorded iteration instead of starting
    over.  Only the <= K rows of each iteration are written.  A folder that
    belongs to other input, first centroids or threshold is refused; the
    iteration limit may change.  ``converged`` of the result tells a run that
    reached the threshold from one that the limit stopped.

    ``bounds`` keeps for each vector how far its centroids may move before it can
    change cluster, and compares only the vectors that may have; centroids
    and trace are the same, ``compared`` tells the share compared in each step.
    It pays where many vectors take many steps.
    """
    if max_iterations < 1:
        raise ValueError("max_iterations must be at least 1")
    spark = vectors.sparkSession
    means = [(int(x), int(y)) for x, y in centers]
    trace: list[tuple] = []
    iteration = 1
    if state_path:
        about = {"centers": means, "eta": eta, "weighted": weighted, "input": input_fingerprint(vectors)}
        check_state(spark, f"{state_path.rstrip('/')}.about", about)
    state = _load_state(spark, state_path) if state_path else None
    if state:
        last = max(r[0] for r in state)
        rows = [r for r in state if r[0] == last]
        if len(rows) != len(means):
            raise ValueError("recorded k-means state has a different number of centroids")
        trace = state
        new = [(r[4], r[5]) for r in rows]
        shift = rows[0][7]
        if converged(shift, eta) or last >= max_iterations:
            return KMeansResult(new, last, shift, trace, converged=converged(shift, eta))
        means, iteration = new, last + 1
    owned = not (weighted and "n" in vectors.columns)
    if owned:
        data = weighted_vectors(vectors) if weighted else vectors.select("x", "y")
        data = materialize(data, "kmeans-input")
    else:  # already weighted (x, y, n) and materialised by the caller
        data = vectors
    steps = (_Bounded if bounds else _Plain)(data, means)
    try:
        while True:
            new = steps.step(means)
            shift = centroid_shift(means, new)
            rows = [
                (iteration, i, o[0], o[1], n[0], n[1], _sq(o, n), shift)
                for i, (o, n) in enumerate(zip(means, new))
            ]
            trace.extend(rows)
            if state_path:
                _save_iteration(spark, state_path, rows)
            if converged(shift, eta) or iteration >= max_iterations:
                return KMeansResult(
                    new, iteration, shift, trace, converged=converged(shift, eta), compared=steps.compared
                )
            means = new
            iteration += 1
    finally:
        steps.close()
        if owned:
            release(data)
