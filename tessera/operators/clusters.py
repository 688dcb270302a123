"""Describe k-means clusters: label, share of the label, size, median score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.forum import DEFAULT_LANG_SPREAD

from tessera.functions.vectors import Point
from tessera.operators.kmeans import assign
from tessera.operators.ordering import part_totals, ranged
from tessera.session import release

# Fixed report layout values: three header lines, then one line per cluster
# (median score, label, percent, size).
REPORT_HEADER = [
    "Resulting clusters:",
    "  Score  Dominant language (%percent)  Questions",
    "================================================",
]
REPORT_LINE = "%7d  %-17s (%-5.1f%%)      %7d"


# Up to so many distinct scores a cluster's counts are sorted in one task.
SORTED_SCORES = 1_000_000


def len_at_most(df: DataFrame, n: int) -> bool:
    return df.limit(n + 1).count() <= n


def _middle(total: Column, less: int) -> Column:
    """Number of members before one of the two middle ones."""
    return F.floor((total - less) / 2)


def _medians(counted: DataFrame) -> DataFrame:
    """``cluster, med`` from rows ``cluster, y, upto, total`` around the middle of each cluster."""
    values = [F.min(F.when(F.col("upto") > _middle(F.col("total"), less), F.col("y"))) for less in (1, 0)]
    return counted.groupBy("cluster").agg(((values[0] + values[1]) / 2).alias("med"))


def _medians_sorted(per_y: DataFrame) -> DataFrame:
    """Sorted, spillable counts per distinct score instead of one value -> count map per cluster."""
    in_cluster = Window.partitionBy("cluster")
    upto = F.sum("cnt").over(in_cluster.orderBy("y"))
    return _medians(per_y.select("cluster", "y", upto.alias("upto"), F.sum("cnt").over(in_cluster).alias("total")))


def medians_by_range(per_y: DataFrame) -> DataFrame:
    """The same for clusters of any number of distinct scores: ``cluster, med``.

    The counts are range-sorted by (cluster, score).  The totals of the ranges
    tell which hold the two middle members of each cluster; only those ranges,
    at most two per cluster, are summed along.  One row per cluster is collected.
    """
    parts = ranged(per_y, ["cluster"], ["y"], "scores")
    totals = part_totals(parts, ["cluster"], F.col("cnt"))
    holds = F.lit(False)
    for less in (1, 0):
        at = _middle(F.col("_total"), less)
        holds = holds | ((at >= F.col("_before")) & (at < F.col("_before") + F.col("_held")))
    middle = totals.where(holds).select("cluster", "_part", "_before", F.col("_total").alias("total"))
    rows = parts.join(F.broadcast(middle), ["cluster", "_part"])  # at most two rows per cluster
    along = Window.partitionBy("cluster", "_part").orderBy("y")
    counted = rows.select("cluster", "y", (F.col("_before") + F.sum("cnt").over(along)).alias("upto"), "total")
    medians = _medians(counted)
    found = per_y.sparkSession.createDataFrame(medians.collect(), medians.schema)
    release(parts)
    return found


def cluster_results(
    centers: list[Point],
    vectors: DataFrame,
    languages: Sequence[str],
    lang_spread: int = DEFAULT_LANG_SPREAD,
    label_rule: str = "lowest",
) -> DataFrame:
    """One row per non-empty cluster, ordered by median score:
    ``cluster, label, percent, size, median_score``.

    ``label_rule="lowest"`` labels a cluster by its smallest ``x`` (what the
    reference computes); ``"mode"`` by its most frequent ``x`` (what it
    documents; ties to the smaller x).  ``percent`` is the share of members
    carrying that ``x``; the median of ``y`` averages the two middle values
    of an even count and truncates to an integer.  Accepts raw vectors or
    weighted ``(x, y, n)`` rows.  Members are counted per (cluster, x) and
    (cluster, y) with map-side combine; only those counts are sorted, one row
    per distinct score of a cluster, and above ``SORTED_SCORES`` of them only the
    ranges around each median.
    """
    w = F.col("n") if "n" in vectors.columns else F.lit(1).cast("long")
    assigned = assign(vectors, centers).select("cluster", "x", "y", w.alias("w"))
    per_x = assigned.groupBy("cluster", "x").agg(F.sum("w").alias("cnt"))
    if label_rule == "lowest":
        pick = F.min(F.struct(F.col("x"), F.col("cnt")))
    elif label_rule == "mode":
        pick = F.max(F.struct(F.col("cnt"), (-F.col("x")).alias("neg_x")))
    else:
        raise ValueError("label_rule must be 'lowest' or 'mode'")
    labels = per_x.groupBy("cluster").agg(pick.alias("p"), F.sum("cnt").alias("size"))
    label_x = F.col("p.x") if label_rule == "lowest" else -F.col("p.neg_x")
    labels = labels.select(
        "cluster",
        label_x.alias("label_x"),
        F.col("p.cnt").alias("label_cnt"),
        "size",
    )
    per_y = assigned.groupBy("cluster", "y").agg(F.sum("w").alias("cnt"))
    if len_at_most(vectors if "n" in vectors.columns else per_y, SORTED_SCORES):
        medians = _medians_sorted(per_y)
    else:
        medians = medians_by_range(per_y)
    langs = F.array(*[F.lit(x) for x in languages])
    return (
        labels.join(medians, "cluster")
        .select(
            "cluster",
            F.try_element_at(langs, (F.expr(f"label_x div {int(lang_spread)}") + 1).cast("int")).alias("label"),
            ((F.col("label_cnt") * 100).cast("double") / F.col("size")).alias("percent"),
            F.col("size"),
            F.col("med").cast("int").alias("median_score"),
        )
        .orderBy("median_score", "cluster")
    )


def cluster_report(results: DataFrame) -> DataFrame:
    """Fixed-width text report: ``line_no, line`` (3 header lines first)."""
    spark = results.sparkSession
    header = spark.createDataFrame(
        [(i, s) for i, s in enumerate(REPORT_HEADER)], "line_no int, line string"
    )
    # results has one row per cluster (at most K)
    body = results.select(
        (F.row_number().over(Window.orderBy("median_score", "cluster")) + len(REPORT_HEADER) - 1)
        .cast("int")
        .alias("line_no"),
        F.format_string(REPORT_LINE, "median_score", "label", "percent", "size").alias("line"),
    )
    return header.unionByName(body).orderBy("line_no")
