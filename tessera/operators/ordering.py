"""Running totals within groups of any size, without a window over a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize


def ranged(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "ranged") -> DataFrame:
    """``df`` range-sorted by group and order, with ``_part``, the number of the range; materialised.

    Ranges hold about equally many rows, so a large group has several of them and
    small groups share one.  :func:`tessera.session.release` it when it is not read any more.
    """
    return materialize(df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()), name)


def part_totals(parts: DataFrame, group: Sequence[str], weight: Column) -> DataFrame:
    """Per group and range: ``_before`` (weight in earlier ranges of the group), ``_held`` and ``_total``.

    Summed with map-side combine; the window sees one row per range of a group.
    """
    held = parts.groupBy(*group, "_part").agg(F.sum(weight).alias("_held"))
    of_group = Window.partitionBy(*group)
    upto = F.sum("_held").over(of_group.orderBy("_part"))
    return held.select(*group, "_part", "_held", (upto - F.col("_held")).alias("_before"), F.sum("_held").over(of_group).alias("_total"))


def running_totals(
    parts: DataFrame, group: Sequence[str], order: Sequence[str], weight: Column, name: str = "before", tasks: int | None = None
) -> DataFrame:
    """Rows of a :func:`ranged` table with the weight of the rows before them in their group.

    The sum over earlier ranges and a window within (group, range): no task
    holds more of a group than a range.  ``tasks`` is how many the rows are dealt to,
    by group and range, if not as many as the session says.
    """
    totals = part_totals(parts, group, weight).drop("_held", "_total")
    here = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    if tasks is not None:
        parts = parts.repartition(tasks, *group, "_part")
    joined = parts.join(totals, [*group, "_part"])
    return joined.withColumn(name, F.col("_before") + F.sum(weight).over(here) - weight).drop("_part", "_before")
