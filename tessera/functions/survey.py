"""Column expressions for time-use survey summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import as_col

MINUTES_PER_HOUR = 60


def working_status(telfs: str | Column = "telfs") -> Column:
    """``1 <= telfs < 3`` -> "working", anything else (and null) -> "not working"."""
    t = as_col(telfs)
    return F.when((t >= 1) & (t < 3), "working").otherwise("not working")


def sex_label(tesex: str | Column = "tesex") -> Column:
    """``tesex = 1`` -> "male", anything else (and null) -> "female"."""
    return F.when(as_col(tesex) == 1, "male").otherwise("female")


def age_band(teage: str | Column = "teage") -> Column:
    """15..22 "young", 23..55 "active", everything else (and null) "elder"."""
    a = as_col(teage)
    return (
        F.when((a >= 15) & (a <= 22), "young")
        .when((a >= 23) & (a <= 55), "active")
        .otherwise("elder")
    )


def balanced_sum(cols: Sequence[str | Column]) -> Column:
    """Sum of many columns as a balanced tree of ``+``.

    A left-deep chain over a few hundred columns overflows the analyzer's
    stack; the balanced tree has logarithmic depth.  Null if any input is
    null, like ``+``.
    """
    if not cols:
        raise ValueError("cannot sum an empty column group")
    if len(cols) == 1:
        return as_col(cols[0])
    mid = len(cols) // 2
    return balanced_sum(cols[:mid]) + balanced_sum(cols[mid:])


def balanced_sum_sql(names: Sequence[str]) -> str:
    """The same tree as SQL text (for oracle statements)."""
    if not names:
        raise ValueError("cannot sum an empty column group")
    if len(names) == 1:
        return names[0]
    mid = len(names) // 2
    return f"({balanced_sum_sql(names[:mid])} + {balanced_sum_sql(names[mid:])})"


def group_hours(cols: Sequence[str | Column], group: str = "group") -> Column:
    """Minutes summed over a column group, in hours."""
    if not cols:
        raise ValueError(f"column group {group!r} is empty")
    return balanced_sum(cols) / MINUTES_PER_HOUR
