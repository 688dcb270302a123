"""Sum and maximum of a column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_sum(df: DataFrame, column: str, alias: str = "total") -> DataFrame:
    """Sum of a column; 0 for an empty input.  Integers widen to bigint."""
    return df.agg(F.coalesce(F.sum(column), F.lit(0)).alias(alias))


def column_max(df: DataFrame, column: str, alias: str = "maximum", strict: bool = False) -> DataFrame:
    """Largest value of a column (repeated maxima are fine).

    Empty input gives null, or fails the job with ``strict``.
    """
    m = F.max(column)
    if strict:
        m = F.when(F.count(F.lit(1)) > 0, m).otherwise(
            F.raise_error(F.lit(f"max of empty column {column}"))
        )
    return df.agg(m.alias(alias))
