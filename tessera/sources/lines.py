"""Line-oriented text input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, column ``value``.

    Split sizes come from ``spark.sql.files.maxPartitionBytes``; no
    partition count is hard-coded.
    """
    return spark.read.text(path)


def require(ok: Column, line: Column, what: str) -> Column:
    """Filter condition that is true, or fails the job where ``ok`` does not hold.

    A failing expression in one output column would be pruned with it.
    """
    text = F.coalesce(F.substring(line, 1, 80), F.lit("null"))
    error = F.raise_error(F.concat(F.lit(f"malformed {what} line: "), text))
    return F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(error.cast("boolean"))


def computed_once(df: DataFrame, **values: Column) -> DataFrame:
    """``df`` with further columns, each computed once per row however often it is read.

    Catalyst copies an expression into every filter and column that reads it.
    It does not copy across a generator, so each value is the only element of an
    array that is unfolded; the rows stay in one generated method.
    """
    for name, value in values.items():
        df = df.select("*", F.explode(F.array(value)).alias(name))
    return df
