"""Time-use survey: classify activity columns, summarise, average by group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tessera.functions.survey import age_band, group_hours, sex_label, working_status

# Fixed activity-code prefixes; the first group that matches a column wins.
PRIMARY_NEEDS_PREFIXES = ("t01", "t03", "t11", "t1801", "t1803")
WORK_PREFIXES = ("t05", "t1805")
OTHER_PREFIXES = (
    "t02", "t04", "t06", "t07", "t08", "t09", "t10",
    "t12", "t13", "t14", "t15", "t16", "t18",
)

KEYS = ("working", "sex", "age")
HOURS = ("primaryNeeds", "work", "other")

# Row type of a summary (typed variants are checked against it by name).
TIME_USAGE_ROW = StructType(
    [StructField(k, StringType(), True) for k in KEYS]
    + [StructField(h, DoubleType(), True) for h in HOURS]
)


def classify_columns(column_names: Sequence[str]) -> tuple[list[str], list[str], list[str]]:
    """Split column names into (primary needs, work, other), order kept.

    Names matching no group are dropped.  Pure metadata: no Spark job.
    """
    primary: list[str] = []
    work: list[str] = []
    other: list[str] = []
    for name in column_names:
        if name.startswith(PRIMARY_NEEDS_PREFIXES):
            primary.append(name)
        elif name.startswith(WORK_PREFIXES):
            work.append(name)
        elif name.startswith(OTHER_PREFIXES):
            other.append(name)
    return primary, work, other


def labour_force(df: DataFrame) -> DataFrame:
    """Respondents in the labour force: ``telfs <= 4`` (null dropped)."""
    return df.where(F.col("telfs") <= 4)


def summary_columns(
    primary: Sequence[str | Column], work: Sequence[str | Column], other: Sequence[str | Column]
) -> list[Column]:
    return [
        working_status().alias("working"),
        sex_label().alias("sex"),
        age_band().alias("age"),
        group_hours(primary, "primary needs").alias("primaryNeeds"),
        group_hours(work, "work").alias("work"),
        group_hours(other, "other").alias("other"),
    ]


def time_usage_summary(
    primary: Sequence[str | Column],
    work: Sequence[str | Column],
    other: Sequence[str | Column],
    df: DataFrame,
) -> DataFrame:
    """One row per labour-force respondent:
    ``working, sex, age, primaryNeeds, work, other`` (hours).

    The filter is written before the projection so it reaches the scan.
    """
    cols = summary_columns(primary, work, other)
    return labour_force(df).select(*cols)


def time_usage_summary_arrays(names: Sequence[str], df: DataFrame) -> DataFrame:
    """:func:`time_usage_summary` over an array table (``telfs``, ``tesex``, ``teage``, ``values`` named by ``names``).

    The sums are the same trees of ``+``, over the array's elements.  The
    status is computed inside a lambda, which Spark does not fuse: a projection
    fused with its neighbours is one method for all elements, too long to be
    compiled to machine code, and on its own it is cut into many.
    """
    place = {n: F.get("values", F.lit(i)) for i, n in enumerate(names)}
    primary, work, other = ([place[n] for n in group] for group in classify_columns(names))
    _, *columns = summary_columns(primary, work, other)
    status = F.get(F.transform(F.array("telfs"), lambda t: working_status(t)), F.lit(0))
    return labour_force(df).select(status.alias("working"), *columns)


def _round1(c: Column, via_decimal: bool) -> Column:
    if via_decimal:
        # round the decimal expansion, not the binary double: stable across
        # engines and summation orders
        return F.round(c.cast("decimal(18,6)"), 1).cast("double")
    return F.round(c, 1)


def _grouped_aggs(via_decimal: bool) -> list[Column]:
    return [_round1(F.avg(h), via_decimal).alias(h) for h in HOURS]


def time_usage_grouped(summed: DataFrame, via_decimal: bool = False) -> DataFrame:
    """Mean hours per (working, sex, age), rounded to one decimal, sorted by the keys."""
    return summed.groupBy(*KEYS).agg(*_grouped_aggs(via_decimal)).orderBy(*KEYS)


def grouped_sql(view: str = "{summed}", via_decimal: bool = False) -> str:
    def r(h: str) -> str:
        if via_decimal:
            return f"CAST(round(CAST(avg({h}) AS DECIMAL(18,6)), 1) AS DOUBLE) AS {h}"
        return f"round(avg({h}), 1) AS {h}"

    return (
        f"SELECT working, sex, age, {', '.join(r(h) for h in HOURS)} "
        f"FROM {view} GROUP BY working, sex, age ORDER BY working, sex, age"
    )


def register_view(df: DataFrame, name: str) -> str:
    """Name a DataFrame for SQL in this session; returns the name."""
    df.createOrReplaceTempView(name)
    return name


def time_usage_grouped_sql(
    summed: DataFrame, via_decimal: bool = False, view_name: str | None = None
) -> DataFrame:
    """Same as :func:`time_usage_grouped`, written in SQL.

    By default the DataFrame is passed to ``spark.sql`` as an argument (no
    session-wide name); with ``view_name`` it is registered as a temporary
    view of that name and the statement reads the view.
    """
    spark = summed.sparkSession
    if view_name is None:
        return spark.sql(grouped_sql("{summed}", via_decimal), summed=summed)
    return spark.sql(grouped_sql(register_view(summed, view_name), via_decimal))


def time_usage_summary_typed(summary: DataFrame) -> DataFrame:
    """The summary conformed to the row type, columns matched by name."""
    return summary.to(TIME_USAGE_ROW)


def time_usage_grouped_typed(summed: DataFrame, via_decimal: bool = False) -> DataFrame:
    """Grouped means over typed rows; the result conforms to the row type."""
    typed = time_usage_summary_typed(summed)
    return (
        typed.groupBy(*KEYS)
        .agg(*_grouped_aggs(via_decimal))
        .to(TIME_USAGE_ROW)
        .orderBy(*KEYS)
    )
