"""Parser for comma-separated forum postings.

A line is ``posting_type,id,accepted_answer,parent_id,score[,tag[,...]]``:
split on every comma, no quoting.  Fields 0, 1 and 4 are required
integers; 2 and 3 are optional (empty -> null); the tag is field 5 when
present and non-empty; later fields are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.lines import computed_once, read_lines, require

POSTING_SCHEMA = (
    "posting_type int, id bigint, accepted_answer bigint, parent_id bigint, "
    "score int, tag string"
)

_INT = r"[+-]?[0-9]+"
# a well-formed line: three required integers, two optional ones, anything after
LINE_PATTERN = rf"^{_INT},{_INT},({_INT})?,({_INT})?,{_INT}(,.*)?$"


def well_formed(value: Column, fields: Column) -> Column:
    """The line has its fields, and each number fits its column."""
    number = [F.nullif(F.try_element_at(fields, F.lit(i + 1)), F.lit("")) for i in range(5)]
    fits = value.rlike(LINE_PATTERN)
    for c, kind in zip(number, ("int", "bigint", "bigint", "bigint", "int")):
        fits = fits & (c.isNull() | c.try_cast(kind).isNotNull())
    return F.coalesce(fits, F.lit(False))


def posting_columns(fields: Column, strict: bool = True) -> list[Column]:
    """Posting columns from the comma-split ``fields`` of a line."""
    cast = (lambda c, t: c.cast(t)) if strict else (lambda c, t: c.try_cast(t))

    def field(i: int) -> Column:
        return F.try_element_at(fields, F.lit(i + 1))

    return [
        cast(field(0), "int").alias("posting_type"),
        cast(field(1), "bigint").alias("id"),
        cast(F.nullif(field(2), F.lit("")), "bigint").alias("accepted_answer"),
        cast(F.nullif(field(3), F.lit("")), "bigint").alias("parent_id"),
        cast(field(4), "int").alias("score"),
        F.nullif(field(5), F.lit("")).alias("tag"),
    ]


def parse_postings(lines: DataFrame, column: str = "value", strict: bool = True) -> DataFrame:
    """Raw lines -> postings (``POSTING_SCHEMA``).

    ``strict`` fails the job on a malformed line (bad integer, too few
    fields), like the reference; the check is a filter, so it holds whichever
    columns are read.  Otherwise bad integers become null and a ``malformed``
    flag marks the line.  The line is split once; the check and every column
    read that array.
    """
    v = F.col("_line")
    split = computed_once(lines.select(F.col(column).alias("_raw")), _line=F.col("_raw"), _f=F.split("_line", ",", -1))
    cols, ok = posting_columns(F.col("_f"), strict), well_formed(v, F.col("_f"))
    if strict:
        return split.where(require(ok, v, "posting")).select(*cols)
    return split.select(*cols, (~ok).alias("malformed"))


def read_postings(spark: SparkSession, path: str | list[str], strict: bool = True) -> DataFrame:
    return parse_postings(read_lines(spark, path), strict=strict)
