"""Header-driven survey tables: first column text, every other column a number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tessera.sources.lines import computed_once, require


def survey_schema(column_names: Sequence[str]) -> StructType:
    """First column string, all others double; none nullable."""
    if not column_names:
        raise ValueError("a survey needs at least one column")
    head, *rest = column_names
    return StructType(
        [StructField(head, StringType(), False)]
        + [StructField(n, DoubleType(), False) for n in rest]
    )


def survey_row(fields: Sequence[str]) -> Row:
    """Raw fields -> Row(first as text, rest as doubles); a bad number raises."""
    head, *rest = fields
    return Row(head, *[float(x) for x in rest])


#: Columns that stay columns in an array table (they are filtered on and label the respondents).
KEY_COLUMNS = ("telfs", "tesex", "teage")
#: A character that no line may hold: a whole line is one field between two of these.
_NO_SEPARATOR = "\x01"


def _header(spark: SparkSession, path: str | list[str]) -> str:
    header = spark.read.text(path).first()
    if header is None:
        raise ValueError(f"empty survey input: {path}")
    return header[0]


def _checked(spark: SparkSession, path: str | list[str], header: str) -> DataFrame:
    """The data lines of all files, checked: ``_f`` (fields) and ``_x`` (all but the first, as numbers).

    The CSV source drops the first line of each file and refuses a file whose
    header differs; a data line that equals the header stays.
    """
    whole_line = StructType([StructField(header, StringType())])
    reader = spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    lines = reader.option("quote", "").option("sep", _NO_SEPARATOR).schema(whole_line).csv(path).toDF("_line")
    n = header.count(",") + 1
    fields = computed_once(lines, _f=F.split("_line", ",", -1))
    fields = computed_once(fields, _x=F.transform(F.slice("_f", 2, n), lambda x: x.try_cast("double")))
    ok = (F.size("_f") == n) & (F.get("_f", F.lit(0)) != "") & F.forall("_x", lambda x: x.isNotNull())
    return fields.where(require(ok, F.col("_line"), "survey"))


def _number(x: str, i: int) -> Column:
    return F.coalesce(F.get(x, F.lit(i)), F.lit(0.0))  # checked: never null


def read_survey(
    spark: SparkSession, path: str | list[str], strict: bool = True
) -> tuple[list[str], DataFrame]:
    """Read a CSV survey: returns (column names, table).

    Names come from the header line of one file; a file whose header differs,
    in names or order, fails the read.  Fields are split on every comma, quotes
    are ordinary characters.  The first line of each file is its header and
    no other: a data line that equals it is a data line.  Blank lines are skipped.

    ``strict`` checks every field of every line, whichever columns a query
    reads: an empty field, a bad number or a line of another length fails the
    job (as does a control character 0x01).  Each line is split once.  Otherwise
    only the columns that are read are parsed (and pruned from the scan), empty
    fields are null, and only a bad number among them fails.
    """
    header = _header(spark, path)
    names = header.split(",")
    if not strict:
        reader = spark.read.option("header", True).option("quote", "").option("mode", "FAILFAST")
        return names, reader.option("enforceSchema", False).schema(survey_schema(names)).csv(path)
    columns = [F.coalesce(F.get("_f", F.lit(0)), F.lit("")).alias(names[0])]
    columns += [_number("_x", i).alias(n) for i, n in enumerate(names[1:])]
    return names, _checked(spark, path, header).select(*columns)


def read_survey_arrays(
    spark: SparkSession, path: str | list[str], keys: Sequence[str] = KEY_COLUMNS
) -> tuple[list[str], DataFrame]:
    """Read a CSV survey as an array table, strictly: returns (names of the values, table).

    The table has the first column, the ``keys`` and ``values``, one array with all
    other columns in the order of the names.  However many columns the survey has,
    stored as Parquet it is read in batches, by few columns.
    """
    header = _header(spark, path)
    first, *numbers = header.split(",")
    missing = [k for k in keys if k not in numbers]
    if missing:
        raise ValueError(f"the survey has no column {missing[0]!r}")
    names = [n for n in numbers if n not in keys]
    values = F.col("_x")
    if names != numbers[len(keys):]:  # the keys are not the first numbers, in whatever order
        places = F.array(*(F.lit(numbers.index(n)) for n in names))
        values = F.transform(places, lambda i: F.get("_x", i))
    else:
        values = F.slice("_x", len(keys) + 1, len(numbers))
    return names, _checked(spark, path, header).select(
        F.coalesce(F.get("_f", F.lit(0)), F.lit("")).alias(first),
        *(_number("_x", numbers.index(k)).alias(k) for k in keys),
        values.alias("values"),
    )


def survey_arrays(df: DataFrame, keys: Sequence[str] = KEY_COLUMNS) -> tuple[list[str], DataFrame]:
    """A survey table of many columns as an array table: (names of the values, table).

    One element is read through a lambda, which keeps Spark from fusing the
    projection with the scan and the filters: fused, the array is one method for
    all elements, too long to be compiled to machine code.
    """
    first, *numbers = df.columns
    names = [n for n in numbers if n not in keys]
    columns = [F.col(f"`{n}`") for n in names]
    if columns:
        columns[0] = F.get(F.transform(F.array(columns[0]), lambda x: x), F.lit(0))
    return names, df.select(first, *keys, F.array(*columns).alias("values"))
