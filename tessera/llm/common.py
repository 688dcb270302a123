"""Helpers shared by the operators: stored intermediates, text columns, lets."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import shared_dir

#: White space of the text contracts: space and the controls 9 to 13.
WS = "\x20\t\n\x0b\x0c\r"
WS_CLASS = "[\\x20\\x09-\\x0D]"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks it ran, and what
    was stored is not computed again.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete a table made by :func:`stored`; only for tables no result reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    base = shared_dir(spark)
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        plain = path.toUri().getPath()
        if plain.startswith(jvm.org.apache.hadoop.fs.Path(base).toUri().getPath()):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once.

    A plain reuse of a column expression inside a lambda would be inlined and
    evaluated again for each element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def text_or_empty(col: str | Column = "text") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(""))


def space_words(text: Column) -> Column:
    """Array of the words between white space."""
    return F.array_remove(F.split(text, WS_CLASS + "+"), "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay.

    Pure ASCII texts take the built-in ``lower``, which is then the same.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, ASCII_UPPER, ASCII_LOWER)
    )


def content_keys(doc_id: str | Column, text: Column) -> tuple[Column, Column]:
    """128 bits of a row's id and text, which any later scan computes again.

    Rows that agree in them have the same id and the same text, so they get the
    same result.
    """
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.xxhash64(c, text), F.xxhash64(text, F.lit("b"), c)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: A table of one row per key is broadcast up to so many bytes, and joined in so many salted parts beyond.
BROADCAST_BYTES = 16 << 20
SALTS = 16


def join_per_key(rows: DataFrame, per_key: DataFrame, key: str, salt: Column) -> DataFrame:
    """``rows`` with the other columns of ``per_key`` (a stored table, one row per ``key``; nulls match).

    ``per_key`` is measured first and broadcast if it is small.  Otherwise the
    rows of a key are dealt to ``SALTS`` parts by ``salt`` (any long), each of which
    meets a copy of the key's row, so that no key is one task.
    """
    held = F.octet_length(F.col(key).cast("string"))
    n, width = per_key.agg(F.count("*"), F.coalesce(F.sum(held), F.lit(0))).first()
    other = unused(rows, "other_" + key)
    table = per_key.withColumnRenamed(key, other)
    if 64 * n + width <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), F.col(key).eqNullSafe(F.col(other)), "left").drop(other)
    mine, theirs = unused(rows, "salt"), unused(rows, "other_salt")
    table = table.withColumn(theirs, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn(mine, F.pmod(salt, F.lit(SALTS)).cast("int"))
    same = F.col(key).eqNullSafe(F.col(other)) & (F.col(mine) == F.col(theirs))
    return dealt.join(table, same, "left").drop(other, mine, theirs)
