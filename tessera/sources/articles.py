"""Positional parser for one-line article records.

Layout (fixed values that must match the record format):
    14 leading characters, the title, the delimiter ``</title><text>``,
    the text, 16 trailing characters.
No XML parsing and no unescaping; the first delimiter wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.lines import computed_once, read_lines, require

# Fixed layout values of the record format.
LEAD_CHARS = 14
TITLE_END = "</title><text>"
TRAIL_CHARS = 16


def article_columns(value: Column, i: Column) -> tuple[Column, Column, Column]:
    """(title, text, well_formed) over a raw line and the delimiter's place in it (from 1, 0 when absent)."""
    title_len = i - (LEAD_CHARS + 1)
    text_start = i + len(TITLE_END)
    text_len = F.length(value) - TRAIL_CHARS - (text_start - 1)
    ok = (title_len >= 0) & (text_len >= 0)
    title = F.substring(value, F.lit(LEAD_CHARS + 1), title_len)
    text = F.substring(value, text_start, text_len)
    return title, text, F.coalesce(ok, F.lit(False))


def parse_articles(lines: DataFrame, column: str = "value", strict: bool = True) -> DataFrame:
    """Raw lines -> ``title, text``.

    ``strict`` fails the job on a line without the delimiter (or too short
    for the layout), like the reference; the check is a filter, so it holds
    whichever columns are read.  Otherwise malformed lines get null
    title/text and ``malformed = true`` so they can be routed aside.  The
    delimiter is looked for once per line.
    """
    v = F.col("_line")
    raw = lines.select(F.col(column).alias("_raw"))
    lines = computed_once(raw, _line=F.col("_raw"), _at=F.instr("_line", TITLE_END))
    title, text, ok = article_columns(v, F.col("_at"))
    if strict:
        return lines.where(require(ok, v, "article")).select(title.alias("title"), text.alias("text"))
    return lines.select(
        F.when(ok, title).alias("title"),
        F.when(ok, text).alias("text"),
        (~ok).alias("malformed"),
    )


def read_articles(spark: SparkSession, path: str | list[str], strict: bool = True) -> DataFrame:
    return parse_articles(read_lines(spark, path), strict=strict)
