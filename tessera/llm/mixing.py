"""Mixing sources to target weights by capped water-filling.

Every source wants its share, by weight, of all words; a source that would be
repeated more than ``max_epochs`` times stops there, and what it cannot give is
shared anew among the others by weight, until none is above.  The level of each
round is one pair of exact sums over the table of sources.

A source's target is then met by whole repetitions of all its documents and one
fractional repetition: the documents in seeded order, as long as words are
wanted, the last one in part.  The order is never sorted: the place where the
words run out is searched digit by digit (12 of 60 bits at a time), each time
summing the sizes by digit among the documents that share the digits found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WS_CLASS, drop_stored, join_per_key, space_words, stored, text_or_empty, unused

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 42
KEY_DIGITS = 5
DIGIT_BITS = 12


def seeded_key(doc_id: Column, text: Column, seed: int) -> Column:
    """60 bits of the MD5 of seed, id and text: a document's place in the seeded order."""
    shown = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), shown, F.lit(":"), text)), 1, 15), 16, 10).cast("long")


def _weighted(sized: DataFrame, weights: Sequence[int]) -> DataFrame:
    """One row per source: source, source_size and weight, the weights dealt in the order of the sources, null last.

    Sources are range-sorted; the driver sees one count per range.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranged = sums.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "sources")
    bases, total = [], 0
    for part, n in sorted(ranged.groupBy("part").count().collect()):
        bases.append((part, total))
        total += n
    base = sized.sparkSession.createDataFrame(bases, "part int, base long")
    rank = F.col("base") + F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    dealt = F.get(F.array(*(F.lit(int(w)).cast("long") for w in weights)), F.pmod(rank, F.lit(len(weights))).cast("int"))
    out = stored(ranged.join(F.broadcast(base), "part").select("source", "source_size", dealt.alias("weight")), "weights")
    drop_stored(ranged)
    return out


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Sources (source_size, weight) with their target in words.

    A round clamps every source whose share is above ``max_epochs`` times its size
    and raises the level (words per weight) for the rest; levels only rise, so a
    source once clamped stays so.  Sums are exact, so reruns agree to the last bit.
    """
    cap = F.col("source_size") * F.lit(max_epochs)
    everything = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    words = int(everything[0] or 0)
    level = words / int(everything[1]) if everything[1] else 0.0
    while True:
        above = F.col("weight") * F.lit(level) > cap
        given, weight = sources.agg(F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))).first()
        raised = (words - int(given or 0)) / int(weight) if weight else level
        if raised <= level:
            break
        level = raised
    target = F.when(F.col("weight") * F.lit(level) > cap, cap.cast("double"))
    return sources.withColumn("target", target.otherwise(F.col("weight") * F.lit(level)))


def _run_out(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source that wants a fractional repetition, where its words run out.

    Columns source, run_out (key), left (words wanted of the documents with that
    key) and held (words that they have).
    """
    found = plan.filter("wanted > 0").select("source", F.col("wanted").alias("left"), F.lit(0).cast("long").alias("run_out"))
    rows, tables = sized.filter("size > 0"), []
    for i in range(KEY_DIGITS):
        found = stored(found, "run-out")
        tables.append(found)
        shift = DIGIT_BITS * (KEY_DIGITS - 1 - i)
        here = F.shiftright("key", shift)
        rows = join_per_key(rows.select("source", "size", "key"), found, "source", F.col("key"))
        rows = rows.filter(F.shiftright("key", shift + DIGIT_BITS) == F.col("run_out"))
        if i == 1:  # the documents that share the first digit, a small part of each source
            rows = stored(rows, "run-out-rows")
            tables.append(rows)
        sums = rows.groupBy("source", "left", here.alias("digits")).agg(F.sum("size").alias("held"))
        upto = F.sum("held").over(Window.partitionBy("source", "left").orderBy("digits"))  # of 4096 sums at most
        sums = sums.withColumn("upto", upto).filter((F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("held") < F.col("left")))
        found = sums.select(
            "source", (F.col("left") - F.col("upto") + F.col("held")).alias("left"), F.col("digits").alias("run_out"), "held"
        )
    found = stored(found, "run-out")
    for table in tables:
        drop_stored(table)
    return found


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """How often the mix takes each document: the columns of ``docs`` with size, source_size, target, repeats, part_words and taken.

    ``weights`` (whole numbers from 1) go to the sources in code point order, null
    last, repeating; ``max_epochs`` is a whole number.  A document of ``size`` words is
    taken ``repeats`` times whole and once more with its first ``part_words`` words,
    ``taken`` words in all and never more than ``max_epochs * size``.  The taken words of
    a source add up to its target, rounded, unless the target runs out among
    copies.  :func:`repeated` makes the mixed corpus.

    Null text counts as empty; documents without words are taken 0 times.  Rows
    with the same id and text (all of null ids too) are copies: where the words run
    out among them, each is taken with the same part, so a source may miss less
    than one word per copy.  Columns of ``docs`` with the name of a result column
    are replaced.  An empty table gives no rows.
    """
    work = unused(docs, "work")
    body = text_or_empty(text)
    sized = docs.withColumn(
        work,
        F.struct(
            F.col(source).alias("source"),
            F.size(space_words(body)).cast("long").alias("size"),
            seeded_key(F.col(doc_id), body, seed).alias("key"),
        ),
    )
    compact = stored(sized.select(f"{work}.*"), "sizes")
    weighted = _weighted(compact, weights)
    goal = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.least(F.expr("goal div source_size"), F.lit(max_epochs))).otherwise(0)
    plan = stored(
        water_fill(weighted, max_epochs)
        .withColumn("goal", goal)
        .withColumn("whole", whole)
        .withColumn("wanted", F.col("goal") - F.col("whole") * F.col("source_size"))
        .drop("goal", "weight"),
        "targets",
    )
    ends = _run_out(compact, plan)
    plan_cols = ["source_size", "target", "whole", "run_out", "left", "held"]
    # both have one row per source; null sources meet each other
    ended = plan.alias("p").join(ends.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left")
    ended = stored(ended.select("p.source", F.struct(*plan_cols).alias("of")), "mix-plan")
    for table in (compact, weighted, plan, ends):
        drop_stored(table)

    key_name, of = unused(docs, "source_key"), unused(docs, "of")
    rows = sized.withColumn(key_name, F.col(work).source)
    ended = ended.withColumnRenamed("source", key_name).withColumnRenamed("of", of)
    mixed = join_per_key(rows, ended, key_name, F.col(work).key)
    size, key, end = F.col(work).size, F.col(work).key, F.col(of)
    share = (size.cast("decimal(19,0)") * end.left.cast("decimal(19,0)")).cast("decimal(38,0)")
    of_last = F.call_function("div", share, end.held.cast("decimal(19,0)"))
    extra = F.when(key < end.run_out, 1).otherwise(0)
    part = F.when(key == end.run_out, of_last).otherwise(F.lit(0))
    # the last one's part may be all of it
    repeats = F.when(size > 0, end.whole + extra + F.when((part == size) & (key == end.run_out), 1).otherwise(0))
    part_words = F.when(part == size, F.lit(0)).otherwise(part)
    results = {
        "size": size,
        "source_size": end.source_size,
        "target": end.target,
        "repeats": F.coalesce(repeats, F.lit(0)).cast("long"),
        "part_words": F.coalesce(part_words, F.lit(0)).cast("long"),
        "taken": F.coalesce(size * (end.whole + extra) + part, F.lit(0)).cast("long"),
    }
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in results]
    return mixed.select(*kept, *(c.alias(name) for name, c in results.items()))


def repeated(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mixed corpus: a row per repetition, with its number in ``repetition``; the last may hold only the first words.

    Takes what :func:`mix` returns; documents taken 0 times drop out.  Number
    and order of a document's rows are the same in every run.
    """
    n = F.col("repeats") + F.when(F.col("part_words") > 0, 1).otherwise(0)
    rows = mixed.withColumn("repetition", F.explode(F.when(n > 0, F.sequence(F.lit(1).cast("long"), n))))
    tokens = F.split(F.col(text), f"(?<={WS_CLASS.replace('[', '[^')})(?={WS_CLASS})")  # each with the white space before it
    first = F.array_join(F.slice(tokens, F.lit(1), F.col("part_words").cast("int")), "")
    return rows.withColumn(text, F.when(F.col("repetition") > F.col("repeats"), first).otherwise(F.col(text)))
