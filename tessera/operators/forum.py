"""Forum postings: questions, answers, their pairs, scores and k-means vectors.

Postings follow ``POSTING_SCHEMA``: ``posting_type`` 1 is a question keyed
by ``id``, 2 an answer pointing at its question through ``parent_id``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import as_col
from tessera.operators.ordering import ranged, running_totals
from tessera.session import at_least_partitions, owning

POSTING_FIELDS = ("posting_type", "id", "accepted_answer", "parent_id", "score", "tag")

# Fixed default parameters: distance between two languages on the x axis,
# and the number of k-means centroids.
DEFAULT_LANG_SPREAD = 50000
DEFAULT_KERNELS = 45


def questions(postings: DataFrame) -> DataFrame:
    """Postings of type 1 (keyed by ``id``)."""
    return postings.where(F.col("posting_type") == 1)


def answers(postings: DataFrame) -> DataFrame:
    """Postings of type 2 that name a parent question."""
    return postings.where((F.col("posting_type") == 2) & F.col("parent_id").isNotNull())


def question_answer_pairs(postings: DataFrame) -> DataFrame:
    """Inner equi-join question.id = answer.parent_id, one flat row per pair.

    Columns: the question's ``id, accepted_answer, score, tag`` and the
    answer's ``answer_id, answer_accepted_answer, answer_score, answer_tag``.
    Unanswered questions and orphan answers drop out; a key held by many
    answers is split by AQE's skew-join handling.
    """
    q = questions(postings).select("id", "accepted_answer", "score", "tag")
    a = answers(postings).select(
        F.col("parent_id").alias("_parent"),
        F.col("id").alias("answer_id"),
        F.col("accepted_answer").alias("answer_accepted_answer"),
        F.col("score").alias("answer_score"),
        F.col("tag").alias("answer_tag"),
    )
    return q.join(a, q["id"] == a["_parent"]).drop("_parent")


def grouped_postings(postings: DataFrame) -> DataFrame:
    """The (question, answer) pairs of each question id, flat, with their number ``n_pairs``.

    One row per pair: the columns of :func:`question_answer_pairs` and
    ``n_pairs``, the size of the pair's group.  A nested list per id would
    gather a hot question into one row.  The size is (questions with the id) x
    (answers pointing at it), each counted with map-side combine and attached
    to the questions before the pairs are formed; their join then reads both
    sides from exchanges of its own, so AQE can split a hot id.
    """
    q = questions(postings).select("id", "accepted_answer", "score", "tag")
    a = answers(postings)
    nq = q.groupBy("id").agg(F.count(F.lit(1)).alias("_nq"))
    na = a.groupBy(F.col("parent_id").alias("id")).agg(F.count(F.lit(1)).alias("_na"))
    sizes = nq.join(na, "id").select("id", (F.col("_nq") * F.col("_na")).alias("n_pairs"))
    sized = q.join(sizes, "id").repartition("id", "score")  # not the join's own distribution
    answer = a.select(
        F.col("parent_id").alias("_parent"),
        F.col("id").alias("answer_id"),
        F.col("accepted_answer").alias("answer_accepted_answer"),
        F.col("score").alias("answer_score"),
        F.col("tag").alias("answer_tag"),
    )
    return sized.join(answer, sized["id"] == answer["_parent"]).drop("_parent")


DEFAULT_SEGMENT = 1000
# Most postings per task, on average, that the nested lists sort.
TASK_POSTINGS = 500_000


def nested_postings(postings: DataFrame, segment_size: int = DEFAULT_SEGMENT) -> DataFrame:
    """The (question, answer) pairs of each question id as lists of bounded length: ``id, segment, n, pairs``.

    ``pairs`` holds up to ``segment_size`` structs ``(question, answer)`` in the order
    of the question's and then the answer's fields, nulls first; segments are
    numbered from 0 along that order, and all but an id's last are full.  Equal
    pairs are kept as often as they occur.

    Copies of questions and of answers are counted first, with map-side combine;
    the join makes one row per pair of distinct ones, with its number of copies.
    The pairs are range-sorted by id and fields, so a question with a third of
    all answers lies in many ranges, and each range's running count gives its
    pairs their segment.  The postings are counted first: however few shuffle
    partitions the session asks for, a task sorts about ``TASK_POSTINGS``.  The
    result reads a stored table: release it after use.
    """
    fields = ["accepted_answer", "score", "tag"]
    answer_fields = ["answer_id", "answer_accepted_answer", "answer_score", "answer_tag"]
    q = questions(postings).groupBy("id", *fields).agg(F.count("*").alias("_nq"))
    a = answers(postings).select(
        F.col("parent_id").alias("_parent"),
        F.col("id").alias("answer_id"),
        *(F.col(c).alias(f"answer_{c}") for c in fields),
    )
    a = a.groupBy("_parent", *answer_fields).agg(F.count("*").alias("_na"))
    pairs = q.join(a, q["id"] == a["_parent"]).select(
        "id", *fields, *answer_fields, (F.col("_nq") * F.col("_na")).alias("copies")
    )
    spark = postings.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-postings.count() // TASK_POSTINGS))
    with at_least_partitions(spark, tasks):
        parts = ranged(pairs, ["id"], [*fields, *answer_fields], "pairs")
    placed = running_totals(parts, ["id"], [*fields, *answer_fields], F.col("copies"), "place", tasks)
    size = F.lit(int(segment_size)).cast("long")
    first, last = (F.expr(f"{at} div {int(segment_size)}") for at in ("place", "(place + copies - 1)"))
    spread = placed.withColumn("segment", F.explode(F.sequence(first, last)))
    here = F.least(F.col("place") + F.col("copies"), (F.col("segment") + 1) * size) - F.greatest(F.col("place"), F.col("segment") * size)
    question = F.struct("id", *fields)
    answer = F.struct(F.col("answer_id").alias("id"), *(F.col(f"answer_{c}").alias(c) for c in fields))
    held = F.sort_array(
        F.collect_list(F.struct("place", question.alias("question"), answer.alias("answer"), here.cast("int").alias("times")))
    )
    each = F.transform(held, lambda p: F.array_repeat(F.struct(p.question.alias("question"), p.answer.alias("answer")), p.times))
    grouped = spread.repartition(tasks, "id", "segment").groupBy("id", "segment").agg(F.flatten(each).alias("pairs"))
    return owning(grouped.select("id", "segment", F.size("pairs").cast("long").alias("n"), "pairs"), parts)


def high_score(max_score: Column) -> Column:
    """Best answer score floored at 0 (an all-negative thread scores 0)."""
    return F.greatest(F.lit(0), max_score)


def answer_high_score(postings: DataFrame) -> DataFrame:
    """Per question id: best answer score floored at 0: ``id, high_score``.

    Partial aggregation before the shuffle keeps a hot question to one
    row per task.
    """
    return (
        answers(postings)
        .groupBy(F.col("parent_id").alias("id"))
        .agg(high_score(F.max("score")).alias("high_score"))
    )


def scored_postings(postings: DataFrame, dedupe: bool = True) -> DataFrame:
    """One row per answered question: posting fields + ``high_score``.

    Both sides are reduced to one row per question id *before* the
    shuffle: answers to their maximum score (hash aggregation with
    map-side combine), questions sharing an id to the lowest one (a
    deterministic stand-in for "an arbitrary one"; partial aggregation
    collapses copies inside each task).  A question holding a third of
    all answers, or a third of all rows being copies of one question,
    then costs one row per task, and the join sees unique keys on both
    sides - no skewed join task.
    """
    best = (
        answers(postings)
        .groupBy(F.col("parent_id").alias("_parent"))
        .agg(F.max("score").alias("_max"))
    )
    q = questions(postings).select(*[F.col(c).alias(c) for c in POSTING_FIELDS])
    if dedupe:
        others = [c for c in POSTING_FIELDS if c != "id"]
        q = (
            q.groupBy("id")
            .agg(F.min(F.struct(*others)).alias("_q"))
            .select("id", *[F.col(f"_q.{c}").alias(c) for c in others])
        )
    joined = q.join(best, F.col("id") == F.col("_parent"))
    return joined.select(*POSTING_FIELDS, high_score(F.col("_max")).alias("high_score"))


def first_tag_index(tag: str | Column, languages: Sequence[str]) -> Column:
    """0-based index of the first language equal to the tag; null if none."""
    pos = F.array_position(F.array(*[F.lit(x) for x in languages]), as_col(tag))
    return (F.nullif(pos, F.lit(0)) - 1).cast("int")


def posting_vectors(
    scored: DataFrame,
    languages: Sequence[str],
    lang_spread: int = DEFAULT_LANG_SPREAD,
    unmatched: str = "first",
) -> DataFrame:
    """k-means input ``id, x, y``: x = language index * spread, y = high score.

    ``unmatched="first"`` puts tags not in the list on index 0 (as the
    reference does); ``"drop"`` leaves those questions out.
    """
    if lang_spread <= 0:
        raise ValueError("lang_spread must be positive to recover the language")
    idx = first_tag_index("tag", languages)
    if unmatched == "drop":
        scored = scored.where(idx.isNotNull())
    elif unmatched != "first":
        raise ValueError("unmatched must be 'first' or 'drop'")
    return scored.select(
        "id",
        (F.coalesce(idx, F.lit(0)).cast("long") * lang_spread).alias("x"),
        F.col("high_score").cast("long").alias("y"),
    )
