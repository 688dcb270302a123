"""Term tables too large to broadcast: a term of many entries and many mentions is spread over the tasks."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from tessera.operators import terms as T
from tessera.plans import catalog as C
from tests.conftest import plan_text


def _hits(articles, entries):
    return Counter((k, t, p) for k, text in articles for p, t in entries if f" {t} " in f" {text} ")


def test_hot_term(spark, monkeypatch):
    monkeypatch.setattr(T, "ENTRY_BLOCK", 10, raising=False)
    articles = [(i, "hot rod" if i % 2 else "hot one two") for i in range(40)] + [(None, "cold"), (99, None)]
    entries = [(i, "hot") for i in range(300)] + [(7, "hot")] * 25 + [(None, "hot"), (2, "cold"), (3, "one two")]
    frame = spark.createDataFrame(articles, "title long, text string")
    table = spark.createDataFrame(entries, "position long, term string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits = T.term_hits(frame, table, broadcast_rows=0).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert Counter((r.title, r.term, r.position) for r in hits) == _hits(
        [a for a in articles if a[1] is not None], entries
    )
    per_task = Counter(r.task for r in hits if r.term == "hot")
    assert max(per_task.values()) < 0.6 * sum(per_task.values())


def test_no_position(spark):
    frame = spark.createDataFrame([("a", "x y"), ("b", "x")], "title string, text string")
    table = spark.createDataFrame([("x",)] * 3 + [("y",)], "term string")
    hits = T.term_hits(frame, table, broadcast_rows=0)
    assert hits.schema["position"].dataType.simpleString() == "bigint"
    assert Counter(map(tuple, hits.collect())) == {("a", "x", 0): 3, ("b", "x", 0): 3, ("a", "y", 0): 1}


def _contains(articles, entries):
    return Counter((k, t, p) for k, x in articles for p, t in entries if x is not None and t is not None and f" {t} " in f" {x} ")


def test_a_list_of_entries_meets_the_mentions_in_shares(spark, monkeypatch):
    monkeypatch.setattr(T, "SHARE_ENTRIES", 10, raising=False)
    articles = [(i, f"hot {i}") for i in range(300)]
    entries = [(i, "hot") for i in range(100)]  # one list
    frame = spark.createDataFrame(articles, "title long, text string")
    table = spark.createDataFrame(entries, "position long, term string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits = T.term_hits(frame, table, broadcast_rows=0).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert Counter((r.title, r.term, r.position) for r in hits) == _contains(articles, entries)
    per_task = Counter(r.task for r in hits)
    assert max(per_task.values()) < 0.6 * sum(per_task.values())


def test_tasks_follow_the_lists_and_shares(spark, monkeypatch):
    monkeypatch.setattr(T, "ENTRY_BLOCK", 50)
    monkeypatch.setattr(T, "SHARE_ENTRIES", 40, raising=False)
    monkeypatch.setattr(T, "TASK_CELLS", 5, raising=False)
    frame = spark.createDataFrame([(i, f"hot {i}") for i in range(400)], "title long, text string")
    table = spark.createDataFrame([(i, "hot") for i in range(400)], "position long, term string")
    hits = T.term_hits(frame, table, broadcast_rows=0)
    # a few kB are shuffled, which adaptive execution would put into one task
    tasks = hits.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == 160_000
    assert len(tasks) > 8 and max(r["count"] for r in tasks) < 50_000


def test_runs_of_the_shuffled_table(spark):
    twice = "a b a b  a b c"
    articles = [(1, twice), (1, twice), (1, "a"), (None, twice), (None, None), (2, ""), (3, " a b"), (4, "c a"), (4, "xa b")]
    entries = [(1, "a b"), (2, "a"), (2, "a"), (None, "b c"), (3, "b  a b c"), (4, ""), (5, "a b c d"), (6, None), (7, " a")]
    frame = spark.createDataFrame(articles, "title long, text string")
    frame = frame.withColumn("note", F.when(F.col("text").isNotNull(), F.create_map(F.col("text"), F.col("title"))))
    table = spark.createDataFrame(entries, "position long, term string")
    hits = T.term_hits(frame, table, keep=["note"], broadcast_rows=0)
    rows = hits.collect()
    assert hits.columns == ["title", "term", "position", "note"]
    assert Counter((r.title, r.term, r.position) for r in rows) == _contains(articles, entries)
    assert all(list(r.note.values()) == [r.title] for r in rows)
    assert "array_distinct" not in plan_text(hits)  # no article's runs are all held at once


def test_first_words_of_documents(spark, tmp_dir):
    texts = ["a b c", "a", "", None, " a b", "a  b", "  ", "a b"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    for n in (1, 2):
        found = {r.position: r.term for r in C._first_words(spark, tmp_dir, n).collect()}
        wanted = {i: " ".join(t.split(" ")[:n]) for i, t in enumerate(texts) if t is not None}
        assert found == {i: t for i, t in wanted.items() if t}
