"""Nested lists of postings: a task's share is bounded, however few shuffle partitions the session asks for."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from tessera.operators import forum as Q
from tessera.session import release


def test_more_tasks_than_the_session_asks_for(spark, monkeypatch):
    monkeypatch.setattr(Q, "TASK_POSTINGS", 100, raising=False)
    schema = "posting_type int, id long, accepted_answer long, parent_id long, score int, tag string"
    rows = [(1, i, None, None, 0, "t") for i in range(100)]
    rows += [(2, 1000 + i, None, i % 100 if i % 3 else 7, i % 5, None) for i in range(900)] + [(2, 5000, None, 7, 1, None)] * 4
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        nested = Q.nested_postings(spark.createDataFrame(rows, schema), 50)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "2"
        found = nested.withColumn("task", F.spark_partition_id()).collect()
        release(nested)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len({r.task for r in found}) > 4
    answers = Counter((r[3], r[1]) for r in rows if r[0] == 2)
    assert Counter((r.id, p.answer.id) for r in found for p in r.pairs) == answers
    for key in {r.id for r in found}:
        lists = sorted((r.segment, r.n, [p.answer.id for p in r.pairs]) for r in found if r.id == key)
        assert [s for s, _, _ in lists] == list(range(len(lists)))
        assert all(n == 50 for _, n, _ in lists[:-1]) and all(n == len(a) for _, n, a in lists)
        assert [a for _, _, each in lists for a in each] == sorted(a for _, _, each in lists for a in each)
