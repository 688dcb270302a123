"""Lineage cutting: written tables in the checkpoint folder, or persistence."""

from __future__ import annotations

import os

from tessera import session as SES


def test_materialize_writes_and_release_deletes(spark):
    base = SES.checkpoint_dir(spark)
    assert base is not None  # configured by the environment or by local_session
    df = spark.range(100).selectExpr("id", "id % 7 AS k")
    m = SES.materialize(df, "unit")
    path = m._written_path
    assert path.startswith(base) and "unit-" in path
    local = path.replace("file:", "")
    assert os.path.isdir(local)
    assert m.count() == 100 and "Scan parquet" in m._jdf.queryExecution().executedPlan().toString()
    SES.release(m)
    assert not os.path.exists(local)


def test_materialize_without_checkpoint_folder_persists(spark, monkeypatch):
    monkeypatch.setattr(SES, "checkpoint_dir", lambda s: None)
    df = spark.range(10).selectExpr("id * 2 AS v")
    m = SES.materialize(df)
    assert m.is_cached and m.count() == 10
    SES.release(m)
    assert not m.is_cached


def test_scale_settings():
    tb = 1024**4
    s = SES.scale_settings(5 * tb, 8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 40960
    assert SES.scale_settings(10, 8)["spark.sql.shuffle.partitions"] == "16"


def test_input_fingerprint(spark, tmp_dir):
    a = spark.range(5).selectExpr("id", "id * 2 AS v")
    assert SES.input_fingerprint(a) == SES.input_fingerprint(a.repartition(3))
    assert SES.input_fingerprint(a) != SES.input_fingerprint(a.where("id > 0"))
    a.write.parquet(f"{tmp_dir}/t")
    one = SES.input_fingerprint(spark.read.parquet(f"{tmp_dir}/t"))
    assert one == SES.input_fingerprint(spark.read.parquet(f"{tmp_dir}/t").selectExpr("id"))
    a.write.mode("append").parquet(f"{tmp_dir}/t")
    assert one != SES.input_fingerprint(spark.read.parquet(f"{tmp_dir}/t"))
