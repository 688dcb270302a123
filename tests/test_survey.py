"""Survey classification, summary and grouped averages (fixture A4)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.functions.survey import age_band, balanced_sum, group_hours, working_status
from tessera.operators import survey as U
from tessera.sources.survey import survey_row, survey_schema


def codes(*prefixes):
    """Three activity columns of each prefix."""
    return [f"{p}{i:02d}" for p in prefixes for i in (5, 17, 40)]


# prefixes of the three groups: fixed values of the survey's code book
PRIMARY = codes("t01", "t03", "t11", "t1801", "t1803")
WORK = codes("t05") + ["t180511", "t180523", "t180590"]
OTHER = codes("t02", "t04", "t06", "t07", "t08", "t09", "t10", "t12", "t13", "t14", "t15", "t16") + ["t18220", "t1890", "t187"]


def test_classify_columns():
    mixed = [c for group in zip(PRIMARY[:6], WORK, OTHER[:6]) for c in group] + PRIMARY[6:] + OTHER[6:]
    p, w, o = U.classify_columns(["tucaseid", "t1799", *mixed, "telfs", "t5005"])
    assert (p, w, o) == (PRIMARY, WORK, OTHER)


def test_summary_one_respondent(spark):
    names = ["tucaseid", "telfs", "tesex", "teage", *OTHER, *PRIMARY, *WORK]
    minutes = ["7"] * len(OTHER) + ["24"] * len(PRIMARY) + ["50"] * len(WORK)
    df = spark.createDataFrame([survey_row(["p3", "3", "2", "60", *minutes])], survey_schema(names))
    r = U.time_usage_summary(PRIMARY, WORK, OTHER, df).first()
    assert (r.working, r.sex, r.age) == ("not working", "female", "elder")
    assert (r.primaryNeeds, r.work, round(r.other, 3)) == (6.0, 5.0, 4.55)


def test_bands_and_labour_force(spark):
    ages = spark.createDataFrame([(a,) for a in [14.0, 22.0, 22.5, 23.0, 55.0, 56.0, None]], "teage double")
    assert [r.a for r in ages.select(age_band().alias("a")).collect()] == [
        "elder", "young", "elder", "active", "active", "elder", "elder"]
    st = spark.createDataFrame([(t, s) for t, s in [(0.0, 1.0), (1.0, 2.0), (3.0, None), (4.0, 1.0), (5.0, 1.0), (None, 1.0)]],
                               "telfs double, tesex double")
    kept = U.labour_force(st).select(working_status().alias("w"), U.summary_columns(["telfs"], ["telfs"], ["telfs"])[1])
    assert [(r.w, r.sex) for r in kept.collect()] == [
        ("not working", "male"), ("working", "female"), ("not working", "female"), ("not working", "male")]


def test_group_sums(spark):
    df = spark.createDataFrame([(60.0, 120.0, None)], "a double, b double, c double")
    r = df.select(group_hours(["a", "b"]).alias("h"), group_hours(["a", "c"]).alias("n")).first()
    assert r.h == 3.0 and r.n is None
    with pytest.raises(ValueError, match="work"):
        group_hours([], "work")


def test_wide_table_balanced_sum(spark):
    names = [f"t01{i:04d}" for i in range(450)]
    df = spark.range(3).select(*[(F.col("id") + i).cast("double").alias(n) for i, n in enumerate(names)])
    got = [r.s for r in df.select(balanced_sum(names).alias("s")).orderBy("s").collect()]
    base = sum(range(450))
    assert got == [float(base), float(base + 450), float(base + 900)]


def _summary(spark):
    rows = []
    for i in range(60):
        rows.append((str(i), float(i % 6), float(1 + i % 2), float(10 + i % 60), float(i * 7 % 500), float(i % 50), float(i % 30)))
    df = spark.createDataFrame(rows, "tucaseid string, telfs double, tesex double, teage double, t010101 double, t050101 double, t020101 double")
    p, w, o = U.classify_columns(df.columns)
    return U.time_usage_summary(p, w, o, df)


def test_grouped_variants_agree(spark):
    s = _summary(spark)
    a = [tuple(r) for r in U.time_usage_grouped(s).collect()]
    b = [tuple(r) for r in U.time_usage_grouped_sql(s).collect()]
    c = [tuple(r) for r in U.time_usage_grouped_typed(s).collect()]
    d = [tuple(r) for r in U.time_usage_grouped_sql(s, view_name="summed").collect()]
    assert a == b == c == d
    assert spark.catalog.tableExists("summed")
    keys = [r[:3] for r in a]
    assert keys == sorted(keys)
    got = [(f.name, f.dataType) for f in U.time_usage_grouped_typed(s).schema]
    assert got == [(f.name, f.dataType) for f in U.TIME_USAGE_ROW]
    assert U.time_usage_summary_typed(s.select("other", "work", "primaryNeeds", "age", "sex", "working")).columns == [
        "working", "sex", "age", "primaryNeeds", "work", "other"]


def test_filter_reaches_scan(spark, tmp_dir):
    from tests.conftest import plan_text

    path = f"{tmp_dir}/survey.parquet"
    spark.range(10).select(F.col("id").cast("string").alias("tucaseid"), F.col("id").cast("double").alias("telfs"),
                           F.lit(1.0).alias("tesex"), F.lit(30.0).alias("teage"), F.lit(60.0).alias("t010101"),
                           F.lit(60.0).alias("t050101"), F.lit(60.0).alias("t020101"), F.lit(5.0).alias("unused")).write.parquet(path)
    df = spark.read.parquet(path)
    p, w, o = U.classify_columns(df.columns)
    plan = plan_text(U.time_usage_grouped(U.time_usage_summary(p, w, o, df)))
    assert "PushedFilters: [IsNotNull(telfs), LessThanOrEqual(telfs,4.0)]" in plan
    assert "unused" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_array_table_gives_the_same_rows(spark):
    """Doubles of any kind: the sums are the same trees, so equal to the last bit; nulls stay null."""
    from tessera.sources.survey import survey_arrays

    names = [f"{p}{i:04d}" for i in range(150) for p in ("t01", "t05", "t02", "t99")]
    columns = [(F.rand(i) * 1e3 - F.randn(i)).alias(n) for i, n in enumerate(names)]
    columns[7] = F.when(F.rand(1) > 0.3, 1.5).alias(names[7])
    people = [F.col("id").cast("string").alias("tucaseid"), (F.col("id") % 6).cast("double").alias("telfs")]
    people += [(F.col("id") % 3).cast("double").alias("tesex"), (F.col("id") % 80).cast("double").alias("teage")]
    df = spark.range(300).select(*people, *columns)
    df = spark.createDataFrame(df.collect(), df.schema)
    wide = U.time_usage_summary(*U.classify_columns(df.columns), df)
    arrays = U.time_usage_summary_arrays(*survey_arrays(df))
    assert sorted(map(str, arrays.collect())) == sorted(map(str, wide.collect()))
    assert arrays.columns == wide.columns


def test_array_table_is_read_in_batches(spark, tmp_dir):
    from tests.conftest import plan_text
    from tessera.sources.survey import survey_arrays

    columns = [F.col("id").cast("double").alias(n) for n in ("telfs", "tesex", "teage")]
    columns += [F.lit(float(i)).alias(f"t{p}{i:04d}") for i in range(100) for p in ("01", "05", "02")]
    names, df = survey_arrays(spark.range(20).select(F.col("id").cast("string").alias("tucaseid"), *columns))
    df.write.parquet(f"{tmp_dir}/arrays")
    plan = plan_text(U.time_usage_summary_arrays(names, spark.read.parquet(f"{tmp_dir}/arrays")))
    assert "Batched: true" in plan and "PushedFilters: [IsNotNull(telfs), LessThanOrEqual(telfs,4.0)]" in plan
    assert plan.startswith("Project [transform(") and "*(1) Filter" in plan  # the sums are not fused with the scan
