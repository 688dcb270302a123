"""The array of a wide survey is built by a projection of its own, not fused with the scan."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tessera.sources.survey import survey_arrays


def test_array_projection_is_not_fused(spark):
    frame = spark.range(5).select(
        F.col("id").cast("string").alias("who"),
        *(F.col("id").cast("double").alias(k) for k in ("telfs", "tesex", "teage")),
        *((F.col("id") + i).cast("double").alias(f"t{i}") for i in range(40)),
    )
    names, table = survey_arrays(frame)
    assert names == [f"t{i}" for i in range(40)]
    rows = table.orderBy("who").collect()
    assert [r["values"] for r in rows] == [[float(k + i) for i in range(40)] for k in range(5)]
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"^\s*(\+- )?Project \[.*array\(", plan, re.M), plan  # no "*(1)" before it
