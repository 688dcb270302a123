"""Column sum and maximum (fixture A5)."""

from __future__ import annotations

import pytest

from tessera.operators.columns import column_max, column_sum


def col(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "v int")


def test_sum(spark):
    assert column_sum(col(spark, [12, -4, 30, 5]), "v").first().total == 43
    assert column_sum(col(spark, []), "v").first().total == 0
    assert column_sum(col(spark, [-1, -2]), "v").first().total == -3
    assert column_sum(col(spark, [2**31 - 1, 1]), "v").first().total == 2**31  # widened, no wrap


def test_max(spark):
    assert column_max(col(spark, [-8, 41, 40, 0]), "v").first().maximum == 41
    assert column_max(col(spark, [3, 3]), "v").first().maximum == 3
    assert column_max(col(spark, [-5, -2]), "v").first().maximum == -2
    assert column_max(col(spark, []), "v").first().maximum is None
    with pytest.raises(Exception, match="max of empty column"):
        column_max(col(spark, []), "v", strict=True).collect()
