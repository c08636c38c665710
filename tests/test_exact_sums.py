"""Exact sums of doubles, and ids that do not run into each other."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strata.functions import scalars as fx
from strata.plans import marts


def total(df, **how):
    return df.select(fx.sum_value(fx.exact_sum("v", **how)).alias("s")).first()["s"]


def test_small_readings_add_up(spark):
    many = spark.range(10_000).select(F.lit(0.004).alias("v"))
    assert total(many) == 40.0 and total(many, wide=True) == 40.0
    assert many.select(fx.money_sum("v")).first()[0] == 40.0
    readings = spark.range(10_000).selectExpr(
        "1 AS site_id", "DATE'2001-01-01' AS production_date", "1 AS tons_extracted", "0.004D AS mineral_grade_percent", "0.004D AS total_cost_usd", "1.0D AS operating_hours"
    )
    row = marts.site_day_rollup(readings).first()
    assert row["total_cost"] == 40.0 and row["avg_grade"] == 0.004


@pytest.mark.parametrize("seed", range(4))
def test_sums_of_any_sign_and_size_are_exact_in_any_order(spark, seed):
    draw = random.Random(seed)
    values = [draw.choice([-1, 1]) * draw.random() * 10 ** draw.randrange(-3, 14) for _ in range(400)]
    values += [-v for v in values[:390]] + [draw.choice([0.1, -0.1, 1e-9, 3.5]) for _ in range(50)]
    want = math.fsum(values)
    for _ in range(2):
        draw.shuffle(values)
        df = spark.createDataFrame([(v, i % 7) for i, v in enumerate(values)], "v double, k int").repartition(3)
        for wide in (False, True):
            assert total(df, wide=wide) == pytest.approx(want, rel=3e-16, abs=1e-27)
        parts = df.groupBy("k").agg(fx.carried(fx.exact_sum("v")).alias("s"))
        assert parts.select(fx.sum_value(fx.add_sums("s"))).first()[0] == total(df)


def test_nulls_weights_and_values_that_do_not_fit(spark):
    df = spark.createDataFrame([(0.1, 3), (None, 5), (-7.25, 2)], "v double, n long")
    assert total(df, weight=F.col("n")) == math.fsum([0.1] * 3 + [-7.25] * 2)
    assert total(df.filter("v IS NULL")) is None and total(df.limit(0)) is None
    for bad in (1.2345678e-20, float("nan"), 1e300):
        with pytest.raises(Exception, match="more digits than an exact sum holds|CAST_OVERFLOW"):
            total(spark.createDataFrame([(bad,)], "v double"))


def test_ids_of_different_parts_differ(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("x", None), ("", "x"), ("-", "x"), ("1:a", ""), ("1", ":a"), ("a", "1:b")]
    ids = spark.createDataFrame(rows, "a string, b string").select(fx.stable_id("a", "b")).collect()
    assert len({r[0] for r in ids}) == len(rows)
