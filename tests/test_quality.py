import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from strata.operators import quality

ROWS = [(1, 10), (2, None), (None, 30), (4, -1)]
SCHEMA = "k int, v int"


def rules():
    return {"key": F.col("k").isNotNull(), "positive": F.col("v") >= 0}


def test_fail_aborts_the_write(spark, path):
    bad = quality.expect_fail(spark.createDataFrame(ROWS, SCHEMA), rules())
    with pytest.raises(Exception, match="expectation violated"):
        bad.write.parquet(path("out"))
    good = quality.expect_fail(spark.createDataFrame(ROWS[:1], SCHEMA), rules())
    assert good.count() == 1


def test_fail_survives_column_pruning(spark):
    bad = quality.expect_fail(spark.createDataFrame(ROWS, SCHEMA), {"positive": F.col("v") >= 0})
    with pytest.raises(Exception, match="expectation violated: positive"):
        bad.select("k").collect()


def test_drop_treats_null_as_a_violation(spark):
    kept = quality.expect_drop(spark.createDataFrame(ROWS, SCHEMA), rules())
    assert [tuple(r) for r in kept.collect()] == [(1, 10)]


def test_metrics_and_observation_agree(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    counted = {r["rule"]: r["violations"] for r in quality.expect_metrics(df, rules()).collect()}
    assert counted == {"key": 1, "positive": 2}
    seen = Observation("rules")
    quality.observe_rules(df, rules(), seen).collect()
    assert seen.get == {"rows": 4, "key": 1, "positive": 2}


def test_require_unique(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], SCHEMA)
    with pytest.raises(Exception, match="one row per k"):
        quality.require_unique(df, ["k"]).collect()
    assert quality.require_unique(df.filter("v > 1"), ["k"]).count() == 2


def test_reconcile_of_an_empty_table(spark):
    source = spark.createDataFrame(ROWS, SCHEMA)
    gold = source.limit(0)
    row = quality.reconcile_totals(gold, source, {"v": (F.sum("v"), F.sum("v"))}).first()
    assert (row["gold_value"], row["source_value"], row["difference"]) == (0.0, 39.0, -39.0)
