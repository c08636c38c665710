"""Columns with dots in their names, maps, and rows that share id and text."""

import pytest
from pyspark.sql import functions as F
from small import make, frame

import corpus_pipeline
from strata.llm import substrings


@pytest.fixture(scope="module")
def docs(spark):
    same = " ".join(f"word{i}" for i in range(40))
    rows = make(n=20) + [(3000, same, "en", s, 1) for s in ("a", "b")] + [(3001, "of its own " + same, "en", "a", 1)]
    return frame(spark, rows, False).select("*", F.lit("dot").alias("a.b"), F.create_map(F.lit("k"), "source").alias("held"), F.lit("q").alias("tick`s")).cache()


@pytest.mark.parametrize("name", ["near_duplicates", "substring_dedup", "mixing"])
def test_stages_keep_odd_columns(spark, docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    first, second = (stage(spark, d, "") for d in (docs, docs.repartition(5, "n_chars", "text")))
    assert first.columns == docs.columns
    one = sorted(map(repr, first.collect()))
    assert one and one == sorted(map(repr, second.collect()))
    assert {r["a.b"] for r in first.collect()} == {"dot"}


def test_rows_that_differ_in_a_map_alone_stay_apart(spark):
    rows = spark.createDataFrame([(1, "a few words", {"k": i}) for i in (1, 2)], "doc_id long, text string, m map<string,int>")
    assert sorted(r["m"]["k"] for r in substrings.deduplicate(rows.repartition(1)).collect()) == [1, 2]
