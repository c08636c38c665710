"""What the near-duplicate stage of the pipeline shuffles."""

from small import frame

import corpus_pipeline


def test_kept_rows_are_shuffled_once(spark):
    rows = [(i % 40 if i % 7 else None, f"some words that make a text of its own {i % 50} {i % 50} and {i % 50} more", "en", f"s{i % 3}", 1) for i in range(120)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = corpus_pipeline.near_duplicates(spark, frame(spark, rows, False).coalesce(1), "")
        planned = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert planned.count("Exchange hashpartitioning") == 2, planned  # the rows, and the ids that stay
