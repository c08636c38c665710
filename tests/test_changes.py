"""Change operators against a plain Python model on random tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import changes

SCHEMA = "k int, a int, b string"
T = dt.datetime(2020, 1, 1)


def snapshot(rng, keys=30):
    return {
        k: (rng.choice([None, 1, 2]), rng.choice([None, "x", "y"]))
        for k in range(keys)
        if rng.random() < 0.7
    }


def frame(spark, rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], SCHEMA)


def expected_feed(old, new):
    out = []
    for k in old.keys() | new.keys():
        if k not in old:
            out.append((k, *new[k], "insert"))
        elif k not in new:
            out.append((k, *old[k], "delete"))
        elif old[k] != new[k]:
            out += [(k, *old[k], "update_preimage"), (k, *new[k], "update_postimage")]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_feed_and_mirror_follow_random_snapshots(spark, seed):
    rng = random.Random(seed)
    states = [snapshot(rng) for _ in range(4)]
    feed = None
    for version in range(1, 4):
        step = changes.change_feed(
            frame(spark, states[version - 1]), frame(spark, states[version]), ["k"], version, T
        )
        got = sorted((tuple(r)[:4] for r in step.select("k", "a", "b", "_change_type").collect()), key=repr)
        assert got == expected_feed(states[version - 1], states[version])
        feed = step if feed is None else feed.unionByName(step)

    start = frame(spark, states[0]).withColumns(
        {"_cdc_type": F.lit("insert"), "_cdc_timestamp": F.lit(T).cast("timestamp")}
    )
    mirror = changes.cdc_mirror(start, feed, ["k"])
    assert {r["k"]: (r["a"], r["b"]) for r in mirror.collect()} == states[3]
    assert mirror.count() == len(states[3])

    audit = changes.audit_append(feed)
    assert {r[0] for r in audit.select("_operation").distinct().collect()} <= {"INSERT", "UPDATE_POSTIMAGE"}


def test_feed_with_a_new_column(spark):
    old = spark.createDataFrame([(1, 1), (2, 1)], "k int, a int")
    new = spark.createDataFrame([(1, 1, None), (2, 1, "x")], "k int, a int, note string")
    feed = changes.change_feed(old, new, ["k"], 1, T).select("k", "a", "note", "_change_type")
    assert sorted((tuple(r) for r in feed.collect()), key=repr) == [
        (2, 1, "x", "update_postimage"), (2, 1, None, "update_preimage"),
    ]


def test_insert_then_delete_leaves_no_ghost(spark):
    feed = spark.createDataFrame(
        [
            (1, 5, "x", "insert", 1, T),
            (1, 5, "x", "delete", 2, T),
            (2, 1, "x", "delete", 2, T),
            (2, 2, "y", "insert", 2, T),
            (3, 1, "x", "update_preimage", 3, T),
            (3, 2, "x", "update_postimage", 3, T),
            (3, 2, "x", "update_preimage", 4, T),
            (3, 9, "x", "update_postimage", 4, T),
        ],
        SCHEMA + ", _change_type string, _commit_version long, _commit_timestamp timestamp",
    )
    target = spark.createDataFrame(
        [(2, 1, "x", "insert", T), (3, 1, "x", "insert", T)],
        SCHEMA + ", _cdc_type string, _cdc_timestamp timestamp",
    )
    rows = {r["k"]: (r["a"], r["b"]) for r in changes.cdc_mirror(target, feed, ["k"]).collect()}
    assert rows == {2: (2, "y"), 3: (9, "x")}
    assert changes.strip_meta(feed).columns == ["k", "a", "b"]


def test_merge_upsert_takes_the_first_source_row(spark):
    target = spark.createDataFrame([(1, 1, "old"), (2, 2, "old")], SCHEMA)
    source = spark.createDataFrame([(2, 5, "new"), (2, 7, "newer"), (3, 1, "new")], SCHEMA)
    merged = changes.merge_upsert(target, source, ["k"], [F.desc("a")])
    assert sorted(tuple(r) for r in merged.collect()) == [(1, 1, "old"), (2, 7, "newer"), (3, 1, "new")]


def test_merge_update_reads_the_row_before_and_refuses_ambiguity(spark):
    target = spark.createDataFrame([(1, 10, "x"), (2, 20, "y"), (3, None, "z")], SCHEMA)
    source = spark.createDataFrame([(1, 0.55), (3, 0.5)], "k int, f double")
    sets = {
        "a": (F.col("t.a") * F.col("s.f")).cast("int"),
        "b": F.concat(F.col("t.b"), F.col("t.a").cast("string")),
    }
    rows = changes.merge_update(target, source, ["k"], sets).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == [(1, 5, "x10"), (2, 20, "y"), (3, None, None)]
    with pytest.raises(Exception, match="one row per k"):
        changes.merge_update(target, source.union(source), ["k"], sets).collect()


def test_align_schema(spark):
    df = spark.createDataFrame([("7", 1.5)], "a string, extra double")
    wanted = spark.createDataFrame([], "b date, a int").schema
    aligned = changes.align_schema(df, wanted)
    assert aligned.schema.simpleString() == "struct<b:date,a:int>"
    assert tuple(aligned.first()) == (None, 7)


def test_sample_is_stable_and_close_to_its_share(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    first = {r[0] for r in changes.key_sample(df, ["k"], 0.1).collect()}
    again = {r[0] for r in changes.key_sample(df.repartition(13), ["k"], 0.1).collect()}
    assert first == again and 1800 < len(first) < 2200
