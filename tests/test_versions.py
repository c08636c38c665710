import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.sources import versions

SCHEMA = "k int, grp string, v int"

def by_group():
    return versions.part_by("grp")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_staged_data_is_invisible_until_committed(spark, path):
    root = path("t")
    versions.publish(frame(spark, [(1, "a", 1)]), root, 0, "first")
    newer = frame(spark, [(1, "a", 2)])
    parts = versions.stage(newer, root, 1)
    assert rows(versions.read(spark, root)) == [(1, "a", 1)]
    versions.commit(spark, root, 1, "second", newer.schema, parts)
    assert rows(versions.read(spark, root)) == [(1, "a", 2)]
    assert rows(versions.read(spark, root, 0)) == [(1, "a", 1)]
    assert versions.version_at(spark, root, dt.datetime.now() + dt.timedelta(days=1)) == 1
    assert versions.version_at(spark, root, dt.datetime(2000, 1, 1)) is None


def test_a_version_touches_only_its_parts(spark, path):
    root = path("t")
    versions.publish(frame(spark, [(1, "a", 1), (2, "b", 1), (3, None, 1)]), root, 0, "load", by_group())
    versions.publish(frame(spark, [(1, "a", 2)]), root, 1, "merge", by_group(), ["pa"])
    versions.publish(frame(spark, []), root, 2, "delete", by_group(), ["pb"])
    assert rows(versions.read(spark, root).fillna("-")) == [(1, "a", 2), (3, "-", 1)]
    assert rows(versions.read(spark, root, 0).fillna("-")) == [(1, "a", 1), (2, "b", 1), (3, "-", 1)]
    assert rows(versions.read(spark, root, parts=["pb"])) == []
    assert all("_version=1/" in f for f in versions.read(spark, root, parts=["pa"]).inputFiles())
    listed = versions.history(spark, root).orderBy("version").collect()
    assert [(r["version"], r["operation"], r["parts"]) for r in listed] == [
        (0, "load", 3), (1, "merge", 1), (2, "delete", 1),
    ]


def test_repeated_publish_is_harmless(spark, path):
    root = path("t")
    versions.publish(frame(spark, [(1, "a", 1)]), root, 0, "load", by_group())
    for _ in range(2):
        batch = frame(spark, [(1, "a", 10)])
        versions.rewrite(
            spark, root, 1, "add", by_group(), batch,
            lambda before: before.unionByName(batch).groupBy("k", "grp").agg(F.sum("v").cast("int").alias("v")),
        )
    assert rows(versions.read(spark, root)) == [(1, "a", 11)]


def test_changes_between_versions(spark, path):
    root = path("t")
    versions.publish(frame(spark, [(1, "a", 1), (2, "b", 1), (4, "c", 1)]), root, 0, "load", by_group())
    # key 1 changes, key 2 moves to another part, then key 4 goes away
    versions.publish(frame(spark, [(1, "a", 5), (2, "a", 1)]), root, 1, "merge", by_group(), ["pa", "pb"])
    versions.publish(frame(spark, []), root, 2, "delete", by_group(), ["pc"])
    feed = versions.read_changes(spark, root, ["k"], 1, 2)
    got = sorted(tuple(r)[:5] for r in feed.collect())
    assert got == [
        (1, "a", 1, "update_preimage", 1),
        (1, "a", 5, "update_postimage", 1),
        (2, "a", 1, "update_postimage", 1),
        (2, "b", 1, "update_preimage", 1),
        (4, "c", 1, "delete", 2),
    ]
    assert feed.schema["_commit_timestamp"].dataType.simpleString() == "timestamp"
    assert feed.filter("_commit_timestamp is null").isEmpty()


def test_create_once_and_missing_tables(spark, path):
    root = path("t")
    schema = frame(spark, []).schema
    assert versions.latest_version(spark, root) is None
    with pytest.raises(ValueError):
        versions.read(spark, root)
    assert versions.create_once(spark, root, schema)
    assert not versions.create_once(spark, root, schema)
    assert versions.read(spark, root).schema == schema and versions.read(spark, root).isEmpty()


def test_added_columns_read_as_null_in_older_parts(spark, path):
    root = path("t")
    versions.publish(frame(spark, [(1, "a", 1)]), root, 0, "load", by_group())
    wider = frame(spark, [(2, "b", 2)]).withColumn("note", F.lit("new"))
    versions.publish(wider, root, 1, "append", by_group(), run_ts=dt.datetime(2020, 1, 1))
    assert sorted(tuple(r) for r in versions.read(spark, root).fillna("-").collect()) == [
        (1, "a", 1, "-"), (2, "b", 2, "new"),
    ]
