import os
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import scd2
from strata.sources import versions
from strata.streaming import tables

SCHEMA = "k int, seq bigint, v int"


def drop(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path("src"))


def source(spark, path):
    return tables.table_stream(spark, path("src"))


def upsert(spark, path, checkpoint="cp"):
    order = [F.desc("seq"), F.desc("v")]
    return tables.stream_upsert(
        source(spark, path), path("table"), ["k"], order, path(checkpoint), versions.part_by_key(["k"], 4)
    )


def table(spark, path):
    return sorted(tuple(r) for r in versions.read(spark, path("table")).collect())


def test_upsert_keeps_one_row_per_key(spark, path):
    drop(spark, path, [(1, 1, 10), (1, 3, 30), (1, 2, 20), (2, 1, 5)])
    upsert(spark, path)
    assert table(spark, path) == [(1, 3, 30), (2, 1, 5)]
    assert upsert(spark, path) == 0
    drop(spark, path, [(2, 0, 7), (3, 1, 1)])  # matched rows are replaced, whatever their age
    upsert(spark, path)
    assert table(spark, path) == [(1, 3, 30), (2, 0, 7), (3, 1, 1)]


def test_upsert_rewrites_only_touched_parts(spark, path):
    drop(spark, path, [(k, 1, k) for k in range(40)])
    upsert(spark, path)
    drop(spark, path, [(7, 2, 70)])
    upsert(spark, path)
    held = [r["version"] for r in versions.live_parts(spark, path("table")).collect() if not r["empty"]]
    assert sorted(held) == [1, 1, 1, 2]


def test_repeated_batch_is_ignored(spark, path):
    drop(spark, path, [(1, 1, 10)])
    upsert(spark, path)
    for name in ("0", ".0.crc"):  # as if it had stopped before it noted the batch as done
        os.remove(f"{path('cp')}/commits/{name}")
    upsert(spark, path)
    assert table(spark, path) == [(1, 1, 10)]
    assert versions.latest_version(spark, path("table")) == 1


def test_a_batch_that_failed_half_way_is_redone(spark, path, monkeypatch):
    drop(spark, path, [(1, 1, 10)])
    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", _stop_after_create(versions.commit))
        with pytest.raises(Exception, match="stopped"):
            upsert(spark, path)
    assert table(spark, path) == []
    upsert(spark, path)
    assert table(spark, path) == [(1, 1, 10)]


def _stop_after_create(commit):
    def stopping(spark, root, version, *args, **kwargs):
        if version > 0:
            raise RuntimeError("stopped")
        return commit(spark, root, version, *args, **kwargs)

    return stopping


def test_streamed_history_equals_the_batch_history(spark, path):
    rng = random.Random(5)
    rows = [(rng.randrange(6), rng.randrange(50) * 30_000, i) for i in range(150)]
    rng.shuffle(rows)
    for start in range(0, 150, 50):
        drop(spark, path, rows[start : start + 50] + rows[:5])
        tables.stream_scd2(
            source(spark, path), path("table"), ["k"], "seq", [F.desc("v")], path("cp"),
            versions.part_by_key(["k"], 4),
        )
    direct = scd2.scd2_history(spark.createDataFrame(rows, SCHEMA), ["k"], "seq", [F.desc("v")])
    streamed = versions.read(spark, path("table"))
    assert streamed.exceptAll(direct).isEmpty() and direct.exceptAll(streamed).isEmpty()


def test_history_takes_up_a_new_column(spark, path):
    how = (["k"], "seq", [F.desc("v")], path("cp"), versions.part_by_key(["k"], 2))
    drop(spark, path, [(1, 1, 10), (2, 1, 10)])
    tables.stream_scd2(source(spark, path), path("table"), *how)
    wider = spark.createDataFrame([(1, 2, 11, "new")], SCHEMA + ", note string")
    wider.write.mode("append").parquet(path("src"))
    tables.stream_scd2(tables.table_stream(spark, path("src"), wider.schema), path("table"), *how)
    rows = versions.read(spark, path("table")).select("k", "seq", "note", "__END_AT")
    assert sorted((tuple(r) for r in rows.collect()), key=repr) == [
        (1, 1, None, 2), (1, 2, "new", None), (2, 1, None, None),
    ]


def test_table_to_table(spark, path):
    drop(spark, path, [(1, 1, -1), (2, 1, 5)])
    silver = lambda df: df.drop("seq").filter("v >= 0")
    assert tables.stream_table(source(spark, path), path("silver"), path("cp"), silver) == 2
    drop(spark, path, [(3, 1, 6)])
    assert tables.stream_table(source(spark, path), path("silver"), path("cp"), silver) == 1
    assert tables.stream_table(source(spark, path), path("silver"), path("cp"), silver) == 0
    assert sorted(tuple(r) for r in spark.read.parquet(path("silver")).collect()) == [(2, 5), (3, 6)]
