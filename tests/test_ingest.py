import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sources import schemas, versions
from strata.sources.files import load_targets, read_text_documents, write_partitioned
from strata.streaming import ingest


def run(spark, path, fmt="parquet", **how):
    return ingest.ingest_files(spark, path("src"), path("dst"), path("meta"), fmt=fmt, **how)


def bronze(spark, path):
    return ingest.read_bronze(spark, path("dst"), path("meta"))


def drop(spark, path, rows, schema, fmt="parquet", **options):
    writer = spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").format(fmt)
    writer.options(**options).save(path("src"))


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_each_file_is_read_once(spark, path, fmt):
    options = {"header": "true"} if fmt == "csv" else {}
    drop(spark, path, [(1, "a"), (2, "b")], "k bigint, v string", fmt, **options)
    assert run(spark, path, fmt) == 2
    assert run(spark, path, fmt) == 0
    drop(spark, path, [(3, "c")], "k bigint, v string", fmt, **options)
    assert run(spark, path, fmt) == 1
    assert sorted(tuple(r) for r in bronze(spark, path).select("k", "v").collect()) == [
        (1, "a"), (2, "b"), (3, "c"),
    ]
    assert bronze(spark, path).filter("_rescued_data is not null").isEmpty()


def test_binary_files_as_a_stream(spark, path):
    os.makedirs(path("src"))
    for name in "ab":
        with open(f"{path('src')}/{name}.bin", "wb") as f:
            f.write(name.encode() * 3)
    assert (run(spark, path, "binaryFile"), run(spark, path, "binaryFile")) == (2, 0)
    rows = bronze(spark, path).select("content", "length").collect()
    assert sorted(bytes(r["content"]) for r in rows) == [b"aaa", b"bbb"]


def test_new_columns_by_mode(spark, path):
    drop(spark, path, [(1,)], "k bigint")
    run(spark, path)
    drop(spark, path, [(2, "x")], "k bigint, extra string")
    with pytest.raises(ValueError, match="extra"):
        run(spark, path, evolution="fail_on_new_columns")
    run(spark, path, evolution="none")
    assert bronze(spark, path).columns == ["k", "_rescued_data"]
    drop(spark, path, [(3, "y")], "k bigint, extra string")
    run(spark, path, evolution="rescue")
    drop(spark, path, [(4, "z")], "k bigint, extra string")
    run(spark, path, evolution="add_new_columns")
    got = {r["k"]: (r["extra"], r["_rescued_data"]) for r in bronze(spark, path).collect()}
    assert got == {1: (None, None), 2: (None, None), 3: (None, '{"extra":"y"}'), 4: ("z", None)}


def test_a_file_that_arrives_during_the_schema_check(spark, path, monkeypatch):
    drop(spark, path, [(1,)], "k bigint")
    infer, late = schemas.infer, [True]

    def infer_then_deliver(*args):
        found = infer(*args)
        if late:
            late.clear()
            time.sleep(0.05)
            drop(spark, path, [(2, "x")], "k bigint, extra string")
        return found

    monkeypatch.setattr(schemas, "infer", infer_then_deliver)
    run(spark, path)
    got = {r["k"]: r["extra"] for r in bronze(spark, path).collect()}
    assert got == {1: None, 2: "x"}


def test_misfits_of_text_formats_are_kept(spark, path):
    schema = StructType.fromDDL("k int, day date, v double, tags array<string>")
    spark.createDataFrame(
        [('{"k":1,"day":"2020-01-02","v":1.5,"tags":["a"]}',), ('{"k":"one","day":"soon","v":2}',), ('{"v":"NaN?"}',)],
        "value string",
    ).coalesce(1).write.text(path("src"))
    run(spark, path, "json", schema=schema)
    rows = [tuple(r) for r in bronze(spark, path).orderBy(F.col("k").desc_nulls_last(), "v").collect()]
    assert rows == [
        (1, dt.date(2020, 1, 2), 1.5, ["a"], None),
        (None, None, None, None, '{"v":"NaN?"}'),
        (None, None, 2.0, None, '{"k":"one","day":"soon"}'),
    ]


def test_only_new_files_when_existing_ones_are_skipped(spark, path):
    drop(spark, path, [(1,)], "k bigint")
    old = time.time() - 3600
    for name in os.listdir(path("src")):
        os.utime(os.path.join(path("src"), name), (old, old))
    run(spark, path, existing=False)
    assert bronze(spark, path).isEmpty()
    time.sleep(1.1)
    drop(spark, path, [(2,)], "k bigint")
    run(spark, path, existing=False)
    assert [r["k"] for r in bronze(spark, path).collect()] == [2]


def test_a_failed_expectation_writes_nothing_and_can_be_repeated(spark, path):
    drop(spark, path, [(1,), (None,)], "k bigint")
    with pytest.raises(Exception, match="expectation violated: not_empty"):
        run(spark, path, rules={"not_empty": F.col("k").isNotNull()})
    assert run(spark, path) == 2
    assert bronze(spark, path).count() == 2


def test_partitioned_landing_and_target(spark, path):
    days = spark.range(40).select("id", F.date_add(F.lit("2020-01-01"), (F.col("id") % 4).cast("int")).alias("day"))
    write_partitioned(days, path("src"), ["day"])
    run(spark, path, partition_by=["day"])
    table = spark.read.parquet(path("dst"))
    assert table.filter("day = date'2020-01-02'").count() == 10
    assert sorted(n for n in os.listdir(path("dst")) if n.startswith("day=")) == [
        f"day=2020-01-0{i}" for i in (1, 2, 3, 4)
    ]
    # a dynamic overwrite replaces the days it brings and no others
    write_partitioned(days.filter("id = 1"), path("src"), ["day"], overwrite_present_only=True)
    assert spark.read.parquet(path("src")).count() == 31


def test_running_trigger_keeps_the_stream_alive(spark, path):
    drop(spark, path, [(1,)], "k bigint")
    stream = run(spark, path, trigger="1 second")
    try:
        stream.processAllAvailable()
        drop(spark, path, [(2,)], "k bigint")
        stream.processAllAvailable()
        assert stream.isActive
    finally:
        stream.stop()
    assert bronze(spark, path).count() == 2


def test_typed_files_that_disagree(spark, path):
    load = lambda: ingest.ingest_typed_files(spark, path("src"), path("table"), path("meta"))
    drop(spark, path, [(1, 1.5)], "k bigint, v double")
    load()
    drop(spark, path, [(2, "7.25"), (3, "none")], "k bigint, v string")
    drop(spark, path, [(4, 9)], "k bigint, v int")
    drop(spark, path, [(5, 2.5, "x")], "k bigint, v double, extra string")
    load()
    load()
    got = {r["k"]: (r["v"], r["extra"], r["_rescued_data"]) for r in versions.read(spark, path("table")).collect()}
    assert got == {
        1: (1.5, None, None),
        2: (7.25, None, None),
        3: (None, None, '{"v":"none"}'),
        4: (9.0, None, None),
        5: (2.5, "x", None),
    }


def test_lossy_numbers_do_not_fit(spark):
    df = spark.createDataFrame([(1.0,), (1.5,), (1e12,)], "v double")
    rows = schemas.rescue_columns(df, StructType.fromDDL("v int")).collect()
    assert [r["v"] for r in rows] == [1, None, None]
    assert [r["_rescued_data"] is None for r in rows] == [True, False, False]


def test_copy_into_takes_each_file_once(spark, path):
    load = lambda: ingest.copy_into(spark, path("src"), path("table"))
    drop(spark, path, [(1,)], "k bigint")
    assert (load(), load()) == (1, 0)
    drop(spark, path, [(2,)], "k bigint")
    assert load() == 1
    assert sorted(r["k"] for r in versions.read(spark, path("table")).collect()) == [1, 2]


def test_copy_into_in_several_versions(spark, path):
    for k in range(5):
        drop(spark, path, [(k,)], "k bigint")
    assert ingest.copy_into(spark, path("src"), path("table"), files_per_version=2) == 5
    assert versions.latest_version(spark, path("table")) == 2
    assert sorted(r["k"] for r in versions.read(spark, path("table")).collect()) == list(range(5))


def test_copy_into_after_a_stop_before_the_commit(spark, path, monkeypatch):
    drop(spark, path, [(1,)], "k bigint")
    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            ingest.copy_into(spark, path("src"), path("table"))
    assert ingest.copy_into(spark, path("src"), path("table")) == 1
    assert versions.read(spark, path("table")).count() == 1


def test_small_business_files(spark, path):
    os.makedirs(path("docs"))
    with open(path("docs") + "/a.txt", "w") as f:
        f.write("héllo\nworld")
    with open(path("docs") + "/targets.csv", "w") as f:
        f.write("site_id,site_name,monthly_target_tons\n1,Ridge,100\n2,\"Peak, II\",200\n")
    docs = read_text_documents(spark, path("docs"), "*.txt")
    assert [r["text"] for r in docs.collect()] == ["héllo\nworld"]
    rows = load_targets(spark, path("docs") + "/targets.csv").collect()
    assert [tuple(r) for r in rows] == [(1, "Ridge", 100), (2, "Peak, II", 200)]
