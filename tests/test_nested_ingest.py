"""Nested schemas, everything rescued, and one file list per batch."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sources import schemas, versions
from strata.streaming import ingest

DDL = StructType.fromDDL


def run(spark, path, fmt="parquet", **how):
    return ingest.ingest_files(spark, path("src"), path("dst"), path("meta"), fmt=fmt, **how)


def bronze(spark, path):
    return ingest.read_bronze(spark, path("dst"), path("meta"))


def lines(path, name, *text):
    os.makedirs(path("src"), exist_ok=True)
    with open(f"{path('src')}/{name}", "w") as f:
        f.write("\n".join(text) + "\n")
    return f"{path('src')}/{name}"


def rescued(df):
    return [None if r[0] is None else json.loads(r[0]) for r in df.select(schemas.RESCUED).collect()]


def test_nested_misfits_are_rescued_by_path(spark, path):
    schema = DDL("k int, p struct<x:int,y:int,q:struct<d:date>>, items array<struct<n:int>>, m map<string,int>, s string")
    lines(
        path, "a.json",
        '{"k":1,"p":{"x":"bad","y":7,"q":{"d":"soon"}},"items":[{"n":1},{"n":"two"},"three"],"m":{"a":1,"b":"x"},"s":{"o":1}}',
        '{"k":2,"p":"none","items":{"n":1},"m":[1],"s":"t"}',
        '{"k":3,"p":{"x":3,"w.w":{"deep":[1]},"v":null}}',
        '{"k":4,"p":null,"items":null}',
        '{"k":5,"p":{"x":',
        "[broken",
    )
    run(spark, path, "json", schema=schema, evolution="rescue")
    got = {r["k"]: r for r in bronze(spark, path).collect()}
    one = got[1].asDict(recursive=True)
    assert one["p"] == {"x": None, "y": 7, "q": {"d": None}} and one["items"] == [{"n": 1}, {"n": None}, None]
    assert one["m"] == {"a": 1, "b": None} and one["s"] == '{"o":1}'
    assert json.loads(one["_rescued_data"]) == {"p.x": "bad", "p.q.d": "soon", "items[1].n": "two", "items[2]": "three", "m[b]": "x"}
    assert json.loads(got[2]["_rescued_data"]) == {"p": "none", "items": '{"n":1}', "m": "[1]"} and got[2]["p"] is None
    assert json.loads(got[3]["_rescued_data"]) == {"p.w.w": '{"deep":[1]}'} and got[3]["p"]["x"] == 3
    assert got[4]["_rescued_data"] is None and got[4]["p"] is None
    broken = [r["_rescued_data"] for r in bronze(spark, path).collect() if r["k"] is None]
    assert sorted(json.loads(b)["_malformed"] for b in broken) == ["[broken", '{"k":5,"p":{"x":']


def test_inferred_json_takes_no_column_from_broken_lines(spark, path):
    lines(path, "a.json", '{"p":{"x":1}}', '{"p":{')
    run(spark, path, "json")
    assert bronze(spark, path).columns == ["p", "_rescued_data"]
    assert sorted(map(str, rescued(bronze(spark, path)))) == ["None", "{'_malformed': '{\"p\":{'}"]


def test_new_fields_inside_columns_by_mode(spark, path):
    old, new = "k long, p struct<x:long>, l array<struct<a:long>>, m map<string,struct<a:long>>", "k long, p struct<x:long,y:string>, l array<struct<a:long,b:long>>, m map<string,struct<a:long,c:long>>"
    drop = lambda ddl, row: spark.createDataFrame([row], ddl).coalesce(1).write.mode("append").parquet(path("src"))
    drop(old, (1, (1,), [(1,)], {"a": (1,)}))
    run(spark, path)
    drop(new, (2, (2, "y"), [(2, 3)], {"a": (2, 4)}))
    with pytest.raises(ValueError, match="p.y.*l.b.*m.c"):
        run(spark, path, evolution="fail_on_new_columns")
    run(spark, path, evolution="rescue")
    assert rescued(bronze(spark, path).filter("k = 2")) == [{"p.y": "y", "l[0].b": "3", "m[a].c": "4"}]
    drop(new, (3, (3, "z"), [(3, 5)], {"a": (3, 6)}))
    run(spark, path)
    rows = {r["k"]: (r["p"]["y"], r["l"][0]["b"], r["m"]["a"]["c"]) for r in bronze(spark, path).collect()}
    assert rows == {1: (None, None, None), 2: (None, None, None), 3: ("z", 5, 6)}


def test_typed_columns_of_another_kind(spark):
    df = spark.sql("SELECT named_struct('a', 1.5D, 'b', 'x') s, array('1', 'q') l, map('k', 300) m, 'text' t, named_struct('z', 1) u")
    got = schemas.rescue_columns(df, DDL("s struct<a:int,b:string>, l array<int>, m map<string,tinyint>, t struct<i:int>, u string")).first()
    assert (got["s"]["a"], got["s"]["b"], got["l"], got["m"], got["t"], got["u"]) == (None, "x", [1, None], {"k": None}, None, '{"z":1}')
    assert json.loads(got["_rescued_data"]) == {"s.a": "1.5", "l[1]": "q", "m[k]": "300", "t": "text"}


def test_csv_surplus_fields_short_lines_and_headers_in_another_order(spark, path):
    lines(path, "a.csv", "k,v,w", "1,one,1.5", "2,two", '3,"three, and",x,more,"and, more"', "4,four,2.5,")
    lines(path, "b c%20.csv", "w,k,extra", "9.5,5,e", "bad,6,f")
    run(spark, path, "csv", schema=DDL("k int, v string, w double"))
    rows = {r["k"]: r for r in bronze(spark, path).collect()}
    assert [(k, rows[k]["v"], rows[k]["w"], rows[k]["extra"]) for k in sorted(rows)] == [
        (1, "one", 1.5, None), (2, "two", None, None), (3, "three, and", None, None), (4, "four", 2.5, None), (5, None, 9.5, "e"), (6, None, None, "f"),
    ]
    kept = {k: r["_rescued_data"] and json.loads(r["_rescued_data"]) for k, r in rows.items()}
    assert kept[3] == {"w": "x", "_malformed": '3,"three, and",x,more,"and, more"'} and kept[6] == {"w": "bad"}
    assert kept[4] == {"_malformed": "4,four,2.5,"} and not any(kept[k] for k in (1, 2, 5))


def test_a_file_from_the_future_hides_no_later_column(spark, path):
    lines(path, "a.json", '{"id":1}')
    ahead = time.time() + 30 * 86400
    os.utime(f"{path('src')}/a.json", (ahead, ahead))
    assert run(spark, path, "json") == 1
    lines(path, "b.json", '{"id":2,"note":"new"}')
    assert run(spark, path, "json") == 1
    assert {r["id"]: r["note"] for r in bronze(spark, path).collect()} == {1: None, 2: "new"}


def test_a_later_run_reads_only_the_files_of_its_list(spark, path, monkeypatch):
    lines(path, "a.json", '{"id":1}')
    run(spark, path, "json")
    looked_at = []
    infer = schemas.infer
    monkeypatch.setattr(schemas, "infer", lambda s, fmt, options, paths: looked_at.append(paths) or infer(s, fmt, options, paths))
    assert run(spark, path, "json") == 0 and not looked_at
    old = time.time() - 90 * 86400
    os.utime(lines(path, "b.json", '{"id":2,"note":"old file"}'), (old, old))
    assert run(spark, path, "json") == 1
    assert [[os.path.basename(p) for p in paths] for paths in looked_at] == [["b.json"]]
    assert {r["id"]: r["note"] for r in bronze(spark, path).collect()} == {1: None, 2: "old file"}


def test_a_batch_that_stopped_is_repeated_from_its_own_list(spark, path, monkeypatch):
    lines(path, "a.json", '{"id":1}')
    mark = ingest.small_frame

    def stop(session, columns):
        if "rows" in columns:
            raise RuntimeError("stopped")
        return mark(session, columns)

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "small_frame", stop)
        with pytest.raises(RuntimeError):
            run(spark, path, "json")
    lines(path, "b.json", '{"id":2}')
    assert run(spark, path, "json") == 2
    assert sorted(r["id"] for r in bronze(spark, path).collect()) == [1, 2]


def test_many_small_batches_and_a_running_stream_share_the_log(spark, path):
    for i in range(5):
        lines(path, f"{i}.json", json.dumps({"id": i}))
    assert run(spark, path, "json", files_per_batch=2) == 5
    lines(path, "5.json", '{"id":5,"late":true}')
    stream = run(spark, path, "json", trigger="1 second")
    try:
        stream.processAllAvailable()
        lines(path, "6.json", '{"id":6}')
        stream.processAllAvailable()
    finally:
        stream.stop()
    assert run(spark, path, "json") == 0
    assert sorted((r["id"], r["late"]) for r in bronze(spark, path).collect() if r["id"] != 5) == [(i, None) for i in (0, 1, 2, 3, 4, 6)]


def test_typed_files_that_disagree_are_grouped_by_tasks(spark, path, monkeypatch):
    drop = lambda ddl, *rows: spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").partitionBy("day").parquet(path("src"))
    for day in ("2024-01-01", "2024-01-02"):
        drop("k long, v double, day string", (1, 1.5, day))
        drop("k long, v string, day string", (2, "2.5", day), (3, "none", day))
    monkeypatch.setattr(ingest, "_one_by_one", lambda s, fmt, paths: [] if not paths else pytest.fail("a job per file"))
    ingest.ingest_typed_files(spark, path("src"), path("table"), path("meta"))
    got = sorted((str(r["day"]), r["k"], r["v"]) for r in versions.read(spark, path("table")).fillna(-1.0, ["v"]).collect())
    assert [g for g in got if g[0] == "2024-01-01"] in ([("2024-01-01", 1, 1.5), ("2024-01-01", 2, 2.5), ("2024-01-01", 3, -1.0)], [("2024-01-01", 1, "1.5"), ("2024-01-01", 2, "2.5"), ("2024-01-01", 3, "none")])
    assert len(got) == 6


def test_partitions_of_the_landing_folder_reach_the_target_and_prune(spark, path):
    rows = spark.range(20).selectExpr("id", "named_struct('a', id) p", "DATE'2024-01-01' + cast(id % 4 AS int) day")
    rows.write.partitionBy("day").parquet(path("src"))
    run(spark, path, partition_by=["day"])
    table = bronze(spark, path)
    plan = table.filter("day = DATE'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and table.filter("day = DATE'2024-01-02'").count() == 5
    assert table.agg(F.sum("p.a")).first()[0] == 190
