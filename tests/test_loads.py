import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans import loads, marts
from strata.sources import versions

KEYS = ["k"]
SCHEMA = "k int, day string, v int"

def by_day():
    return versions.part_by("day")


def put(spark, root, version, data):
    df = spark.createDataFrame(data, SCHEMA)
    seen = [] if version == 0 else [r["part"] for r in versions.live_parts(spark, root).collect()]
    versions.publish(df, root, version, "load", by_day(), seen)


def values(df):
    return sorted((r["k"], r["day"], r["v"]) for r in df.collect())


V0 = [(1, "mon", 1), (2, "mon", 1), (3, "tue", 1)]
V1 = [(1, "mon", 5), (3, "tue", 1), (4, "wed", 1)]
V2 = [(1, "tue", 5), (4, "wed", 2)]


def mirror(spark, path, parts=True):
    part = by_day() if parts else versions.WHOLE
    return loads.load_cdc(spark, path("src"), path("mirror"), path("state"), "m", KEYS, part)


@pytest.mark.parametrize("parts", [True, False])
def test_mirror_equals_source_and_rerun_does_nothing(spark, path, parts):
    put(spark, path("src"), 0, V0)
    assert mirror(spark, path, parts) == 0
    assert mirror(spark, path, parts) is None
    put(spark, path("src"), 1, V1)
    put(spark, path("src"), 2, V2)
    assert mirror(spark, path, parts) == 2
    assert values(versions.read(spark, path("mirror"))) == sorted(V2)
    assert mirror(spark, path, parts) is None
    assert loads.get_state(spark, path("state"), "m") == 2


def test_mirror_survives_a_stop_before_the_state_is_saved(spark, path, monkeypatch):
    put(spark, path("src"), 0, V0)
    mirror(spark, path)
    put(spark, path("src"), 1, V1)
    with monkeypatch.context() as patch:
        patch.setattr(loads, "save_state", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            mirror(spark, path)
    assert loads.get_state(spark, path("state"), "m") == 0
    assert mirror(spark, path) == 1
    assert values(versions.read(spark, path("mirror"))) == sorted(V1)


def test_mirror_takes_up_a_new_column(spark, path):
    put(spark, path("src"), 0, V0)
    mirror(spark, path)
    wider = spark.createDataFrame([(3, "tue", 2, "new")], SCHEMA + ", note string")
    versions.publish(wider, path("src"), 1, "merge", by_day(), ["ptue"])
    mirror(spark, path)
    rows = versions.read(spark, path("mirror")).select("k", "v", "note")
    assert sorted((tuple(r) for r in rows.collect()), key=repr) == [
        (1, 1, None), (2, 1, None), (3, 2, "new"),
    ]


def test_mirror_rewrites_only_the_parts_that_changed(spark, path):
    put(spark, path("src"), 0, V0)
    mirror(spark, path)
    put(spark, path("src"), 1, [(1, "mon", 1), (2, "mon", 1), (3, "tue", 7)])
    mirror(spark, path)
    by_part = {r["part"]: r["version"] for r in versions.live_parts(spark, path("mirror")).collect()}
    assert by_part == {"pmon": 0, "ptue": 1}


def audit(spark, path):
    return loads.load_audit(spark, path("src"), path("audit"), path("state"), "a", KEYS)


def test_audit_never_shrinks_and_repeats_nothing(spark, path, monkeypatch):
    put(spark, path("src"), 0, V0)
    audit(spark, path)
    put(spark, path("src"), 1, V1)
    with monkeypatch.context() as patch:
        patch.setattr(loads, "save_state", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            audit(spark, path)
    assert audit(spark, path) == 1
    rows = versions.read(spark, path("audit"))
    assert rows.count() == 5  # three at first, one update, one insert; the delete is ignored
    put(spark, path("src"), 2, [(1, "mon", 5)])  # deletes only
    assert audit(spark, path) == 2
    assert versions.read(spark, path("audit")).count() == 5
    assert audit(spark, path) is None
    states = {r["table_name"]: r["last_version"] for r in loads.load_state(spark, path("state")).collect()}
    assert states == {"a": 2}


def test_refresh_recomputes_only_changed_parts(spark, path):
    seen = []

    def build(df):
        seen.append({r["day"] for r in df.select("day").distinct().collect()})
        return df.groupBy("day").agg(F.sum("v").alias("v"))

    def refresh():
        return loads.load_changed_parts(
            spark, path("src"), path("gold"), path("state"), "g", build, by_day()
        )

    put(spark, path("src"), 0, V0)
    assert refresh() == 0 and refresh() is None
    versions.publish(
        spark.createDataFrame([(3, "tue", 4)], SCHEMA), path("src"), 1, "merge", by_day(), ["ptue", "pmon"]
    )
    assert refresh() == 1
    assert seen == [{"mon", "tue"}, {"tue"}]
    assert [tuple(r) for r in versions.read(spark, path("gold")).collect()] == [("tue", 4)]


READING = (
    "site_id int, production_datetime timestamp_ntz, production_date date, tons_extracted int,"
    " mineral_grade_percent double, operating_hours double, total_cost_usd double"
)


def readings(spark, hours):
    base = dt.datetime(2020, 1, 1)
    rows = [
        (s, base + dt.timedelta(hours=h), (base + dt.timedelta(hours=h)).date(), h, h / 3, 1.0, h * 1.01)
        for h in hours
        for s in (1, 2)
    ]
    return spark.createDataFrame(rows, READING)


def test_incremental_appends_once_and_merges_a_split_day(spark, path):
    root = path("gold")
    run = lambda hours: loads.load_incremental(
        readings(spark, hours), root, "production_datetime", date_col="production_date"
    )
    assert loads.get_watermark(spark, root) == loads.EPOCH
    assert run(range(30)) == 0
    assert run(range(30)) is None
    assert run(range(55)) == 1
    assert run(range(55)) is None
    assert loads.get_watermark(spark, root) == dt.datetime(2020, 1, 3, 6)
    merged = marts.merge_site_days(versions.read(spark, root))
    direct = marts.site_day_rollup(readings(spark, range(55)))
    assert merged.exceptAll(direct).isEmpty() and direct.exceptAll(merged).isEmpty()
    marks = versions.read(spark, root).select("_watermark_start").distinct().orderBy("_watermark_start")
    assert [r[0] for r in marks.collect()] == [loads.EPOCH, dt.datetime(2020, 1, 2, 5)]


def test_full_refresh_replaces_rows_and_schema(spark, path):
    source = readings(spark, range(5))
    assert loads.load_full(source, path("gold"), marts.site_day_rollup) == 0
    assert loads.load_full(source, path("gold"), lambda df: df.agg(F.count("*").alias("n"))) == 1
    now = versions.read(spark, path("gold"))
    assert now.columns == ["n", "_refreshed_at"] and now.first()["n"] == 10
    assert versions.read(spark, path("gold"), 0).count() == 2


def test_watermark_prunes_date_partitions(spark, path):
    readings(spark, range(100)).write.partitionBy("production_date").parquet(path("src"))
    late = loads.newer_than(
        spark.read.parquet(path("src")), "production_datetime", dt.datetime(2020, 1, 4, 5), "production_date"
    )
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "production_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert late.count() == 2 * (100 - 78)
