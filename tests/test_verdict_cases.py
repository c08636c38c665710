"""Inputs that once lost or changed values silently."""

import os
import time

import pytest

from strata.operators.windows import bounded_rank, global_rank
from strata.plans import marts
from strata.streaming.ingest import ingest_files, read_bronze
from strata.streaming.tables import stream_upsert, table_stream
from strata.sources import versions

from pyspark.sql import functions as F


def test_ranks_agree_with_nulls_and_ties(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5.0, 5.0, None, 3.0, 7.0, None, 3.0, 1.0])], "id long, m double")
    one, other = bounded_rank(df, "m", "r"), global_rank(df, "m", "r", pieces=3)
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, other.select(*one.columns).collect()), key=repr)
    assert other.count() == 8


def test_measures_of_two_loads_count_a_site_once(spark):
    readings = spark.sql(
        "SELECT 1 site_id, DATE'2001-01-01' production_date, 10 tons_extracted, 2.0D mineral_grade_percent, 5.0D total_cost_usd, 1.0D operating_hours"
    )
    split = marts.site_day_measures(readings).union(marts.site_day_measures(readings))
    whole = marts.site_day_measures(readings.union(readings))
    for mart in (marts.executive_daily, marts.site_day_rollup):
        assert mart(split).collect() == mart(whole).collect()
    twice = spark.sql("SELECT 1 site_id, 'gold' primary_mineral").union(spark.sql("SELECT 1 site_id, 'gold' primary_mineral"))
    assert marts.production_by_mineral(split, twice).first()["site_count"] == 1


@pytest.mark.parametrize("shift", [-30 * 86400, 3600])
def test_files_of_any_time_are_ingested(spark, path, shift):
    def deliver(name, n):
        spark.range(n).coalesce(1).write.parquet(path(name))
        part = next(f for f in os.listdir(path(name)) if f.endswith(".parquet"))
        os.makedirs(path("landing"), exist_ok=True)
        os.rename(f"{path(name)}/{part}", f"{path('landing')}/{name}.parquet")
        return f"{path('landing')}/{name}.parquet"

    deliver("one", 3)
    assert ingest_files(spark, path("landing"), path("bronze"), path("meta")) == 3
    when = time.time() + shift
    os.utime(deliver("two", 5), (when, when))
    assert ingest_files(spark, path("landing"), path("bronze"), path("meta")) == 5
    assert read_bronze(spark, path("bronze"), path("meta")).count() == 8


def test_every_step_of_a_long_catch_up_is_counted(spark, path):
    spark.range(130).repartition(130).write.parquet(path("src"))
    rows = table_stream(spark, path("src"), maxFilesPerTrigger=1)
    from strata.streaming.tables import stream_table

    assert stream_table(rows, path("dst"), path("check")) == 130


def test_another_checkpoint_is_refused(spark, path):
    spark.range(5).write.parquet(path("src"))
    order = [F.desc("id")]
    stream_upsert(table_stream(spark, path("src")), path("dst"), ["id"], order, path("one"))
    spark.range(5, 10).write.mode("append").parquet(path("src"))
    with pytest.raises(Exception, match="new target"):
        stream_upsert(table_stream(spark, path("src")), path("dst"), ["id"], order, path("two"))
    stream_upsert(table_stream(spark, path("src")), path("dst"), ["id"], order, path("one"))
    assert versions.read(spark, path("dst")).count() == 10


def test_batch_loads_keep_partition_columns_and_old_columns(spark, path):
    from strata.streaming.ingest import copy_into

    first = spark.range(3).selectExpr("id", "id * 2 AS old", "DATE'2024-01-01' + cast(id AS int) AS day")
    first.write.partitionBy("day").parquet(path("landing"))
    assert copy_into(spark, path("landing"), path("table")) == 3
    spark.range(3, 5).selectExpr("id", "DATE'2024-02-01' AS day", "'x' AS new").write.partitionBy("day").mode("append").parquet(path("landing"))
    copy_into(spark, path("landing"), path("table"))
    got = versions.read(spark, path("table")).orderBy("id").collect()
    assert [(r["id"], r["old"], str(r["day"]), r["new"]) for r in got][2:4] == [(2, 4, "2024-01-03", None), (3, None, "2024-02-01", "x")]


def test_names_are_not_patterns(spark, path):
    from strata.streaming.ingest import copy_into

    os.makedirs(path("landing"))
    for i, name in enumerate(("x[1].json", "x1.json", "y*.json")):
        with open(f"{path('landing')}/{name}", "w") as f:
            f.write(f'{{"id": {i}}}\n')
    assert copy_into(spark, path("landing"), path("table"), "json") == 3
    assert sorted(r["id"] for r in versions.read(spark, path("table")).collect()) == [0, 1, 2]
