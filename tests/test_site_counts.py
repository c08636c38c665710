"""Sites per mineral and day, counted without a second hash table of all sites and days."""

import datetime as dt

from pyspark.sql import functions as F

from strata.plans import marts

READINGS = "site_id long, production_date date, tons_extracted int, mineral_grade_percent double, operating_hours double, total_cost_usd double"


def readings(spark):
    day = dt.date(2001, 1, 1)
    rows = [(s, day + dt.timedelta(days=d), 10, 0.5, 1.0, 2.0) for s in range(6) for d in range(s % 3 + 1) for _ in range(2)]
    return spark.createDataFrame([*rows, (None, day, 1, 0.5, 1.0, 2.0)], READINGS)


def test_repeated_sites_count_once(spark):
    rows = [(0, "iron"), (1, "iron"), (2, "iron"), (2, "iron"), (2, "gold"), (3, "gold"), (4, None), (5, None), (None, "iron")]
    got = marts.production_by_mineral(readings(spark), spark.createDataFrame(rows, "site_id long, primary_mineral string"))
    sites = {(r["primary_mineral"], r["production_date"].day): (r["site_count"], r["total_tons_extracted"]) for r in got.collect()}
    assert sites == {
        ("iron", 1): (3, 80), ("iron", 2): (2, 60), ("iron", 3): (1, 40), ("gold", 1): (2, 40), ("gold", 2): (1, 20),
        ("gold", 3): (1, 20), (None, 1): (2, 40), (None, 2): (2, 40), (None, 3): (1, 20),
    }


def test_sites_and_days_are_hashed_once(spark, capsys):
    sites = spark.range(6).select(F.col("id").alias("site_id"), F.lit("iron").alias("primary_mineral"))
    marts.production_by_mineral(readings(spark), sites).explain()
    plan = capsys.readouterr().out
    # readings to site and day, those to mineral and day; each in two steps
    assert plan.count("HashAggregate(") == 4 and "distinct" not in plan
