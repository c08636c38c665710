"""The layers in their order: landing files to bronze, silver and gold tables.

Each step may run again at any time: streams take only new rows, gold marts are
refreshed whole. Tables lie under ``base/<layer>/<name>``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.joins import broadcast_if_small
from strata.operators.quality import expect_drop, expect_fail
from strata.operators.scd2 import scd2_current
from strata.plans import loads, marts
from strata.sources import versions
from strata.sources.schemas import RESCUED
from strata.streaming import ingest, tables

SITES, PRODUCTION, EQUIPMENT = "mine_sites", "daily_production", "equipment_maintenance"
KEYS = {SITES: "site_id", PRODUCTION: "site_id", EQUIPMENT: "equipment_id"}
Result = TypeVar("Result")


def _together(steps: dict[str, Callable[[], Result]]) -> dict[str, Result]:
    """Steps that do not need each other, begun at once: one plans while another's tasks run.

    All of them end before the first error is raised; what one has done, its repetition finds done.
    """
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        begun = {name: pool.submit(step) for name, step in steps.items()}
    return {name: step.result() for name, step in begun.items()}


def run_bronze(spark: SparkSession, landing: dict[str, str], base: str, fmt: str = "parquet") -> dict[str, int]:
    """Ingest the landing folder of each table; a missing key aborts the step."""

    def load(name: str) -> int:
        rules = {"not_empty": F.col(KEYS[name]).isNotNull()}
        return ingest.ingest_files(spark, landing[name], f"{base}/bronze/{name}", f"{base}/meta/bronze/{name}", fmt, rules=rules)

    return _together({name: partial(load, name) for name in landing})


def bronze(spark: SparkSession, base: str, name: str) -> DataFrame:
    return ingest.read_bronze(spark, f"{base}/bronze/{name}", f"{base}/meta/bronze/{name}")


def run_silver(spark: SparkSession, base: str, tie_break: str) -> None:
    """Pass sites and readings through range checks; keep the history of equipment.

    ``tie_break`` is the column whose greater value wins among equipment rows of one
    key and day.
    """

    def clean(name: str) -> None:
        rows = tables.table_stream(spark, f"{base}/bronze/{name}", bronze(spark, base, name).schema)
        to, checkpoint = f"{base}/silver/{name}", f"{base}/meta/silver/{name}"
        if name == EQUIPMENT:
            keys, order = ["equipment_id", "site_id"], [F.desc(tie_break)]
            tables.stream_scd2(_clean(rows, name), to, keys, "last_maintenance_date", order, checkpoint)
        else:
            tables.stream_table(rows, to, checkpoint, lambda df: _clean(df, name))

    _together({name: partial(clean, name) for name in (SITES, PRODUCTION, EQUIPMENT)})


def _clean(rows: DataFrame, name: str) -> DataFrame:
    rows = rows.drop(RESCUED)
    if name == PRODUCTION:
        return expect_drop(
            rows,
            {
                "tons": F.col("tons_extracted") >= 0,
                "grade": F.col("mineral_grade_percent").between(0, 100),
            },
        )
    if name == EQUIPMENT:
        known = expect_fail(rows, {"not_empty": F.col("equipment_id").isNotNull()})
        return expect_drop(
            known,
            {"valid_equipment_id": F.col("equipment_id") > 0, "valid_site": F.col("site_id").isNotNull()},
        )
    return rows


def silver(spark: SparkSession, base: str, name: str) -> DataFrame:
    if name == EQUIPMENT:
        return versions.read(spark, f"{base}/silver/{name}")
    return spark.read.schema(bronze(spark, base, name).drop(RESCUED).schema).parquet(f"{base}/silver/{name}")


def run_gold(spark: SparkSession, base: str, as_of: dt.date, run_ts: dt.datetime | None = None) -> list[str]:
    """Refresh all marts. The readings are scanned and shuffled once, for the site-day table."""
    loads.load_full(silver(spark, base, PRODUCTION), f"{base}/gold/site_day", marts.site_day_measures, run_ts)
    measures = gold(spark, base, "site_day").drop("_refreshed_at")  # one load, so added up already
    sites = broadcast_if_small(silver(spark, base, SITES))
    fleet = scd2_current(silver(spark, base, EQUIPMENT))
    results = {
        "daily_production_summary": lambda: marts.site_day_rollup(measures, added_up=True),
        "production_by_site": lambda: marts.production_by_site(measures, sites, added_up=True),
        "production_by_mineral": lambda: marts.production_by_mineral(measures, sites, added_up=True),
        "executive_summary_daily": lambda: marts.executive_daily(measures, added_up=True),
        "site_performance_ranked": lambda: marts.site_performance(measures, sites, as_of, added_up=True),
        "equipment_health_by_site": lambda: marts.equipment_health_by_site(fleet, sites, as_of),
        "equipment_maintenance_due": lambda: marts.maintenance_due(fleet, sites, as_of),
        "equipment_risk_summary": lambda: marts.equipment_risk(fleet, sites),
        "fleet_snapshot": lambda: marts.fleet_snapshot(fleet, sites, as_of),
    }

    def refresh(name: str) -> int:
        return loads.load_full(results[name](), f"{base}/gold/{name}", lambda df: df, run_ts)

    _together({name: partial(refresh, name) for name in results})
    return list(results)


def gold(spark: SparkSession, base: str, name: str, version: int | None = None) -> DataFrame:
    return versions.read(spark, f"{base}/gold/{name}", version)
