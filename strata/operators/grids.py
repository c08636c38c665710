"""Time spines and dense site-day grids, without cross joins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def time_spine(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Every hour from the start of ``first`` to the end of ``last``, generated in parallel."""
    hours = ((last - first).days + 1) * 24
    day = F.date_add(F.lit(first), F.floor(F.col("id") / 24).cast("int"))
    hour = (F.col("id") % 24).cast("int")
    return spark.range(hours).select(
        (day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour)).alias("production_datetime"),
        day.alias("production_date"),
        hour.alias("hour_of_day"),
    )


def site_day_grid(sites: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Every site on every day: each site row expands into its own days."""
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return sites.select("site_id", F.explode(days).alias("production_date"))


def extent(df: DataFrame, day: str) -> tuple[dt.date, dt.date]:
    """First and last day of a table."""
    row = df.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    return row["first"], row["last"]


def missing_site_days(sites: DataFrame, production: DataFrame) -> DataFrame:
    """Site-days of the covered period without a reading."""
    first, last = extent(production, "production_date")
    seen = production.select("site_id", "production_date").distinct()
    return site_day_grid(sites, first, last).join(seen, ["site_id", "production_date"], "left_anti")


def peer_access(members: DataFrame, member: str) -> DataFrame:
    """For each member, how many others may read what it owns: everyone but itself.

    The access rule itself is ``may_read``; the pairs are never listed.
    """
    total = members.agg(F.count(F.lit(1))).scalar()
    return members.select(member, (total - 1).alias("readers"))


def may_read(owner: str, viewer: str):
    """Access rule between peers."""
    return F.col(owner) != F.col(viewer)
